"""op2 learns from, calibrates on and sets its thresholds by all labelled rows."""

import numpy as np

from membra.llm import toxicity


def _tables(spark, n, words):
    rng = np.random.default_rng(5)
    plain = [f"plain{i}" for i in range(40)]
    rows = []
    for i in range(n):
        body = rng.choice(plain, words).tolist()
        if i % 3 == 0:
            body[int(rng.integers(words))] = "vile"
        rows.append((i, " ".join(body), ("en", "fr", None)[i % 5 % 3]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(n)], "doc_id long, toxic int")


def test_long_texts_are_learned_from(spark):
    docs, labels = _tables(spark, 60, 9_000)  # over 60,000 bytes each
    net, slope, _, cuts = toxicity.train(docs, labels)
    assert len(net.rows) > 40 and slope != 0 and cuts


def test_all_labelled_rows_count(spark, monkeypatch):
    docs, labels = _tables(spark, 600, 12)
    seen, binned = [], toxicity._binned

    def watch(held, net):
        got = binned(held, net)
        seen.append((held.count(), sum(int(n.sum()) for *_, n in got)))
        return got

    monkeypatch.setattr(toxicity, "_binned", watch)
    learned, one_round = [], toxicity.one_round
    monkeypatch.setattr(toxicity, "one_round", lambda learn, *a: (learned.append(learn.count()), one_round(learn, *a))[1])
    model = toxicity.train(docs, labels, shard_rows=120)
    assert set(seen) == {(600 - learned[0], 600 - learned[0])} and set(learned) == {learned[0]} and learned[0] > 400
    got = toxicity.with_language_threshold(toxicity.predict(docs, model, ["doc_id", "lang"]), model).collect()
    assert np.mean([r["toxic_by_lang"] == (r["doc_id"] % 3 == 0) for r in got]) >= 0.95
    again = toxicity.train(docs.repartition(5), labels.repartition(3), shard_rows=120)
    assert again[1:] == model[1:] and all(np.array_equal(again[0].p[k], v) for k, v in model[0].p.items())


def test_best_cut_of_counted_rows():
    p, y, n = np.array([0.9, 0.8, 0.8, 0.2]), np.array([1, 1, 0, 0]), np.array([3, 2, 1, 50])
    assert toxicity._best_cut(p, y, n) == toxicity._best_cut(np.repeat(p, n), np.repeat(y, n)) == 0.5


def test_only_texts_are_shuffled_and_only_learned_rows_written(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(8)
    vocabulary = np.array([f"{'abcdefgh'[i % 8]}{i * 7919 % 3001}x" for i in range(3000)])
    rows = [(i, " ".join(rng.choice(vocabulary, 400)), "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    plans, map_text, learned = [], toxicity.map_text, []
    monkeypatch.setattr(toxicity, "shared_path", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(toxicity, "map_text", lambda df, *a: (plans.append((df.columns, df._jdf.queryExecution().toString())), map_text(df, *a))[1])
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    used = toxicity._used_rows
    monkeypatch.setattr(toxicity, "_used_rows", lambda learn: (learned.append(learn.count()), used(learn))[1])
    toxicity.train(docs, labels, shard_rows=50)
    # the deal comes before the texts become rows, and held texts aren't dealt
    assert {"shard" in columns: "Repartition" in plan for columns, plan in plans} == {True: True, False: False}
    assert 100 < learned[0] < 200 and spark.read.parquet(str(tmp_path / "toxicity-rows")).count() == learned[0]
    size = sum(f.stat().st_size for f in (tmp_path / "toxicity-rows").rglob("*.parquet"))
    assert size < 0.75 * sum(len(r[1]) for r in rows)


def test_model_does_not_follow_how_shards_are_read(spark):
    docs, labels = _tables(spark, 400, 10)
    model = toxicity.train(docs, labels, shard_rows=100)
    layout = {"spark.sql.files.openCostInBytes": "0", "spark.sql.execution.arrow.maxRecordsPerBatch": "64"}
    had = {k: spark.conf.get(k) for k in layout}
    try:
        for k, v in layout.items():
            spark.conf.set(k, v)
        again = toxicity.train(docs, labels, shard_rows=100)
    finally:
        for k, v in had.items():
            spark.conf.set(k, v)
    assert again[1:] == model[1:] and all(np.array_equal(again[0].p[k], v) for k, v in model[0].p.items())
