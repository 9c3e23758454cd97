"""Operators against brute force, the libraries and odd rows."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from membra.llm import jaccard, langid, neardup, packing, pieces, planes, quality, repetition, sharding, toxicity
from membra.llm.common import shared_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{i}" for i in range(60))
TEXTS = [None, "", "   ", "!!! ...", "Ab\ncd", "ab CD", BASE, BASE + " tail", BASE.upper(), BASE.replace("w3 ", "x "), "a b c d",
         "A b C d", "a b c d e", "x " * 400, ("one two three four five six seven eight\n" * 30), "İ é 日本 " * 50, "y" * 30_000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else "de", i, "clash") for i, t in enumerate(TEXTS)]
    rows += [(6, BASE, "en", 6, "clash"), (None, BASE, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score long, Shard string")


def test_jaccard_against_brute_force(docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(docs).collect() if r["doc_id"] is not None}

    def shingles(t):
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for t in TEXTS]
    comp = list(range(len(TEXTS)))
    for _ in TEXTS:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    assert got == {i: (len(s), comp[i]) for i, s in enumerate(sets)}


def test_jaccard_small_sets_share_subsets():
    assert [jaccard.least_overlap(4, 5), jaccard.least_overlap(4, 4), jaccard.least_overlap(500, 500)] == [4, 4, 445]


def test_sharding_is_gapless_near_equal_and_keeps_groups(spark, docs):
    out = sharding.shard_by_bytes(docs).collect()
    assert len(out) == docs.count() and {"lang", "score"} <= set(out[0].asDict())
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr(
        "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else repeat('z', int(id % 90)) || id end").alias("text"))
    rows = sharding.shard_by_bytes(many).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    total = sum(r["size"] for r in rows)
    assert max(abs(sum(r["size"] for r in v) - total / 8) for v in by.values()) <= 0.011 * total / 8 + 91
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    assert sharding.shard_by_bytes(many.limit(0)).count() == 0


def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 16))
    x = np.concatenate([base, base[:40] + rng.normal(size=(40, 16)) * 0.03, base[:5], np.repeat(base[7:8], 60, 0) + rng.normal(size=(60, 16)) * 0.02])
    rows = [(i, v.tolist(), int(i % 2 if i < 150 else (i - 150) % 2 if i < 195 else 1)) for i, v in enumerate(x)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, x[0].tolist(), None), (904, [], 1), (None, x[1].tolist(), 1)]
    got = {r["vec_id"]: r for r in neardup.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")).collect()}
    u, lab = x / np.linalg.norm(x, axis=1)[:, None], np.array([r[2] for r in rows])
    link = (u @ u.T >= 0.98) & (lab[:, None] == lab[None])
    np.fill_diagonal(link, False)
    comp = np.arange(len(x))
    for _ in range(50):
        comp = np.minimum(comp, np.where(link, comp[None], len(x)).min(1))
    assert [got[i]["n_links"] for i in range(len(x))] == link.sum(1).tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == comp.tolist()
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i for i in (900, 901, 902, 903, 904))


def test_near_duplicates_in_dense_groups_against_brute_force(spark, monkeypatch):
    """Groups larger than a window, over several blocks: no link is lost."""
    monkeypatch.setattr(neardup, "BLOCK", 700)
    monkeypatch.setattr(neardup, "OWN", 100, raising=False)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(4, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    x = np.concatenate([base[0] + rng.normal(size=(3000, 64)) * 0.0227] + [b + rng.normal(size=(150, 64)) * 0.015 for b in base[1:]])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = {r["vec_id"]: r for r in neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    assert 0.966 < (u[:3000] @ u[:3000].T).mean() < 0.970
    link = u @ u.T >= 0.98
    np.fill_diagonal(link, False)
    comp = np.arange(len(x))
    for _ in range(50):
        comp = np.minimum(comp, np.where(link, comp[None], len(x)).min(1))
    assert [got[i]["n_links"] for i in range(len(x))] == link.sum(1).tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == comp.tolist()
    assert [got[i]["kept"] for i in range(len(x))] == (comp == np.arange(len(x))).tolist()


def test_repetition_against_brute_force(docs):
    for r in repetition.apply_rules(docs.where("doc_id is not null"), ["doc_id", "lang"]).collect():
        w = WORD.findall(TEXTS[r["doc_id"]] or "")
        seen, cover = {}, set()
        for i in range(len(w) - 7):
            seen.setdefault(tuple(w[i : i + 8]), []).append(i)
        for at in seen.values():
            if len(at) > 1:
                cover |= {i + j for i in at for j in range(8)}
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(cover))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(cover) > 30 * len(w))
    assert repetition.spans("a b c d x a b c d") == [(0, 4), (5, 9)]


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_plane_files_round_trip(spark, docs, kind):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(planes.default_path())
    files = planes.write(docs, shared_path(spark, "planes"), kind=kind, block_ids=100)
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in planes.read(spark, files).orderBy("start").collect()]
    want, at = [], 0
    for i, t in [(None, BASE)] + sorted([*enumerate(TEXTS), (6, BASE)], key=lambda r: r[0]):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    assert planes.read(spark, planes.write(docs.limit(0), shared_path(spark, "planes"))).count() == 0


def test_plane_files_order_repeated_ids_by_text_hash(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(planes.default_path())
    docs = spark.createDataFrame([(i, f"text {k} of {i}" * (k % 3 + 1)) for i in (5, 2) for k in range(40)], "doc_id long, text string").repartition(4)
    got = [(r["doc_id"], r["ids_crc32"]) for r in planes.read(spark, planes.write(docs, shared_path(spark, "planes"))).orderBy("start").collect()]
    want = [(r["doc_id"], zlib.crc32(np.array(tok.encode(r["text"], add_special_tokens=False).ids + [2], dtype="<u4").tobytes()))
            for r in sorted(docs.withColumn("h", F.xxhash64(F.col("text").cast("binary"))).collect(), key=lambda r: (r["doc_id"], r["h"]))]
    assert got == want


def test_pieces_equal_the_library(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    for r in pieces.encode(docs.where("doc_id is not null"), ["doc_id"]).collect():
        assert r["ids"] == sp.encode(TEXTS[r["doc_id"]] or "")
        assert r["decoded_crc32"] == zlib.crc32((TEXTS[r["doc_id"]] or "").encode())


def test_pieces_decode_stored_ids(spark, docs):
    path = shared_path(spark, "ids")
    odd = spark.createDataFrame([(0, "snow \u2603 \U0001f9ff \u0b95"), (1, ""), (2, None)], "doc_id long, text string")
    for d in (docs.where("doc_id is not null").select("doc_id", "text"), odd):
        pieces.encode(d, ["doc_id", "text"]).selectExpr("doc_id", "text as was", "ids").write.mode("overwrite").parquet(path)
        got = pieces.decode(spark.read.parquet(path), ["doc_id", "was"]).collect()
        assert len(got) == d.count() and all(r["text"] == (r["was"] or "") for r in got)
    bad = spark.createDataFrame([(0, None), (1, []), (2, [5, None]), (3, [-1]), (4, [10**9])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in pieces.decode(bad, ["doc_id"]).collect()} == {0: None, 1: "", 2: None, 3: None, 4: None}
    assert pieces.decode(bad.limit(0), ["doc_id"]).count() == 0


def test_pieces_of_a_chunk_shorter_than_the_longest_piece():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    matcher = pieces.Matcher(pieces.load(pieces.default_path()))
    for text in ("a", "...", "\u2603"):
        assert np.frombuffer(b"".join(matcher.encode([pieces.MARK + text])), "<u4").tolist() == sp.encode(text)


def test_packing_places_every_piece(docs):
    out = packing.pack(docs).collect()
    seqs = {}
    for r in out:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for v in seqs.values():
        v.sort()
        assert [o for o, _ in v] == np.cumsum([0] + [n for _, n in v])[:-1].tolist() and sum(n for _, n in v) <= 2048
    assert len([r for r in out if r["doc_id"] == 0]) == 1 and packing.pack(docs.limit(0)).count() == 0
    hist = {k: k % 7 + 1 for k in range(1, 2048)}
    plan = packing.plan(hist)
    assert max(p[2] + p[3] for p in plan) <= 1.02 * sum(k * n for k, n in hist.items()) / 2048


def test_classifiers_on_odd_rows_and_none(docs, spark):
    labels = spark.createDataFrame([(i, i % 2, int(i in (6, 7))) for i in range(17)] + [(3, None, None)], "doc_id long, quality int, toxic int")
    out = langid.predict(docs, langid.train(docs), docs.columns).collect()
    assert len(out) == docs.count() and {r["lang_pred"] for r in out if r["text"] in (None, "", "   ", "!!! ...")} == {"und"}
    assert langid.predict(docs, langid.train(docs.limit(0)), ["doc_id"]).where("lang_pred != 'und'").count() == 0
    for mod, label in ((quality, "quality"), (toxicity, "toxic")):
        for some in (labels, labels.limit(0)):
            got = mod.predict(docs, mod.train(docs, some, label), docs.columns).collect()
            assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_pipeline_stages_on_the_small_tables(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = P.run(spark, sf)
    kept = {r[0] for r in out.select("doc_id").distinct().collect()}
    assert 0 < len(kept) < docs.count()
    first = P.language(spark, docs, sf)
    assert first.columns == docs.columns and first.count() == docs.where("text is not null").count()


def test_pipeline_near_duplicates_of_repeated_and_missing_ids(spark):
    import corpus_pipeline as P

    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in ("north", "south", "west"))
    near = a + " and"
    rows = [(1, a), (1, b), (2, near), (3, b), (None, c), (None, c), (None, near), (4, "so"), (4, "so"), (5, ""), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = P.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    want = [(1, a), (1, b), (None, c), (4, "so"), (5, ""), (6, None)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert P.near_duplicates(spark, docs.limit(0), "").count() == 0
