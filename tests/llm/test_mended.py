"""Ids before punctuation, packing against best fit, packed ids, null ids,
and the pipeline's row numbers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from membra.llm import langid, packing, quality, toxicity
from membra.llm.common import is_held_out
from membra.llm.tokens import Encoder, default_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


def test_ids_of_every_letter_before_punctuation(library):
    letters = [c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x10000), *range(0x10400, 0x10450), 0x1D15E, 0x2F800]) if c.isalpha()]
    texts = [f"{c}{p}" for c in letters for p in ",!"] + [f"a{c}." for c in letters]
    ids, count = Encoder(default_path()).encode([t.encode() for t in texts])
    at = np.concatenate([[0], np.cumsum(count)])
    want = library.encode_batch_fast(texts, add_special_tokens=False)
    assert [t for i, t in enumerate(texts) if ids[at[i] : at[i + 1]].tolist() != want[i].ids] == []


def test_ids_of_random_texts(library):
    rnd, enc = random.Random(11), Encoder(default_path())
    letters = [*"aabcdEFG',.!?;: 01", *"éßİΣςﬁ日क़ড়ǅ̇", "́"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(30))) for _ in range(5000)]
    ids, count = enc.encode([t.encode() for t in texts])
    at = np.concatenate([[0], np.cumsum(count)])
    for i, e in enumerate(library.encode_batch_fast(texts, add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == e.ids, texts[i]


def used(plan):
    return sum({(r[3], r[2]): r[2] for r in plan}.values())


@pytest.mark.parametrize("seed", range(6))
def test_packing_never_needs_more_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    n = [300, 3000, 10_000][seed % 3]
    lengths = np.clip(rng.lognormal(5 + seed % 2, 1.1, n).astype(int), 1, 2047) if seed < 4 else rng.integers(1, 2048, n)
    hist = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    plan = packing.plan(hist)
    plain = sum(c for c, _ in packing._best_fit([], dict(hist), packing.CAPACITY, fresh=True))
    assert used(plan) <= plain and used(plan) >= -(-int(lengths.sum()) // packing.CAPACITY)
    ranks, place = {}, {}
    for k, first, rows, seq, at in plan:
        ranks[k] = ranks.get(k, 0) + rows
        for i in range(rows):
            place.setdefault(seq + i, []).append((at, k))
    assert ranks == hist
    for items in place.values():
        end = 0
        for at, k in sorted(items):
            assert at == end
            end += k
        assert end <= packing.CAPACITY


def test_packed_sequences_hold_the_ids(spark, library):
    texts = [None, "", "a b c", "x " * 5000, "İ, don't!", "x " * 2047, "y " * 2046]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = {}
    for r in packing.sequences(packing.pack(docs, with_ids=True)).collect():
        assert len(r["ids"]) <= packing.CAPACITY and len(r["ids"]) == sum(p["length"] for p in r["parts"])
        for p in r["parts"]:
            got.setdefault(p["doc_id"], []).append((p["piece"], r["ids"][p["offset"] : p["offset"] + p["length"]]))
    for i, t in enumerate(texts):
        want = library.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        assert [x for _, part in sorted(got[i]) for x in part] == want


def test_rows_without_an_id_are_held_out(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,), (4,)], "doc_id long")
    got = [r[0] for r in df.select(is_held_out("doc_id", 3, 1)).collect()]
    assert got[0] is True and None not in got
    for m in (langid, quality, toxicity):
        assert m.is_held_out is is_held_out


@pytest.mark.parametrize("files", [True, False])
def test_pipeline_near_duplicates_by_place_in_file(spark, tmp_path, files):
    body = " ".join(f"w{i}" for i in range(50))
    rows = [(5, body, "en"), (3, body, "en"), (3, "other words of another text here", "en"), (None, body + " tail", "en"),
            (None, "only one", None), (7, None, "en"), (7, None, "en"), (8, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    if files:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    numbered, name = corpus_pipeline._row_numbers(docs)
    assert numbered.select(name).distinct().count() == len(rows)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [(3, body, "en"), (3, "other words of another text here", "en"), (None, "only one", None),
         (7, None, "en"), (7, None, "en"), (8, "", "en")], key=repr)
