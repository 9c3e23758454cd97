"""The Jaccard join's two passes and its rounds against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from membra.llm import jaccard

PASSAGE = " ".join(f"p{i}" for i in range(55))


def sets_of(texts):
    out = []
    for t in texts:
        w = t.lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def smallest_reachable(sets):
    comp = list(range(len(sets)))

    def find(i):
        while comp[i] != i:
            comp[i] = comp[comp[i]]
            i = comp[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                a, b = sorted((find(i), find(j)))
                comp[b] = a
    return [find(i) for i in range(len(sets))]


@pytest.fixture(scope="module")
def texts():
    rnd, out = random.Random(5), []
    for fam in range(16):
        base = [f"f{fam}w{rnd.randrange(40)}" for _ in range(rnd.choice((12, 20, 60, 140)))]
        for _ in range(14):
            t = list(base)
            for _ in range(rnd.randrange(0, max(2, len(t) // 18))):
                t[rnd.randrange(len(t))] = f"x{rnd.randrange(10**6)}"
            if rnd.random() < 0.2:
                t = t[: rnd.randrange(1, len(t) + 1)]
            if rnd.random() < 0.5:  # a passage that many share, in front or behind
                t = [PASSAGE, *t] if rnd.random() < 0.5 else [*t, PASSAGE]
            out.append(" ".join(t))
    out += [PASSAGE] * 9 + out[:20] + [""]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("lowered", [{}, {"ROUNDS": 0, "LIST_CHUNK": 2, "CELL": 5, "HOT_SHARE": 0.05, "PART_MEMBERS": 900},
                                     {"ROUNDS": 1, "LIST_CHUNK": 3, "CELL": 9, "HOT_SHARE": 0.002, "MOST_BITS": 1 << 15}])
def test_join_against_brute_force(spark, texts, monkeypatch, lowered):
    for name, value in lowered.items():
        monkeypatch.setattr(jaccard, name, value)
    got = jaccard.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    sets = sets_of(texts)
    want = smallest_reachable(sets)
    assert len(set(want)) < len(want) - 60  # the fixture holds links
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (len(s), want[i]) for i, s in enumerate(sets)}


def test_leading_members_of_links_are_shared():
    """Worst cases: the members that aren't common come first in both sets."""
    for n in range(1, 400):
        for m in range(n, min(-(-5 * n // 4) + 1, 400)):
            common = jaccard.least_overlap(n, m)
            if common > n:
                continue
            sent = [min(common, jaccard.lead_length(k) - (k - common)) for k in (n, m)]
            assert min(sent) >= max(jaccard.lead_shared(n), jaccard.lead_shared(m)), (n, m)


@pytest.mark.parametrize("most", [1 << 15, 1 << 20])
def test_bitmap_lets_every_wanted_document_through(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard, "MOST_BITS", most)
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    ids = docs.where("doc_id % 13 = 0").select("doc_id")
    got = jaccard._only(docs, ids, ids.count())
    assert got.columns == docs.columns
    assert ids.join(got, "doc_id", "left_anti").count() == 0
    assert got.count() < (40_000 if most == 1 << 15 else 6_500)
    assert jaccard._only(docs, ids.limit(0), 0).count() == 0
