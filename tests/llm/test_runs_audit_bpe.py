"""Periodic runs, the filter audit and BPE against brute force and the library."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from membra.llm import audit, bpe, runs
from membra.llm.common import Words

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \t\n ", "one", "x " * 400, "a b " * 40 + "c", ("p q r s t u v w " * 3) + "end", "y" * 30_000, "İ é 日本 " * 50,
       "don't STOP!!'s 123 <|endoftext|>x<|startoftext|> ½²   z", "k l m n o p k l m n o p", "x " * 400]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, i, "clash", "clash") for i, t in enumerate(ODD)]
    rows += [(4, ODD[4], "en", 4, "clash", "clash"), (None, ODD[4], None, None, None, None), (None, "one", "en", None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, runs long, Ids string, part string")


# ---------------------------------------------------------------- runs
def brute_runs(w, least=12):
    """Runs by comparing words at every distance, smallest period first."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1 if j == i else j
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse(w, found):
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def test_runs_against_brute_force_on_random_words():
    rnd = random.Random(1)
    for _ in range(400):
        texts, least = [], rnd.choice([12, 12, 6, 4, 2])
        for _ in range(rnd.randrange(1, 5)):
            letters = "abcd"[: rnd.choice([1, 2, 2, 3, 4])]
            w = [rnd.choice(letters) for _ in range(rnd.randrange(60))]
            if rnd.random() < 0.5:
                w += ([rnd.choice(letters) for _ in range(rnd.randrange(1, 12))] * 8)[: rnd.randrange(60)] + w[: rnd.randrange(10)]
            texts.append(" ".join(w))
        chunk = Words([t.encode() for t in texts])
        if not len(chunk.start):
            continue
        got = runs.find_runs(chunk.hashes(), chunk.doc, chunk.first, least)
        assert got.tolist() == [[s + int(chunk.first[d]), n, q] for d, t in enumerate(texts) for s, n, q in brute_runs(t.split(), least)]


def test_runs_of_highly_periodic_words():
    a, b = "a", "a b"
    while len(b) < 3000:
        a, b = b, b + " " + a
    for t in (b, "x " * 900, "a b " * 300 + "c " + "a b " * 200):
        w = t.split()
        chunk = Words([t.encode()])
        assert [tuple(r) for r in runs.find_runs(chunk.hashes(), chunk.doc, chunk.first).tolist()] == brute_runs(w)


def test_a_long_text_of_one_word_takes_linear_work():
    chunk = Words([b"x " * 500_000])
    assert runs.find_runs(chunk.hashes(), chunk.doc, chunk.first).tolist() == [[0, 500_000, 1]]


def test_runs_on_odd_rows(odd):
    out = runs.periodic_runs(odd, odd.columns)
    assert out.columns == ["doc_id", "text", "lang", "Ids", "part", "n_words", "runs", "collapsed"]
    got = out.collect()
    assert len(got) == len(ODD) + 3
    for r in got:
        if r["doc_id"] is None:
            continue
        w = WORD.findall(ODD[r["doc_id"]] or "")
        want = brute_runs(w)
        assert (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) == (len(w), want, collapse(w, want))
    assert runs.periodic_runs(odd.limit(0), ["doc_id"]).count() == 0


def test_op11_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = runs.op11_maximal_pair_runs(spark, SF).collect()
    assert len(got) == len(docs)
    planted = 0
    for r in got:
        w = WORD.findall(docs[r["doc_id"]] or "")
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        found = brute_runs(w)
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert (r["n_words"], r["n_runs"], r["start"], r["length"], r["period"]) == (len(w), len(found), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapse(w, found).encode()).hexdigest()
    assert planted > 5


# ---------------------------------------------------------------- audit
def brute_audit(docs, labels):
    """All counts by applying the filters one after the other."""
    labels = [x for x in labels if x[0] is not None]  # a label without an id says nothing
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    rows, out = [], {}
    for d, text, lang in docs:
        t = text or ""
        w = WORD.findall(t)
        bad = {f for f, c in (("A", len(w) < 100), ("B", 100 * len(set(w)) < 80 * len(w)),
                              ("C", 100 * len(re.findall("[A-Z]", t)) > 10 * len(t)), ("D", re.search("[#$%&*|]", t)),
                              ("E", d is not None and any(e is not None and e < d and (u or "") == t for e, u, _ in docs))) if c}
        rows.append((lang or "", bad, d in good, d in toxic))
    for part in {r[0] for r in rows}:
        mine, total = [r for r in rows if r[0] == part], {}
        for o in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(o, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = [r for r in mine if f in r[1]]
                total[f] = total.get(f, 0) + len(gone)
                out[part, o, step] = [len(left), len(gone), len([r for r in failing if r[1] & set(o[: step - 1])]),
                                      len([r for r in mine if r[1] == {f}]), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, o, step), v in out.items():
            if p == part:
                v.append(total[o[step - 1]])
    return out


def as_rows(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[k] for k in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in df.collect()}


def test_min_plus_gives_the_first_failed_filter():
    orders, gone = audit.removal_steps(4)
    for m in range(16):
        for j, o in enumerate(orders):
            assert gone[m, j] == min([o.index(f) for f in range(4) if m >> f & 1], default=4)


def test_audit_on_odd_rows_against_brute_force(spark, odd):
    words = " ".join(f"w{i}" for i in range(120))
    more = [(100 + i, t, g) for i, (t, g) in enumerate([
        (words, "de"), (words, "de"), (words, None), (words + " #", "de"), (words.upper(), ""), ("", "de"), (None, "de")])]
    docs = odd.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    labels = [(0, 1, 0), (4, 1, 1), (4, 0, 0), (100, 1, 0), (101, 0, 1), (102, None, 1), (None, 1, 1), (999, 1, 1), (104, 1, None)]
    got = as_rows(audit.audit(docs.withColumn("mask", F.lit(1)), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert got == brute_audit([tuple(r) for r in docs.collect()], labels)
    assert audit.audit(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_op12_against_brute_force_and_sql(spark):
    got = as_rows(audit.op12_min_plus_filter_audit(spark, SF))
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    assert got == brute_audit(docs, labels)
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    rel = con.sql(audit.OP12_SQL)
    assert {(r[0], r[1], r[2]): list(r[3:]) for r in rel.fetchall()} == got


# ---------------------------------------------------------------- BPE
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_path())


def same(codec, library, text):
    e = library.encode(text, add_special_tokens=False)
    got = codec.encode(text.encode())
    assert np.frombuffer(got, "<u4").tolist() == e.ids, text
    assert codec.decode(memoryview(got).cast("I")).decode() == library.decode(e.ids, skip_special_tokens=False)


def test_bpe_equals_the_library_on_random_texts(library):
    codec, rnd = bpe.Codec(bpe.default_path()), random.Random(3)
    letters = [*"aabcdefghijklmnopqrstuvwxyz'''ABC012 \n\t.,!?-_", *"éßİΣςﬁ日本ก́̇  \u0085\x1c\x00क़ড়😀‍½²ª",
               "<|endoftext|>", "<|startoftext|>", "<|endoftext", "'ll", "don't"]
    for _ in range(4000):
        same(codec, library, "".join(rnd.choice(letters) for _ in range(rnd.randrange(40))))


def test_bpe_equals_the_library_on_every_letter_before_punctuation(library):
    codec = bpe.Codec(bpe.default_path())
    for cp in [*range(0x80, 0x3000), 0xFB1D, 0xFB4F, 0x1D15E, 0x2F800, 0x187F8, 0x18D09]:
        if not 0xD800 <= cp < 0xE000:
            same(codec, library, f"{chr(cp)}, a{chr(cp)}b1{chr(cp)}!")


def test_bpe_long_words_take_the_same_merges(library, monkeypatch):
    codec, rnd = bpe.Codec(bpe.default_path()), random.Random(5)
    for t in ("y" * 3000, "ab" * 700, "the" * 500, "日本語" * 300, "".join(rnd.choice("etaoinshr") for _ in range(5000))):
        same(codec, library, t)
    monkeypatch.setattr(bpe, "SHORT", 1)  # all words by the heap
    again = bpe.Codec(bpe.default_path())
    for _ in range(500):
        t = "".join(rnd.choice("aeinorst'd ") for _ in range(60))
        assert again.encode(t.encode()) == codec.encode(t.encode())


def test_bpe_memos_forget_and_long_texts_are_cut(monkeypatch):
    codec = bpe.Codec(bpe.default_path())
    text = " ".join(f"word{i % 700} tail,{i}" for i in range(9000)).encode()
    want = codec.encode(text)
    monkeypatch.setattr(bpe, "MEMO_KEYS", 50)
    monkeypatch.setattr(bpe, "SPLIT_BYTES", 1000)
    small = bpe.Codec(bpe.default_path())
    assert small.encode(text) == want and len(small.words) <= 50 and len(small.words.old) <= 50


def test_bpe_encode_and_decode_on_odd_rows(spark, odd, library):
    out = bpe.encode(odd, odd.columns, decoded=True)
    assert out.columns == ["doc_id", "text", "lang", "runs", "part", "ids", "decoded"]
    got = out.collect()
    assert len(got) == len(ODD) + 3
    for r in got:
        e = library.encode(r["text"] or "", add_special_tokens=False)
        assert (r["ids"], r["decoded"]) == (e.ids, library.decode(e.ids, skip_special_tokens=False))
    for packed in (False, True):
        back = bpe.decode(bpe.encode(odd, ["doc_id"], packed=packed, decoded=True), ["doc_id", "decoded"], out="again")
        assert back.where("not (decoded <=> again)").count() == 0
    odd_ids = spark.createDataFrame([(1, None), (2, []), (3, [None, 320, 99_999_999, -1])], "k int, ids array<int>")
    assert [r["decoded"] for r in bpe.decode(odd_ids, ["k"]).orderBy("k").collect()] == [None, "", "a</w>"]
    assert bpe.encode(odd.limit(0), ["doc_id"]).count() == 0


def test_op13_against_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = bpe.op13_rank_array_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        e = library.encode(docs[r["doc_id"]] or "", add_special_tokens=False)
        text = library.decode(e.ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
