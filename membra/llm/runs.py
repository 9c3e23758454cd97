"""Periodic runs in a text's words, as maximal pairs of an LCP-interval tree.

Two places i < j of a word sequence are a *maximal pair* of length l if l words
from each are equal, the words before them differ and so do those after.  A
pair at distance p = j - i <= l says that the stretch of p + l words from i has
period p and that no neighbouring word extends it: it is a run, without any
extension step.

The pairs come from the tree of LCP intervals of the suffix array, walked
bottom-up: the places below a node share their first l words, l being the
node's LCP, and when two children are united, every pair across them has
exactly that l.  A node holds its places in order with the word to the left of
each; neighbours of one left word form a class, and pairs inside a class are
never formed.  Only pairs of neighbours need be looked at: if a place k lay
between i and j, at a distance below l from i, the l words from i would
repeat inside their own first p words, so p would not be the run's smallest
period.  So a union of two children costs the smaller one's places, n log n in
all, and each run comes once, with its smallest period.

A run of at least ``MIN_LENGTH`` words and two periods has l >= MIN_LENGTH / 2;
the suffix array is built over windows of that many words, and a window found
once in its text is a leaf of its own, which takes no further work.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, bounded_batches, chunks, field, mix, quoted

#: least words of a run, and the least times that its period comes
MIN_LENGTH, MIN_TIMES = 12, 2
#: words that every maximal pair of a run shares
WINDOW = MIN_LENGTH // 2


# ---------------------------------------------------------------- suffix array
def window_ids(word: np.ndarray, doc: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
    """A number for the ``k`` words from each place, equal only for equal words
    of one text, and -1 where the text ends before or no place equals it."""
    n = len(word)
    out = np.full(n, -1, dtype=np.int64)
    full = np.flatnonzero(np.arange(n) + k <= end[doc])
    if not len(full):
        return out
    h = mix(doc[full].astype(np.uint64) + np.uint64(1))
    for j in range(k):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + word[full + j])
    _, back, count = np.unique(h, return_inverse=True, return_counts=True)
    out[full] = np.where(count[back] > 1, back, -1)
    return out


def suffix_order(sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places with a symbol in suffix order, LCP of each with the one before).

    ``sym`` < 0 is a symbol of its own, equal to nothing.  Ranks double the
    symbols they compare; only places that still share a rank are sorted again.
    The LCPs follow in text order, each at least the one before less one, so
    memory and the number of comparisons stay linear in the places."""
    n = len(sym)
    act = np.flatnonzero(sym >= 0)
    if not len(act):
        return act, act
    o = act[np.argsort(sym[act], kind="stable")]
    new = np.concatenate([[True], sym[o][1:] != sym[o][:-1]])
    at = np.arange(len(o))
    # rank: place of the group's first suffix; a lone symbol has a rank after all others
    rank = np.arange(n + 1, dtype=np.int64) + len(o)
    rank[o] = np.maximum.accumulate(np.where(new, at, 0))
    k = 1
    while True:
        size = np.bincount(rank[act], minlength=len(o))
        live = act[size[rank[act]] > 1]
        if not len(live):
            break
        nxt = rank[np.minimum(live + k, n)]
        s = np.lexsort((nxt, rank[live]))
        live, nxt = live[s], nxt[s]
        grp = rank[live]
        new_grp = np.concatenate([[True], grp[1:] != grp[:-1]])
        new_key = new_grp | np.concatenate([[True], nxt[1:] != nxt[:-1]])
        at = np.arange(len(live))
        inside = at - np.maximum.accumulate(np.where(new_grp, at, 0))
        rank[live] = grp + inside[np.maximum.accumulate(np.where(new_key, at, 0))]
        k *= 2
    order = np.empty(len(o), dtype=np.int64)
    order[rank[act]] = act
    return order, _lcps(sym, order, rank, act)


def _lcps(sym: np.ndarray, order: np.ndarray, rank: np.ndarray, act: np.ndarray) -> np.ndarray:
    """LCP of each place of ``order`` with the one before it."""
    before = np.full(len(order), -1, dtype=np.int64)
    before[1:] = order[:-1]
    same = np.concatenate([[False], sym[order][1:] == sym[order][:-1]])
    before[~same] = -1
    lcp = [0] * len(order)
    s = [*sym.tolist(), -1]
    h, last = 0, -2
    for i, r, j in zip(act.tolist(), rank[act].tolist(), before[rank[act]].tolist()):
        h = h - 1 if h > 0 and i == last + 1 else 0
        last = i
        if j < 0:
            h = 0
            continue
        while s[i + h] == s[j + h] >= 0:
            h += 1
        lcp[r] = h
    return np.array(lcp, dtype=np.int64)


# ---------------------------------------------------------------- runs
def find_runs(word: np.ndarray, doc: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and then period.

    ``word`` holds a hash of each word, ``doc`` its text's number and ``first``
    the number of each text's first word (and one past the last word)."""
    k = max(1, min_length // MIN_TIMES)
    sym = window_ids(word, doc, first[1:], k)
    order, lcp = suffix_order(sym)
    # the word to the left: -1 and below at the start of a text, so that each differs
    left = np.unique(word, return_inverse=True)[1].astype(np.int64)
    left = np.concatenate([[-1], left[:-1]]) if len(left) else left
    at_start = first[:-1][np.diff(first) > 0]
    left[at_start] = -1 - np.arange(len(at_start))
    found = _pairs(order.tolist(), lcp, left.tolist(), k - 1, min_length)
    runs = np.array(found, dtype=np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _pairs(order: list, lcp: np.ndarray, left: list, extra: int, min_length: int) -> list[tuple[int, int, int]]:
    """Maximal pairs at a distance of at most their length, as runs.

    Nodes are united by falling LCP, which is bottom-up; of a node's places
    only those of the smaller child look for their neighbours."""
    out = []
    node = list(range(len(order)))  # the node of each end of an interval, by its other end
    places = [[p] for p in order]
    where = np.flatnonzero(lcp > 0)
    where = where[np.argsort(-lcp[where], kind="stable")]
    for r, l in zip(where.tolist(), (lcp[where] + extra).tolist()):
        a, b = node[r - 1], node[r]  # first of the interval that ends before r; last of the one that starts there
        node[a], node[b] = b, a
        x, y = places[a], places[r]
        if len(x) < len(y):
            x, y = y, x
        if y[0] > x[-1]:  # children one after another
            i, j = x[-1], y[0]
            if j - i <= l and j - i + l >= min_length and left[i] != left[j]:
                out.append((i, j - i + l, j - i))
            x += y
        else:
            for k, p in enumerate(y):
                q = bisect_left(x, p)
                if q and (not k or y[k - 1] < x[q - 1]):
                    i = x[q - 1]
                    if p - i <= l and p - i + l >= min_length and left[i] != left[p]:
                        out.append((i, p - i + l, p - i))
                if q < len(x) and (k + 1 == len(y) or y[k + 1] > x[q]):
                    j = x[q]
                    if j - p <= l and j - p + l >= min_length and left[p] != left[j]:
                        out.append((p, j - p + l, j - p))
            if len(y) * 16 < len(x):
                for p in y:
                    x.insert(bisect_left(x, p), p)
            else:
                x += y
                x.sort()
        places[a], places[r] = x, None
    return out


# ---------------------------------------------------------------- texts
def repeated_from(first: np.ndarray, count: np.ndarray, rows: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """For each word of a chunk the word that is read in its place, where the
    texts ``rows`` repeat the ``period`` words from ``start`` on to their end."""
    out = np.arange(first[-1])
    for d, a, p in zip(rows.tolist(), start.tolist(), period.tolist()):
        i = np.arange(a, count[d])
        out[first[d] + a : first[d] + count[d]] = first[d] + a + (i - a) % p
    return out


def _tail(w: Words, start: list, period: list) -> np.ndarray | None:
    """Where texts have a tail to repeat, the words read in its place."""
    rows = [d for d, (a, p) in enumerate(zip(start, period)) if a is not None and p and 0 <= a < w.count[d]]
    if not rows:
        return None
    rows = np.array(rows)
    return repeated_from(w.first, w.count, rows, np.array([start[d] for d in rows], np.int64),
                         np.array([period[d] for d in rows], np.int64))


def _collapsed(w: Words, source: np.ndarray | None, runs: np.ndarray) -> list[bytes]:
    """Each text's words but those that a run holds after its first period."""
    n = len(w.start)
    d = np.bincount(runs[:, 0] + runs[:, 2], minlength=n + 1) - np.bincount(runs[:, 0] + runs[:, 1], minlength=n + 1)
    keep = np.cumsum(d)[:n] == 0
    place = np.arange(n) if source is None else source
    raw, out = w.buf.tobytes(), []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        at = place[a:b][keep[a:b]]
        out.append(b" ".join([raw[x:y] for x, y in zip(w.start[at].tolist(), w.end[at].tolist())]))
    return out


def periodic_runs(docs: DataFrame, carry: list[str], text_col: str = "text", min_length: int = MIN_LENGTH,
                  tail: tuple[str, str] | None = None) -> DataFrame:
    """``carry`` plus ``n_words``, ``runs`` and ``collapsed`` of each whole text.

    ``runs`` (array of start, length, period) lists every run of at least
    ``min_length`` words and two periods by start, then period; words are
    numbered from 0.  ``collapsed`` joins by one space the words left when each
    run keeps its first period.  A null, empty or wordless text has 0 words, no
    run and an empty ``collapsed``; repeated rows are judged alike; an empty
    table gives an empty one; a carried column named like a result column gives
    way to it.

    ``tail`` names two columns (start, period), not carried on: a text's words
    from ``start`` on are then read as the ``period`` words there, repeated to
    the text's end.  Rows where either is null, ``period`` is 0 or ``start`` lies outside
    are read as they are."""
    names = ["n_words", "runs", "collapsed"]
    carry = [c for c in carry if c.lower() not in names]
    kind = T.ArrayType(T.StructType([field(k, "bigint") for k in ("start", "length", "period")]))
    fields = [field("n_words", "bigint"), T.StructField("runs", kind), field("collapsed", "string")]
    extra = [quoted(c).cast("long") for c in tail] if tail else [F.lit(None).cast("long")] * 2
    k = len(carry)
    src = docs.select(*[quoted(c) for c in carry], *extra, quoted(text_col).cast("binary")).toDF(
        *[f"c{i}" for i in range(k)], "start", "period", "text")
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(carry, src.schema)] + fields)

    def run(batches):
        for b in batches:
            start, period = b.column(k).to_pylist(), b.column(k + 1).to_pylist()
            for at, texts in chunks(b, "text"):
                w, m = Words(texts), len(texts)
                source = _tail(w, start[at : at + m], period[at : at + m])
                word = w.hashes()
                got = find_runs(word if source is None else word[source], w.doc, w.first, min_length)
                doc = w.doc[got[:, 0]]
                off = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=m))])
                items = pa.StructArray.from_arrays(
                    [pa.array(got[:, 0] - w.first[doc]), pa.array(got[:, 1]), pa.array(got[:, 2])], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).slice(at, m) for i in range(k)]
                    + [pa.array(w.count), pa.ListArray.from_arrays(pa.array(off, pa.int32()), items),
                       pa.array(_collapsed(w, source, got), pa.string())], names=[*carry, *names])

    return bounded_batches(src).mapInArrow(run, schema)


def op11_maximal_pair_runs(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    # words as the operator counts them; only the texts that are changed need their number
    n = F.when(h % 10 == 0, F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")))
    plan = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), n.alias("n")).withColumn(
        "a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn(
        "p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    out = periodic_runs(plan, ["doc_id"], tail=("a", "p"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return out.withColumn("best", best).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
