"""Quality rules from a suffix array: repetition inside a text.

The words of a chunk of texts are numbered by rank doubling, the document's
number first, so that no two suffixes of different texts share a prefix.
Neighbours of the resulting suffix array share their longest common prefix
(LCP); a suffix's longest repeated prefix is the larger of the LCPs with its
two neighbours, so LCP intervals give the maximal repeated substrings.  Spans
of at least ``MIN_WORDS`` words are united; a text passes if the union's share
of its word characters and the longest repeat stay under their limits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .common import Words, field, map_text, mix

#: a repeat counts from this many words; limits of share and of words
MIN_WORDS, MAX_SHARE, MAX_LONGEST = 4, 0.35, 120
WINDOW = 8
SYMBOLS = b"#*$%&|<>"


def suffix_lcp(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, LCP with the neighbour before) of a sequence of symbols.

    Ranks by the first 1, 2, 4, ... symbols are kept as long as two suffixes
    share one; an LCP then is the sum of the levels that agree on the way
    down.  Only positions that still share a rank are sorted again."""
    n = len(first)
    _, rank = np.unique(first, return_inverse=True)
    rank = rank.astype(np.int64)
    # ranks are the position of the group's first suffix in sorted order
    size = np.bincount(rank)
    rank = (np.cumsum(size) - size)[rank]
    levels, k = [rank], 1
    while True:
        shared = np.bincount(rank, minlength=n) > 1
        act = np.flatnonzero(shared[rank])
        if not len(act):
            break
        nxt = np.where(act + k < n, rank[np.minimum(act + k, n - 1)] + 1, 0)
        key = rank[act] * (n + 2) + nxt
        o = np.argsort(key, kind="stable")
        act, key, grp = act[o], key[o], rank[act[o]]
        new_grp = np.concatenate([[True], grp[1:] != grp[:-1]])
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        at = np.arange(len(act))
        inside = at - np.maximum.accumulate(np.where(new_grp, at, 0))
        start = np.maximum.accumulate(np.where(new_key, at, 0))
        rank = rank.copy()
        rank[act] = grp + inside[start]
        levels.append(rank)
        k *= 2
    sa = np.empty(n, dtype=np.int64)
    sa[rank] = np.arange(n)
    lcp = np.zeros(n, dtype=np.int64)
    if n > 1:
        a, b, got = sa[:-1], sa[1:], np.zeros(n - 1, dtype=np.int64)
        pair = np.flatnonzero(levels[0][a] == levels[0][b])
        a, b, cur = a[pair], b[pair], np.zeros(len(pair), dtype=np.int64)
        for j in range(len(levels) - 1, -1, -1):
            x, y = a + cur, b + cur
            inside = (x < n) & (y < n)
            eq = inside.copy()
            eq[inside] = levels[j][x[inside]] == levels[j][y[inside]]
            cur += np.where(eq, 1 << j, 0)
        got[pair] = cur
        lcp[1:] = got
    return sa, lcp


def _union(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n places lies in one of the spans."""
    d = np.bincount(start, minlength=n + 1)[: n + 1] - np.bincount(start + length, minlength=n + 1)[: n + 1]
    return np.cumsum(d)[:n] > 0


def measure(texts: list) -> dict[str, np.ndarray]:
    """Counts of each text of a chunk; null and wordless texts count 0."""
    w = Words(texts)
    n = len(w.start)
    longest = np.zeros(n, dtype=np.int64)
    if n:
        tag = mix(np.arange(1, w.n_docs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        sa, lcp = suffix_lcp(mix(w.hashes() ^ tag[w.doc]))
        longest[sa] = np.maximum(lcp, np.concatenate([lcp[1:], [0]]))
    at = np.flatnonzero(longest >= WINDOW)
    repeat = _union(at, longest[at], n)
    at = np.flatnonzero(longest >= MIN_WORDS)
    covered = _union(at, longest[at], n)
    chars = np.concatenate([[0], np.cumsum((w.buf & 0xC0) != 0x80)])
    width = chars[w.end] - chars[w.start]
    sums = lambda v: np.bincount(w.doc, weights=v, minlength=w.n_docs).astype(np.int64)
    top = np.zeros(w.n_docs, dtype=np.int64)
    np.maximum.at(top, w.doc, np.where(longest >= MIN_WORDS, longest, 0))
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    return {"n_words": w.count, "word_chars": sums(width), "n_symbols": w.per_doc(symbol[w.buf]),
            "n_dup_lines": np.array([_dup_lines(t) for t in texts], dtype=np.int64),
            "n_repeat_words": sums(repeat), "covered_chars": sums(width * covered), "longest_repeat": top}


def _dup_lines(text: bytes | None) -> int:
    if not text or b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def spans(text: str) -> list[tuple[int, int]]:
    """Word spans (first, one past the last) of the united repeats of a text."""
    w = Words([text.encode()])
    n = len(w.start)
    if not n:
        return []
    sa, lcp = suffix_lcp(w.hashes())
    longest = np.zeros(n, dtype=np.int64)
    longest[sa] = np.maximum(lcp, np.concatenate([lcp[1:], [0]]))
    at = np.flatnonzero(longest >= MIN_WORDS)
    edge = np.diff(np.concatenate([[0], _union(at, longest[at], n).astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def apply_rules(docs: DataFrame, carry: list[str], text_col: str = "text") -> DataFrame:
    """``carry`` plus the counts, base_failed and kept of each whole text.

    A null or wordless text has counts of 0 and fails the base rules.
    Repeated rows are judged alike; a carried column named like a result
    column gives way to it.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def score(texts):
        m = measure(texts)
        failed = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
        share = m["covered_chars"] / np.maximum(m["word_chars"], 1)
        kept = ~failed & (share <= MAX_SHARE) & (m["longest_repeat"] <= MAX_LONGEST)
        return [*[m[k] for k in names], failed, kept, share, m["longest_repeat"]]

    fields = [field(k, "bigint") for k in names] + [field("base_failed", "boolean"), field("kept", "boolean"),
                                                     field("covered_share", "double"), field("longest_repeat", "bigint")]
    return map_text(docs, text_col, carry, fields, score)


def op5_suffix_repetition(spark, sf_dir) -> DataFrame:
    return apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
