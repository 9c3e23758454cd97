"""N-gram Jaccard join, size-aware: subsets for small sets, lists for large.

A document's set holds its distinct word n-grams as 64-bit hashes; equal sets
are one *set* (its id a hash of its members and size).  Two sets x, y link iff
|x and y| >= c(|x|, |y|), the least overlap that reaches the threshold.

Small sets (at most ``n0`` members): for each partner size m that can reach
the threshold, all subsets of c(n, m) members are enumerated; sets of sizes n
and m link iff they share one.  All sets at one subset are joined to the
smallest, so a popular subset gives a star, not all pairs.

Large sets: inverted lists.  A first pass sends each set's leading members (in
the order of their hashes, about 30 % of the set) and keeps the sets of which
enough are shared with another; linked sets always pass.  Only those are cut
again and send all their members, found in the table by a bitmap of bounded
size that may let others through, which costs work but changes no result.
Their members are ordered from rare to frequent; two
linked sets share one of the first n - ceil(t n) + 1 members of each
(prefixes).  A set most of whose members nobody else has drops out at once,
and a passage that thousands of documents share comes last in the order.
Lists are scanned in rounds: every set of a list is first compared with one
other, chosen anew each round, unless both are in one component already; what
is still apart then is compared in full.  As components are the result, pairs
inside a component needn't be formed, and none that could join two is left out.

``n0`` is set by cost: the largest size for which enumerating a set's subsets
costs no more than scanning the lists of its prefix.

Members that at least ``HOT_SHARE`` of the sets hold are found beforehand by
bounded counters in every task and travel by set instead of by member, so no
task receives a frequent member's whole list.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, bounded_batches, chunks, mix, quoted, release_memos, return_free_memory, staged
from .components import components

N_GRAM, PERCENT = 5, 80
#: largest size whose subsets may be enumerated
SMALL_MAX = 14
#: counters a task keeps, and the share of sets from which a member is hot
COUNTERS, HOT_SHARE = 50_000, 0.01
#: members that a task gathers before it sends them on
GATHER = 400_000
#: members for each partition of the large sets' exchanges, which have at least
#: spark.sql.shuffle.partitions
PART_MEMBERS = 1_000_000
#: a set of n members sends n // LEAD_SHARE leading members above the fewest
LEAD_SHARE = 10
#: bits of the bitmap of possible documents, for each of them and at most (32 MB)
BITS_EACH, MOST_BITS = 16, 1 << 28
#: rounds of single comparisons, and entries of a list that are dealt together
ROUNDS, LIST_CHUNK = 3, 512
#: sets on either side of a cell in which what is left is compared
CELL = 1_000
_M48 = np.uint64((1 << 48) - 1)


def least_overlap(n: int, m: int, percent: int = PERCENT) -> int:
    """Least |x and y| with 100 * overlap >= percent * union, for sizes n, m."""
    return -(-percent * (n + m) // (100 + percent))


def _must_overlap(n):
    """Least overlap of a set of n members with any set that it links to."""
    return -(-PERCENT * n // 100)


def lead_length(n):
    """How many members, least hash first, a set of n sends in the first pass.

    Of its links' common members the first 1 + n // LEAD_SHARE are among them:
    at most n - _must_overlap(n) members of the set are not common."""
    return n - _must_overlap(n) + 1 + n // LEAD_SHARE


def lead_shared(n):
    """How many of those a set with a link shares at least: the first common
    members that both send, where the other has _must_overlap(n) members or more."""
    return 1 + _must_overlap(n) // LEAD_SHARE


# ---------------------------------------------------------------- sets
def shingle_sets(texts: list, n_gram: int = N_GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(members, document of each) of a chunk: distinct, by document."""
    w = Words(texts, lower=True)
    h = w.hashes()
    if not len(h):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    acc = h.copy()
    full = np.arange(len(h)) + n_gram <= w.first[w.doc + 1]
    for j in range(1, n_gram):
        k = max(0, len(h) - j)
        acc[:k] = mix(acc[:k] * np.uint64(0x100000001B3) + h[j:])
    got, doc = [acc[full]], [w.doc[full]]
    for size in range(1, n_gram):  # fewer words: the whole sequence
        d = np.flatnonzero(w.count == size)
        s = np.full(len(d), size, dtype=np.uint64)
        for j in range(size):
            s = mix(s * np.uint64(0x9E3779B97F4A7C15) + h[w.first[d] + j])
        got.append(s)
        doc.append(d)
    got, doc = np.concatenate(got), np.concatenate(doc)
    o = np.argsort(got, kind="stable")
    o = o[np.argsort(doc[o].astype(np.uint16), kind="stable")] if w.n_docs < 1 << 16 else np.lexsort((got, doc))
    got, doc = got[o], doc[o]
    new = np.concatenate([[True], (got[1:] != got[:-1]) | (doc[1:] != doc[:-1])])
    return got[new], doc[new]


def _set_ids(member: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(id as a signed integer, size) of each document's set."""
    n = np.bincount(doc, minlength=n_docs)
    c = np.concatenate([[np.uint64(0)], np.cumsum(mix(member))])
    at = np.concatenate([[0], np.cumsum(n)])
    s = mix((c[at[1:]] - c[at[:-1]]) * np.uint64(0x9E3779B97F4A7C15) + n.astype(np.uint64))
    return s.view(np.int64), n


class _Counters:
    """Frequent members of a stream, each count short by at most its share."""

    def __init__(self):
        self.key, self.n = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, member: np.ndarray) -> None:
        key, n = np.unique(member, return_counts=True)
        key, back = np.unique(np.concatenate([self.key, key]), return_inverse=True)
        n = np.bincount(back, weights=np.concatenate([self.n, n])).astype(np.int64)
        if len(key) > COUNTERS:
            n = n - np.partition(n, len(n) - COUNTERS - 1)[len(n) - COUNTERS - 1]
            key, n = key[n > 0], n[n > 0]
        self.key, self.n = key, n


def _sets(docs: DataFrame) -> DataFrame:
    """One row a document (doc_id, set_id, n, small sets' members) and, with a
    null ``n``, frequent members (set_id) and their counts (doc_id)."""

    def run(batches):
        release_memos()
        seen, rows = _Counters(), 0
        for b in batches:
            for at, texts in chunks(b, "text"):
                member, doc = shingle_sets(texts)
                ids, n = _set_ids(member, doc, len(texts))
                seen.add(member >> np.uint64(16))
                rows += len(texts)
                small = (n <= SMALL_MAX)[doc]
                sizes = np.where(n <= SMALL_MAX, n, 0)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                                                 pa.array(member[small].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), pa.array(ids), pa.array(n.astype(np.int64)), lists],
                    names=["doc_id", "set_id", "n", "members"])
        often = seen.n >= max(2, HOT_SHARE / 4 * rows)
        if often.any():
            k = int(often.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.n[often]), pa.array(seen.key[often].view(np.int64)), pa.nulls(k, pa.int64()),
                 pa.nulls(k, pa.list_(pa.int64()))], names=["doc_id", "set_id", "n", "members"])

    return bounded_batches(docs).mapInArrow(run, "doc_id long, set_id long, n long, members array<long>")


# ---------------------------------------------------------------- small sets
def subset_count(n: int, n0: int) -> int:
    return sum(comb(n, least_overlap(n, m)) for m in range(1, n0 + 1) if least_overlap(n, m) <= min(n, m))


def boundary(small: DataFrame) -> int:
    """Largest size up to which subsets cost no more than lists (at least 1).

    A list costs its entries: the mean length, as a random entry sees it, of
    the lists of the small sets' members."""
    freq = small.select(F.explode("members").alias("t")).groupBy("t").count()
    r = freq.agg(F.sum(F.col("count") * F.col("count")).alias("sq"), F.sum("count").alias("s")).first()
    mean = (r["sq"] or 0) / max(r["s"] or 0, 1)
    n0 = 1
    while n0 < SMALL_MAX and subset_count(n0 + 1, n0 + 1) <= (n0 + 2 - least_overlap(n0 + 1, n0 + 1)) * (1 + mean):
        n0 += 1
    return n0


def _subset_links(small: DataFrame, n0: int) -> DataFrame:
    """(a, b): links that connect all small sets that must be connected."""

    def run(batches):
        for b in batches:
            key, role, who = [], [], []
            for s, n, t in zip(*(b.column(i).to_pylist() for i in range(3))):
                x = mix(np.array(t, dtype=np.int64).view(np.uint64))
                for m in range(1, n0 + 1):
                    c = least_overlap(n, m)
                    if c > min(n, m):
                        continue
                    pick = np.array(list(combinations(range(n), c)))
                    k = mix(x[pick].sum(1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                            + np.uint64(min(n, m) * 64 + max(n, m)))
                    key.append(k)
                    role += [2 if n == m else int(n > m)] * len(k)
                    who += [s] * len(k)
            if key:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(key).view(np.int64)), pa.array(role, pa.int32()),
                                                  pa.array(who, pa.int64())], names=["key", "role", "s"])

    keys = small.select("set_id", "n", "members").mapInArrow(run, "key long, role int, s long")
    first = keys.groupBy("key").agg(F.min("s").alias("a"), F.min("role").alias("r0"), F.max("role").alias("r1"))
    first = first.where("r0 = 2 or r0 < r1").select("key", "a")
    return keys.join(first, "key").where("s != a").select("a", F.col("s").alias("b")).distinct()


# ---------------------------------------------------------------- large sets
def _pack(head: list, arrays: list) -> bytes:
    return np.array(head, dtype="<u4").tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpack(raw: bytes, kinds: list) -> list:
    """Arrays of (dtype, which of the two lengths) from a packed block."""
    n = np.frombuffer(raw, "<u4", 2)
    out, at = [], 8
    for kind, which in kinds:
        out.append(np.frombuffer(raw, kind, int(n[which]), at))
        at += out[-1].nbytes
    return out


SENT = [("<i8", 0), ("<i4", 0), ("<u4", 1), ("<u2", 1), ("<u2", 1)]  # set, size | member low, high, set's number
SHARED = [("<i8", 0), ("<i4", 0), ("<i4", 0)]  # set, size, shared leading members
BACK = [("<i8", 0), ("<i4", 0), ("<i4", 0), ("<u8", 1), ("<u2", 1)]  # set, size, members | member, frequency


def _send(docs: DataFrame, hot: np.ndarray, least: int, parts: int, lead: bool = False) -> DataFrame:
    """Blocks (part, payload) of the members of sets of at least ``least``; with
    ``lead`` the leading members alone."""

    def run(batches):
        release_memos()
        held: list = []

        def flush():
            member, setno, ids, n = [], [], [], []
            at = 0
            for m, d, i, k in held:
                member.append(m)
                setno.append(d + at)
                ids.append(i)
                n.append(k)
                at += len(i)
            held.clear()
            member, setno, ids, n = map(np.concatenate, (member, setno, ids, n))
            _, first, back = np.unique(ids, return_index=True, return_inverse=True)
            keep = np.zeros(len(ids), dtype=bool)
            keep[first] = True
            keep &= n >= least
            m = keep[setno]
            member, setno = member[m] >> np.uint64(16), setno[m]
            part = (member % np.uint64(parts)).astype(np.int64)
            if len(hot):
                i = np.minimum(np.searchsorted(hot, member), len(hot) - 1)
                part = np.where(hot[i] == member, ids[setno] % parts, part)
            o = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[o], np.arange(parts + 1))
            for p in range(parts):
                at = o[cut[p] : cut[p + 1]]
                if len(at):
                    here, no = np.unique(setno[at], return_inverse=True)
                    t = member[at]
                    yield p, _pack([len(here), len(t)], [
                        ids[here].astype("<i8"), n[here].astype("<i4"), (t & np.uint64(0xFFFFFFFF)).astype("<u4"),
                        (t >> np.uint64(32)).astype("<u2"), no.astype("<u2")])

        def out(rows):
            rows = list(rows)
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                               pa.array([r[1] for r in rows], pa.binary())], names=["part", "payload"])

        size = count = 0
        for b in batches:
            for _, texts in chunks(b, "text"):
                member, doc = shingle_sets(texts)
                ids, n = _set_ids(member, doc, len(texts))
                if lead:
                    first = np.cumsum(n) - n
                    early = np.arange(len(member)) - first[doc] < lead_length(n)[doc]
                    member, doc = member[early], doc[early]
                held.append((member, doc, ids, n))
                size, count = size + len(member), count + len(texts)
                if size >= GATHER or count >= 60_000:
                    yield out(flush())
                    size = count = 0
        if held:
            yield out(flush())

    return bounded_batches(docs.select("doc_id", "text")).mapInArrow(run, "part int, payload binary")


def _lists(raw: list, hot: np.ndarray) -> tuple:
    """(set ids, sizes, members, number of the set of each, frequency) of the
    members in the blocks ``raw`` that two or more sets hold."""
    got, member, owner, at = [_unpack(p, SENT) for p in raw], [], [], 0
    for ids, n, lo, hi, no in got:
        member.append((hi.astype(np.uint64) << np.uint64(32)) | lo)
        owner.append(no.astype(np.int64) + at)
        at += len(ids)
    ids, n = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
    member, owner = np.concatenate(member), np.concatenate(owner)
    del got
    uniq, first, back = np.unique(ids, return_index=True, return_inverse=True)
    size, owner = n[first], back[owner]
    o = np.lexsort((owner, member))
    member, owner = member[o], owner[o]
    new = np.concatenate([[True], (member[1:] != member[:-1]) | (owner[1:] != owner[:-1])])
    member, owner = member[new], owner[new]
    start = np.flatnonzero(np.concatenate([[True], member[1:] != member[:-1]]))
    df = np.diff(np.concatenate([start, [len(member)]]))
    freq = np.repeat(np.minimum(df, 65_534), df).astype("<u2")
    if len(hot):
        i = np.minimum(np.searchsorted(hot, member), len(hot) - 1)
        freq[hot[i] == member] = 65_535
    keep = freq > 1
    return uniq, size, member[keep], owner[keep], freq[keep]


def _possible_sets(blocks: DataFrame, hot: np.ndarray, parts: int) -> DataFrame:
    """(set_id, n) of the sets of which enough leading members are shared."""

    def run(batches):
        release_memos()
        return_free_memory()
        raw = [p for b in batches for p in b.column(1).to_pylist()]
        if not raw:
            return
        uniq, size, _, owner, _ = _lists(raw, hot)
        del raw
        k = np.bincount(owner, minlength=len(uniq))
        uniq, size, k = uniq[k > 0], size[k > 0], k[k > 0]
        part = uniq % parts
        o = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[o], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(cut)):
            at = o[cut[p] : cut[p + 1]]
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([_pack(
                [len(at), 0], [uniq[at].astype("<i8"), size[at].astype("<i4"), k[at].astype("<i4")])], pa.binary())],
                names=["part", "payload"])

    def add(batches):
        release_memos()
        got = [_unpack(p, SHARED) for b in batches for p in b.column(1).to_pylist()]
        if got:
            ids, n, k = (np.concatenate([g[i] for g in got]) for i in range(3))
            uniq, first, back = np.unique(ids, return_index=True, return_inverse=True)
            n = n[first].astype(np.int64)
            good = np.bincount(back, weights=k, minlength=len(uniq)) >= lead_shared(n)
            yield pa.RecordBatch.from_arrays([pa.array(uniq[good]), pa.array(n[good])], names=["set_id", "n"])

    counted = blocks.repartition(parts, "part").mapInArrow(run, "part int, payload binary")
    return counted.repartition(parts, "part").mapInArrow(add, "set_id long, n long")


def _only(docs: DataFrame, ids: DataFrame, count: int) -> DataFrame:
    """``docs`` whose doc_id is one of ``ids``, and a few others: those whose
    hash meets a set bit.  The texts stay where they are; the bitmap that is
    broadcast has at most ``MOST_BITS`` bits, whatever the number of ids."""
    bits = 1 << 15
    while bits < min(MOST_BITS, BITS_EACH * count):
        bits *= 2
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits)) + 1
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    maps = ids.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bitmap"))
    near = docs.withColumn("bucket", bucket).withColumn("bit", bit).join(F.broadcast(maps), "bucket")
    byte = "cast(conv(hex(substring(bitmap, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)"
    return near.where(F.expr(f"shiftright({byte}, cast(bit % 8 as int)) & 1 = 1")).select(*docs.columns)


def _count(blocks: DataFrame, hot: np.ndarray, parts: int) -> DataFrame:
    """Blocks (part, payload) by set of the members that two or more sets hold."""

    def run(batches):
        release_memos()
        return_free_memory()
        raw = [p for b in batches for p in b.column(1).to_pylist()]
        if not raw:
            return
        uniq, size, member, owner, freq = _lists(raw, hot)
        del raw
        part = uniq[owner] % parts
        o = np.lexsort((owner, part))
        member, owner, freq, part = member[o], owner[o], freq[o], part[o]
        cut = np.searchsorted(part, np.arange(parts + 1))
        for p in range(parts):
            a, b = cut[p], cut[p + 1]
            if b > a:
                here, k = np.unique(owner[a:b], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([_pack(
                    [len(here), b - a], [uniq[here].astype("<i8"), size[here].astype("<i4"), k.astype("<i4"),
                                         member[a:b].astype("<u8"), freq[a:b]])], pa.binary())], names=["part", "payload"])

    return blocks.repartition(parts, "part").mapInArrow(run, "part int, payload binary")


def _candidates(blocks: DataFrame, parts: int) -> DataFrame:
    """Sets with enough shared members: set_id, n, shared members, prefix and
    how many sets hold each member of the prefix (65,535 for a hot one)."""

    def run(batches):
        release_memos()
        raw = [p for b in batches for p in b.column(1).to_pylist()]
        if not raw:
            return
        got = [_unpack(p, BACK) for p in raw]
        ids = np.concatenate([g[0] for g in got])
        n, k = np.concatenate([g[1] for g in got]).astype(np.int64), np.concatenate([g[2] for g in got])
        member, freq = np.concatenate([g[3] for g in got]), np.concatenate([g[4] for g in got])
        uniq, first, back = np.unique(ids, return_index=True, return_inverse=True)
        n, owner = n[first], np.repeat(back, k)
        shared = np.bincount(owner, minlength=len(uniq))
        good = 100 * shared >= PERCENT * n
        keep = good[owner]
        member, freq, owner = member[keep], freq[keep], owner[keep]
        if not len(member):
            return
        number = np.cumsum(good) - 1
        uniq, n, shared, owner = uniq[good], n[good], shared[good], number[owner]
        o = np.lexsort((member, freq, owner))
        member, owner = member[o], owner[o]
        at = np.cumsum(shared) - shared
        take = shared + 1 - (-(-PERCENT * n // 100))  # prefix less the members nobody shares
        early = np.arange(len(member)) - at[owner] < take[owner]
        prefix, freq = member[early], freq[o][early]
        off = lambda c: pa.array(np.concatenate([[0], np.cumsum(c)]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(uniq), pa.array(n), pa.ListArray.from_arrays(off(shared), pa.array(member.astype(np.int64))),
             pa.ListArray.from_arrays(off(take), pa.array(prefix.astype(np.int64))),
             pa.ListArray.from_arrays(off(take), pa.array(freq.astype(np.int32)))],
            names=["set_id", "n", "members", "prefix", "freq"])

    return blocks.repartition(parts, "part").mapInArrow(
        run, "set_id long, n long, members array<long>, prefix array<long>, freq array<int>")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that reach the threshold.  Members that only one set holds
    can't be common, so the shared ones and the sizes decide exactly."""
    x = sets.select(F.col("set_id").alias("a"), F.col("n").alias("na"), F.col("members").alias("ma"))
    y = sets.select(F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("members").alias("mb"))
    both = pairs.select("a", "b").join(x, "a").join(y, "b").withColumn("o", F.size(F.array_intersect("ma", "mb")))
    return both.where(f"100 * o >= {PERCENT} * (na + nb - o)").select("a", "b")


def _possible(x: str, y: str):
    """Whether sizes and shared members leave the threshold in reach."""
    most = F.least(F.col(f"{x}.shared"), F.col(f"{y}.shared"))
    return 100 * most >= PERCENT * (F.col(f"{x}.n") + F.col(f"{y}.n") - most)


def _dealt(lists: DataFrame) -> DataFrame:
    """A row of each list (t, parts) for every part of it."""
    return lists.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")


def _list_links(sets: DataFrame) -> DataFrame:
    """(a, b): links that connect all candidate sets that must be connected.

    A list's entries are dealt to parts by their set, one for each
    ``LIST_CHUNK`` sets that hold the member, and what is known of the list is
    copied to its parts; so a long list is never read by one task."""
    entries = sets.select("set_id", "n", F.size("members").alias("shared"), F.explode(F.arrays_zip("prefix", "freq")).alias("e"))
    parts = F.ceil(F.col("e.freq") / LIST_CHUNK).cast("int")
    entries = entries.select("set_id", "n", "shared", F.col("e.prefix").alias("t"), parts.alias("parts"),
                             F.pmod(F.xxhash64("set_id"), parts).cast("int").alias("part"))
    lists = entries.groupBy("t", "parts").count().where("count > 1").drop("count")
    entries = staged(entries.join(_dealt(lists), ["t", "part"], "left_semi"), "lists")
    links, label = None, None
    for r in range(ROUNDS + 1):
        if label is None:
            here = entries.withColumn("c", F.col("set_id"))
        else:
            here = (entries.join(label, F.col("set_id") == F.col("node"), "left")
                    .withColumn("c", F.coalesce("component", "set_id")).drop("node", "component"))
            mixed = here.groupBy("t", "parts").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1")
            here = staged(here.join(_dealt(mixed.select("t", "parts")), ["t", "part"], "left_semi"), "lists")
        if r < ROUNDS:
            one = here.groupBy("t", "parts").agg(
                F.min_by(F.struct("set_id", "n", "shared", "c"), F.xxhash64("set_id", F.lit(r))).alias("y"))
            x = F.struct("set_id", "n", "shared", "c").alias("x")
            pairs = (here.select("t", "part", x).join(_dealt(one), ["t", "part"])
                     .where("x.c != y.c").where(_possible("x", "y")))
            pairs = pairs.select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")).distinct()
            found = _verified(pairs, sets)
        else:
            found = _rest(here, sets)
        found = staged(found, "links")
        # a star for each component says as much as all links before
        links = found if links is None else links.unionByName(found)
        if r < ROUNDS and (label is None or not found.isEmpty()):
            label = components(links, "a", "b")
            links = label.where("component < node").select(F.col("component").alias("a"), F.col("node").alias("b"))
    return links


def _rest(here: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links among all pairs across components that share a list.

    A list's sets are cut by a hash of the set into cells of about ``CELL``
    sets of all that are left.  Every set outside its list's largest component
    gets, for each cell, the sets there that its lists name: at most a cell's
    worth, however long the lists are.  Sets so gathered are then compared
    in blocks (cell, row) of about ``CELL`` sets on either side, to which only
    the sets that a block names travel; they give links, not pairs."""
    most = here.groupBy("t", "parts", "c").count().groupBy("t", "parts").agg(F.max_by("c", F.struct("count", "c")).alias("top"))
    here = here.join(_dealt(most), ["t", "part"])
    cells = 1 + here.select("set_id").distinct().count() // CELL
    cell = F.pmod(F.xxhash64("set_id", F.lit("cell")), F.lit(cells)).alias("cell")
    lists = here.groupBy("t", "parts", cell).agg(F.collect_list(F.struct("set_id", "n", "shared", "c")).alias("ys"))
    # each part of a list, its sets outside the largest component, meets each of the list's cells
    some = here.where("c != top").groupBy("t", "part").agg(F.collect_list(F.struct("set_id", "n", "shared", "c")).alias("xs"))
    joined = _dealt(lists).join(some, ["t", "part"]).select("cell", "ys", F.explode("xs").alias("x")).select("x.set_id", "cell", F.expr(
        f"""transform(filter(ys, y -> y.c != x.c and 100 * least(x.shared, y.shared) >=
            {PERCENT} * (x.n + y.n - least(x.shared, y.shared))), y -> y.set_id)""").alias("ys"))
    united = joined.where("size(ys) > 0").groupBy("set_id", "cell").agg(F.array_distinct(F.flatten(F.collect_list("ys"))).alias("ys"))
    united = staged(united, "rest")
    rows = 1 + united.select("set_id").distinct().count() // CELL
    united = united.withColumn("row", F.pmod(F.xxhash64("set_id", F.lit("row")), F.lit(rows)))
    have = sets.select("set_id", "n", "members")
    xs = united.join(have, "set_id").select("cell", "row", "set_id", "n", "members", "ys")
    named = united.groupBy("cell", "row").agg(F.array_distinct(F.flatten(F.collect_list("ys"))).alias("ys"))
    named = named.select("cell", "row", F.explode("ys").alias("set_id"))
    ys = named.join(have, "set_id").select(*[F.col(c).alias(c) for c in ("cell", "set_id", "n", "members", "row")])
    return xs.groupBy("cell", "row").cogroup(ys.groupBy("cell", "row")).applyInArrow(_meet, "a long, b long").distinct()


def _meet(x: pa.Table, y: pa.Table) -> pa.Table:
    """Links between the sets of a cell and those that are to meet them."""
    a, b = [], []
    if len(x) and len(y):
        order = np.argsort(y.column("set_id").to_numpy())
        y = y.take(pa.array(order)).combine_chunks()
        ids, size = y.column("set_id").to_numpy(), y.column("n").to_numpy()
        lists = y.column("members").combine_chunks()
        at, member = lists.offsets.to_numpy(), lists.flatten().to_numpy()
        at = at - at[0]
        for who, n, own, meet in zip(*(x.column(c).to_pylist() for c in ("set_id", "n", "members", "ys"))):
            own, k = np.sort(np.array(own, dtype=np.int64)), np.searchsorted(ids, np.array(meet, dtype=np.int64))
            count = at[k + 1] - at[k]
            first = np.cumsum(count) - count
            some = member[np.repeat(at[k] - first, count) + np.arange(count.sum())]
            hit = own[np.minimum(np.searchsorted(own, some), len(own) - 1)] == some
            common = np.add.reduceat(hit, first, dtype=np.int64)
            good = k[100 * common >= PERCENT * (n + size[k] - common)]
            a += [who] * len(good)
            b += ids[good].tolist()
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links).

    A null, empty or wordless text has an empty set, linked with nothing.  Rows
    without an id keep their n_shingles and get a null component_id.  Rows
    that repeat an id get a row each; links of any of them count for the id.
    Extra columns are not read; an empty table gives an empty one."""
    spark = docs.sparkSession
    src = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("binary").alias("text"))
    table = staged(_sets(src), "sets")
    rows = table.where("n is not null")
    nodes = rows.where("n > 0 and doc_id is not null")
    n_docs, n_members = nodes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    least_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    often = table.where("n is null").groupBy("set_id").agg(F.sum("doc_id").alias("k")).where(
        F.col("k") >= max(2.0, HOT_SHARE / 2 * n_docs))
    hot = np.sort(np.array([r[0] for r in often.select("set_id").collect()], dtype=np.int64).view(np.uint64))
    small = staged(nodes.where(F.col("n") <= SMALL_MAX).select("set_id", "n", "members").dropDuplicates(["set_id"]), "small")
    n0 = boundary(small)
    least = -(-PERCENT * (n0 + 1) // 100)
    # first pass: which sets share enough of their leading members
    named = src.where("doc_id is not null")
    parts = max(least_parts, -(-lead_length(n_members) // PART_MEMBERS))
    possible = _possible_sets(_send(named, hot, least, parts, lead=True), hot, parts)
    possible = nodes.select("doc_id", "set_id").join(possible, "set_id").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))
    possible = staged(possible, "possible")
    count, n_members = possible.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # second pass: all members of one document of each
    parts = max(least_parts, -(-n_members // PART_MEMBERS))
    sent = _send(_only(named, possible.select("doc_id"), count), hot, least, parts)
    sets = staged(_candidates(_count(sent, hot, parts), parts), "candidates")
    links = _subset_links(small.where(F.col("n") <= n0), n0).unionByName(_list_links(sets))
    label = components(links, "a", "b")
    # a set's documents, then the documents of sets with a common component
    by_set = nodes.select("doc_id", "set_id").join(label, F.col("set_id") == F.col("node"), "left")
    by_set = by_set.select("doc_id", F.coalesce("component", "set_id").alias("c"))
    return rows.select("doc_id", F.col("n").alias("n_shingles")).join(_smallest(by_set), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _smallest(by_set: DataFrame) -> DataFrame:
    """(doc_id, component_id).  Only an id that several components hold (rows
    that repeat it) needs another contraction."""
    first = by_set.groupBy("c").agg(F.min("doc_id").alias("m"))
    pairs = by_set.join(first, "c").select("doc_id", "m").distinct()
    best = pairs.groupBy("doc_id").agg(F.min("m").alias("m"), F.count("*").alias("k"))
    best = staged(best, "labels")
    if best.where("k > 1").isEmpty():
        return best.select("doc_id", F.col("m").alias("component_id"))
    label = components(pairs, "m", "doc_id")
    return label.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))


def op9_size_aware_jaccard(spark, sf_dir) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
