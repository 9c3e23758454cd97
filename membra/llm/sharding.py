"""Sharding by a histogram sort, in DataFrame operations alone.

Rows are ordered by a hash of the text, then by id, so equal texts stand side
by side.  Splitters cut that order into shards of near-equal bytes.  They are
found by counting: each round sums the exact bytes between candidate
boundaries over all partitions and narrows every splitter to the interval that
holds its target, until the interval is within the tolerance or a single key.
Only the histogram reaches the driver (``PROBES`` rows for each open
splitter).  Then the rows are exchanged once, to ranges finer than shards, and
numbered inside them; a hot text is cut between ids where it exceeds the
tolerance, otherwise equal texts stay together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, quoted, staged

#: shards, ranges in each, probes for a splitter and round, error in shares of a shard
SHARDS, RANGES, PROBES, TOLERANCE = 8, 16, 256, 0.01
KEY_BITS = 60
#: below every id as it is ordered
LEAST = -(1 << 62)


@dataclass
class _Open:
    """Where a splitter's target lies: keys of the hash (or, once ``h`` is
    fixed, of the id) from lo to below hi, with ``below`` bytes before them."""

    lo: int
    hi: int
    below: int
    h: int | None = None

    def start(self) -> tuple[int, int]:
        return (self.lo, LEAST) if self.h is None else (self.h, self.lo)


def _histogram(rows: DataFrame, spans: list[_Open], probes: int) -> dict[int, list]:
    """For each span its cells in order: (bytes, least and greatest key)."""
    spans_at = sorted(range(len(spans)), key=lambda i: spans[i].start())
    nth = _place([spans[i].start() for i in spans_at], 0, len(spans), "h", "d")
    pick = lambda values: F.get(F.array(*[F.lit(v).cast("long") for v in values]), nth - 1)
    inner = [spans[i] for i in spans_at]
    fixed = pick([0 if s.h is None else 1 for s in inner]) == 1
    key = F.when(fixed, F.col("d")).otherwise(F.col("h"))
    inside = (nth > 0) & (key < pick([s.hi for s in inner])) & (~fixed | (F.col("h") == pick([s.h or 0 for s in inner])))
    step = pick([max(1, -(-(s.hi - s.lo) // probes)) for s in inner])
    cell = F.when(inside, F.floor((key - pick([s.lo for s in inner])) / step))
    which = F.when(inside, pick(spans_at)).cast("int")
    got = (rows.select(which.alias("i"), cell.alias("cell"), key.alias("key"), "size").where("i is not null")
           .groupBy("i", "cell").agg(F.sum("size").alias("size"), F.min("key").alias("lo"), F.max("key").alias("hi")))
    out: dict[int, list] = {i: [] for i in range(len(spans))}
    for r in sorted(got.collect(), key=lambda r: (r["i"], r["lo"])):
        out[r["i"]].append((r["size"], r["lo"], r["hi"]))
    return out


def splitters(rows: DataFrame, total: int, n: int, tolerance: int, probes: int = PROBES) -> list[tuple[int, int]]:
    """n - 1 keys (h, d); rows at or above the k-th belong to part k + 1 or later.

    ``rows`` has h, d and size and is read once a round."""
    target = [total * k // n for k in range(1, n)]
    found: dict[int, tuple[int, int]] = {}
    open_: dict[int, _Open] = {k: _Open(0, 1 << KEY_BITS, 0) for k in range(len(target))}
    first = True
    while open_:
        spans: list[_Open] = []
        at: dict[tuple, int] = {}
        of = {}
        for k, s in open_.items():
            of[k] = at.setdefault((s.h, s.lo, s.hi), len(spans))
            if of[k] == len(spans):
                spans.append(s)
        cells = _histogram(rows, spans, probes * n if first else probes)
        first = False
        for k in list(open_):
            s, want = open_[k], target[k]
            below, pick = s.below, None
            for size, lo, hi in cells[of[k]]:
                if below + size >= want:
                    pick = (size, lo, hi)
                    break
                below += size
            if pick is None:  # nothing left above: the span's end
                found[k] = (s.hi, LEAST) if s.h is None else (s.h, s.hi)
                del open_[k]
                continue
            size, lo, hi = pick
            if size > tolerance and lo == hi and s.h is None:
                open_[k] = _Open(LEAST, 1 << 62, below, h=lo)  # one hot hash: go on by id
            elif size > tolerance and lo < hi:
                open_[k] = _Open(lo, hi + 1, below, s.h)
            else:
                cut = hi + 1 if below + size - want < want - below else lo  # the nearer end
                found[k] = (cut, LEAST) if s.h is None else (s.h, cut)
                del open_[k]
    return sorted(found.values())


def shard_by_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = SHARDS,
                   ranges: int = RANGES, tolerance: float = TOLERANCE) -> DataFrame:
    """All columns of ``docs`` plus size (UTF-8 bytes + 1; 1 for null), shard and
    slot (place in the shard, gapless from 0).

    Shards differ from equal bytes by at most ``tolerance`` of a shard or by
    one row, whichever is larger.  Equal texts share a shard unless they
    exceed the tolerance.  Null texts and null ids are ordinary keys; repeated
    rows get a place each.  Input columns named size, shard or slot give way.
    An empty table gives an empty one."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("size", "shard", "slot")])
    h, d = fresh(docs, "__h"), fresh(docs, "__d")
    text = quoted(text_col).cast("binary")
    keyed = docs.select(
        *[quoted(c) for c in docs.columns], (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - KEY_BITS).alias(h),
        F.least(F.greatest(F.coalesce(quoted(id_col).cast("long"), F.lit(LEAST)), F.lit(LEAST)), F.lit(-LEAST - 1)).alias(d))
    rows = staged(keyed.select(F.col(h).alias("h"), F.col(d).alias("d"), "size"), "keys")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = n_shards * ranges
    cuts = splitters(rows, total, parts, int(total / n_shards * tolerance)) if total else []
    part = _place(cuts, 0, len(cuts), h, d)
    name = fresh(keyed, "__part")
    # rows before each range, by shard: a table of n_shards * ranges rows
    counts = (rows.withColumnsRenamed({"h": h, "d": d}).groupBy(part.alias(name)).count()
              .withColumn("__shard", F.floor(F.col(name) / ranges).cast("int")))
    w = Window.partitionBy("__shard").orderBy(name)
    before = counts.select(name, "__shard", (F.sum("count").over(w) - F.col("count")).alias("__before"))
    nth = F.row_number().over(Window.partitionBy(name).orderBy(h, d, "size"))
    placed = keyed.withColumn(name, part).withColumn("__nth", nth).join(F.broadcast(before), name)
    return placed.select(*[quoted(c) for c in docs.columns], "size", F.col("__shard").alias("shard"),
                         (F.col("__before") + F.col("__nth") - 1).cast("long").alias("slot"))


def _place(cuts: list[tuple[int, int]], lo: int, hi: int, h: str, d: str):
    """Number of splitters at or below a row's key, by a tree of comparisons."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    ch, cd = cuts[mid]
    above = (F.col(h) > ch) | ((F.col(h) == ch) & (F.col(d) >= cd))
    return F.when(above, _place(cuts, mid + 1, hi, h, d)).otherwise(_place(cuts, lo, mid, h, d))


def op1_histogram_sort_sharding(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    out = shard_by_bytes(docs.select("doc_id", "text", crc))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
