"""Best-fit packing of token pieces by a linear grouping scheme.

Lengths are whole numbers up to the capacity, so the problem is a histogram of
at most ``capacity`` rows however many documents there are; the driver plans
on that alone.

1.  Large lengths are sorted and cut into groups of equal cardinality, each
    rounded up to its longest.
2.  The few rounded sizes are packed by the configuration linear program
    (column generation; the pricing step is a knapsack), rounded down.
3.  Slots of the configurations are filled with actual lengths of their group.
4.  Small lengths, and what the rounding left over, go best-fit, longest
    first, into the room that is left; configurations that stay over
    ``LOOSE`` empty are undone, and the rest goes best-fit into new sequences.

Bins that look alike are handled as one with a count.  The plan says which
ranks of each length go to which sequences; a row finds its place by its rank
among the rows of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, quoted, staged
from .tokens import Encoder, default_path

CAPACITY, END_ID = 2048, 0
#: lengths over capacity / SMALL are large; groups of the large ones
SMALL, GROUPS, MAX_COLUMNS = 3, 90, 1500
#: shares of room from which a configuration's sequences are undone; the best is taken
LOOSE = (0.0, 0.0005, 0.002, 0.01)
#: rows of one length are ranked in this many shares, and one more for each so many rows
SALTS, ROWS_A_SALT = 16, 10_000_000


# ---------------------------------------------------------------- the plan
def _knapsack(value: np.ndarray, size: np.ndarray, cap: int, most: int) -> tuple[float, np.ndarray]:
    """Best value of at most ``most`` items within ``cap`` (items may repeat)."""
    best, picks = np.zeros(cap + 1), []
    for _ in range(most):
        nxt, pick = best.copy(), np.full(cap + 1, -1)
        for g in np.flatnonzero(value > 1e-12):
            s = size[g]
            got = best[: cap + 1 - s] + value[g]
            better = got > nxt[s:] + 1e-12
            nxt[s:][better] = got[better]
            pick[s:][better] = g
        picks.append(pick)
        if not (nxt > best + 1e-12).any():
            break
        best = nxt
    a, c = np.zeros(len(size), dtype=np.int64), cap
    for pick in reversed(picks):
        if pick[c] >= 0:
            g = pick[c]
            a[g] += 1
            c -= size[g]
    return float(a @ value), a


def configurations(size: np.ndarray, need: np.ndarray, cap: int) -> list[tuple[int, np.ndarray]]:
    """(times, items of each size) of the configuration LP's basis, rounded down."""
    k = len(size)
    cols = [np.eye(k, dtype=np.int64)[g] * (cap // size[g]) for g in range(k)]
    basis = np.stack(cols, axis=1).astype(float)
    x = need / np.diag(basis)
    for _ in range(MAX_COLUMNS):
        price = np.linalg.solve(basis.T, np.ones(k))
        value, a = _knapsack(price, size, cap, cap // int(size.min()))
        if value <= 1 + 1e-7:
            break
        d = np.linalg.solve(basis, a.astype(float))
        ok = d > 1e-9
        if not ok.any():
            break
        ratio = np.where(ok, x / np.where(ok, d, 1), np.inf)
        out = int(ratio.argmin())
        step = max(ratio[out], 0.0)
        x = np.maximum(x - step * d, 0)
        x[out], cols[out], basis[:, out] = step, a, a
    left, got = need.astype(np.int64).copy(), []
    for g in np.argsort(-x, kind="stable"):
        used = cols[g] > 0
        times = int(min(np.floor(x[g] + 1e-6), (left[used] // cols[g][used]).min()))
        if times > 0:
            left -= times * cols[g]
            got.append((times, cols[g]))
    return got


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple]:
    """(length, first rank, rows, first sequence, offset) rows that place
    ranks 0 to count - 1 of every length."""
    hist = {int(k): int(n) for k, n in histogram.items() if n > 0}
    if any(k < 1 or k > capacity for k in hist):
        raise ValueError("lengths must be from 1 to the capacity")
    bins: list[tuple[int, list[int]]] = []  # (count, lengths)
    large = sorted((k for k in hist if k * SMALL > capacity), reverse=True)
    total = sum(hist[k] for k in large)
    if total:
        # groups of equal cardinality, as runs of (length, rows)
        runs: list[list[list[int]]] = [[]]
        per, room = -(-total // groups), -(-total // groups)
        for k in large:
            n = hist[k]
            while n:
                if not room:
                    runs.append([])
                    room = per
                take = min(n, room)
                runs[-1].append([k, take])
                n, room = n - take, room - take
        size = np.array([r[0][0] for r in runs])
        need = np.array([sum(n for _, n in r) for r in runs])
        # groups that round to one size are one size
        uniq, back = np.unique(size, return_inverse=True)
        merged: list[list[list[int]]] = [[] for _ in uniq]
        for r, u in zip(runs, back):
            merged[u] += r
        need = np.bincount(back, weights=need).astype(np.int64)
        heads = [0] * len(uniq)
        for times, a in configurations(uniq, need, capacity):
            slots = []
            for g in np.flatnonzero(a):
                for _ in range(a[g]):
                    want, got = times, []
                    while want:
                        k, n = merged[g][heads[g]]
                        take = min(want, n)
                        got.append((k, take))
                        merged[g][heads[g]][1] -= take
                        heads[g] += take == n
                        want -= take
                    slots.append(got)
            cuts = sorted({int(c) for s in slots for c in np.cumsum([n for _, n in s])})
            at, done = [0] * len(slots), 0
            left = [s[0][1] for s in slots]
            for c in cuts:
                n = c - done
                bins.append((n, [s[i][0] for s, i in zip(slots, at)]))
                for j, s in enumerate(slots):
                    left[j] -= n
                    if not left[j] and at[j] + 1 < len(s):
                        at[j] += 1
                        left[j] = s[at[j]][1]
                done = c
        for k in large:
            hist[k] = 0
        for r in merged:
            for k, n in r:
                hist[k] += n
    # best fit, longest first: into the configurations' room, then, with the
    # items of configurations that stayed too empty, into new sequences
    tight = _best_fit(bins, hist, capacity, fresh=False)
    tried = []
    for loose in LOOSE:
        kept, left = [], dict(hist)
        for count, items in tight:
            if capacity - sum(items) > loose * capacity:
                for k in items:
                    left[k] += count
            else:
                kept.append((count, items))
        tried.append(_best_fit(kept, left, capacity, fresh=True))
    # rounding must not cost a sequence: plain best fit is the last resort
    tried.append(_best_fit([], {int(k): int(n) for k, n in histogram.items() if n > 0}, capacity, fresh=True))
    rest = min(tried, key=lambda bins: sum(count for count, _ in bins))
    hist = dict.fromkeys(hist, 0)
    out, rank, seq = [], dict.fromkeys(hist, 0), 0
    for count, items in rest:
        at = 0
        for k in items:
            out.append((k, rank[k], count, seq, at))
            rank[k] += count
            at += k
        seq += count
    return out


def _best_fit(bins: list, hist: dict[int, int], capacity: int, fresh: bool) -> list[tuple[int, list[int]]]:
    """Bins after placing ``hist`` (emptied as far as it goes), longest first,
    each row into the bin with the least sufficient room; new bins if ``fresh``."""
    room: dict[int, list[tuple[int, list[int]]]] = {}
    frees: list[int] = []

    def put(count: int, items: list[int]) -> None:
        f = capacity - sum(items)
        if f not in room:
            room[f] = []
            insort(frees, f)
        room[f].append((count, items))

    for count, items in bins:
        put(count, items)
    for k in sorted(hist, reverse=True):
        n = hist[k]
        while n:
            i = bisect_left(frees, k)
            if i == len(frees):
                if not fresh:
                    break
                each = capacity // k
                if n >= each:
                    put(n // each, [k] * each)
                if n % each:
                    put(1, [k] * (n % each))
                n = 0
                break
            f = frees[i]
            count, items = room[f].pop()
            take = min(n, count)
            if count > take:
                room[f].append((count - take, items))
            if not room[f]:
                del room[f]
                frees.pop(i)
            put(take, [*items, k])
            n -= take
        hist[k] = n
    return [b for f in sorted(room) for b in room[f]]


# ---------------------------------------------------------------- on Spark
def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, and
    with ``with_ids`` its ``ids`` (array<int>, the end id included).

    A null text counts as empty: one piece holding the end id alone."""
    path = path or default_path()
    src = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("binary").alias("text"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        enc = Encoder(path)
        for b in batches:
            for at, texts in chunks(b, "text"):
                ids, count = enc.encode(texts)
                raw, first = memoryview(ids.astype("<u4").tobytes()), np.cumsum(count) - count
                n = count // capacity + 1
                doc = np.repeat(np.arange(len(texts)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(count[doc] + 1 - start, capacity)
                lo = first[doc] + start
                hi = np.minimum(lo + length, (first + count)[doc])
                crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(lo.tolist(), hi.tolist())]
                last = np.cumsum(n) - 1
                for i in last.tolist():
                    crc[i] = zlib.crc32(end, crc[i])
                cols = [b.column(0).slice(at, len(texts)).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                        pa.array(start.astype(np.int64)), pa.array(length.astype(np.int64)), pa.array(crc, pa.int64())]
                if with_ids:  # a text's ids with the end id after them are its pieces one after another
                    whole = np.insert(ids.astype(np.int32), first + count, end_id)
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(whole)))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return bounded_batches(src).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long"
                                           + ", ids array<int>" * with_ids)


def place(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length.

    ``parts`` must give the same rows each time it is read (a written table).
    Rows as long as the capacity are a sequence each (numbered below 0).
    Repeated rows are packed once each; an empty table gives an empty one."""
    full = parts.where(F.col("length") == capacity).select(
        *parts.columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = parts.where(F.col("length") < capacity)
    hist = {r[0]: r[1] for r in rest.groupBy("length").count().collect()}  # at most capacity - 1 rows
    salts = SALTS + sum(hist.values()) // ROWS_A_SALT
    rest = rest.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    before = (rest.groupBy("length", "salt").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count"))
              .drop("count"))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")).cast("long")
    ranked = rest.withColumn("nth", nth).join(before, ["length", "salt"])
    ranked = ranked.select(*parts.columns, (F.col("before") + F.col("nth") - 1).alias("rank"))
    table = np.array(sorted(plan(hist, capacity)), dtype=np.int64).reshape(-1, 5)
    key = (table[:, 0] << 44) + table[:, 1]
    names = [*parts.columns, "sequence_id", "offset"]
    n_cols, length_at = len(parts.columns), parts.columns.index("length")

    def run(batches):
        for b in batches:
            length, rank = (np.asarray(b.column(i)) for i in (length_at, n_cols))
            i = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n_cols], pa.array(table[i, 3] + rank - table[i, 1]), pa.array(table[i, 4])], names=names)

    return ranked.mapInArrow(run, full.schema).unionByName(full)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Cuts, encodes and packs every whole text; extra columns are not read."""
    return place(staged(pieces(docs, id_col, text_col, path, capacity, with_ids=with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from :func:`pack` with ids: sequence_id,
    ``ids`` (array<int>, at most the capacity) and ``parts`` (doc_id, piece,
    offset, length of each piece in order)."""
    part = F.struct("offset", "doc_id", "piece", "length", "ids")
    listed = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p"))
    return listed.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"), F.transform("p", lambda p: F.struct(
        p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["offset"].alias("offset"), p["length"].alias("length"))).alias("parts"))


def op10_linear_grouping_packing(spark, sf_dir) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
