"""Embedding near-duplicates by sorted projection passes.

Each pass orders the vectors of a label by the concatenated signs of random
projections (one long integer, compared from its first sign on) and compares
every vector with the ``WINDOW`` before it.  Verified pairs of all passes are
united; a task sends on a spanning forest of what it found, so the links of a
dense cluster don't grow with the square of its size.

A window is bounded, so the passes can't see every link; they only find the
components that make compact blocks.  Then all vectors of a label and length
are compared exactly, in pairs of blocks, by matrix products that give counts
and, between components, further links.  A pair of blocks is left out only
where no link is possible: by the triangle inequality on angles, where their
centers are further apart than both radii and the threshold's angle.  Work
grows with the square of a label's vectors that this bound can't part.

Equal vectors of a label are one vector with a multiplicity throughout.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, quoted, staged
from .components import components

THRESHOLD = 0.98
#: passes (and how many share one exchange), signs of a pass, neighbours before
PASSES, AT_ONCE, BITS, WINDOW = 16, 4, 48, 48
#: most vectors and numbers of a block, the vectors from which a component has blocks
#: of its own, rows of a block compared at once, and parts of a label's list of blocks
BLOCK, NUMBERS, OWN, STRIPE, SALTS = 4_096, 1 << 19, 256, 512, 16


def _matrix(col: pa.Array) -> np.ndarray:
    """Unit rows in double precision (all of one length)."""
    x = np.asarray(col.flatten(), dtype=np.float64).reshape(len(col), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _signs(dim: int, number: int) -> np.ndarray:
    return np.random.default_rng([dim, number]).normal(size=(dim, BITS))


def _keys(reps: DataFrame, numbers: list[int]) -> DataFrame:
    """A row for each vector and pass: number, label, dim, key, rep, vec."""
    kind = reps.schema["vec"].dataType.elementType.simpleString()

    def run(batches):
        for b in batches:
            dims = np.asarray(b.column(b.schema.get_field_index("dim")))
            for d in np.unique(dims):
                rows = b.take(pa.array(np.flatnonzero(dims == d)))
                x = _matrix(rows.column(rows.schema.get_field_index("vec")))
                for p in numbers:
                    bits = (x @ _signs(int(d), p) > 0).astype(np.int64)
                    key = bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), p, np.int32)), rows.column(1), rows.column(2), pa.array(key),
                         rows.column(0), rows.column(3)], names=["number", "label", "dim", "key", "rep", "vec"])

    return reps.select("rep", "label", "dim", "vec").mapInArrow(
        run, f"number int, label string, dim int, key long, rep long, vec array<{kind}>")


class _Forest:
    def __init__(self):
        self.up: dict[int, int] = {}
        self.new: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.new.append((a, b))


def _compare(threshold: float):
    def run(batches):
        group, held_x, held_r = None, None, None
        forest = _Forest()
        for b in batches:
            number, dim = (np.asarray(b.column(i)) for i in (0, 2))
            label = b.column(1).dictionary_encode().indices.to_numpy()
            names = b.column(1).to_pylist()
            rep = np.asarray(b.column(4))
            cut = np.flatnonzero((np.diff(number) != 0) | (np.diff(dim) != 0) | (np.diff(label) != 0)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(rep)]):
                if hi == lo:
                    continue
                here = (int(number[lo]), names[lo], int(dim[lo]))
                if here != group:
                    group, held_x, held_r, forest.up = here, None, None, {}
                x, r = _matrix(b.column(5).slice(lo, hi - lo)), rep[lo:hi]
                before = 0 if held_x is None else len(held_x)
                if before:
                    x, r = np.concatenate([held_x, x]), np.concatenate([held_r, r])
                for i in range(before, len(x), 256):
                    top, low = min(i + 256, len(x)), max(0, i - WINDOW)
                    c = x[i:top] @ x[low:top].T >= threshold
                    gap = (np.arange(i, top)[:, None] - np.arange(low, top)[None])
                    for p, q in zip(*np.nonzero(c & (gap > 0) & (gap <= WINDOW))):
                        forest.join(int(r[i + p]), int(r[low + q]))
                held_x, held_r = x[-WINDOW:], r[-WINDOW:]
            if forest.new:
                a, c = np.array(forest.new, dtype=np.int64).T
                forest.new = []
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], names=["a", "b"])

    return run


def _pack(table: pa.Table) -> pa.Table:
    """One row for a block: its center, its radius as an angle, and its vectors."""
    table = table.combine_chunks()
    x = _matrix(table.column("vec").combine_chunks())
    center = x.mean(axis=0)
    length = math.sqrt(center @ center)
    center = center / length if length > 1e-9 else x[0]
    radius = math.acos(max(-1.0, min(1.0, float((x @ center).min()))))
    row = {k: [table.column(k)[0].as_py()] for k in ("id", "label", "dim")}
    row |= {"center": [center.tolist()], "radius": [radius]}
    row |= {k: [table.column(k).to_numpy().astype(np.int64).tobytes()] for k in ("rep", "node", "times")}
    return pa.table(row | {"x": [x.tobytes()]}, schema=pa.schema(
        [("id", pa.string()), ("label", pa.string()), ("dim", pa.int32()), ("center", pa.list_(pa.float64())),
         ("radius", pa.float64()), ("rep", pa.binary()), ("node", pa.binary()), ("times", pa.binary()), ("x", pa.binary())]))


def _compare_blocks(threshold: float):
    """(rep, n) of the vectors with links in a pair of blocks, and (rep, other) of
    a spanning forest of the links between different components."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {f.name: batch.column(j)[i].as_py() for j, f in enumerate(batch.schema)}
                same = row["id_a"] == row["id_b"]
                rep, node, times, x = ([np.frombuffer(row[f"{k}_{s}"], kind) for s in "ab"] for k, kind in (
                    ("rep", np.int64), ("node", np.int64), ("times", np.int64), ("x", np.float64)))
                x = [m.reshape(len(r), -1) for m, r in zip(x, rep)]
                n = [np.zeros(len(r)) for r in rep]
                forest = _Forest()
                for lo in range(0, len(rep[0]), STRIPE):
                    hi = min(lo + STRIPE, len(rep[0]))
                    near = x[0][lo:hi] @ x[1].T >= threshold
                    if same:
                        near[np.arange(hi - lo), np.arange(lo, hi)] = False
                    n[0][lo:hi] = near @ times[1].astype(np.float64)
                    if not same:
                        n[1] += times[0][lo:hi].astype(np.float64) @ near
                    p, q = np.nonzero(near & (node[0][lo:hi, None] != node[1][None]))
                    if len(p):
                        for u, v in np.unique(np.stack([node[0][lo + p], node[1][q]], axis=1), axis=0).tolist():
                            forest.join(u, v)
                u, v = np.array(forest.new, dtype=np.int64).reshape(-1, 2).T
                for r, c in list(zip(rep, n))[: 1 if same else 2]:
                    at = np.flatnonzero(c)
                    yield pa.RecordBatch.from_arrays([pa.array(r[at]), pa.array(c[at].astype(np.int64)),
                                                      pa.nulls(len(at), pa.int64())], names=["rep", "n", "other"])
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.nulls(len(u), pa.int64()), pa.array(v)], names=["rep", "n", "other"])

    return run


def _exact(member: DataFrame, threshold: float) -> DataFrame:
    """rep, n, other (as ``_compare_blocks``) of all links of ``member``: rep, node, label, dim, vec, times."""
    size = member.groupBy("label", "dim", "node").agg(F.count("*").alias("size")).where(F.col("size") >= OWN)
    member = (member.join(F.broadcast(size), ["label", "dim", "node"], "left")  # a row for OWN vectors at most
              .withColumn("own", F.when(F.col("size").isNotNull(), F.col("node").cast("string")).otherwise(F.lit("*"))))
    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(NUMBERS) / F.col("dim"))))
    number = member.groupBy("label", "dim", "own").agg(F.count("*").alias("rows")).withColumn("blocks", F.ceil(F.col("rows") / most))
    by = F.when(F.col("own") == "*", F.xxhash64("node")).otherwise(F.xxhash64("rep"))
    member = (member.join(F.broadcast(number), ["label", "dim", "own"])
              .withColumn("id", F.concat_ws(":", F.col("dim").cast("string"), "own", F.pmod(by, F.col("blocks")).cast("string"), "label")))
    blocks = staged(member.select("id", "label", "dim", "rep", "node", "times", "vec").groupBy("id").applyInArrow(
        _pack, "id string, label string, dim int, center array<double>, radius double, rep binary, node binary, times binary, x binary"), "blocks")

    def named(s: str, *cols: str) -> DataFrame:
        return blocks.select(*[F.col(c).alias(f"{c}_{s}") for c in cols])

    left = named("a", "id", "label", "dim", "center", "radius").withColumn("salt", F.pmod(F.xxhash64("id_a"), F.lit(SALTS)))
    right = (named("b", "id", "label", "dim", "center", "radius")
             .withColumn("salt_b", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    cosine = F.aggregate(F.zip_with("center_a", "center_b", lambda u, v: u * v), F.lit(0.0), lambda u, v: u + v)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    reach = F.col("radius_a") + F.col("radius_b") + F.lit(math.acos(max(-1.0, min(1.0, threshold))) + 1e-6)
    turn = F.pmod(F.xxhash64("id_a", "id_b"), F.lit(2)) == 0  # so no block is always on the same side
    pairs = left.join(right, (F.col("label_a") == F.col("label_b")) & (F.col("dim_a") == F.col("dim_b"))
                      & (F.col("salt") == F.col("salt_b")) & (F.col("id_a") <= F.col("id_b")) & (apart <= reach))
    pairs = staged(pairs.select(F.when(turn, F.col("id_a")).otherwise(F.col("id_b")).alias("id_a"),
                                F.when(turn, F.col("id_b")).otherwise(F.col("id_a")).alias("id_b")), "pairs")
    load = ("id", "rep", "node", "times", "x")
    both = pairs.join(named("a", *load), "id_a").join(named("b", *load), "id_b")
    return bounded_batches(both).mapInArrow(_compare_blocks(threshold), "rep long, n long, other long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, passes: int = PASSES) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row for each row.

    Only vectors of equal, non-null label and equal length are compared.  A
    vector that is null, empty, zero or holds a null, NaN or infinite
    component, or has no id, links with nothing (component its own id; kept
    false without an id).  Rows that repeat an id and its vector count as one
    vector.  Extra columns are not read; an empty table gives an empty one."""
    rows = vectors.select(quoted(id_col).cast("long").alias("vec_id"), quoted(label_col).cast("string").alias("label"),
                          quoted(vec_col).alias("vec"))
    fine = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0)
            & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
            & F.exists("vec", lambda v: v != 0))
    good = rows.where(F.coalesce(fine, F.lit(False))).distinct()
    reps = staged(good.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("times"))
                  .withColumn("dim", F.size("vec")), "vectors")
    links = None
    for at in range(0, passes, AT_ONCE):
        keys = _keys(reps, list(range(at, min(at + AT_ONCE, passes))))
        order = ["number", "label", "dim", "key", "rep"]
        found = keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_compare(threshold), "a long, b long")
        found = staged(found.distinct(), "links")
        links = found if links is None else links.unionByName(found)
    label = staged(components(links, "a", "b"), "labels")
    member = staged(reps.join(label, F.col("rep") == F.col("node"), "left")
                    .select("rep", "label", "dim", "vec", "times", F.coalesce("component", "rep").alias("node")), "members")
    found = staged(_exact(member, threshold), "exact")
    counts = found.where("n is not null").groupBy("rep").agg(F.sum("n").alias("n"))
    wider = components(found.where("other is not null"), "rep", "other").withColumnRenamed("node", "part")
    per_rep = (member.join(counts, "rep", "left").join(wider, F.col("node") == F.col("part"), "left")
               .select("label", "vec", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n"),
                       F.coalesce("component", "node").alias("c")))
    by_id = good.join(per_rep, ["label", "vec"]).groupBy("vec_id").agg(F.max("n").alias("n"), F.min("c").alias("c"))
    return rows.select("vec_id").join(by_id, "vec_id", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("c", "vec_id"), F.lit(False)).alias("kept"))


def op3_sorted_projection_neardup(spark, sf_dir) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
