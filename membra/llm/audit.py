"""Filter interaction audit: what each filter removes, in every order.

A document's *mask* says which filters it fails.  Filters are applied one after
the other, and a document goes at the first filter it fails.  For a mask m and
an order o, written as its inverse permutation (the step at which each filter
comes), the removal step is the least step among the failed filters.  With 0
where a mask fails a filter and infinity where it passes, that is the min-plus
product of the matrix of masks and the matrix of positions: all masks and all
orders at once.

Documents enter only as weights: the number of documents of each part and mask,
of those with good quality and of those that are toxic.  Weights are scattered
to the removal steps; what stays, what a filter finds already removed, what it
alone fails and what it removes over all orders follow from them.

The masks are counted by Spark, with built-in functions on the text.  A copy is
a document whose whole text an earlier one (of a smaller id) has.  Of the rows
of a text only those with the least id are no copies, so they are taken from
the text's counts; rows aren't gathered by text.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, staged

#: the filter that holds copies; the others are conditions on a row's text
COPY = "E"
_WEIGHTS = ("docs", "good", "toxic")


# ---------------------------------------------------------------- removal steps
def min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(i, j): least a[i, k] + b[k, j]."""
    return (a[:, :, None] + b[None]).min(axis=1)


def removal_steps(n: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """(orders of n filters, removal step from 0 of each mask by order); a mask
    that fails nothing has step n."""
    orders = list(permutations(range(n)))
    position = np.argsort(np.array(orders), axis=1).T.astype(float)  # inverse permutations: filter by order
    fails = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1 == 1
    step = min_plus(np.where(fails, 0.0, np.inf), position)
    return orders, np.where(np.isinf(step), n, step).astype(np.int64)


def tabulate(weights: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """Counts by part, order and step from weights by kind, part and mask."""
    orders, gone = removal_steps(n)
    who = np.array(orders)  # order by step: the filter
    kinds, parts, masks = weights.shape
    scatter = np.zeros((kinds, parts, len(orders), n + 1), dtype=np.int64)
    column = np.broadcast_to(np.arange(len(orders)), gone.shape)
    for m in range(masks):  # each mask has one step an order, so no place comes twice
        scatter[:, :, column[m], gone[m]] += weights[:, :, m, None]
    removed = scatter[..., :n]
    fails = ((np.arange(masks)[:, None] >> np.arange(n)) & 1).astype(np.int64)
    failing = weights[0] @ fails
    only = weights[0][:, 1 << np.arange(n)]
    # a mask that fails a filter is gone before it comes, or at it
    shapley = np.zeros((parts, n), dtype=np.int64)
    for f in range(n):
        shapley[:, f] = removed[0][:, who == f].sum(axis=1)
    return {"kept": weights[0].sum(axis=1)[:, None, None] - np.cumsum(removed[0], axis=2), "removed": removed[0],
            "redundant": failing[:, who] - removed[0], "unique_fails": only[:, who],
            "good_lost": removed[1], "toxic_lost": removed[2], "shapley": shapley[:, who]}


# ---------------------------------------------------------------- masks
def text_filters(text: str = "text") -> dict[str, Column]:
    """Conditions under which a text (never null) fails."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": F.size(words) < 100,
            "B": 100 * F.size(F.array_distinct(words)).cast("long") < 80 * F.size(words).cast("long"),
            "C": 100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
            "D": F.col(text).rlike("[#$%&*|]")}


def mask_counts(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, part: str = "lang") -> DataFrame:
    """part, mask and the number of documents, good ones and toxic ones.

    Bit i of a mask is filter i of ``filters``; the last bit is the copy filter.
    Of the columns of ``docs`` only doc_id, text and ``part`` are read.  A null
    text is an empty one, a null part an empty string.  A row without an id
    precedes and follows none, so it is no copy and makes none; rows that repeat
    the least id of a text are no copies either.  A document is good (toxic)
    if any of its labels says so; labels without an id say nothing."""
    filters = filters or text_filters()
    bits = len(filters)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(quoted(part).cast("string"), F.lit("")).alias("part"),
                      F.coalesce("text", F.lit("")).alias("text"))
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(0) for i, c in enumerate(filters.values())), F.lit(0))
    rows = src.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"), mask.cast("long").alias("mask"))
    # rows that are alike are one row with a number; ids that are missing go to any partition
    rows = rows.groupBy("doc_id", "key", "part", "mask").count()
    seen = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("key", "part"), F.lit(1 << 16))).otherwise(0)
    rows = rows.withColumn("salt", salt).join(seen.withColumn("salt", F.lit(0).cast("long")), ["doc_id", "salt"], "left").drop("salt")
    rows = staged(rows.fillna(0, ["good", "toxic"]), "masks")
    first = rows.where("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    by = ["part", "mask", "good", "toxic"]
    all_rows = rows.groupBy(*by).agg(F.sum("count").alias("n"))
    # of a text's rows those of the least id, and those without an id, are no copies
    own = rows.join(first, ["key", "doc_id"]).select(*by, "count").unionByName(
        rows.where("doc_id is null").select(*by, "count")).groupBy(*by).agg(F.sum("count").alias("n"))
    copy = 1 << bits
    both = all_rows.withColumn("mask", F.col("mask") + copy).unionByName(own).unionByName(
        own.select("part", (F.col("mask") + copy).alias("mask"), "good", "toxic", (-F.col("n")).alias("n")))
    n = F.col("n")
    return both.groupBy("part", "mask").agg(F.sum("n").alias("docs"), F.sum(n * F.col("good")).alias("good"),
                                            F.sum(n * F.col("toxic")).alias("toxic")).where("docs > 0")


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, part: str = "lang") -> DataFrame:
    """One row for each part, filter_order and step, with the counts of
    :func:`tabulate`; an empty table has no part and gives no row.

    ``filters`` maps one-letter names to conditions on ``text`` under which a
    document fails; the copy filter ``E`` comes last."""
    filters = filters or text_filters()
    names = [*filters, COPY]
    n = len(names)
    if any(len(x) != 1 for x in names) or len(set(names)) < n:
        raise ValueError("filters need one-letter names of their own, other than " + COPY)
    masks = 1 << n
    pick = lambda k: F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(k))), F.lit(0)) for m in range(masks)]).alias(k)
    weights = mask_counts(docs, labels, filters, part).groupBy("part").agg(*[pick(k) for k in _WEIGHTS])
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def run(batches):
        orders, _ = removal_steps(n)
        name = ["".join(names[i] for i in o) for o in orders]
        for b in batches:
            for at in range(0, b.num_rows, 64):
                here = b.slice(at, 64)
                w = np.stack([np.array(here.column(i + 1).to_pylist(), dtype=np.int64).reshape(-1, masks) for i in range(3)])
                got = tabulate(w, n)
                per = len(orders) * n
                cols = [pa.array(np.repeat(np.array(here.column(0).to_pylist(), dtype=object), per), pa.string()),
                        pa.array(np.tile(np.repeat(name, n), len(here)), pa.string()),
                        pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(here) * len(orders)))]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(got[k].reshape(-1)) for k in counts],
                                                 names=["part", "filter_order", "step", *counts])

    return weights.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{k} long" for k in counts))


def op12_min_plus_filter_audit(spark, sf_dir) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP12_SQL = """
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
label AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
  FROM labels GROUP BY doc_id),
fails AS (
  SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         len(d.w) < 100 AS a,
         100 * len(list_distinct(d.w)) < 80 * len(d.w) AS b,
         100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 10 * length(d.text) AS c,
         regexp_matches(d.text, '[#$%&*|]') AS d,
         coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY d.text), false) AS e
  FROM words d LEFT JOIN label l ON l.doc_id = d.doc_id),
weight AS (
  SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM fails GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT p.f || q.f || r.f || s.f || t.f AS filter_order
  FROM letter p, letter q, letter r, letter s, letter t
  WHERE q.f <> p.f AND r.f NOT IN (p.f, q.f) AND s.f NOT IN (p.f, q.f, r.f) AND t.f NOT IN (p.f, q.f, r.f, s.f)),
gone AS (
  SELECT w.*, o.filter_order,
         least(CASE WHEN a THEN instr(o.filter_order, 'A') ELSE 6 END, CASE WHEN b THEN instr(o.filter_order, 'B') ELSE 6 END,
               CASE WHEN c THEN instr(o.filter_order, 'C') ELSE 6 END, CASE WHEN d THEN instr(o.filter_order, 'D') ELSE 6 END,
               CASE WHEN e THEN instr(o.filter_order, 'E') ELSE 6 END) AS gone_at
  FROM weight w, orders o),
steps AS (
  SELECT g.part, g.filter_order, s.step, substr(g.filter_order, s.step, 1) AS f, g.gone_at, g.n, g.good, g.toxic,
         CASE substr(g.filter_order, s.step, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS failing,
         CAST(a AS INTEGER) + CAST(b AS INTEGER) + CAST(c AS INTEGER) + CAST(d AS INTEGER) + CAST(e AS INTEGER) AS fails
  FROM gone g, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
counted AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (WHERE gone_at > step), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE gone_at = step), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE failing AND gone_at < step), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE failing AND fails = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE gone_at = step), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE gone_at = step), 0) AS toxic_lost
  FROM steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
