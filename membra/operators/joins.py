"""Join forms used by the operators, with dplyr's NA = NA key rule.

``<=>`` keys stay equi-join keys (Spark plans them on ``coalesce(k, 0)`` and
``isnull(k)``), so these are ordinary hash / sort-merge joins.  Broadcasts are
only requested for tables whose size is bounded by construction (rule tables
built from literals); data-derived dimensions are left to the optimizer's
size-based broadcast, which AQE re-checks at run time from measured sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: tables we build from literal rules and broadcast explicitly must
# stay under this many rows.
MAX_LITERAL_BROADCAST_ROWS = 100_000


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str] | Sequence[tuple[str, str]],
            how: str = "left", null_safe: bool = True) -> DataFrame:
    """Join on explicit keys, NULL matching NULL by default.

    ``keys`` are shared names or (left, right) name pairs (J9).  For shared
    names the result has one copy of each key: for full and right joins the
    coalesce of both sides (like dplyr), otherwise the left one.  Both sides
    are aliased, so self-joins of one lineage resolve correctly.
    """
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in keys]
    shared = {lk for lk, rk in pairs if lk == rk}
    lq, rq = left.alias("__l"), right.alias("__r")
    cond = None
    for lk, rk in pairs:
        a, b = F.col(f"__l.`{lk}`"), F.col(f"__r.`{rk}`")
        e = a.eqNullSafe(b) if null_safe else (a == b)
        cond = e if cond is None else cond & e
    joined = lq.join(rq, cond, how)
    if how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti"):
        return joined
    outer_right = how in ("full", "full_outer", "fullouter", "outer", "right", "right_outer")
    out = []
    for c in left.columns:
        lc = F.col(f"__l.`{c}`")
        if c in shared and outer_right:
            out.append(F.coalesce(lc, F.col(f"__r.`{c}`")).alias(c))
        else:
            out.append(lc.alias(c))
    out += [F.col(f"__r.`{c}`").alias(c) for c in right.columns if c not in shared]
    return joined.select(*out)


def left_join_dim_dropna(df: DataFrame, dim: DataFrame, keys: Sequence[str],
                         required: str) -> DataFrame:
    """``left_join(x, distinct(dim)) |> drop_na(required)`` (J1 + F1).

    The dimension is deduplicated first, as the reference does; Catalyst then
    rewrites the left join + not-null filter into an inner join.
    """
    d = dim.distinct()
    return join_on(df, d, keys, "left").filter(F.col(required).isNotNull())


def exists_flag(df: DataFrame, keys_df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``left_join(marker) |> replace_na(FALSE)``: TRUE when the key is in
    ``keys_df`` (J12/J13 as a flag, never NULL)."""
    marks = keys_df.select(*keys).distinct().withColumn(name, F.lit(True))
    out = join_on(df, marks, keys, "left")
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def literal_table(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A small table from literal rows, marked for broadcast (size bounded)."""
    if len(rows) > MAX_LITERAL_BROADCAST_ROWS:
        raise ValueError(f"literal table has {len(rows)} rows; write it as a dataset instead")
    return F.broadcast(spark.createDataFrame(rows, schema))


def join_split_nulls(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "full",
                     spread: str = "right", parts: int | None = None) -> DataFrame:
    """:func:`join_on` with NULL = NULL where the rows whose first key is NULL
    (R pools them, N4) don't all meet in one task.

    Such rows of the ``spread`` side are dealt over ``parts`` (default
    ``spark.sql.shuffle.partitions``) by a hash of their columns; those of the
    other side are copied to each part, but only where the spread side has
    their key at all.  Rows that match nothing come once.  Rows with a key are
    joined as usual.  ``how`` is "full", or "left" with the left side spread.
    """
    if how not in ("full", "left") or (how == "left" and spread != "left"):
        raise ValueError("full joins, or left joins that spread the left side")
    n = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    no_key = F.col(f"`{keys[0]}`").isNull()
    dealt, copied = (left, right) if spread == "left" else (right, left)
    plain = [F.col(f"`{f.name}`") for f in dealt.schema if "map<" not in f.dataType.simpleString()]
    met = dealt.filter(no_key).select(*keys).distinct().withColumn("__met", F.lit(True))
    copied = join_on(copied.filter(no_key), met, keys, "left").unionByName(
        copied.filter(~no_key).withColumn("__met", F.lit(None).cast("boolean")))
    salts = F.when(F.col("__met"), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    copied = copied.withColumn("__salt", F.explode(salts))
    dealt = dealt.withColumn("__salt", F.when(no_key, F.pmod(F.xxhash64(*plain), F.lit(n)).cast("int")).otherwise(0))
    dealt = dealt.withColumn("__dealt", F.lit(True))
    a, b = (dealt, copied) if spread == "left" else (copied, dealt)
    out = join_on(a, b, [*keys, "__salt"], how)
    # a copy that met nothing in its part has met something in another
    out = out.filter(F.col("__dealt") | ~no_key | F.col("__met").isNull()) if how == "full" else out
    return out.drop("__salt", "__dealt", "__met")
