"""Reports and audits (K11, K12 helpers, A1, A3, A11, O3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import exists_flag, join_split_nulls
from .sets import add_count

# Fixed values of the gap test: a set counts as empty when NULL, "" or ";".
EMPTY_SET_TEXTS = ("", ";")


def value_counts(df: DataFrame, keys: Sequence, name: str = "n", sort: bool = True) -> DataFrame:
    """dplyr ``count(keys, sort = TRUE)`` (A1/A2); keys may be expressions (A3)."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(name))
    return out.orderBy(F.desc(name), *[k for k in out.columns if k != name]) if sort else out


def dims(df: DataFrame) -> DataFrame:
    """``dim(x)`` (A12): one row of ``rows`` and ``columns``."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def columns_starting_with(df: DataFrame, prefix: str) -> list[str]:
    """``starts_with(prefix)`` (P5), resolved from the schema on the driver."""
    return [c for c in df.columns if c.startswith(prefix)]


def null_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """``count(is.na(col))`` (A3)."""
    return value_counts(df, [F.col(col).isNull().alias(f"is_na_{col}")], name)


def head_n(df: DataFrame, order: Sequence, n: int = 15) -> DataFrame:
    """First ``n`` rows by an explicit total order (O3)."""
    return df.orderBy(*order).limit(n)


def duplicate_audit(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows whose key occurs more than once, most frequent first (A11: W1 + F6 + O1)."""
    return (add_count(df, list(keys), name).filter(F.col(name) > 1)
            .orderBy(F.desc(name), *keys))


def is_empty_set(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | c.isin(list(EMPTY_SET_TEXTS))


def roster_with_sets(roster: DataFrame, memberships: DataFrame, keys: Sequence[str],
                     period: str, min_period: int) -> DataFrame:
    """K11 input: roster rows after ``min_period`` (filtered before the join,
    so the filter reaches the scan) left-joined to the membership sets."""
    return join_split_nulls(roster.filter(F.col(period) > min_period), memberships, list(keys), "left",
                            spread="left")


def gap_condition(set_col: str, exclude_col: str, exclude_value: str) -> Column:
    """A roster row is a gap when its set is empty and its category is not the
    excluded one (a NULL category is not TRUE, so it is no gap, as in R)."""
    return F.coalesce((F.col(exclude_col) != exclude_value) & is_empty_set(set_col),
                      F.lit(False))


def gap_report(joined: DataFrame, is_gap: Column, missing_ids: DataFrame,
               flag_keys: Sequence[str], flag: str = "icpsr_missing") -> DataFrame:
    """Gap rows flagged when their key is on a known missing-id list
    (the flag is never NULL)."""
    return exists_flag(joined.filter(is_gap), missing_ids, list(flag_keys), flag)


def gap_ids(roster_joined: DataFrame, is_gap: Column, id_col: str) -> DataFrame:
    """The distinct ids of gap rows, NULL among them; deduplicated map-side."""
    return roster_joined.filter(is_gap).select(id_col).distinct()


def gap_history(roster_joined: DataFrame, ids: DataFrame, id_col: str, order: Sequence = ()) -> DataFrame:
    """K11 second report: every row of members that have a gap in any row.

    ``ids`` is what :func:`gap_ids` gives, best as a written table, because it
    is read twice.  Rows with an id are semi-joined to it; rows without one are
    one member, as ``%in%`` matches NA to NA, and all stay where any of them is
    a gap, which a scalar of the plan says.
    """
    known = ids.filter(F.col(id_col).isNotNull())
    no_id_gap = ids.filter(F.col(id_col).isNull()).agg(F.count(F.lit(1)) > 0).scalar()
    out = roster_joined.filter(F.col(id_col).isNotNull()).join(known, id_col, "left_semi").select(
        *[F.col(f"`{c}`") for c in roster_joined.columns])
    out = out.unionByName(roster_joined.filter(F.col(id_col).isNull() & no_id_gap))
    return out.orderBy(*order) if order else out


def numbered(df: DataFrame, order: Sequence, path: str, name: str = "row") -> DataFrame:
    """``df`` sorted by ``order`` with each row's number from 1 (O1/O2 made
    visible), without a window over all rows.

    The range-partitioned, sorted rows are written to ``path`` with their place
    in their partition; a partition's offset is the number of rows before it,
    a table of one row a partition."""
    (df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id())
     .write.parquet(path))
    rows = df.sparkSession.read.parquet(path)
    place = F.lit((1 << 33) - 1)
    part = F.shiftright(F.col("__id"), 33).alias("__part")
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return rows.withColumn("__part", F.shiftright(F.col("__id"), 33)).join(offsets, "__part").withColumn(
        name, F.col("__before") + F.col("__id").bitwiseAND(place) + 1).drop("__part", "__before", "__id")
