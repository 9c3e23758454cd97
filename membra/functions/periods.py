"""Date -> period arithmetic and version names."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the period calendar: the first period starts in 1789 and a
# period lasts two years, switching on 3 January of odd years.
FIRST_PERIOD_YEAR = 1789
PERIOD_SWITCH_MONTH = 1
PERIOD_SWITCH_DAY = 3

# Fixed values of the legacy election-year table: periods 96..115 map to
# election years 1978..2016 in steps of two; other periods have none.
ELECTION_TABLE_FIRST_PERIOD = 96
ELECTION_TABLE_LAST_PERIOD = 115
ELECTION_TABLE_FIRST_YEAR = 1978
ELECTION_TABLE_STEP = 2

# Fixed value: the version-date pattern inside a snapshot file name.
SNAPSHOT_DATE_PATTERN = r"(\d{4}-\d{2}-\d{2})"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_of(date_col) -> Column:
    """Period number of a date (P16).  NULL date -> NULL period.

    An odd year counts as the year before until the switch day, so
    2019-01-02 -> 115 and 2019-01-03 -> 116.
    """
    d = _c(date_col).cast("date")
    y = F.year(d)
    before_switch = (y % 2 == 1) & (
        d < F.make_date(y, F.lit(PERIOD_SWITCH_MONTH), F.lit(PERIOD_SWITCH_DAY)))
    eff = F.when(before_switch, y - 1).otherwise(y)
    return (F.floor((eff - F.lit(FIRST_PERIOD_YEAR)) / 2) + 1).cast("int")


def election_year_of(period_col) -> Column:
    """Election year of a period from the legacy table, by arithmetic."""
    p = _c(period_col)
    return F.when(
        p.between(ELECTION_TABLE_FIRST_PERIOD, ELECTION_TABLE_LAST_PERIOD),
        (F.lit(ELECTION_TABLE_FIRST_YEAR)
         + F.lit(ELECTION_TABLE_STEP) * (p - F.lit(ELECTION_TABLE_FIRST_PERIOD))).cast("int"))


def election_year_table(spark: SparkSession):
    """The same table as a 20-row dimension built with ``sequence``.

    Its size is fixed by construction, so joining it with ``broadcast`` is safe.
    """
    return spark.range(1).select(F.inline(F.arrays_zip(
        F.sequence(F.lit(ELECTION_TABLE_FIRST_PERIOD),
                   F.lit(ELECTION_TABLE_LAST_PERIOD)).alias("period"),
        F.sequence(F.lit(ELECTION_TABLE_FIRST_YEAR),
                   F.lit(ELECTION_TABLE_FIRST_YEAR + ELECTION_TABLE_STEP
                         * (ELECTION_TABLE_LAST_PERIOD - ELECTION_TABLE_FIRST_PERIOD)),
                   F.lit(ELECTION_TABLE_STEP)).alias("year_elected"))))


def snapshot_date_of(file_name) -> Column:
    """Version date from a file base name (X1); NULL when the name has none."""
    txt = F.regexp_extract(_c(file_name), SNAPSHOT_DATE_PATTERN, 1)
    return F.when(txt == "", F.lit(None)).otherwise(F.try_to_date(txt, "yyyy-MM-dd"))


def base_name(path) -> Column:
    """``basename(path)``."""
    return F.element_at(F.split(_c(path), "/"), -1)


def version_file_name(prefix: str, commit_date, sha, ext: str = "yaml") -> Column:
    """``<prefix>-<yyyy-MM-dd>-<sha[0:7]>.<ext>`` for a version table."""
    stem = F.concat_ws("-", F.lit(prefix), F.date_format(_c(commit_date), "yyyy-MM-dd"),
                       F.substring(_c(sha), 1, 7))
    return F.concat(stem, F.lit("." + ext))
