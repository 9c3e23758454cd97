"""Delimited files, positional renames, stage datasets and report sinks
(S5, S6, S8, S9)."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The committed correction overlay file (20 rows).  The blank
# header of the fourth column is named ``...4`` as R names it.
CORRECTIONS_SCHEMA = (
    "congress int, chamber string, bioname string, `...4` string, icpsr int, "
    "member_groups string, chair int, ranking_minority int, district_code int, "
    "state_abbrev string, state string, pop2010 int, majority int, presidents_party int, "
    "party string, first_cong int, first_year int, notes string")
# The committed gap report.
GAP_REPORT_SCHEMA = ("chamber string, congress int, bioname string, icpsr int, state string, "
                     "bioguide_id string, icpsr_missing boolean")
# The committed list of people without an id.
MISSING_ID_SCHEMA = "congress int, bioguide string, full_name string, wikipedia_id string"
# Positional names of the legacy House spreadsheet (20) and Senate one (21).
HOUSE_SHEET_NAMES = (
    "congress", "commcode", "source_code", "name", "partystatus", "partyrank", "party",
    "assigneddate", "terminationdate", "seniorstatus", "committeeseniority", "committeeperiod",
    "assignmentstatusatend", "assignmentstatusnext", "ac", "committeename", "statenumber", "cd",
    "state.name", "notes")
SENATE_SHEET_NAMES = (
    "congress", "commcode", "source_code", "name", "partystatus", "partyrank", "party",
    "assigneddate", "terminationdate", "X", "seniorstatus", "committeeseniority",
    "committeeperiod", "assignmentstatusatend", "assignmentstatusnext", "ac", "committeename",
    "statenumber", "cd", "state.name", "notes")


def read_csv_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header, declared types, ``NA`` and "" -> NULL, quoted commas, UTF-8.

    The header is skipped, not matched, so a blank header name is fine."""
    return (spark.read.option("header", True).option("enforceSchema", True)
            .option("nullValue", "NA").option("emptyValue", None)
            .option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
            .option("multiLine", False).option("mode", "PERMISSIVE")
            .schema(schema).csv(path))


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``names(x) <- c(...)`` - rename by position (export of a sheet)."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns, {len(names)} names")
    return df.toDF(*names)


def read_csv_checked(spark: SparkSession, path: str, schema: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S5 with malformed lines set aside: (typed rows, bad rows).

    A line is bad when a value isn't of its column's type or the number of
    fields differs; it goes whole, as a bad snapshot file does.  A bad row has
    the columns (what of them could be read) and its ``line``."""
    bad = "__line"
    df = (spark.read.option("header", header).option("enforceSchema", True)
          .option("nullValue", "NA").option("emptyValue", None).option("quote", '"').option("escape", '"')
          .option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad)
          .schema(f"{schema}, {bad} string").csv(path))
    good = [c for c in df.columns if c != bad]
    cols = [F.col(f"`{c}`") for c in good]
    # Spark converts only the fields that a query uses; the line names all of
    # them, so that each row is judged by its whole line
    line = F.concat(F.col(bad), F.substring(F.array_join(F.array(*[c.cast("string") for c in cols]), ""), 1, 0))
    rows = df.select(*cols, line.alias(bad))
    return rows.filter(F.col(bad).isNull()).select(*cols), rows.filter(F.col(bad).isNotNull()).withColumnRenamed(bad, "line")


def save_stage(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write a stage dataset and continue from what was written.

    Reading it back cuts the lineage (a restarted job resumes from the
    dataset, not from the sources)."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Stages:
    """S8 resumable: named stage datasets in a folder, for one state of the inputs.

    The folder's name holds a fingerprint of ``inputs`` (paths: files, sizes and
    times of change; other values as they are), so changed inputs or parameters
    start anew.  A stage is written beside its place and renamed there when it
    is whole; where it is there already, it is read and its builder not called.
    The fingerprint lists the input files on the driver."""

    def __init__(self, spark: SparkSession, path: str, inputs: Sequence = ()):
        self.spark = spark
        state = "|".join(self._state(x) for x in inputs)
        self.root = f"{path.rstrip('/')}/{hashlib.sha256(state.encode()).hexdigest()[:16]}"

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _state(self, x) -> str:
        if not isinstance(x, str):
            return repr(x)
        fs, p = self._fs(x)
        if not fs.exists(p):
            return x
        found, files = [], fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
        return ";".join(sorted(found))

    def done(self, name: str) -> bool:
        fs, p = self._fs(f"{self.root}/{name}/_SUCCESS")
        return fs.exists(p)

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage's rows, written by this or an earlier run."""
        place = f"{self.root}/{name}"
        if not self.done(name):
            made = f"{self.root}/_{name}-{uuid.uuid4().hex}"
            build().write.parquet(made)
            fs, src = self._fs(made)
            dst = self._fs(place)[1]
            if not self.done(name) and not fs.rename(src, dst):
                raise OSError(f"stage {name} was not moved to {place}")
        return self.spark.read.parquet(place)

    def delete(self, name: str | None = None) -> None:
        """Removes one stage, or all of this state."""
        fs, p = self._fs(f"{self.root}/{name}" if name else self.root)
        fs.delete(p, True)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report as CSV with a header, NULL written as NA and quotes doubled.

    A small report is one file: the rows are rebalanced to files of Spark's
    advisory partition size, so a large one is written by many tasks."""
    (df.hint("rebalance").write.mode(mode).option("header", True).option("nullValue", "NA")
     .option("emptyValue", "").option("quote", '"').option("escape", '"').csv(path))
