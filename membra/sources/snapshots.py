"""Versioned nested snapshots -> one long table.

A snapshot file is a YAML document ``{group_id: [member, ...], ...}`` whose
file name carries the version date.  Files are read whole (one row per file,
so a file is never split across tasks), decoded in ``mapInArrow`` - the only
Python step - and everything after that is DataFrame code.  A version that
fails any check in any of its part files is dropped *whole*; its bad parts are
reported in a quarantine table.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import SNAPSHOT_DATE_PATTERN, period_of, snapshot_date_of
from ..session import bound_batches

# Fixed value: snapshot file names accepted by the listing.
SNAPSHOT_NAME_PATTERN = r"^committee-membership-\d{4}-\d{2}-\d{2}(-[a-f0-9]{7,40}).*\.ya?ml$"

DECODED_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("source_path", T.StringType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("reason", T.StringType()),
    T.StructField("thomas_id", T.StringType()),
    T.StructField("group_pos", T.IntegerType()),
    T.StructField("member_pos", T.IntegerType()),
    T.StructField("member", T.MapType(T.StringType(), T.StringType())),
])


# Columns of ``member_rows`` besides the member keys; a member key of the same
# name gets the suffix ``_member``.
ROW_COLUMNS = ("snapshot_date", "congress", "source_file", "source_path", "thomas_id",
               "group_pos", "member_pos")
# Files and bytes handed to the decoder at once (a longer file
# goes alone), and rows handed back at once.
BATCH_FILES, BATCH_BYTES = 1_000, 16 << 20
ROWS_PER_BATCH = 5_000
# The column of a member written as bare text instead of a mapping.
BARE_TEXT_KEY = "value"


def list_snapshots(spark: SparkSession, path: str, name_pattern: str = SNAPSHOT_NAME_PATTERN,
                   partitioned: bool = False) -> DataFrame:
    """Every snapshot file under ``path`` as (source_file, source_path, content).

    Two layouts: plain files named like the pattern, or a Spark-written
    landing folder ``path/file_name=<name>/part-*`` (``partitioned=True``),
    where the name filter prunes partitions before any file is opened.
    """
    # ``text()`` has its own ``wholetext`` argument, which would override an option
    if partitioned:
        df = spark.read.text(path, wholetext=True)
        name = F.col("file_name")
    else:
        df = spark.read.option("pathGlobFilter", "*.y*ml").text(path, wholetext=True)
        name = F.col("_metadata.file_name")
    return (df.select(name.alias("source_file"),
                      F.col("_metadata.file_path").alias("source_path"),
                      F.col("value").alias("content"))
            .filter(F.col("source_file").rlike(name_pattern)))


def _scalar_text(v) -> str | None:
    if v is None:
        return None
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (dict, list)):
        return json.dumps(v, default=str, sort_keys=True)
    return str(v)


def decode_document(text: str | None, file_name: str):
    """Parse one snapshot document.

    Returns ``(ok, reason, rows)`` where rows are
    ``(group_id, group_pos, member_pos, {key: text})``.  Checks: a date in the
    file name, valid YAML, no duplicate map keys (PyYAML would silently keep
    the last one), a non-empty mapping at the top.  A member written as bare
    text is a row with the one key ``value``.  NULL members and NULL or empty
    groups give no rows.
    """
    import re

    import yaml

    # libyaml's C parser when present (same documents, several times faster)
    base = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

    class UniqueKeyLoader(base):
        pass

    def construct_mapping(loader, node, deep=False):
        seen = set()
        for k_node, _ in node.value:
            k = loader.construct_object(k_node, deep=deep)
            if k in seen:
                raise yaml.constructor.ConstructorError(
                    None, None, f"duplicate key {k!r}", k_node.start_mark)
            seen.add(k)
        return yaml.constructor.SafeConstructor.construct_mapping(loader, node, deep)

    UniqueKeyLoader.add_constructor(
        yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, construct_mapping)

    if not re.search(SNAPSHOT_DATE_PATTERN, file_name or ""):
        return False, "no date: no YYYY-MM-DD in the file name", []
    try:
        doc = yaml.load(text or "", Loader=UniqueKeyLoader)
    except yaml.constructor.ConstructorError as e:
        if "duplicate key" in str(e):
            return False, "duplicate key: " + str(e.problem)[:200], []
        return False, "unparsable: " + str(e).splitlines()[0][:200], []
    except yaml.YAMLError as e:
        return False, "unparsable: " + str(e).splitlines()[0][:200], []
    if not isinstance(doc, dict) or len(doc) == 0:
        return False, "empty or not a mapping: file has no groups", []
    rows = []
    for gpos, (gid, members) in enumerate(doc.items()):
        if not members:
            continue
        if not isinstance(members, list):
            members = [members]
        for mpos, m in enumerate(members):
            if m is None:
                continue
            if not isinstance(m, dict):
                m = {BARE_TEXT_KEY: m}
            rows.append((str(gid), gpos, mpos, {str(k): _scalar_text(v) for k, v in m.items()}))
    return True, None, rows


def _decode_batches(batches):
    """Decoded rows of each document in turn, ``ROWS_PER_BATCH`` at a time: a task
    holds one document's rows, however many documents it reads."""
    import pyarrow as pa

    schema = pa.schema([
        ("source_file", pa.string()), ("source_path", pa.string()), ("ok", pa.bool_()),
        ("reason", pa.string()), ("thomas_id", pa.string()), ("group_pos", pa.int32()),
        ("member_pos", pa.int32()), ("member", pa.map_(pa.string(), pa.string()))])

    def batch(name, path, ok, reason, rows):
        n = len(rows)
        cols = [[name] * n, [path] * n, [ok] * n, [reason] * n,
                *([r[i] for r in rows] for i in range(3)),
                [None if r[3] is None else list(r[3].items()) for r in rows]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    for files in batches:
        names, paths, contents = (files.column(files.schema.get_field_index(c))
                                  for c in ("source_file", "source_path", "content"))
        for i in range(files.num_rows):
            name, path = names[i].as_py(), paths[i].as_py()
            ok, reason, rows = decode_document(contents[i].as_py(), name)
            if not ok:
                rows = [(None, None, None, None)]
            for at in range(0, len(rows), ROWS_PER_BATCH):
                yield batch(name, path, ok, reason, rows[at:at + ROWS_PER_BATCH])


def decode_snapshots(files: DataFrame) -> DataFrame:
    """One row per (file, group, member) for good files, one row with
    ``ok = false`` and a reason per bad file."""
    bound_batches(files.sparkSession, BATCH_FILES, BATCH_BYTES)
    return files.select("source_file", "source_path", "content").mapInArrow(
        _decode_batches, DECODED_SCHEMA)


def quarantine(decoded: DataFrame) -> DataFrame:
    """Files set aside, with the reason (the reference only prints it)."""
    return decoded.filter(~F.col("ok")).select("source_file", "source_path", "reason")


def whole_versions(decoded: DataFrame) -> DataFrame:
    """S3: rows of the versions none of whose part files is bad.  The bad
    versions are few, so the anti-join costs no shuffle of the rows; ``decoded``
    is read twice and should be a written or checkpointed table."""
    bad = decoded.filter(~F.col("ok")).select(F.col("source_file").alias("__bad")).distinct()
    return decoded.filter(F.col("ok")).join(bad, F.col("source_file") == F.col("__bad"),
                                            "left_anti")


def member_rows(decoded: DataFrame, keys: list[str] | None = None,
                always: tuple[str, ...] = ()) -> DataFrame:
    """Rows of whole versions in the reference's column order: snapshot_date,
    congress, source_file, source_path, member keys..., thomas_id (S4: a key
    missing in a file is NULL there - the union by name of all files).

    ``keys`` lists the member keys to project; by default ``always`` and then
    the other distinct keys found in the data (column names, collected once).
    """
    good = whole_versions(decoded)
    if keys is None:
        found = good.select(F.explode(F.map_keys("member"))).distinct().collect()
        keys = [*always, *sorted({r[0] for r in found} - set(always))]
    d = snapshot_date_of("source_file")
    return good.select(
        d.alias("snapshot_date"), period_of(d).alias("congress"),
        "source_file", "source_path",
        *[F.col("member")[k].alias(k + "_member" if k.lower() in ROW_COLUMNS else k)
          for k in keys],
        "thomas_id", "group_pos", "member_pos")


def per_period_distinct(members: DataFrame, cols: list[str]) -> DataFrame:
    """K1: ``distinct(congress, ...)`` - the facts of each period."""
    return members.select(*cols).distinct()
