"""Incremental snapshot ingest with Structured Streaming (S10 + S2/S3, K1).

New version folders arriving in a landing folder are decoded and appended to
a Parquet member table, or merged into the facts of each period.
``trigger(availableNow=True)`` processes what is there and stops, so the same
code serves a scheduled batch job and a continuous one; the checkpoint records
which files are done, so a restarted or failed run neither skips nor repeats a
version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.snapshots import DECODED_SCHEMA, SNAPSHOT_NAME_PATTERN, decode_snapshots


def _decoded_stream(spark: SparkSession, landing: str, name_pattern: str, partitioned: bool,
                    max_files_per_trigger: int | None) -> DataFrame:
    path = F.col("_metadata.file_path")
    if partitioned:
        name = F.url_decode(F.regexp_extract(path, r"file_name=([^/]+)/", 1))
    else:
        name = F.element_at(F.split(path, "/"), -1)
    reader = (spark.readStream.format("text").option("wholetext", True)
              .option("recursiveFileLookup", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = (reader.load(landing)
             .select(name.alias("source_file"), path.alias("source_path"),
                     F.col("value").alias("content"))
             .filter(F.col("source_file").rlike(name_pattern)))
    return decode_snapshots(files)


def snapshot_stream(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                    name_pattern: str = SNAPSHOT_NAME_PATTERN, partitioned: bool = True,
                    max_files_per_trigger: int = 1000) -> DataFrame:
    """Run the ingest until the landing folder is drained; return the sink.

    The sink holds the decoded rows of every file (``ok`` false rows are the
    quarantine)."""
    decoded = _decoded_stream(spark, landing, name_pattern, partitioned, max_files_per_trigger)
    q = (decoded.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(sink))
    q.awaitTermination()
    return spark.read.schema(DECODED_SCHEMA).parquet(sink)


def merge_facts(decoded: DataFrame, batch_id: int, sink: str,
                facts_of: Callable[[DataFrame], DataFrame], period: str = "congress") -> None:
    """Add the facts of one batch that no earlier batch has to ``sink``.

    The batch's decoded rows go to ``decoded/batch=<id>`` and its new facts to
    ``facts/batch=<id>``, both replaced when the batch is repeated, so a batch
    that failed half way leaves nothing twice.  Facts of earlier batches are
    read, for the periods of this batch alone; their files are not."""
    spark = decoded.sparkSession
    rows = f"{sink}/decoded/batch={batch_id}"
    decoded.write.mode("overwrite").parquet(rows)
    new = facts_of(spark.read.schema(DECODED_SCHEMA).parquet(rows)).distinct()
    schema = T.StructType([*new.schema.fields, T.StructField("batch", T.LongType())])
    earlier = spark.read.schema(schema).parquet(f"{sink}/facts").filter(F.col("batch") < batch_id)
    had = earlier.select([F.col(c).alias("__" + c) for c in new.columns])
    same = [F.col(c).eqNullSafe(F.col("__" + c)) for c in new.columns]
    (new.join(had, same, "left_anti").repartition(period).write.mode("overwrite")
     .partitionBy(period).parquet(f"{sink}/facts/batch={batch_id}"))


def facts_stream(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                 facts_of: Callable[[DataFrame], DataFrame], period: str = "congress",
                 name_pattern: str = SNAPSHOT_NAME_PATTERN, partitioned: bool = True) -> DataFrame:
    """K1 kept up to date: merge what has landed since the last run into the
    facts of each period and return them, each once.

    ``facts_of`` turns decoded rows into facts with a column ``period``.  Several
    landings give the facts of a single one.  A run takes all that is there
    as one batch, because a version with a bad part is left out whole: all parts
    of a version must have landed before the run that reads it.  One sink
    belongs to one checkpoint.  With nothing landed the facts are empty."""
    schema = facts_of(spark.createDataFrame([], DECODED_SCHEMA)).schema
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").partitionBy(period).parquet(f"{sink}/facts/batch=-1")
    decoded = _decoded_stream(spark, landing, name_pattern, partitioned, None)
    q = (decoded.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, batch_id: merge_facts(df, batch_id, sink, facts_of, period))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(schema).parquet(f"{sink}/facts").select(schema.names)
