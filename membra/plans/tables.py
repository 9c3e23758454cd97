"""Access to the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import is_remote

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Inputs of this size range are spread over the cluster's cores
# when the files yield fewer scan partitions than cores.  Only the number of
# partitions changes; larger tables are never shuffled for it.
SPREAD_MIN_BYTES = 8 * 1024 * 1024
SPREAD_MAX_BYTES = 1024 * 1024 * 1024
# Characters of text (and 20 for each row) that one task takes where every word becomes rows.
TEXT_PER_TASK = 8 * 1024 * 1024


def _input_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  Columns are pruned and filters pushed into the scan
    by Catalyst from whatever the query selects.

    A large table stored as very few row groups scans in very few tasks, and
    everything up to the first shuffle would then run on one core.  Such a
    table is spread round-robin over the default parallelism (Catalyst still
    prunes columns and pushes filters below the repartition).  A table over
    ``SPREAD_MAX_BYTES`` keeps its scan partitions, however many cores there
    are.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    if is_remote():  # Spark Connect: no view of the scan's partitions
        return df
    if SPREAD_MIN_BYTES <= _input_bytes(spark, path) <= SPREAD_MAX_BYTES:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            df = df.repartition(cores)
    return df


def spread_by_text(df: DataFrame, text: str) -> DataFrame:
    """``df`` dealt over as many partitions as its text needs, at most about
    ``TEXT_PER_TASK`` characters each: what a task holds of the words that it
    makes of them follows neither the table nor its files.  Costs one more scan
    of the text, for its length, and a shuffle of the rows."""
    n = df.agg(F.coalesce(F.sum(F.coalesce(F.length(text), F.lit(0)) + 20), F.lit(0))).first()[0]
    return df.repartition(1 + n // TEXT_PER_TASK)
