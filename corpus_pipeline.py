"""A training corpus from raw documents: four stages, each one operator.

``run`` applies STAGES in order; each stage's rows are written as Parquet to
the shared folder and read again as the next stage's input, so a stage works
on all that its predecessor kept and a lost executor repeats one stage.

1.  language: string-kernel language ID, learned from labelled languages of
    its input; documents without a recognisable language (null, or no letter)
    go.
2.  quality: subword-embedding classifier, learned from the labels of its
    input's documents; predicted low quality goes.
3.  near_duplicates: n-gram Jaccard join of the rows, whatever their ids; of
    each group the row with the smallest id and text hash stays.  A document
    without a word is a group of its own.
4.  packing: best-fit packing into sequences of 2,048 tokens; its rows are
    the pieces with their places.

SQL can't express the models and the packing, so ORACLE_SQL is None; the
near duplicates are tested against brute force, the models by their accuracy
on rows held out, and the packed ids against the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from membra.llm import jaccard, langid, packing, quality
from membra.llm.common import fresh, quoted, staged


def _plain(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named like a result column renamed for the way."""
    away = {c: fresh(docs, "__in_" + c) for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(away), {v: k for k, v in away.items()}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a recognisable language."""
    src, back = _plain(docs, ("lang_pred", "score"))
    out = langid.predict(src, langid.train(src), src.columns)
    return out.where(F.col("lang_pred") != langid.UND).drop("lang_pred", "score").withColumnsRenamed(back).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    src, back = _plain(docs, ("score", "predicted"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality.predict(src, quality.train(src, labels), src.columns)
    return out.where(F.col("predicted") == 1).drop("score", "predicted").withColumnsRenamed(back).select(*docs.columns)


def _row_numbers(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of its own for each row, in a new column.

    Rows of Parquet files are numbered by their file's part number and their
    place in it, so the texts aren't written again; where there are no such
    places, or two files share a part number, the rows are numbered in a
    written copy."""
    name = fresh(docs, "__row")
    path, part = F.col("_metadata.file_path"), F.regexp_extract("_metadata.file_path", r"part-(\d+)[^/]*$", 1).try_cast("long")
    try:
        files = docs.select(path.alias("f"), part.alias("p")).distinct()
        clash = files.groupBy("p").count().where("count > 1 or p is null").limit(1).count()
    except AnalysisException:  # not read from files
        clash = 1
    if clash:
        return staged(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name
    return docs.withColumn(name, F.shiftleft(part, 40) + F.col("_metadata.row_index")), name


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the smallest id (null last), then
    text hash.  Rows are numbered first, so rows that repeat an id or have
    none are compared by their own texts."""
    rows, name = _row_numbers(docs)
    found = jaccard.join(rows, name).select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    plain = [quoted(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]  # a map has no hash
    order = rows.select(F.col(name).alias("row"), F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"),
        F.xxhash64(*plain).alias("all"), F.col(name).alias("number")).alias("place"))
    keep = found.join(order, "row").groupBy("component").agg(F.min("place")["number"].alias(name))
    return rows.join(keep.select(name), name, "left_semi").select(*[quoted(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [("language", language), ("quality", good_quality), ("near_duplicates", near_duplicates), ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
