"""Helpers shared by the operators: staged tables, Arrow chunking, word hashes.

Tasks see a text as UTF-8 bytes.  A word is ``[^\\x20\\x09-\\x0D]+``, which is
the same on bytes and on code points.  A chunk is a run of rows of at most
``CHUNK_BYTES`` of text (one longer text is a chunk of its own), so a task's
memory follows the longest text and never the size of the table.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import bound_batches

CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 512
BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20


# ---------------------------------------------------------------- staged tables
def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, which all executors share.

    Where neither the session nor its context names a checkpoint folder, the
    folder ``checkpoints`` of the warehouse is taken, which must be shared as
    well: a cluster with a warehouse on a local file system is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = found.get() if found.isDefined() else None
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
        if not spark.sparkContext.master.startswith("local") and base.split(":")[0] in ("file", base):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_of(col, n: int):
    """Partition rule of the library's shards: a column's crc32 remainder."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n))


def is_held_out(col, n: int, bucket: int):
    """Whether a row is kept from learning: its bucket is ``bucket``, or it has no
    id (a row without an id is never learned from)."""
    return F.coalesce(bucket_of(col, n) == bucket, F.lit(True))


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


# ---------------------------------------------------------------- Arrow chunks
def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, its session set to hand tasks at most ``BATCH_ROWS`` rows and
    ``BATCH_BYTES`` at once (lower settings stay), so long texts fit in memory."""
    bound_batches(df.sparkSession, BATCH_ROWS, BATCH_BYTES)
    return df


def chunks(batch: pa.RecordBatch, column: str, max_bytes: int = CHUNK_BYTES,
           max_rows: int = CHUNK_ROWS) -> Iterator[tuple[int, list]]:
    """(first row, texts as bytes or None) of each chunk of a batch."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
    at, size = 0, 0
    for i, n in enumerate(sizes):
        if i > at and (size + n > max_bytes or i - at >= max_rows):
            yield at, col.slice(at, i - at).to_pylist()
            at, size = i, 0
        size += n
    if at < len(sizes):
        yield at, col.slice(at).to_pylist()


def map_text(df: DataFrame, text_col: str, carry: list[str], fields: list[T.StructField],
             score: Callable[[list], list]) -> DataFrame:
    """Columns of ``carry`` and those that ``score`` gives for each text.

    ``score`` takes the texts of one chunk (bytes or None) and returns one
    array or list for each of ``fields``.  A carried column whose name
    clashes with one of ``fields`` gives way to it.
    """
    new = {f.name.lower() for f in fields}
    carry = [c for c in carry if c.lower() not in new]
    tmp = "__text"
    while tmp in {c.lower() for c in carry}:
        tmp += "_"
    src = df.select(*[quoted(c).alias(c) for c in carry], quoted(text_col).cast("binary").alias(tmp))
    schema = T.StructType([src.schema[c] for c in carry] + fields)
    kinds = [arrow_type(f.dataType) for f in fields]
    names = carry + [f.name for f in fields]

    def run(batches):
        for b in batches:
            for at, texts in chunks(b, tmp):
                got = score(texts)
                cols = [b.column(i).slice(at, len(texts)) for i in range(len(carry))]
                cols += [pa.array(v, type=k) for v, k in zip(got, kinds)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return bounded_batches(src).mapInArrow(run, schema)


def arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(arrow_type(t.elementType))
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "boolean": pa.bool_(), "binary": pa.binary()}[t.simpleString()]


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind), True)


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, over its tasks."""
    mod = sys.modules.setdefault("_membra_worker_cache", types.ModuleType("_membra_worker_cache"))
    return mod.__dict__.setdefault(name, {})


def release_memos() -> None:
    """Frees what token encoders keep in this worker; other operators call it.
    What earlier tasks freed goes back to the system once a memo is dropped."""
    held = sys.modules.get("_membra_worker_cache")
    names = [k for k in (held.__dict__ if held else ()) if k.startswith(("ids:", "pieces:"))]
    for k in names:
        del held.__dict__[k]
    if names:
        return_free_memory()


def return_free_memory() -> None:
    """Hands unused memory of Arrow's pool and the C library back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(ctypes.util.find_library("c")), "malloc_trim", None)
    if trim is not None:  # glibc only
        trim(0)


# ---------------------------------------------------------------- words and hashes
_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wraps)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    c = worker_cache("powers")
    if "up" not in c or len(c["up"]) < n:
        size = max(n, 1 << 16)
        for k, p in (("up", _P), ("down", _PINV)):
            a = np.full(size, p, dtype=np.uint64)
            a[0] = 1
            c[k] = np.cumprod(a)
    return c["up"][:n], c["down"]


def byte_values() -> np.ndarray:
    """A 64-bit value for each byte, from a rule."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The words of a chunk: byte spans, document numbers and 64-bit hashes."""

    def __init__(self, texts: list, lower: bool = False):
        self.n_docs = len(texts)
        raw = [t or b"" for t in texts]
        self.buf = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
        if lower:
            up = (self.buf >= 65) & (self.buf <= 90)
            self.buf = self.buf + up.astype(np.uint8) * np.uint8(32)
        self.doc_at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in raw])]).astype(np.int64)
        self.space = (self.buf == 32) | ((self.buf >= 9) & (self.buf <= 13))
        edge = np.diff(np.concatenate([[True], self.space, [True]]).astype(np.int8))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)[: len(self.start)]
        self.doc = np.searchsorted(self.doc_at, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=self.n_docs).astype(np.int64)
        #: number of the first word of each document, and one past the last
        self.first = np.concatenate([[0], np.cumsum(self.count)])

    def prefix_sums(self) -> np.ndarray:
        up, _ = _powers(len(self.buf))
        s = np.empty(len(self.buf) + 1, dtype=np.uint64)
        s[0] = 0
        np.cumsum(byte_values()[self.buf] * up, out=s[1:])
        return s

    def hashes(self) -> np.ndarray:
        s = self.prefix_sums()
        _, down = _powers(len(self.buf))
        return mix((s[self.end] - s[self.start]) * down[self.start])

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per byte over each document's bytes."""
        c = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return c[self.doc_at[1:]] - c[self.doc_at[:-1]]


# ---------------------------------------------------------------- bounded samples
def sample_by(df: DataFrame, stratum: str, id_col: str, per: int) -> DataFrame:
    """About ``per`` rows of each value of ``stratum`` (all where fewer exist).

    Rows are chosen by a hash of the id, at a rate from exact counts of the
    strata, so the sample's size doesn't follow the table's.
    """
    counts = {r[0]: r[1] for r in df.where(quoted(stratum).isNotNull()).groupBy(quoted(stratum)).count().collect()}
    draw = F.pmod(F.xxhash64(quoted(id_col), F.lit(97)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    keep = F.lit(False)
    for v, n in counts.items():
        keep = keep | ((quoted(stratum) == F.lit(v)) & (draw < F.lit(min(1.0, per / n))))
    return df.where(keep)
