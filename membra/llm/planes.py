"""Token ids in binary files of compressed byte or bit planes.

A file holds the ids of a run of documents in ascending id order:

    magic | block ... | footer | footer length (u32) | magic

A block is ``block_ids`` ids (the last one fewer), taken as little-endian
unsigned 32-bit integers and transposed: plane k holds byte (or bit) k of each
id.  Each plane is compressed with zstandard.  The footer, compressed too, is
the chunk index (offset, ids and compressed plane sizes of each block) and the
documents' ids and token counts, so that a reader can seek to any document.

A task writes its file under a name of its own; the manifest names only files
of tasks that ended well, so a repeated or lost task leaves no trace in it.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, chunks, quoted, shared_path
from .tokens import Encoder, default_path

MAGIC = b"MBPLANE1"
BLOCK_IDS, LEVEL, END_ID = 1 << 16, 3, 2
HEAD = "<BIQQ"  # kind, block ids, blocks, documents


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Planes of a block: 4 byte planes or 32 bit planes."""
    b = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [p.tobytes() for p in np.ascontiguousarray(b.T)]
    bits = np.unpackbits(b, axis=1, bitorder="little")
    return [p.tobytes() for p in np.packbits(np.ascontiguousarray(bits.T), axis=1)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        b = np.stack([np.frombuffer(p, dtype=np.uint8) for p in planes], axis=1)
    else:
        bits = np.unpackbits(np.stack([np.frombuffer(p, dtype=np.uint8) for p in planes]), axis=1)[:, :n]
        b = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return np.ascontiguousarray(b).view("<u4").reshape(-1)


class Writer:
    def __init__(self, sink, kind: str = "byte", block_ids: int = BLOCK_IDS, level: int = LEVEL):
        self.sink, self.kind, self.block_ids = sink, kind, block_ids
        self.zip = zstandard.ZstdCompressor(level=level)
        self.wait: list[np.ndarray] = []
        self.held, self.at, self.index = 0, len(MAGIC), []
        self.docs: list[np.ndarray] = []
        self.valid: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        sink.write(MAGIC)

    def add(self, doc_ids: np.ndarray, valid: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.valid.append(valid)
        self.counts.append(counts)
        self.wait.append(ids)
        self.held += len(ids)
        if self.held >= self.block_ids:
            ids = np.concatenate(self.wait)
            full = len(ids) // self.block_ids * self.block_ids
            for i in range(0, full, self.block_ids):
                self._block(ids[i : i + self.block_ids])
            self.wait, self.held = [ids[full:]], len(ids) - full

    def _block(self, ids: np.ndarray) -> None:
        packed = [self.zip.compress(p) for p in to_planes(ids, self.kind)]
        self.index.append((self.at, len(ids), [len(p) for p in packed]))
        for p in packed:
            self.sink.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.wait))
        cat = lambda x, t: np.concatenate([*x, np.empty(0)]).astype(t).tobytes()
        body = struct.pack(HEAD, 0 if self.kind == "byte" else 1, self.block_ids, len(self.index), sum(map(len, self.docs)))
        for at, n, sizes in self.index:
            body += struct.pack(f"<QI{len(sizes)}I", at, n, *sizes)
        docs = b"".join(d.astype("<i8").tobytes() for d in self.docs)
        foot = self.zip.compress(body + docs + cat(self.valid, np.uint8) + cat(self.counts, "<i8"))
        self.sink.write(foot + struct.pack("<I", len(foot)) + MAGIC)


class Reader:
    """Index and ids of a file that supports ``seek`` and ``read``."""

    def __init__(self, src, size: int):
        self.src, self.unzip = src, zstandard.ZstdDecompressor()
        src.seek(size - len(MAGIC) - 4)
        tail = src.read(len(MAGIC) + 4)
        if tail[4:] != MAGIC:
            raise ValueError("not a plane file, or cut short")
        n = struct.unpack("<I", tail[:4])[0]
        src.seek(size - len(MAGIC) - 4 - n)
        foot = self.unzip.decompress(src.read(n))
        kind, self.block_ids, blocks, docs = struct.unpack_from(HEAD, foot)
        self.kind, planes, at = ("byte", "bit")[kind], (4, 32)[kind], struct.calcsize(HEAD)
        entry = struct.Struct(f"<QI{planes}I")
        self.index = [entry.unpack_from(foot, at + i * entry.size) for i in range(blocks)]
        at += blocks * entry.size
        self.docs = np.frombuffer(foot, "<i8", docs, at)
        self.valid = np.frombuffer(foot, np.uint8, docs, at + 8 * docs).astype(bool)
        self.counts = np.frombuffer(foot, "<i8", docs, at + 9 * docs)

    def block(self, i: int) -> np.ndarray:
        at, n, *sizes = self.index[i]
        self.src.seek(at)
        raw, planes = self.src.read(sum(sizes)), []
        for s in sizes:
            planes.append(self.unzip.decompress(raw[:s]))
            raw = raw[s:]
        return from_planes(planes, n, self.kind)

    def documents(self):
        """(document's number, its ids) in order, one block in memory at a time
        besides the document's own ids."""
        have, k = np.empty(0, "<u4"), 0
        for d, n in enumerate(self.counts.tolist()):
            if len(have) < n:
                parts, held = [have], len(have)
                while held < n:
                    parts.append(self.block(k))
                    held, k = held + len(parts[-1]), k + 1
                have = np.concatenate(parts)
            yield d, have[:n]
            have = have[n:]


def _filesystem(uri: str):
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


MANIFEST = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("path", T.StringType()),
                         T.StructField("n_docs", T.LongType()), T.StructField("n_tokens", T.LongType())])


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
          end_id: int = END_ID, kind: str = "byte", block_ids: int = BLOCK_IDS) -> list:
    """Encodes every text and writes plane files; returns the manifest rows in
    ascending document order (one row a file, the only thing the driver sees).

    Null texts count as empty and hold the end id alone; rows without an id
    come first; rows with the same id are ordered by their text's xxhash64,
    then by text.  An empty table gives no file.  Other columns are not read.
    """
    path = path or default_path()
    src = (docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("binary").alias("text"))
           .withColumn("hash", F.xxhash64("text")))
    # ranges by two longs, so no text reaches the driver with the sample
    src = src.repartitionByRange("id", "hash").sortWithinPartitions("id", "hash", "text").select("id", "text")

    def run(batches):
        sink = out = None
        n_docs = n_tokens = 0
        for b in batches:
            for at, texts in chunks(b, "text"):
                if out is None:
                    part = TaskContext.get().partitionId()
                    store, base = _filesystem(folder)
                    store.create_dir(base, recursive=True)
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.planes"
                    sink = store.open_output_stream(f"{base}/{name}")
                    out, enc = Writer(sink, kind, block_ids), Encoder(path)
                ids, count = enc.encode(texts)
                ids = np.insert(ids.astype("<u4"), np.cumsum(count), end_id)
                col = b.column(0).slice(at, len(texts))
                valid = np.asarray(col.is_valid())
                out.add(np.asarray(col.fill_null(0)), valid, count + 1, ids)
                n_docs, n_tokens = n_docs + len(texts), n_tokens + len(ids)
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([n_docs]), pa.array([n_tokens])],
                names=MANIFEST.names)

    return sorted(bounded_batches(src).mapInArrow(run, MANIFEST).collect(), key=lambda r: r["part"])


def read(spark: SparkSession, manifest: list) -> DataFrame:
    """Per document of the files: doc_id, start (ids before it), n_tokens and
    ids_crc32 (of its ids as little-endian unsigned 32-bit integers)."""
    rows, start = [], 0
    for r in manifest:
        rows.append((r["path"], start))
        start += r["n_tokens"]
    files = spark.createDataFrame(rows, "path string, start long").repartition(max(1, len(rows)))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches):
        for b in batches:
            for p, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                store, base = _filesystem(p)
                with store.open_input_file(base) as f:
                    r = Reader(f, f.size())
                    crc = np.array([zlib.crc32(np.ascontiguousarray(ids, dtype="<u4")) for _, ids in r.documents()], np.int64)
                    begin = at + np.cumsum(r.counts) - r.counts
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r.docs.astype(np.int64), mask=~r.valid), pa.array(begin.astype(np.int64)),
                         pa.array(r.counts.astype(np.int64)), pa.array(crc)],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, schema)


def op8_plane_files(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read(spark, write(docs, shared_path(spark, "planes")))
