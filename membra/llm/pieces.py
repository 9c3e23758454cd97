"""SentencePiece BPE encoding and decoding by suffix-array matching.

A text becomes segments (a run of the space mark and what follows it) that no
piece crosses.  The new distinct segments of a chunk are joined to one
sequence of characters, whose suffixes are sorted by their first ``longest
piece`` characters.  Binary search of every piece gives its range in the
suffix array, i.e. all its occurrences: the edges of a lattice.  Edges are
sorted by the place where they end and relaxed place by place, over all
segments at once.

What the relaxation keeps: the prefix of a BPE encoding is the encoding of the
prefix, and a row of pieces is the encoding of its text iff each neighbouring
pair is (no merge across the border would have come before the merges that
made the two).  So each place is reached by exactly one edge that agrees with
the piece before it, and the result is that of merging by rank.  Characters
without a piece become the byte pieces of their UTF-8 bytes.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, field, fresh, map_text, quoted, worker_cache

MARK = "▁"
#: segments that a worker keeps before it starts anew
MEMO_SEGMENTS = 700_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Table:
    """A model's pieces as arrays: built once on the driver, shipped to tasks."""

    text: list[str]  # "" for control and byte pieces
    byte: list[int]  # id of each byte's piece
    rank: np.ndarray  # order of the merge that makes a piece; -1 for one character
    left: np.ndarray
    right: np.ndarray
    pair: np.ndarray  # left * size + right, ascending
    made: np.ndarray  # rank of the piece that the pair makes
    usable: np.ndarray  # pieces that merging their own characters gives
    prefix: bool  # a space mark goes before the text
    crosses: bool  # some piece holds the space mark after another character


def load(path: str) -> Table:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
    text = [sp.id_to_piece(i) if ok else "" for i, ok in enumerate(plain)]
    byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    ids = {t: i for i, t in enumerate(text) if t}
    order = sorted((i for i in ids.values() if len(text[i]) > 1), key=lambda i: (-sp.get_score(i), i))
    rank = np.full(n, -1, dtype=np.int64)
    rank[order] = np.arange(len(order))
    pairs = {}
    for i in order:
        t = text[i]
        for k in range(1, len(t)):
            a, b = ids.get(t[:k]), ids.get(t[k:])
            if a is not None and b is not None:
                pairs[a, b] = i
    left, right, usable = np.full(n, -1), np.full(n, -1), np.zeros(n, dtype=bool)
    for t, i in ids.items():
        row = [ids.get(c) for c in t]
        if None in row:
            continue
        while len(row) > 1:
            at = [(rank[pairs[p]], k) for k, p in enumerate(zip(row, row[1:])) if p in pairs]
            if not at:
                break
            k = min(at)[1]
            if len(row) == 2:
                left[i], right[i] = row
            row[k : k + 2] = [pairs[row[k], row[k + 1]]]
        usable[i] = row == [i]
    key = np.array([a * n + b for a, b in pairs], dtype=np.int64)
    made = np.array([rank[i] for i in pairs.values()], dtype=np.int64)
    o = np.argsort(key)
    crosses = any(re.search(f"[^{MARK}]{MARK}", t) for t in text)
    return Table(text, byte, rank, left, right, key[o], made[o], usable, sp.encode("a", out_type=str)[0].startswith(MARK), crosses)


def compatible(t: Table, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pieces a, b side by side stay apart when their text is merged.

    Merges are undone from the last to the first, on the border's two sides;
    a pair that would merge before the merge undone last is a conflict.  At
    equal rank the merge further left comes first."""
    n, good = len(t.rank), np.ones(len(a), dtype=bool)
    live = np.flatnonzero((a >= 0) & (b >= 0))
    x, y, limit = a[live], b[live], np.full(len(live), 1 << 60, dtype=np.int64)
    while len(live):
        key = x * n + y
        at = np.minimum(np.searchsorted(t.pair, key), len(t.pair) - 1)
        clash = (t.pair[at] == key) & (t.made[at] < limit)
        good[live[clash]] = False
        rx, ry = t.rank[x], t.rank[y]
        go = ~clash & ((rx >= 0) | (ry >= 0))
        live, x, y, rx, ry = live[go], x[go], y[go], rx[go], ry[go]
        undo_x = rx > ry
        limit = np.where(undo_x, rx, ry + 1)
        x, y = np.where(undo_x, t.right[x], x), np.where(undo_x, y, t.left[y])
    return good


class Matcher:
    """The pieces sorted as rows of character codes, for binary search."""

    def __init__(self, t: Table):
        self.t = t
        use = sorted(np.flatnonzero(t.usable), key=lambda i: t.text[i])
        self.longest = max(len(t.text[i]) for i in use)
        chars = sorted({c for i in use for c in t.text[i]})
        self.code = {c: k + 2 for k, c in enumerate(chars)}  # 0: border, 1: no piece
        self.lookup = np.ones(0x110000, dtype=np.uint16)
        for c, k in self.code.items():
            self.lookup[ord(c)] = k
        rows = np.zeros((len(use), self.longest), dtype=">u2")
        for r, i in enumerate(use):
            rows[r, : len(t.text[i])] = [self.code[c] for c in t.text[i]]
        self.ids, self.size = np.array(use), np.array([len(t.text[i]) for i in use])
        self.low = self._rows(rows)
        fill = rows.copy()
        fill[np.arange(self.longest)[None] >= self.size[:, None]] = 0xFFFF
        self.high = self._rows(fill)

    def _rows(self, codes: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(codes).view(f"S{2 * self.longest}").reshape(-1)

    def suffixes(self, code: np.ndarray) -> np.ndarray:
        """Suffix array of the sequence by the first ``longest`` characters."""
        n, rank, k = len(code), code.astype(np.int64), 1
        while True:
            nxt = np.zeros(n, dtype=np.int64)
            nxt[: n - k] = rank[k:] + 1 if n > k else 0
            key = rank * (int(rank.max()) + 2) + nxt
            o = np.argsort(key, kind="stable")
            k *= 2
            if k >= self.longest:
                return o
            new = np.concatenate([[False], key[o][1:] != key[o][:-1]])
            rank = np.empty(n, dtype=np.int64)
            rank[o] = np.cumsum(new)

    def encode(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment as little-endian unsigned 32-bit integers."""
        t, size = self.t, np.array([len(s) for s in segments], dtype=np.int64)
        cps = np.frombuffer("\0".join(segments).encode("utf-32-le", "surrogatepass") + b"\0\0\0\0", dtype="<u4")
        at = np.cumsum(size + 1) - (size + 1)
        code = self.lookup[cps]
        code[at + size] = 0
        n = len(code)
        order = self.suffixes(code)
        wide = np.zeros((n, self.longest), dtype=">u2")
        ended = np.zeros(n, dtype=bool)
        for j in range(min(self.longest, n)):  # few short segments can be shorter than a piece
            c = np.zeros(n, dtype=np.uint16)
            c[: n - j] = code[j:]
            ended |= c == 0
            wide[:, j] = np.where(ended, 0, c)
        rows = self._rows(wide[order])
        lo, hi = np.searchsorted(rows, self.low), np.searchsorted(rows, self.high, side="right")
        times = np.maximum(hi - lo, 0)
        start = order[np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
        piece, length = np.repeat(self.ids, times), np.repeat(self.size, times)
        lone = np.flatnonzero(code == 1)  # characters without a piece
        start = np.concatenate([start, lone])
        piece = np.concatenate([piece, np.full(len(lone), -1)])
        length = np.concatenate([length, np.ones(len(lone), dtype=np.int64)])
        # edges by the depth in their segment at which they end
        seg_at = np.repeat(at, size + 1)
        end = start + length
        depth = end - seg_at[start]
        o = np.argsort(depth, kind="stable")
        start, piece, length, end, depth = start[o], piece[o], length[o], end[o], depth[o]
        cut = np.searchsorted(depth, np.arange(1, (depth[-1] if len(depth) else 0) + 2))
        last = np.full(n + 1, -2, dtype=np.int64)  # piece that ends at a place: -2 none yet, -1 a lone character
        back = np.zeros(n + 1, dtype=np.int64)
        for a, b in zip(cut[:-1], cut[1:]):
            s, p, e = start[a:b], piece[a:b], end[a:b]
            first = s == seg_at[s]
            prev = np.where(first, -1, last[s])
            ok = prev > -2
            s, p, e, prev = s[ok], p[ok], e[ok], prev[ok]
            ok = compatible(t, prev, p)
            last[e[ok]], back[e[ok]] = p[ok], s[ok]
        # walk back from every segment's end, all at once
        place, seg = at + size, np.flatnonzero(size)
        place = place[seg]
        got_seg, got_piece, got_at = [], [], []
        while len(seg):
            got_seg.append(seg)
            got_piece.append(last[place])
            got_at.append(back[place])
            place = back[place]
            more = place > at[seg]
            place, seg = place[more], seg[more]
        if not got_seg:
            return [b""] * len(segments)
        seg, pc, pos = map(np.concatenate, (got_seg, got_piece, got_at))
        o = np.lexsort((pos, seg))
        seg, pc, pos = seg[o], pc[o], pos[o]
        raw = pc.astype("<u4").tobytes()
        cut = (4 * np.concatenate([[0], np.cumsum(np.bincount(seg, minlength=len(segments)))])).tolist()
        out = [raw[a:b] for a, b in zip(cut[:-1], cut[1:])]
        if len(lone):
            for i in np.unique(seg[pc < 0]).tolist():
                chars = iter([c for c in segments[i] if c not in self.code])
                ids = pc[cut[i] // 4 : cut[i + 1] // 4].tolist()
                out[i] = np.array([y for p in ids for y in (
                    [p] if p >= 0 else [t.byte[v] for v in next(chars).encode("utf-8", "replace")])], dtype="<u4").tobytes()
        return out


class Codec:
    """``encode(texts)`` with memoised segments."""

    def __init__(self, table: Table, name: str):
        self.t = table
        self.cache = worker_cache("pieces:" + name)
        if "matcher" not in self.cache:
            self.cache |= {"matcher": Matcher(table), "memo": {}}
        self.split = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if not table.crosses else "(?s).+")

    def encode(self, texts: list) -> list[np.ndarray]:
        rows = []
        for b in texts:
            s = (b or b"").decode("utf-8", "replace").replace(" ", MARK)
            rows.append(self.split.findall(MARK + s if s and self.t.prefix else s))
        memo = self.cache["memo"]
        new = {x for r in rows for x in r}
        if len(memo) + len(new) > MEMO_SEGMENTS:
            memo.clear()
        new = sorted(new.difference(memo))
        memo.update(zip(new, self.cache["matcher"].encode(new) if new else ()))
        return [np.frombuffer(b"".join([memo[x] for x in r]), dtype="<u4") for r in rows]


def _piece_bytes(table: Table) -> list[bytes]:
    bytes_of = {i: bytes([b]) for b, i in enumerate(table.byte)}
    return [bytes_of.get(i, s.replace(MARK, " ").encode()) for i, s in enumerate(table.text)]


def decode(rows: DataFrame, carry: list[str], ids_col: str = "ids", text_name: str = "text", path: str | None = None) -> DataFrame:
    """``carry`` plus the text that each row's ids stand for.

    No ids give an empty text; null ids, and ids with a null or a number that
    no piece has, a null one.  Bytes that aren't UTF-8 become U+FFFD.  A
    carried column named like the text gives way to it."""
    table = load(path or default_path())
    part, prefix = pa.array(_piece_bytes(table), pa.large_binary()), table.prefix
    carry = [c for c in carry if c.lower() != text_name.lower()]
    tmp = "__ids"
    while tmp in {c.lower() for c in carry}:
        tmp += "_"
    src = rows.select(*[quoted(c).alias(c) for c in carry], quoted(ids_col).cast("array<bigint>").alias(tmp))

    def texts(col) -> list:
        flat, fine = col.flatten(), np.asarray(col.is_valid())
        ids = np.asarray(flat.fill_null(-1), dtype=np.int64)
        size = np.asarray(col.value_lengths().fill_null(0), dtype=np.int64)
        wrong = (ids < 0) | (ids >= len(part))
        fine[np.repeat(np.arange(len(col)), size)[wrong]] = False
        found = part.take(pa.array(np.where(wrong, 0, ids)))
        at = np.frombuffer(found.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        raw = found.buffers()[2].to_pybytes() if len(ids) else b""
        cut = at[np.concatenate([[0], np.cumsum(size)])].tolist()
        skip = [int(prefix and raw[i : min(i + 1, j)] == b" ") for i, j in zip(cut[:-1], cut[1:])]
        return [raw[i + k : j].decode("utf-8", "replace") if ok else None for i, j, k, ok in zip(cut[:-1], cut[1:], skip, fine)]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 64):
                c = b.slice(at, 64)
                yield pa.RecordBatch.from_arrays([*c.columns[:-1], pa.array(texts(c.column(len(carry))), pa.string())], names=[*carry, text_name])

    return bounded_batches(src).mapInArrow(run, T.StructType([*[src.schema[c] for c in carry], field(text_name, "string")]))


def encode(docs: DataFrame, carry: list[str], text_col: str = "text", path: str | None = None, with_ids: bool = True) -> DataFrame:
    """``carry`` plus the ids of each whole text (array of int), their number
    and crc32 (little-endian unsigned 32-bit), and the crc32 of the text that
    decoding the ids gives back.

    Null and empty texts have no ids.  Repeated rows get the same ids each; a
    carried column named like a result column gives way to it."""
    path = path or default_path()
    table = load(path)

    def score(texts):
        codec = Codec(table, path)
        ids = codec.encode(texts)
        return [ids, [len(i) for i in ids], [zlib.crc32(i.tobytes()) for i in ids]]

    carry = [c for c in carry if c.lower() not in ("decoded_crc32", *(["ids"] if with_ids else []))]
    ids = "ids" if with_ids else fresh(docs.select(*[quoted(c) for c in carry]), "__piece_ids")
    fields = [field(ids, "array<int>"), field("n_pieces", "bigint"), field("ids_crc32", "bigint")]
    out = map_text(docs, text_col, carry, fields, score)
    text = fresh(out, "__decoded")
    keep = [c for c in out.columns if with_ids or c != ids]
    return decode(out, keep, ids, text, path).select(*[quoted(c) for c in keep], F.crc32(quoted(text).cast("binary")).alias("decoded_crc32"))


def op6_suffix_array_pieces(spark, sf_dir) -> DataFrame:
    """Per document: doc_id, n_pieces, ids_crc32, text_crc32 and decoded_crc32
    (equal where the round trip is exact)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    out = encode(docs.select("doc_id", "text", crc), ["doc_id", "text_crc32"], with_ids=False)
    return out.select("doc_id", "n_pieces", "ids_crc32", "text_crc32", "decoded_crc32")
