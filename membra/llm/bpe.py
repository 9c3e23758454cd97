"""BPE encoding and decoding with a contiguous rank array per word.

A text is cut at white space and, inside a white-space word, by the
tokenizer's own split pattern.  A short word's merging holds its parts and, for
each boundary between two of them, the rank of joining them, in two plain
lists: the least rank is found by a scan, its boundary deleted, and the ranks
on either side looked up again.  Words over ``SHORT`` parts take the same
merges in the same order from a heap of boundaries, so that a long word costs
n log n.  No library encodes here; ids equal those of the tokenizers library.

The tokenizer file is of the kind ``word_bpe_49k.json``: NFC, lower case,
byte-level letters, a suffix on a word's last part, and no decoder, so that
decoding joins the tokens by one space.  Characters up to U+024F are prepared
here; words with others are lower-cased and split by the library's normaliser
and split rule, because those depend on its Unicode version.

Each Python worker keeps the ids of the words and pieces it met last, within
``MEMO_KEYS`` and ``MEMO_LENGTH``.
"""

from __future__ import annotations

import json
import os
from array import array
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_type, bounded_batches, field, fresh, map_text, quoted, worker_cache

#: parts up to which a word's ranks are scanned
SHORT = 64
MEMO_KEYS, MEMO_LENGTH = 200_000, 64
#: bytes of a long text whose words are held at once
SPLIT_BYTES = 1 << 20
_NONE = 1 << 30
# Fixed value: the split pattern of the tokenizer file
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else one of
    the letters from U+0100 on, in order."""
    shows = set(chain(range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100)))
    other = iter(range(0x100, 0x200))
    return [chr(b if b in shows else next(other)) for b in range(256)]


class Merges:
    """The vocabulary and merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]
        if model["type"] != "BPE" or spec["decoder"] or pattern != {"Regex": SPLIT} or model["continuing_subword_prefix"]:
            raise ValueError(f"not a word BPE file: {path}")
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + end] for c in letters]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        #: rank of joining two parts, by both ids; id that joining at a rank gives
        self.rank = {(vocab[a] << 32) | vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        #: text of each id, as bytes; None where the file has no such id
        size = 1 + max(chain(vocab.values(), self.special.values()))
        self.token: list[bytes | None] = [None] * size
        for t, i in chain(vocab.items(), self.special.items()):
            self.token[i] = t.encode()

    def merge(self, parts: list[int]) -> list[int]:
        """The parts of a word after all merges; ``parts`` is used up."""
        if len(parts) > SHORT:
            return self._merge_long(parts)
        get, made = self.rank.get, self.made
        ranks = [get((a << 32) | b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == _NONE:
                break
            i = ranks.index(low)
            parts[i] = made[low]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get((parts[i] << 32) | parts[i + 1], _NONE)
            if i:
                ranks[i - 1] = get((parts[i - 1] << 32) | parts[i], _NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        get, made, n = self.rank.get, self.made, len(parts)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (r := get((parts[i] << 32) | parts[i + 1], _NONE)) < _NONE]
        heapify(heap)
        while heap:
            r, i, a, b = heappop(heap)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # a boundary that is gone or whose parts have grown
            parts[i], parts[j] = made[r], -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
            for x, y in ((left[i], i), (i, k)):
                if x >= 0 and y < n and (r := get((parts[x] << 32) | parts[y], _NONE)) < _NONE:
                    heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]


class Memo(dict):
    """What ``make`` gives for a key.  The last ``MEMO_KEYS`` keys asked for, and
    as many before them, are kept; keys over ``MEMO_LENGTH`` are not."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= MEMO_LENGTH:
            if len(self) >= MEMO_KEYS:
                self.old = dict(self)
                self.clear()
            self[key] = got
        return got


class Codec:
    """Ids of texts as little-endian unsigned 32-bit integers, and back."""

    def __init__(self, path: str):
        self.m = Merges(path)
        self.path, self.library = path, None
        self.find = regex.compile(SPLIT).findall
        special = "|".join(regex.escape(s) for s in sorted(self.m.special, key=len, reverse=True))
        self.cut = regex.compile(f"({special})").split if special else lambda w: [w]
        self.hint = os.path.commonprefix([s.encode() for s in self.m.special]) or b"\x00"
        self.words, self.pieces = Memo(self.word_ids), Memo(self.piece_ids)

    def word_ids(self, word: bytes) -> bytes:
        """Ids of a text without ASCII white space.  Bytes that aren't UTF-8
        are read as U+FFFD; special tokens' texts are their ids, as the library
        has it."""
        text = word.decode("utf-8", "replace")
        if self.hint not in word:
            return b"".join(map(self.pieces.__getitem__, self._split(text)))
        out = []
        for s in self.cut(text):
            if s in self.m.special:
                out.append(self.m.special[s].to_bytes(4, "little"))
            else:
                out += map(self.pieces.__getitem__, self._split(s))
        return b"".join(out)

    def _split(self, s: str) -> list[str]:
        """The lower-case pieces whose letters are merged."""
        if s.isascii() or s and max(s) < "ɐ":  # no character here has another composed form
            return self.find(s.lower())
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        s = self.library.normalizer.normalize_str(s)
        return [s[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(s)]

    def piece_ids(self, piece: str) -> bytes:
        raw = piece.encode()
        parts = [self.m.inner[b] for b in raw]
        parts[-1] = self.m.last[raw[-1]]
        return array("I", self.m.merge(parts)).tobytes()

    def encode(self, text: bytes | None) -> bytes:
        """Ids of a whole text; a null one has none."""
        if not text:
            return b""
        if len(text) <= SPLIT_BYTES:
            return b"".join(map(self.words.__getitem__, text.split()))
        out, at = [], 0
        while at < len(text):
            end = min(len(text), at + SPLIT_BYTES)
            while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
                end += 1
            out += map(self.words.__getitem__, text[at:end].split())
            at = end
        return b"".join(out)

    def decode(self, ids: memoryview | np.ndarray) -> bytes:
        """The tokens of ids, joined by one space; unknown ids give nothing."""
        token = self.m.token
        try:
            return b" ".join(map(token.__getitem__, ids))
        except (IndexError, TypeError):
            return b" ".join(t for i in ids if 0 <= i < len(token) and (t := token[i]) is not None)


def codec(path: str) -> Codec:
    """The worker's codec of a file, kept over its tasks."""
    held = worker_cache("bpe:" + path)
    if "codec" not in held:
        held["codec"] = Codec(path)
    return held["codec"]


def encode(docs: DataFrame, carry: list[str], text_col: str = "text", path: str | None = None,
           packed: bool = False, decoded: bool = False) -> DataFrame:
    """``carry`` plus ``ids`` of each whole text, one row a row of ``docs``.

    ``ids`` is array<int>, or with ``packed`` binary: little-endian unsigned
    32-bit integers.  With ``decoded`` the ids are decoded in the same task, to
    a column ``decoded``.  A null, empty or blank text has no ids and decodes to
    an empty text.  Equal texts have equal ids; a carried column named like a
    result column gives way to it; an empty table gives an empty one."""
    path = path or default_path()

    def score(texts):
        c = codec(path)
        got = [c.encode(t) for t in texts]
        cols: list = [got if packed else [np.frombuffer(g, "<i4") for g in got]]
        if decoded:
            cols.append([c.decode(memoryview(g).cast("I")) for g in got])
        return cols

    fields = [field("ids", "binary" if packed else "array<int>")] + [field("decoded", "string")] * decoded
    return map_text(docs, text_col, carry, fields, score)


def decode(df: DataFrame, carry: list[str], ids_col: str = "ids", path: str | None = None, out: str = "decoded") -> DataFrame:
    """``carry`` plus ``out``, the text of stored ids (array of integers, or
    binary as :func:`encode` packs them).

    No ids give an empty text, null ids a null one; null elements and ids that
    the file doesn't hold give nothing, as in the library."""
    import pyarrow as pa

    path = path or default_path()
    carry = [c for c in carry if c.lower() != out.lower()]
    tmp = fresh(df.select(*[quoted(c) for c in carry]), "__ids")
    src = df.select(*[quoted(c) for c in carry], quoted(ids_col).alias(tmp))
    if not isinstance(src.schema[tmp].dataType, T.BinaryType):
        src = src.withColumn(tmp, F.col(tmp).cast("array<bigint>"))
    schema = T.StructType([src.schema[c] for c in carry] + [field(out, "string")])
    kind = arrow_type(T.StringType())

    def text(c: Codec, ids) -> bytes | None:
        if ids is None:
            return None
        return c.decode(memoryview(ids).cast("I") if isinstance(ids, bytes) else [i for i in ids if i is not None])

    def run(batches):
        c = codec(path)
        for b in batches:
            got = pa.array([text(c, x.as_py()) for x in b.column(len(carry))], type=kind)
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(carry))] + [got], names=[*carry, out])

    return bounded_batches(src).mapInArrow(run, schema)


def op13_rank_array_bpe(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = encode(docs, ["doc_id"], packed=True, decoded=True)
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
