"""Token ids of whole texts with a public tokenizer, by memoised words.

The tokenizer drops white space and never joins characters across it, so a
text's ids are those of its white-space separated words one after another.
Each Python worker keeps the ids of the words it has met, in arrays sorted by
the words' 64-bit hashes; a chunk of texts is looked up by binary search, and
only words not met before go to the tokenizer.
"""

from __future__ import annotations

import os
from array import array
from itertools import repeat

import numpy as np

from .common import Words, worker_cache

#: words, and words without punctuation, that a worker keeps before it starts anew
MEMO_WORDS, MEMO_CORES = 1_500_000, 300_000
_TAIL = ".,;:!?"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _ByteTable(dict):
    """What the tokenizer's byte-level step makes of a character (for str.translate)."""

    def __missing__(self, cp: int) -> str:
        from tokenizers.pre_tokenizers import ByteLevel

        self[cp] = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(cp))[0][0]
        return self[cp]


class Encoder:
    """``encode(texts as bytes or None)`` gives (ids of all texts, ids per text)."""

    def __init__(self, path: str):
        self.memo = worker_cache("ids:" + path)
        if "tok" not in self.memo:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.memo["tok"] = Tokenizer.from_file(path)
            if self.memo["tok"].get_vocab_size(with_added_tokens=True) > 1 << 16:
                raise ValueError("ids over 65535 are not supported")
            self._empty()

    def _empty(self) -> None:
        self.memo |= {"key": np.empty(0, np.uint64), "at": np.empty(0, np.int64), "len": np.empty(0, np.int64),
                      "ids": np.empty(0, np.uint16), "used": 0, "core": {"": b""}, "bytes": _ByteTable()}

    def _library(self, words: list[str]) -> list[bytes]:
        """Ids of words: lower-case ones of letters up to U+00FF straight from
        the BPE model, which is all that the other steps leave to do there."""
        tok, model, table = self.memo["tok"], self.memo["tok"].model, self.memo["bytes"]
        simple = [w.isalpha() and w.islower() and (w.isascii() or max(w) < "Ā") for w in words]
        rest = iter(tok.encode_batch_fast([w for w, s in zip(words, simple) if not s], add_special_tokens=False))
        return [array("H", [t.id for t in model.tokenize(w if w.isascii() else w.translate(table))] if s
                      else next(rest).ids).tobytes() for w, s in zip(words, simple)]

    def _learn(self, key: np.ndarray, words: list[bytes]) -> None:
        """Adds words that aren't known yet; ``key`` ascending."""
        m, parts = self.memo, []
        core = m["core"]
        if len(core) > MEMO_CORES:
            core.clear()
            core[""] = b""
        for w in map(str, words, repeat("utf-8"), repeat("replace")):
            c = w.rstrip(_TAIL)
            # letters are split from plain punctuation after them anyway, and
            # up to U+00FF their case doesn't matter; other letters may become
            # a letter and a mark, which stays with the punctuation
            if c.isalpha() and (c.isascii() or (max(c) < "\u0250" and c.lower().isalpha())):
                parts.append((c.lower() if c.isascii() or max(c) < "Ā" else c, w[len(c) :]))
            else:
                parts.append((w, ""))
        new = list({x for p in parts for x in p if x not in core})
        core.update(zip(new, self._library(new)))
        got = [core[a] + core[b] for a, b in parts]
        size = np.fromiter(map(len, got), np.int64, len(got)) // 2
        need = m["used"] + int(size.sum())
        if need > len(m["ids"]):
            m["ids"] = np.concatenate([m["ids"][: m["used"]], np.empty(max(need, 1 << 16), np.uint16)])
        m["ids"][m["used"] : need] = np.frombuffer(b"".join(got), dtype=np.uint16)
        at = m["used"] + np.cumsum(size) - size
        m["used"] = need
        place = np.searchsorted(m["key"], key)
        for name, v in (("key", key), ("at", at), ("len", size)):
            m[name] = np.insert(m[name], place, v)

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        w = Words(texts)
        if not len(w.start):
            return np.empty(0, np.uint16), np.zeros(len(texts), np.int64)
        h, first, back = np.unique(w.hashes(), return_index=True, return_inverse=True)
        m = self.memo
        if len(m["key"]) > MEMO_WORDS:
            self._empty()
        place = np.searchsorted(m["key"], h)
        known = place < len(m["key"])
        known[known] = m["key"][place[known]] == h[known]
        if not known.all():
            at, raw = first[~known], w.buf.tobytes()
            self._learn(h[~known], [raw[a:b] for a, b in zip(w.start[at].tolist(), w.end[at].tolist())])
            place = np.searchsorted(m["key"], h)
        size, src = m["len"][place][back], m["at"][place][back]
        done = np.cumsum(size)
        ids = m["ids"][np.repeat(src - (done - size), size) + np.arange(done[-1])]
        return ids, np.diff(np.concatenate([[0], done])[w.first])
