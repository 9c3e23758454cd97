"""Language ID with a blended-spectrum string kernel.

Two texts are compared by the character 1- to 3-grams that both hold
(presence, not counts): k(x, y) = |X and Y| / sqrt(|X| |Y|).  A bounded sample
of labelled texts fits a one-versus-rest kernel ridge regression on Nystroem
landmarks; ``score = k(x, landmarks) @ alpha``.  As k is linear in the presence
vector of x, the landmark matrix and alpha are multiplied once, and a batch is
scored by one matrix product of its presence matrix.

n-grams are hashed into fixed tables (``SIZES``) after lower-casing; characters
that are no letters all count as one symbol.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import field, is_held_out, map_text, quoted, release_memos, sample_by, worker_cache

#: hash table of each n-gram order, n = 1, 2, 3
SIZES = (256, 4096, 16384)
DIMS = sum(SIZES)
#: rows fitted on, landmarks among them, and the ridge, for each language
TRAIN_PER_LANG, LANDMARKS_PER_LANG, RIDGE = 300, 40, 1e-2
UND = "und"


def _letters() -> np.ndarray:
    """Symbol of each code point: 0 for no letter, else 1 to 255."""
    c = worker_cache("letters")
    if "table" not in c:
        cp = np.arange(0x110000, dtype=np.uint64)
        sym = ((cp * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
        keep = np.zeros(0x110000, dtype=bool)
        keep[[i for i in range(0x110000) if chr(i).isalpha()]] = True
        c["table"] = np.where(keep, sym, 0).astype(np.uint8)
    return c["table"]


def presence(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(rows of 0/1 over DIMS, whether the text has a letter)."""
    low = [(t or b"").decode("utf-8", "replace").lower() for t in texts]
    size = np.array([len(t) for t in low], dtype=np.int64)
    cps = np.frombuffer("".join(t + "  " for t in low).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    sym = _letters()[np.concatenate([cps, [32, 32]])].astype(np.int64)
    doc = np.repeat(np.arange(len(low)), size + 2)
    at = np.concatenate([[0], np.cumsum(size + 2)])[:-1]
    real = np.ones(len(doc), dtype=bool)
    real[at + size] = real[at + size + 1] = False
    pos, doc = np.flatnonzero(real), doc[real]
    out = np.zeros((len(low), DIMS), dtype=np.uint8)
    flat, base = out.reshape(-1), doc * DIMS
    a, b, c = sym[pos], sym[pos + 1], sym[pos + 2]
    flat[base + a] = 1
    two = a * 257 + b
    flat[base + SIZES[0] + (two * 40503 >> 4) % SIZES[1]] = 1
    flat[base + SIZES[0] + SIZES[1] + ((two * 257 + c) * 2654435761 >> 9) % SIZES[2]] = 1
    return out, np.bincount(doc, weights=a > 0, minlength=len(low)) > 0


def fit(rows: list[tuple[str, bytes]], landmarks: int = LANDMARKS_PER_LANG,
        ridge: float = RIDGE) -> tuple[list[str], np.ndarray]:
    """(languages, weights DIMS x languages) from (language, packed presence)."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return [], np.zeros((DIMS, 0), dtype=np.float32)
    x = np.stack([np.unpackbits(np.frombuffer(r[1], dtype=np.uint8))[:DIMS] for r in rows]).astype(np.float32)
    y = np.array([langs.index(r[0]) for r in rows])
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    pick = np.concatenate([np.flatnonzero(y == i)[:landmarks] for i in range(len(langs))])
    marks = x[pick]
    k_nl, k_ll = (x @ marks.T).astype(np.float64), (marks @ marks.T).astype(np.float64)
    weight = 1.0 / np.bincount(y, minlength=len(langs))[y]
    target = np.where(y[:, None] == np.arange(len(langs)), 1.0, 0.0)
    left = (k_nl * weight[:, None]).T @ k_nl + ridge * k_ll + 1e-8 * np.eye(len(pick))
    alpha = np.linalg.solve(left, (k_nl * weight[:, None]).T @ target)
    return langs, (marks.T @ alpha).astype(np.float32)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_lang: int = TRAIN_PER_LANG) -> tuple[list[str], np.ndarray]:
    """Fits on at most about ``per_lang`` rows of each language.

    Only fixed-size presence bits of the sample reach the driver."""
    some = sample_by(docs.where(quoted(text_col).isNotNull()), lang_col, id_col, per_lang)

    def bits(texts):
        p, _ = presence(texts)
        return [[r.tobytes() for r in np.packbits(p, axis=1)]]

    got = map_text(some, text_col, [id_col, lang_col], [field("bits", "binary")], bits)
    rows = sorted(((r[1], r[0], bytes(r[2])) for r in got.collect()), key=lambda r: (r[0], str(r[1])))
    return fit([(r[0], r[2]) for r in rows])


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], carry: list[str],
            text_col: str = "text") -> DataFrame:
    """``carry`` plus lang_pred and score of each whole text.

    lang_pred is a learned language, or ``und`` (score 0) where the text is
    null, empty or without a letter, or nothing could be learned.  Repeated
    rows get the same result each; a carried column named like a result
    column gives way to it.
    """
    langs, weights = model

    def score(texts):
        release_memos()
        names, conf = [], []
        for i in range(0, len(texts), 128):
            p, letters = presence(texts[i : i + 128])
            n = np.sqrt(np.maximum(p.sum(1, dtype=np.int64), 1))
            s = (p.astype(np.float32) @ weights) / n[:, None] if langs else np.zeros((len(p), 1))
            best = s.argmax(1)
            ok = letters & bool(langs)
            names += [langs[b] if k else UND for b, k in zip(best, ok)]
            conf += np.where(ok, np.clip(s.max(1), 0.0, 1.0), 0.0).astype(float).tolist()
        return [names, conf]

    return map_text(docs, text_col, carry, [field("lang_pred", "string"), field("score", "double")], score)


def op4_string_kernel_language(spark, sf_dir) -> DataFrame:
    """Learns from rows whose crc32(doc_id as text) mod 3 is not 1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~is_held_out("doc_id", 3, 1)))
    out = predict(docs, model, ["doc_id"])
    return out.select("doc_id", is_held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")
