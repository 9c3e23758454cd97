"""Quality classifier: supervised subword embeddings.

A text is the mean of the vectors of its words, of the words' byte 3- and
4-grams (a space on either side counts as a byte) and of one row for each word
equal to the word before it, all hashed into one table.
A softmax layer gives the class.  Table and layer are trained together by
stochastic gradient descent in numpy on a bounded sample of labelled rows.
As the layer is linear in the mean, scoring adds one number for each feature.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, byte_values, field, is_held_out, map_text, mix, quoted, release_memos, sample_by

#: hashed rows for words, and for n-grams; vector size
WORD_ROWS, GRAM_ROWS, DIM = 1 << 14, 1 << 14, 12
TABLE = WORD_ROWS + GRAM_ROWS + 1
#: labelled rows fitted on for each class, those kept for calibration included
TRAIN_PER_CLASS, EPOCHS, BATCH, RATE = 1500, 12, 32, 0.5
CUT = 0.3


def features(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(row of the table, document) of every feature of a chunk."""
    w = Words(texts)
    h = w.hashes()
    again = np.flatnonzero((h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])) + 1
    ids = [(h % np.uint64(WORD_ROWS)).astype(np.int32), np.full(len(again), WORD_ROWS + GRAM_ROWS, dtype=np.int32)]
    docs = [w.doc, w.doc[again]]
    v = byte_values()[np.where(w.space, np.uint8(32), w.buf)]
    doc_of = np.repeat(np.arange(w.n_docs), np.diff(w.doc_at))
    for n in (3, 4):
        if len(v) < n:
            continue
        m = len(v) - n + 1
        h = np.zeros(m, dtype=np.uint64)
        ok = np.ones(m, dtype=bool)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + v[j : j + m]
            if 0 < j < n - 1:
                ok &= ~w.space[j : j + m]
        ok &= doc_of[:m] == doc_of[n - 1 :]
        ids.append((mix(h[ok]) % np.uint64(GRAM_ROWS)).astype(np.int32) + WORD_ROWS)
        docs.append(doc_of[:m][ok])
    return np.concatenate(ids), np.concatenate(docs)


def bags(texts: list) -> list:
    """Distinct rows and their shares of each text, packed (row int32, share float32)."""
    ids, docs = features(texts)
    key, n = np.unique(docs.astype(np.int64) * TABLE + ids, return_counts=True)
    doc, row = np.divmod(key, TABLE)
    total = np.bincount(doc, weights=n, minlength=len(texts))
    share = (n / total[doc]).astype(np.float32)
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [row[a:b].astype("<i4").tobytes() + share[a:b].astype("<f4").tobytes() for a, b in zip(cut[:-1], cut[1:])]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(rows: list[tuple[int, bytes]], prior: float, epochs: int = EPOCHS) -> tuple[np.ndarray, float, float]:
    """(number of each table row, slope, offset): P(1) = sigmoid(slope * sum + offset).

    A fifth of the sample is kept to calibrate the scores to ``prior``, the
    share of label 1 among all labelled rows that may be learned from."""
    n_rows = TABLE
    if len({r[0] for r in rows}) < 2:
        return np.zeros(n_rows, dtype=np.float32), 0.0, _logit(prior)
    got = [np.frombuffer(b, dtype=np.uint8) for _, b in rows]
    ids = [g[: len(g) // 2].view("<i4") for g in got]
    share = [g[len(g) // 2 :].view("<f4") for g in got]
    y = np.array([r[0] for r in rows])
    rng = np.random.default_rng(7)
    table = rng.uniform(-1.0 / DIM, 1.0 / DIM, (n_rows, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    order = rng.permutation(len(y))
    held, learn = order[: len(y) // 5], order[len(y) // 5 :]
    class_w = 0.5 / np.maximum(np.bincount(y[learn], minlength=2) / max(len(learn), 1), 1e-9)
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for at in range(0, len(learn), BATCH):
            pick = learn[at : at + BATCH] if epoch == 0 else rng.choice(learn, BATCH)
            flat = np.concatenate([ids[i] for i in pick])
            rows_u, inv = np.unique(flat, return_inverse=True)
            x = np.zeros((len(pick), len(rows_u)), dtype=np.float32)
            x[np.repeat(np.arange(len(pick)), [len(ids[i]) for i in pick]), inv] = np.concatenate([share[i] for i in pick])
            mean = x @ table[rows_u]
            p = _softmax(mean @ layer + bias)
            p[np.arange(len(pick)), y[pick]] -= 1
            g = (p * class_w[y[pick]][:, None] / len(pick)).astype(np.float32)
            g_mean = g @ layer.T
            layer -= rate * (mean.T @ g)
            bias -= rate * g.sum(0)
            table[rows_u] -= rate * BATCH * (x.T @ g_mean)
    value = (table @ (layer[:, 1] - layer[:, 0])).astype(np.float32)
    raw = np.array([float(value[ids[i]] @ share[i]) for i in held])
    slope, offset = _platt(raw, y[held], prior)
    return value, slope, offset


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def _platt(raw: np.ndarray, y: np.ndarray, prior: float, n: np.ndarray | None = None) -> tuple[float, float]:
    """Logistic fit of y on raw, each class weighted to its share under ``prior``;
    ``n``: rows of each entry."""
    if len(set(y.tolist())) < 2:
        return 0.0, _logit(prior)
    n = np.ones(len(y)) if n is None else n
    one = n[y == 1].sum() / n.sum()
    w = n * np.where(y == 1, prior / max(one, 1e-9), (1 - prior) / max(1 - one, 1e-9))
    mid = np.average(raw, weights=n)
    sd = np.sqrt(np.average((raw - mid) ** 2, weights=n)) + 1e-9
    z = (raw - mid) / sd
    a, b = 1.0, 0.0
    soft = np.where(y == 1, 1 - 1e-3, 1e-3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-(a * z + b)))
        r, c = w * (p - soft), w * p * (1 - p) + 1e-6
        h = np.array([[(c * z * z).sum() + 0.05, (c * z).sum()], [(c * z).sum(), c.sum() + 1e-3]])
        step = np.linalg.solve(h, [(r * z).sum() + 0.05 * a, r.sum()])
        a, b = a - step[0], b - step[1]
        if not np.isfinite(a + b):
            return 1.0 / sd, float(-mid / sd + _logit(prior))
    return float(a / sd), float(b - a * mid / sd)


def labelled(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """One row (id, label) for each id with labels 0 or 1 (the larger where labels differ)."""
    return (labels.where(quoted(label).isin(0, 1) & quoted(id_col).isNotNull())
            .groupBy(quoted(id_col).alias("label_id")).agg(F.max(quoted(label)).cast("int").alias("label_value")))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", per_class: int = TRAIN_PER_CLASS) -> tuple[np.ndarray, float, float]:
    """Fits on at most about ``per_class`` labelled rows of each class.

    The sample's ids (bounded) are broadcast, so the texts aren't shuffled."""
    marked = labelled(docs, labels, label, id_col)
    count = {r[0]: r[1] for r in marked.groupBy("label_value").count().collect()}
    prior = (count.get(1, 0) + 0.5) / (sum(count.values()) + 1.0)
    some = sample_by(marked, "label_value", "label_id", per_class)
    joined = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).join(
        F.broadcast(some), F.col("id") == F.col("label_id"))
    got = map_text(joined, "text", ["id", "label_value"], [field("bag", "binary")], lambda t: [bags(t)])
    rows = sorted(((r[0], r[1], bytes(r[2])) for r in got.collect()), key=lambda r: (str(r[0]), r[2]))
    return fit([(r[1], r[2]) for r in rows], prior)


def predict(docs: DataFrame, model: tuple[np.ndarray, float, float], carry: list[str],
            text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``carry`` plus score (probability of label 1) and predicted (score >= cut).

    Null texts and those without a word have no features and get the score of
    a zero vector.  Repeated rows get the same result each; a carried column
    named like a result column gives way to it.
    """
    value, slope, offset = model

    def score(texts):
        release_memos()
        ids, docs_ = features(texts)
        n = np.bincount(docs_, minlength=len(texts))
        s = np.bincount(docs_, weights=value[ids], minlength=len(texts)) / np.maximum(n, 1)
        p = 1 / (1 + np.exp(-np.clip(slope * s + offset, -30, 30)))
        return [p, (p >= cut).astype(np.int32)]

    return map_text(docs, text_col, carry, [field("score", "double"), field("predicted", "int")], score)


def op7_subword_quality(spark, sf_dir) -> DataFrame:
    """Learns from labels of rows whose crc32(doc_id as text) mod 5 is not 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~is_held_out("doc_id", 5, 0))
    out = predict(docs, train(docs, labels), ["doc_id"])
    return out.select("doc_id", is_held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")
