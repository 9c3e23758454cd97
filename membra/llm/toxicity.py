"""Toxicity: a convolutional text classifier.

Words (A-Z lower-cased, characters other than letters and digits at their ends
ignored) and their first 4 and 5 bytes are hashed into an embedding table, and
the three vectors are added, so that inflected forms share one; filters of widths 1, 2 and 3 run
over the sequence, each filter's largest answer over the whole text is kept,
and a logistic layer gives the score.  Table, filters and layer are trained in
numpy (Adam) on all labelled rows, shard by shard in Spark tasks whose changes
are averaged after each pass; a quarter of the ids, not trained on, calibrates
the score and one threshold for each language with all its rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BATCH_BYTES, BATCH_ROWS, Words, bounded_batches, field, is_held_out, map_text, mix, quoted
from .common import _powers, shared_path, staged
from .quality import CUT, _logit, _platt, labelled

#: rows of the hashed table; only rows that MIN_TEXTS of the texts learned from
#: use are trained and kept, all others stay the zero vector
ROWS, MIN_TEXTS, DIM, WIDTHS, FILTERS = 1 << 26, 3, 8, (1, 2, 3), 8
EPOCHS, BATCH, RATE = 6, 16, 0.02
#: rows that one task learns from by itself between two averages
SHARD_ROWS = 3000
#: labelled ids that are broadcast (some 30 bytes each), so that the texts stay
#: where they are; more are joined by a shuffle
BROADCAST_IDS = 5_000_000
#: unit in which changes are summed; step and range of raw scores in calibration
UNIT, STEP, MOST = 2.0**-30, 2.0**-10, 64.0


def _word_rows(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(three table rows from 1 of each word, words of each text)."""
    w = Words(texts, lower=True)
    b = w.buf
    inner = ((b >= 97) & (b <= 122)) | ((b >= 48) & (b <= 57)) | (b >= 128)
    # first and last such byte of a word; a word without one keeps its span
    at = np.flatnonzero(inner)
    lo = np.searchsorted(at, w.start)
    hi = np.searchsorted(at, w.end) - 1
    has = hi >= lo
    start, end = w.start.copy(), w.end.copy()
    start[has] = at[lo[has]]
    end[has] = at[hi[has]] + 1
    s = w.prefix_sums()
    _, down = _powers(len(b))
    out = []
    for n in (0, 4, 5):
        stop = np.minimum(end, start + n) if n else end
        h = mix((s[stop] - s[start]) * down[start] + np.uint64(n))
        out.append((h % np.uint64(ROWS - 1)).astype(np.int32) + 1)
    return np.stack(out, axis=1), w.count


def _padded(rows: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences one after another, each followed by padding (row 0): (rows, starts)."""
    pad = max(WIDTHS)
    starts = np.concatenate([[0], np.cumsum(count + pad)])[:-1]
    out = np.zeros((int((count + pad).sum()) + pad, rows.shape[1]), dtype=np.int32)
    doc = np.repeat(np.arange(len(count)), count)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    out[starts[doc] + np.arange(len(rows)) - first[doc]] = rows
    return out, starts


class Net:
    def __init__(self, rows: np.ndarray, seed: int = 3):
        """rows: the table's trained rows, ascending, without 0."""
        rng = np.random.default_rng(seed)
        self.rows = np.concatenate([[0], rows]).astype(np.int32)
        self.p = {"table": rng.normal(0, 0.3, (len(self.rows), DIM)), "out": rng.normal(0, 0.3, len(WIDTHS) * FILTERS),
                  "bias": np.zeros(1)}
        self.p["table"][0] = 0
        for w in WIDTHS:
            self.p[f"f{w}"] = rng.normal(0, 0.4, (w, DIM, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def place(self, rows: np.ndarray) -> np.ndarray:
        """Index into the kept rows; 0, the zero vector, for any other."""
        i = np.searchsorted(self.rows, rows)
        i[i == len(self.rows)] = 0
        return np.where(self.rows[i] == rows, i, 0)

    def maps(self, x: np.ndarray) -> dict[int, np.ndarray]:
        n = len(x) - max(WIDTHS) + 1
        return {w: sum(x[j : j + n] @ self.p[f"f{w}"][j] for j in range(w)) for w in WIDTHS}

    def logits(self, rows: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Whole texts; the padding gives an empty text its answer."""
        seq, starts = _padded(self.place(rows), count)
        z = self.maps(self.p["table"][seq].sum(1))
        top = [np.maximum(np.maximum.reduceat(z[w], starts, axis=0) + self.p[f"b{w}"], 0) for w in WIDTHS]
        return np.concatenate(top, axis=1) @ self.p["out"] + self.p["bias"][0]

    def others(self) -> list[str]:
        return [k for k in self.p if k != "table"]

    def copy(self) -> Net:
        new = object.__new__(Net)
        new.rows, new.p = self.rows, {k: v.copy() for k, v in self.p.items()}
        return new

    def grads(self, rows, count, y, weight=1.0):
        seq, starts = _padded(self.place(rows), count)
        x = self.p["table"][seq].sum(1)
        z = self.maps(x)
        ends = starts + count + max(WIDTHS)
        spot = {w: np.stack([a + z[w][a : min(b, len(z[w]))].argmax(0) for a, b in zip(starts, ends)]) for w in WIDTHS}
        f = np.arange(FILTERS)
        top = {w: z[w][spot[w], f] + self.p[f"b{w}"] for w in WIDTHS}
        h = np.concatenate([np.maximum(top[w], 0) for w in WIDTHS], axis=1)
        e = (1 / (1 + np.exp(-(h @ self.p["out"] + self.p["bias"][0]))) - y) * weight / len(y)
        g = {"out": h.T @ e, "bias": np.array([e.sum()])}
        back = e[:, None] * self.p["out"][None]
        touched, parts = [], []
        for i, w in enumerate(WIDTHS):
            d = back[:, i * FILTERS : (i + 1) * FILTERS] * (top[w] > 0)
            g[f"b{w}"] = d.sum(0)
            g[f"f{w}"] = np.stack([np.einsum("bfd,bf->df", x[spot[w] + j], d) for j in range(w)])
            for j in range(w):
                part = (d[..., None] * self.p[f"f{w}"][j].T[None]).reshape(-1, DIM)
                for k in range(seq.shape[1]):
                    touched.append(seq[spot[w] + j, k].ravel())
                    parts.append(part)
        at, inv = np.unique(np.concatenate(touched), return_inverse=True)
        gt = np.zeros((len(at), DIM))
        np.add.at(gt, inv, np.concatenate(parts))
        return g, at, gt * (at > 0)[:, None]


class _Adam:
    """Adam's steps on a net's parameters, from zero moments."""

    def __init__(self, net: Net):
        self.net, self.t = net, 0
        self.m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}

    def step(self, rows, count, y, weight, rate: float) -> np.ndarray:
        """One step; returns the table places it changed."""
        g, at, gt = self.net.grads(rows, count, y, weight)
        self.t += 1
        fix = np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, d in [*g.items(), ("table", gt)]:
            s, (m, v) = at if k == "table" else slice(None), self.m[k]
            m[s] = 0.9 * m[s] + 0.1 * d
            v[s] = 0.999 * v[s] + 0.001 * d * d
            self.net.p[k][s] -= rate * fix * m[s] / (np.sqrt(v[s]) + 1e-8)
        return at


def _changes(net: Net, start: dict[str, np.ndarray], touched: list[np.ndarray]) -> list[pa.RecordBatch]:
    """What a pass changed, as (place, DIM numbers) in whole units of UNIT:
    places of the table, then the other parameters from -1 downwards."""
    at = np.unique(np.concatenate(touched))
    at = at[at > 0]
    flat = np.concatenate([net.p[k].ravel().astype(float) - start[k].ravel() for k in net.others()])
    flat = np.pad(flat, (0, -len(flat) % DIM)).reshape(-1, DIM)
    place = np.concatenate([at, -1 - np.arange(len(flat))])
    d = np.concatenate([net.p["table"][at].astype(float) - start["table"][at], flat])
    d = np.rint(d / UNIT).astype(np.int64)
    cols = [pa.array(place, type=pa.int64())] + [pa.array(d[:, i]) for i in range(DIM)]
    return pa.Table.from_arrays(cols, names=["place", *[f"d{i}" for i in range(DIM)]]).to_batches(10_000)


def _pieces(batches):
    """(shard, labels, rows of each text), cut from each shard's first text on, so
    that they don't follow the batches nor which shards one task reads."""
    shard, y, rows, size = None, [], [], 0
    for b in batches:
        for s, v, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            if rows and (s != shard or len(rows) == BATCH_ROWS or size >= BATCH_BYTES):
                yield shard, np.array(y, dtype=np.int32), rows
                y, rows, size = [], [], 0
            shard = s
            y.append(v)
            rows.append(_unpacked(x))
            size += rows[-1].nbytes
    if rows:
        yield shard, np.array(y, dtype=np.int32), rows


def one_round(learn: DataFrame, net: Net, weight: dict[int, float], rate: float, seed: int) -> Net:
    """The net after every row of ``learn`` has been learned from once more.

    Each shard's rows are passed over from the same net, and the shards'
    changes are averaged: a table row's over the shards that changed it.  The
    changes are summed by Spark in whole units, so their order doesn't matter."""
    schema = T.StructType([field("place", "bigint")] + [field(f"d{i}", "bigint") for i in range(DIM)])

    def run(batches):
        now = None
        for shard, y, rows in _pieces(batches):
            if now is not None and now[0] != shard:
                yield from _changes(now[1].net, net.p, now[2])
                now = None
            if now is None:
                now = (shard, _Adam(net.copy()), [], np.random.default_rng([seed, shard]))
            order = now[3].permutation(len(y))
            for at in range(0, len(order), BATCH):
                pick = order[at : at + BATCH]
                now[2].append(now[1].step(np.concatenate([rows[k] for k in pick]), np.array([len(rows[k]) for k in pick]),
                                          y[pick], np.array([weight[v] for v in y[pick].tolist()]), rate))
            now[2][:] = [np.unique(np.concatenate(now[2]))]
        if now is not None:
            yield from _changes(now[1].net, net.p, now[2])

    got = (bounded_batches(learn.select("shard", "label_value", "rows")).mapInArrow(run, schema).groupBy("place")
           .agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"d{i}").alias(f"d{i}") for i in range(DIM)]).toArrow())
    place, n = got["place"].to_numpy(), got["n"].to_numpy()
    d = np.stack([got[f"d{i}"].to_numpy() for i in range(DIM)], axis=1) * UNIT / n[:, None]
    out, table = net.copy(), place > 0
    out.p["table"][place[table]] += d[table]
    flat = d[~table][np.argsort(-place[~table])].ravel()
    for k in net.others():
        size = net.p[k].size
        out.p[k] += flat[:size].reshape(net.p[k].shape).astype(np.float32)
        flat = flat[size:]
    return out


def _unpacked(blob) -> np.ndarray:
    return np.frombuffer(blob.as_py(), dtype=np.int32).reshape(-1, 3)


def _used_rows(learn: DataFrame) -> np.ndarray:
    """Table rows that MIN_TEXTS texts use, ascending, counted over all texts."""
    def run(batches):
        for b in batches:
            per = [np.unique(_unpacked(x)) for x in b.column(0)]
            at, n = np.unique(np.concatenate(per or [np.empty(0, np.int32)]), return_counts=True)
            yield from pa.Table.from_arrays([pa.array(at, type=pa.int32()), pa.array(n)], names=["row", "n"]).to_batches(10_000)

    n = bounded_batches(learn.select("rows")).mapInArrow(run, "row int, n bigint").groupBy("row").agg(F.sum("n").alias("n"))
    return np.sort(n.where(F.col("n") >= MIN_TEXTS).select("row").toArrow()["row"].to_numpy())


def _binned(held: DataFrame, net: Net) -> list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """(lang, raw score, label, rows) of all held rows, raw scores in steps of STEP."""
    def run(batches):
        for b in batches:
            rows = [_unpacked(x) for x in b.column(2)]
            z = np.array([net.logits(r, np.array([len(r)]))[0] for r in rows], dtype=float)
            at = np.rint(np.clip(z, -MOST, MOST) / STEP).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, type=pa.int64())], names=["lang", "y", "at"])

    cols = held.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "label_value", "rows")
    got = (bounded_batches(cols).mapInArrow(run, "lang string, y int, at bigint")
           .groupBy("lang", "y", "at").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by([("lang", "ascending"), ("at", "ascending"), ("y", "ascending")]))
    lang = np.array(got["lang"].to_pylist(), dtype=object)
    raw, y, n = got["at"].to_numpy() * STEP, got["y"].to_numpy(), got["n"].to_numpy()
    return [(k, raw[lang == k], y[lang == k], n[lang == k]) for k in sorted(set(lang.tolist()))]


def _best_cut(p: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """Threshold with the best F1, in the middle of the gap it falls in; ``n``:
    rows of each entry.  Equal scores fall on one side."""
    if len(set(y.tolist())) < 2:
        return CUT
    n = np.ones(len(y), dtype=np.int64) if n is None else n
    at, inv = np.unique(-p, return_inverse=True)
    rows = np.bincount(inv, weights=n)
    tp = np.cumsum(np.bincount(inv, weights=n * y))
    f1 = 2 * tp / (np.cumsum(rows) + tp[-1])
    i = int(f1.argmax())
    return float(-(at[i] + (at[i + 1] if i + 1 < len(at) else 0.0)) / 2)


def _as_rows(joined: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` and the table rows (12 bytes a word) of each text."""
    def rows(texts):
        r, n = _word_rows(texts)
        return [[x.tobytes() for x in np.split(r, np.cumsum(n)[:-1])]]

    return map_text(joined, "text", carry, [field("rows", "binary")], rows)


def _dealt(learn: DataFrame, shards: int) -> DataFrame:
    """Table rows of the texts learned from, one shard to a partition.  The texts
    are shuffled, not their rows, which are twice as long."""
    dealt = _as_rows(learn.repartitionById(shards, F.col("shard")), ["shard", "id", "label_value"])
    return dealt.sortWithinPartitions("shard", F.xxhash64("id", F.lit(13)), "rows").drop("id")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang", shard_rows: int = SHARD_ROWS):
    """(net, slope, offset, threshold by language) from all labelled rows and
    their whole texts; lang serves the thresholds only.

    A quarter of the ids isn't trained on: all its rows calibrate the score and
    the thresholds.  The other rows are dealt to shards of about
    ``shard_rows`` and passed over EPOCHS times, each time by all shards at once."""
    in_quarter = F.pmod(F.xxhash64("label_id", F.lit(11)), F.lit(4)) == 0
    marked = staged(labelled(docs, labels, label, id_col).withColumn("held", in_quarter), "toxicity-labels")
    n = {(r[0], r[1]): r[2] for r in marked.groupBy("held", "label_value").count().collect()}
    prior = (n.get((False, 1), 0) + n.get((True, 1), 0) + 0.5) / (sum(n.values()) + 1.0)
    shards = max(1, round(sum(k for (held, _), k in n.items() if not held) / shard_rows))
    ids = marked.select("label_id", "label_value")
    ids = F.broadcast(ids) if sum(n.values()) <= BROADCAST_IDS else ids
    joined = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), quoted(lang_col).alias("lang")).join(
        ids, F.col("id") == F.col("label_id"))
    learn = joined.where(~in_quarter).withColumn("shard", F.pmod(F.xxhash64("label_id", F.lit(12)), F.lit(shards)).cast("int"))
    learn = _dealt(learn.drop("label_id", "lang"), shards)
    path = shared_path(docs.sparkSession, "toxicity-rows")
    learn.write.option("compression", "zstd").parquet(path)
    learn = docs.sparkSession.read.schema(learn.schema).parquet(path)
    # read once and in any order: neither shuffled nor written
    held = _as_rows(joined.where(in_quarter), ["label_value", "lang"])
    of = {r[0]: r[1] for r in learn.groupBy("label_value").count().collect()}
    net = Net(_used_rows(learn))
    if len(of) < 2:
        net.p["out"][:] = 0
        return net, 0.0, _logit(prior), {}
    weight = {y: 0.5 * sum(of.values()) / k for y, k in of.items()}
    for epoch in range(EPOCHS):
        net = one_round(learn, net, weight, RATE * (1 - 0.8 * epoch / EPOCHS), epoch)
    bins = _binned(held, net)
    if not bins:
        return net, *_platt(np.empty(0), np.empty(0), prior), {}
    slope, offset = _platt(*[np.concatenate([b[i] for b in bins]) for i in (1, 2)], prior, np.concatenate([b[3] for b in bins]))
    return net, slope, offset, {
        k: _best_cut(1 / (1 + np.exp(-np.clip(slope * raw + offset, -30, 30))), y, n) for k, raw, y, n in bins}


def predict(docs: DataFrame, model, carry: list[str], text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``carry`` plus score and predicted (score >= cut) of each whole text.

    Null, empty and wordless texts are scored as padding alone.  Repeated rows
    get the same result each; a carried column named like a result column
    gives way to it.
    """
    net, slope, offset, _ = model

    def score(texts):
        z = net.logits(*_word_rows(texts))
        p = 1 / (1 + np.exp(-np.clip(slope * z.astype(float) + offset, -30, 30)))
        return [p, (p >= cut).astype(np.int32)]

    return map_text(docs, text_col, carry, [field("score", "double"), field("predicted", "int")], score)


def with_language_threshold(scored: DataFrame, model, lang_col: str = "lang") -> DataFrame:
    """Adds lang_threshold and toxic_by_lang (score at or above its language's
    threshold; the general cut for a language that wasn't calibrated)."""
    cut = F.lit(CUT)
    for k, v in model[3].items():
        cut = F.when(F.coalesce(quoted(lang_col), F.lit("")) == k, F.lit(v)).otherwise(cut)
    return scored.withColumn("lang_threshold", cut).withColumn("toxic_by_lang", F.col("score") >= F.col("lang_threshold"))


def op2_convolutional_toxicity(spark, sf_dir) -> DataFrame:
    """Learns from labels of rows whose crc32(doc_id as text) mod 4 is not 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~is_held_out("doc_id", 4, 2))
    model = train(docs, labels)
    out = with_language_threshold(predict(docs, model, ["doc_id", "lang"]), model)
    return out.select("doc_id", is_held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted",
                      "lang_threshold", "toxic_by_lang")
