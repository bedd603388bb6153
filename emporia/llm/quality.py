"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

Every text becomes some twenty statistics (lengths, character classes, word and
line repetition).  Random Fourier features approximate a Gaussian kernel over
the standardised statistics; ridge scores come from the normal equations, whose
sums are formed per partition and added as they stream in two steps, so the
driver gets a few matrices of fixed size.  Scores are calibrated by isotonic regression over
equal-width bins of the ridge score (at most ``BINS`` rows reach the driver).

Only ``text`` is an input of a score; labels are learnt only from rows whose
``crc32(doc_id) mod 3`` is not 1.  Null counts as empty, and empty texts get the
score of their (zero) statistics.  Rows with a null label or a label that is
neither 0 nor 1 are not learnt from; several labels for one document all count.
Without any label of both kinds the score is the share of label 1 (0.5 without
labels).  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import as_bytes, batch_words, small_batches, trimmed, written
from emporia.llm.minhash import _slices

FEATURES, GAMMA, RIDGE, BINS, SEED = 192, 0.04, 1.0, 2048, 7
STATISTICS = ("log_bytes", "log_words", "letter", "digit", "space", "newline", "upper", "high", "sign", "hash", "pipe",
              "word_mean", "word_sd", "long_word", "short_word", "distinct", "top_word", "same_next", "line_mean", "line_same", "stop")


def _classes() -> np.ndarray:
    """Character class of a byte, as eight 0/1 columns."""
    t = np.zeros((256, 8), np.float64)
    t[97:123, 0] = t[65:91, 0] = t[128:, 0] = 1
    t[48:58, 1] = 1
    t[[32, 9, 13], 2] = 1
    t[10, 3] = 1
    t[65:91, 4] = 1
    t[128:, 5] = 1
    sign = [b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:!?'\"()-"]
    t[sign, 6] = 1
    t[[ord("|"), ord("<"), ord(">"), ord("{"), ord("}")], 7] = 1
    return t


_CLASSES = _classes()


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``STATISTICS`` per text, vectorised over the batch."""
    n = len(texts)
    out = np.zeros((n, len(STATISTICS)))
    size = np.array([len(t) for t in texts], np.float64)
    some = np.maximum(size, 1)
    counts = np.stack([np.bincount(np.frombuffer(t, np.uint8), minlength=256) for t in texts]) if n else np.zeros((0, 256))
    shares = (counts @ _CLASSES) / some[:, None]
    rows, lengths, words = batch_words(texts)
    w = np.bincount(rows, minlength=n)
    most = np.maximum(w, 1)
    mean = np.bincount(rows, lengths, n) / most
    sd = np.sqrt(np.maximum(np.bincount(rows, lengths.astype(float) ** 2, n) / most - mean**2, 0))
    order = np.lexsort((words, rows))
    r, x = rows[order], words[order]
    new = np.ones(len(x), bool)
    new[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(x)))
    distinct = np.bincount(r[at], minlength=n) / most
    top = np.zeros(n)
    np.maximum.at(top, r[at], runs)
    same = np.zeros(len(words), bool)
    same[1:] = (rows[1:] == rows[:-1]) & (words[1:] == words[:-1])
    lines = [t.split(b"\n") for t in texts]
    n_lines = np.array([len(x) for x in lines], np.float64)
    line_same = np.array([1 - len(set(x)) / len(x) for x in lines]) if n else np.zeros(0)
    out[:, 0], out[:, 1] = np.log1p(size), np.log1p(w)
    out[:, 2:9] = shares[:, :7]
    out[:, 9] = counts[:, ord("#")] / some if n else 0
    out[:, 10] = shares[:, 7]
    out[:, 11], out[:, 12] = mean, sd
    out[:, 13] = np.bincount(rows, lengths >= 12, n) / most
    out[:, 14] = np.bincount(rows, lengths <= 3, n) / most
    out[:, 15], out[:, 16] = distinct, top / most
    out[:, 17] = np.bincount(rows, same, n) / most
    out[:, 18], out[:, 19] = np.log1p(size / np.maximum(n_lines, 1)), line_same
    out[:, 20] = np.array([t.count(b". ") + t.count(b".\n") for t in texts], float) / most if n else 0
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, ids = as_bytes(b["text"]), b["doc_id"].to_numpy()
            for lo, hi in _slices(texts):
                yield pd.DataFrame({"doc_id": ids[lo:hi], "x": list(statistics(texts[lo:hi]))})

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(trimmed(run), "doc_id long, x array<double>")


class Fourier:
    """cos/sin features of standardised statistics; their inner product approximates a Gaussian kernel."""

    def __init__(self, mean: np.ndarray, sd: np.ndarray, features: int = FEATURES, gamma: float = GAMMA, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.sd = mean, np.where(sd > 1e-9, sd, 1.0)
        self.omega = rng.normal(0, np.sqrt(2 * gamma), (len(mean), features // 2))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        p = np.clip((x - self.mean) / self.sd, -8, 8) @ self.omega
        return np.concatenate([np.cos(p), np.sin(p), np.ones((len(x), 1))], axis=1)


def _added(parts: DataFrame, ways: int = 16) -> np.ndarray | None:
    """Sum of the vectors of ``parts(part, v)``: as they stream, first in the session's partitions, then in ``ways``, then on the driver."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, part = None, 0
        for b in batches:
            for part, v in zip(b["part"], b["v"], strict=True):
                total = np.array(v) if total is None else total + v
        if total is not None:
            yield pd.DataFrame({"part": [part], "v": [total]})

    with small_batches(parts.sparkSession):
        for to in ((), (ways,)):
            parts = parts.repartition(*to, "part").mapInPandas(trimmed(add), "part long, v array<double>")
        some = parts.collect()
    return np.sum([np.array(r["v"]) for r in some], axis=0) if some else None


def _partition_sums(rows: DataFrame, vector) -> DataFrame:
    """One (part, v) row per partition of ``rows(x, y)``, ``v`` being the sum of ``vector(x, y)`` over its batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for b in batches:
            if len(b):
                v = vector(np.stack([np.asarray(x) for x in b["x"]]), b["y"].to_numpy(float))
                total = v if total is None else total + v
        if total is not None:
            yield pd.DataFrame({"part": [b["part"].iloc[0]] if len(b) else [0], "v": [total]})

    return rows.withColumn("part", F.spark_partition_id()).mapInPandas(trimmed(run), "part long, v array<double>")


class Model:
    def __init__(self, fourier: Fourier | None, weights: np.ndarray | None, knots: tuple[np.ndarray, np.ndarray]):
        self.fourier, self.weights, self.knots = fourier, weights, knots

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(x), self.knots[1][0])
        return np.clip(np.interp(self.ridge(x), *self.knots), 0.0, 1.0)


def isotonic(at: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; knots at the blocks' centres, tilted a little so that ties keep the ridge order."""
    blocks: list[list[float]] = []  # value sum, weight, place sum, first, last
    for a, m, w in zip(at, mean, weight, strict=True):
        blocks.append([m * w, w, a * w, a, a])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            v, w2, p, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + v, blocks[-1][1] + w2, blocks[-1][2] + p, blocks[-1][3], last]
    xs, ys = [], []
    for v, w, _, first, last in blocks:
        xs += [first, last] if last > first else [first]
        ys += [v / w] * (2 if last > first else 1)
    x, y = np.array(xs), np.array(ys)
    span = max(x[-1] - x[0], 1e-9)
    y = 0.001 + 0.998 * y
    tilt = 1e-3 * ((x - x[0]) / span - 0.5)
    x, y = np.concatenate([[x[0] - 2], x, [x[-1] + 2]]), np.concatenate([[y[0] - 1e-3], y + tilt, [y[-1] + 1e-3]])
    return x, np.maximum.accumulate(y)


def fit(rows: DataFrame) -> Model:
    """Fit on all of ``rows(x, y)`` (y 0 or 1)."""
    d = len(STATISTICS)
    sums = _added(_partition_sums(rows, lambda x, y: np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)])))
    if sums is None or sums[1] in (0, sums[0]):
        share = 0.5 if sums is None else float(sums[1] / sums[0])
        return Model(None, None, (np.array([0.0]), np.array([share])))
    n = sums[0]
    mean = sums[2 : 2 + d] / n
    fourier = Fourier(mean, np.sqrt(np.maximum(sums[2 + d :] / n - mean**2, 0)))
    positive = sums[1]
    # Both labels weigh the same, so that the rarer one is not drowned.
    up, down = n / (2 * positive), n / (2 * (n - positive))

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z, w = fourier(x), np.where(y > 0.5, up, down)
        return np.concatenate([((z * w[:, None]).T @ z).ravel(), (z * w[:, None]).T @ (2 * y - 1)])

    total = _added(_partition_sums(rows, normal))
    k = FEATURES + 1
    gram, right = total[: k * k].reshape(k, k), total[k * k :]
    penalty = np.full(k, RIDGE)
    penalty[-1] = 1e-6
    weights = np.linalg.solve(gram + np.diag(penalty), right)
    model = Model(fourier, weights, (np.zeros(1), np.zeros(1)))

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                s = model.ridge(np.stack([np.asarray(x) for x in b["x"]]))
                yield pd.DataFrame({"bin": np.clip(((s + 2) / 4 * BINS), 0, BINS - 1).astype(int), "y": b["y"].to_numpy(float)})

    found = rows.mapInPandas(bins, "bin int, y double").groupBy("bin").agg(F.avg("y").alias("m"), F.count("*").alias("n")).orderBy("bin").collect()
    centre = np.array([(r["bin"] + 0.5) * 4 / BINS - 2 for r in found])
    model.knots = isotonic(centre, np.array([r["m"] for r in found]), np.array([float(r["n"]) for r in found]))
    return model


def _held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1


def learnt(stats: DataFrame, labels: DataFrame) -> Model:
    """The model fitted on the rows of ``stats(doc_id, x)`` that have a label and are not held out."""
    learn = labels.select("doc_id", F.col("quality").cast("double").alias("y")).where("y in (0.0, 1.0)").where(~_held_out())
    return fit(written(stats.sparkSession, stats.join(learn, "doc_id").select("x", "y"), "quality-train"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    stats = written(docs.sparkSession, with_statistics(docs), "quality-stats")
    model = learnt(stats, labels)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield pd.DataFrame({"doc_id": b["doc_id"].to_numpy(), "score": model.score(np.stack([np.asarray(x) for x in b["x"]]))})

    out = stats.mapInPandas(trimmed(run), "doc_id long, score double")
    return out.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects; all columns stay.

    A score depends on the text alone, so a row is scored and kept or dropped where it lies; no text is shuffled,
    and ids may be null or repeated.
    """
    model = learnt(written(docs.sparkSession, with_statistics(docs), "quality-stats"), labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = as_bytes(pd.Series([t or "" for t in b.column(at).to_pylist()], dtype=object))
            keep = [model.score(statistics(texts[lo:hi])) >= 0.5 for lo, hi in _slices(texts)]
            if keep:
                yield b.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(trimmed(run), docs.schema)
