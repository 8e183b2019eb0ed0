"""Quality classifier: random Fourier features of document statistics, ridge scores from partition-summed normal equations, isotonic calibration."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_python, stored
from .sets import text_parts

#: Cosines that approximate the kernel, folds for out-of-fold scores, score bins for calibration, tasks that sum equations.
FEATURES, FOLDS, BINS, TASKS = 256, 4, 1000, 8
SEED = 20
_CLASS = np.zeros(256, np.int64)
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\n", b".,;:?'\"()-", b"!", b"|", bytes(range(128, 256))), 1):
    _CLASS[list(_chars)] = _k


def statistics(text: str | None) -> list[float]:
    """Numbers about a text's length, characters, words and lines; an empty or NULL text has its own."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(_CLASS[raw], minlength=9) / max(1, len(raw))
    words = text.split()
    n = max(1, len(words))
    times = Counter(words)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = [x for x in text.split("\n") if x]
    common = max(times.values(), default=0)
    marked = sum(not w[-1].isalnum() for w in words)
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        *counts.tolist(),
        sum(map(len, words)) / n,
        len(times) / n,
        common / n,
        again / n,
        marked / n,
        math.log1p(len(lines)),
        len(set(lines)) / max(1, len(lines)),
        sum(w.isupper() for w in words) / n,
        float(not words),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) per row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batches, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([statistics(t) for t in part.column(1).to_pylist()], pa.list_(pa.float64()))], ["doc_id", "stats"])

    return in_python(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, stats array<double>")


@dataclass(frozen=True)
class QualityModel:
    """Means and scales of the statistics, the random directions and phases, ridge weights, and the calibration's knots."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.hstack([math.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases), np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", usable=None, ridge: float = 1.0) -> QualityModel:
    """Learn from all labelled rows of `stats` (doc_id, stats) whose doc_id is `usable`.

    Each of TASKS tasks sums, for each fold, the products of the features of its rows; so what reaches the driver does not grow with the
    data. A fold's rows are scored by the equations of the others, and these scores are calibrated. Folds follow the
    statistics, so that copies share one. A doc_id labelled twice takes the higher label; NULL labels and ids are left out. Without
    labels every score is 0.5.
    """
    usable = F.lit(True) if usable is None else usable
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & usable)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = stats.join(known, "doc_id").select(F.pmod(F.xxhash64("stats"), F.lit(FOLDS)).cast("int").alias("fold"), "label", "stats")
    rows = stored(rows.repartition(TASKS), "quality-train")
    width = len(statistics(""))
    moments = rows.select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(F.mean("x").alias("mean"), F.stddev_pop("x").alias("scale")).orderBy("i").collect()
    draw = np.random.default_rng(SEED)
    directions = draw.normal(size=(width, FEATURES)) / math.sqrt(width / 2)
    phases = draw.uniform(0, 2 * math.pi, FEATURES)
    if not moments:
        return QualityModel(np.zeros(width), np.ones(width), directions, phases, np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    base = QualityModel(np.array([m["mean"] for m in moments]), np.maximum([m["scale"] for m in moments], 1e-6), directions, phases, np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for batch in batches:
            fold, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            x = base.features(_matrix(batch.column(2)))
            for f in range(FOLDS):
                own = x[fold == f]
                total[f] += own.T @ np.hstack([own, y[fold == f, None]])
        yield pa.RecordBatch.from_arrays([pa.array(range(FOLDS), pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())], ["fold", "sums"])

    shape = (FEATURES + 1, FEATURES + 2)
    sums = np.zeros((FOLDS, *shape))
    for row in in_python(rows.coalesce(TASKS), equations, "fold int, sums binary").toLocalIterator():
        sums[row["fold"]] += np.frombuffer(row["sums"]).reshape(shape)
    penalty = np.diag([ridge / FEATURES * 2] * FEATURES + [1e-9])
    solve = lambda s: np.linalg.solve(s[:, :-1] + penalty, s[:, -1])
    held = np.array([solve(sums.sum(0) - sums[f]) for f in range(FOLDS)])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = (base.features(_matrix(batch.column(2))) * held[batch.column(0).to_numpy()]).sum(1)
            at = np.clip(np.floor((raw + 1) / 3 * BINS), 0, BINS - 1).astype(np.int32)  # from -1 to 2
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1)], ["bin", "label"])

    found = in_python(rows, binned, "bin int, label int").groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).orderBy("bin").collect()
    knots, values = isotonic([(b["bin"] + 0.5) * 3 / BINS - 1 for b in found], [b["ones"] for b in found], [b["n"] for b in found])
    return QualityModel(base.mean, base.scale, directions, phases, solve(sums.sum(0)), knots, values)


def isotonic(at: list[float], ones: list[int], n: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pool neighbours until shares rise; each pool is a knot at its mean position, and between knots the score rises in a line.

    Shares are smoothed by half a row of each label, so that the ends stay apart from 0 and 1.
    """
    pools: list[list[float]] = []
    for x, o, m in zip(at, ones, n, strict=True):
        pools.append([x * m, o, m])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    knots = np.array([p[0] / p[2] for p in pools])
    values = np.maximum.accumulate([(p[1] + 0.5) / (p[2] + 1) for p in pools])
    return np.concatenate([[-3.0], knots, [4.0]]), np.concatenate([[values[0] / 2], values, [(1 + values[-1]) / 2]])


def score(stats: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) per row (doc_id, stats)."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(_matrix(batch.column(1))))], ["doc_id", "score"])

    return in_python(stats, run, f"doc_id {dict(stats.dtypes)['doc_id']}, score double")
