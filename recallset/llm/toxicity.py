"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_python, stored

#: Features are n-grams of lengths from the first to the last, hashed into 2 ** BITS cells.
LENGTHS = (3, 6)
BITS = 18


@dataclass(frozen=True)
class ToxicityModel:
    """A weight for each cell (log-count ratio times what the regression learned), and the intercept."""

    weights: np.ndarray
    intercept: float

    def scores(self, texts) -> np.ndarray:
        """Probabilities of the label; NULL counts as an empty text."""
        seen = np.zeros(1 << BITS, np.int64)
        sums = np.fromiter((self.weights[cells(t, seen)].sum() for t in texts), np.float64)
        return 1 / (1 + np.exp(-np.clip(sums + self.intercept, -40, 40)))


def cells(text: str | None, seen: np.ndarray) -> np.ndarray:
    """The distinct cells of a text's n-grams, in lower case, white space runs as one space. `seen` is scratch space."""
    codes = np.frombuffer((" " + " ".join((text or "").lower().split()) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    found, hashed = [], np.zeros(len(codes), np.uint64)
    for n in range(1, min(LENGTHS[-1], len(codes)) + 1):
        hashed = hashed[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
        if n >= LENGTHS[0]:
            mixed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            found.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
    if not found:
        return np.zeros(0, np.int64)
    every = np.concatenate(found)
    order = np.arange(len(every))
    seen[every] = order  # of equal cells the last write stays
    return every[seen[every] == order]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable, most: int) -> DataFrame:
    """At most about `most` (label, text) rows of documents whose label is known and `usable` by doc_id, picked by a hash.

    A doc_id labelled twice takes the higher label. NULL labels, ids and texts are left out of training.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & usable)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    count = known.count()
    if count > most:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < int(most / count * (1 << 30)))
    picked = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").filter(F.col("text").isNotNull())  # bounded by `most`
    return picked.select("label", "text")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", usable=None, max_labelled: int = 20_000, min_docs: int = 5, min_z: float = 3.0, min_ratio: float = 0.7) -> ToxicityModel:
    """Learn from at most about `max_labelled` labelled documents.

    Counts of documents with a cell, by class, are made by Spark. Cells in fewer than `min_docs` documents, or whose log-count
    ratio is within `min_z` standard errors of 0 or within `min_ratio` of it, get no weight. A regularised logistic regression over the others, scaled by their
    ratios, runs on the driver: its input is bounded by `max_labelled`. With no label, or one class only, the
    score is that class's smoothed share for every text.
    """
    usable = F.lit(True) if usable is None else usable
    sample = stored(labelled_sample(docs, labels, label, usable, max_labelled), "toxicity-sample")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([cells(t, seen).astype(np.int32) for t in part.column(1).to_pylist()], pa.list_(pa.int32()))], ["label", "cells"])

    features = in_python(sample, featurise, "label int, cells array<int>")
    total, positive = features.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    negative = total - positive
    prior = (positive + 0.5) / (total + 1)
    flat = ToxicityModel(np.zeros(1 << BITS), float(np.log(prior / (1 - prior))))
    if not positive or not negative:
        return flat
    counts = features.select("label", F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("n"), F.sum("label").alias("p"))
    found = counts.filter(F.col("n") >= min_docs).toArrow()  # at most 2 ** BITS rows of three numbers
    cell, n, p = (found.column(c).to_numpy().astype(np.float64) for c in ("cell", "n", "p"))
    ratio = np.log((p + 0.5) / (positive + 1)) - np.log((n - p + 0.5) / (negative + 1))
    error = np.sqrt(1 / (p + 0.5) + 1 / (n - p + 0.5))
    kept = (np.abs(ratio) >= min_z * error) & (np.abs(ratio) >= min_ratio)
    if not kept.any():
        return flat
    column = np.full(1 << BITS, -1, np.int32)
    column[cell[kept].astype(np.int64)] = np.arange(kept.sum())

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            rows = [column[cells(t, seen)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[r >= 0] for r in rows], pa.list_(pa.int32()))], ["label", "columns"])

    data = in_python(sample, reduced, "label int, columns array<int>").toArrow().combine_chunks()
    y = data.column("label").to_numpy().astype(np.float64)
    lists = data.column("columns").combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy()
    weights, intercept = _logistic(np.repeat(np.arange(len(y)), sizes), lists.flatten().to_numpy(), y, ratio[kept], prior)
    full = np.zeros(1 << BITS)
    full[cell[kept].astype(np.int64)] = weights * ratio[kept]
    return ToxicityModel(full, intercept)


def _logistic(row: np.ndarray, col: np.ndarray, y: np.ndarray, ratio: np.ndarray, prior: float, ridge: float = 1.0, steps: int = 200) -> tuple[np.ndarray, float]:
    """Mean log loss plus `ridge` / n times half the squared weights, minimised by limited-memory BFGS."""
    n, m = len(y), len(ratio)
    row, value = row.astype(np.int32), ratio[col].astype(np.float32)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        margin = np.bincount(row, value * x[col], n) + x[m]
        error = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y
        total = np.logaddexp(0, margin) - y * margin
        return total.mean() + ridge / (2 * n) * (x[:m] ** 2).sum(), np.append(np.bincount(col, value * error[row], m) / n + ridge / n * x[:m], error.mean())

    x = np.zeros(m + 1)
    x[m] = np.log(prior / (1 - prior))
    value_x, gradient = loss(x)
    steps_done: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        direction, kept = -gradient, []
        for s, d, rho in reversed(steps_done):
            kept.append(rho * (s @ direction))
            direction = direction - kept[-1] * d
        if steps_done:
            s, d, _ = steps_done[-1]
            direction = direction * ((s @ d) / (d @ d))
        for (s, d, rho), a in zip(steps_done, reversed(kept), strict=True):
            direction = direction + (a - rho * (d @ direction)) * s
        slope, rate = gradient @ direction, 1.0 if steps_done else 1 / max(1.0, np.abs(gradient).sum())
        while rate > 1e-10:
            value_new, gradient_new = loss(x + rate * direction)
            if value_new <= value_x + 1e-4 * rate * slope:
                break
            rate /= 2
        else:
            break
        s, d = rate * direction, gradient_new - gradient
        gain = value_x - value_new
        x, value_x, gradient = x + s, value_new, gradient_new
        if s @ d > 1e-12:
            steps_done = [*steps_done[-9:], (s, d, 1 / (s @ d))]
        if gain < 1e-7:
            break
    return x[:m], float(x[m])


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row (doc_id, score) per row of `docs`; other columns are ignored, NULL texts score as empty ones."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shared.value.scores(part.column(1).to_pylist()))], ["doc_id", "score"])

    return in_python(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores under the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.scores(batch.column(at).to_pylist()) < threshold))

    return in_python(docs, run, docs.schema)
