"""Quality by ordinal cumulative-link regression on graded ratings.

A text has hashed features: raw byte 3-grams, which see case, symbols and
layout, and repetition marks (a word equal to the one before, the share of
distinct words).  One weight vector is shared by all grades and ordered
thresholds t_1 < t_2 < ... cut its value: P(grade >= k) = sigmoid(w.x - t_k).
The result is the expected grade and the tail probability of a grade.

Fitted on a bounded sample of rated rows (``sample``, at most twice as many
by chance).  Rows: null and empty texts have no features and get the
thresholds' own odds; null ratings are no ratings; of repeated ratings the
highest counts; equal texts score alike; with fewer than two grades the
expected grade is that grade (0 if there is none); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipwise.llm.tables import pick
from shipwise.llm.toxicity import labelled_sample
from shipwise.llm.words import NONSPACE, Words, each_block


@dataclass(frozen=True)
class QualityParams:
    dims: int = 1 << 12
    sample: int = 4000
    ridge: float = 2e-4
    steps: int = 250


def grades(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, grade: 0 poor, 1 good but toxic, 2 good."""
    return labels.select(F.col(id_col).alias("id"), F.when(F.col("quality") == 0, 0).when(
        F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2).alias("grade"))


def features(words: Words, lengths: np.ndarray, raw: np.ndarray, dims: int) -> np.ndarray:
    """One row of unit length per text; the last 16 columns are the repetition marks."""
    n, out = len(words.rows), np.zeros((len(words.rows), dims), dtype=np.float32)
    doc = np.repeat(np.arange(n), lengths)
    if len(raw) > 2:
        b = raw.astype(np.uint32)
        code = (b[:-2] * np.uint32(257) + b[1:-1]) * np.uint32(257) + b[2:]
        bucket = ((code * np.uint32(2654435761)) >> np.uint32(8)).astype(np.int64) % (dims - 16)
        inside = doc[2:] == doc[:-2]
        out += np.log1p(np.bincount((doc[2:] * dims + bucket)[inside], minlength=n * dims).reshape(n, dims)).astype(np.float32)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        out /= np.where(norm > 0, norm, 1)
    for i in range(n):
        h = words.hash[words.of(i)]
        if len(h):
            distinct = len(np.unique(h)) / len(h)
            again = float((h[1:] == h[:-1]).mean()) if len(h) > 1 else 0.0
            size = np.log2(len(h) + 1)
            out[i, dims - 16 + min(int(distinct * 8), 7)] = 0.3
            out[i, dims - 8 + min(int(again * 4), 3)] = 0.3
            out[i, dims - 4] = 0.02 * size
    return out


def feature_blocks(column: pa.Array, dims: int) -> Iterator[np.ndarray]:
    from shipwise.llm.words import blocks, find_words, string_buffers
    data, offsets = string_buffers(column)
    for rows in blocks(offsets):
        for at in range(rows.start, rows.stop, 64):
            part = range(at, min(at + 64, rows.stop))
            lo, hi = offsets[part.start], offsets[part.stop]
            yield features(find_words(data, offsets, part, NONSPACE), np.diff(offsets[part.start:part.stop + 1]), data[lo:hi], dims)


@dataclass
class QualityModel:
    params: QualityParams
    grades: list[int]
    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each grade but the least."""
        z = (x @ self.weights)[:, None] - self.cuts[None, :]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, k: int, p: QualityParams) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds (first one, then positive steps) by Adam on the mean log-likelihood."""
    share = np.array([(y >= j).mean() for j in range(1, k)]).clip(1e-3, 1 - 1e-3)
    start = -np.log(share / (1 - share))
    free = np.concatenate([np.zeros(x.shape[1]), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    d, m, v = x.shape[1], np.zeros(len(free)), np.zeros(len(free))
    rows = np.arange(len(y))
    for t in range(1, p.steps + 1):
        w, cuts = free[:d].astype(np.float32), np.cumsum(np.concatenate([free[d:d + 1], np.exp(free[d + 1:])]))
        s = 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - cuts, -30, 30)))
        tail = np.concatenate([np.ones((len(y), 1)), s, np.zeros((len(y), 1))], axis=1)
        slope = np.concatenate([np.zeros((len(y), 1)), s * (1 - s), np.zeros((len(y), 1))], axis=1)
        prob = np.maximum(tail[rows, y] - tail[rows, y + 1], 1e-9)
        up, down = slope[rows, y] / prob, slope[rows, y + 1] / prob  # d log P / dz by either threshold
        gw = -(x.T @ (up - down).astype(np.float32)) / len(y) + p.ridge * free[:d]
        gc = np.array([(up * (y == j) - down * (y + 1 == j)).mean() for j in range(1, k)])
        after = np.cumsum(gc[::-1])[::-1]
        g = np.concatenate([gw, after[:1], after[1:] * np.exp(free[d + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        free = free - 0.15 / np.sqrt(t / 30 + 1) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return free[:d].astype(np.float32), np.cumsum(np.concatenate([free[d:d + 1], np.exp(free[d + 1:])]))


def _features(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in feature_blocks(batch.column("text"), dims):
                label = batch.column("label").slice(at, len(x))
                at += len(x)
                cols = [np.flatnonzero(r) for r in x]
                yield pa.RecordBatch.from_arrays(
                    [label, pa.array(cols, pa.list_(pa.int32())), pa.array([r[c] for r, c in zip(x, cols, strict=True)], pa.list_(pa.float32()))],
                    names=["label", "cols", "vals"])
    return run


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", rating_id: str = "id",
        rating_col: str = "grade", params: QualityParams = QualityParams()) -> QualityModel:
    p = params
    rated = pick(ratings, id=rating_id, label=rating_col).withColumn("label", F.col("label").cast("int"))
    rows = labelled_sample(docs, rated, p.sample, id_col, text_col).mapInArrow(
        _features(p.dims), "label int, cols array<int>, vals array<float>").toArrow()
    label = rows.column("label").to_numpy() if rows.num_rows else np.zeros(0, int)
    found = sorted(set(label.tolist()))
    if len(found) < 2:
        return QualityModel(p, found or [0], np.zeros(p.dims, np.float32), np.zeros(0))
    x = np.zeros((rows.num_rows, p.dims), dtype=np.float32)
    i = 0
    for batch in rows.to_batches():
        for cols, vals in zip(batch.column("cols"), batch.column("vals"), strict=True):
            x[i, cols.values.to_numpy()] = vals.values.to_numpy()
            i += 1
    w, cuts = train(x, np.searchsorted(found, label), len(found), p)
    return QualityModel(p, found, w, cuts)


def _score(model, at_least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        steps = np.diff(m.grades)
        k = int(np.searchsorted(m.grades, at_least))
        for batch in batches:
            expected, tail = [], []
            for x in feature_blocks(batch.column("text"), m.params.dims):
                t = m.tails(x)
                expected.append(m.grades[0] + t @ steps)
                whole = np.concatenate([np.ones((len(x), 1)), t, np.zeros((len(x), 1))], axis=1)
                tail.append(whole[:, min(k, len(m.grades))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(np.concatenate(c) if c else np.zeros(0)).cast(pa.float64()) for c in (expected, tail))],
                names=["id", "expected_grade", "tail_probability"])
    return run


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", at_least: int = 1) -> DataFrame:
    """id, expected_grade, tail_probability = P(grade >= ``at_least``) for every row."""
    rows = pick(docs, id=id_col, text=text_col)
    return rows.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model), at_least),
                           f"id {rows.schema['id'].dataType.simpleString()}, expected_grade double, tail_probability double")
