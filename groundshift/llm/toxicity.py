"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is lower-cased and runs of characters that are no letters become one blank; its features are the places, in a fixed table, of the hashes of all its windows of
three to six characters, each once. A feature's log-count ratio compares the labelled texts of either class that hold it, smoothed so
that a feature that was never seen has a ratio of zero. A logistic regression with an L2 penalty, classes at equal weight, is fitted over the ratios of the features
that a text holds. As it knows its own texts too well, its slope and bias are then set on one in FOLDS of the sample that it was not fitted on, each row
weighted by how many of its class it stands for: a score is a share of toxic texts.

The classifier is fitted on a bounded sample of labelled rows (SAMPLE rows of each class, by a hash of doc_id; all rows of a class that has fewer).
The sample's features are a written table; each step of the fit is a pass over it whose gradients are added up. Scoring reads every whole text once.

Definite results: null and empty texts and texts without letters hold no features and get the classifier's bias; very long texts are read whole; of
several labels of a document the most frequent counts, 1 if there are as many of both; null labels teach nothing; of several texts of one labelled doc_id the least is learned from;
with no labels at all every score is 0.5, with labels of one class only it is the smoothed share of that class; a null doc_id is not held out and not learned from; repeated rows give
repeated rows; an empty table gives an empty result; lang, source and doc_id are no inputs of a score; other columns play no part, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.llm.shared import small_batches, written

#: Table of features, lengths of windows, rows of each class to learn from (a documented bound on the sample), partitions of the sample, tasks of a step of the fit.
TABLE_BITS, LENGTHS, SAMPLE, SAMPLE_PARTS, STEP_PARTS = 19, (3, 4, 5, 6), 10_000, 12, 6
#: Smoothing of counts, texts that must hold a feature, penalty, steps of the fit and how many it remembers, one in so many rows sets slope and bias.
SMOOTH, LEAST_TEXTS, PENALTY, STEPS, MEMORY, FOLDS = 1.0, 5, 1.0, 15, 5, 5
#: Characters of a text whose windows are hashed at once.
PIECE = 1 << 18
_TABLE = 1 << TABLE_BITS
_APART = re.compile(r"[\W\d_]+")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Features:
    """The table places that a text's windows reach; a scratch table is kept between texts."""

    def __init__(self) -> None:
        self.held = np.zeros(_TABLE, bool)

    def __call__(self, text: str | None) -> np.ndarray:
        t = _APART.sub(" ", (text or "").lower()).strip()
        if not t:
            return np.zeros(0, np.int64)
        c = np.frombuffer(f" {t} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        for i in range(0, len(c), PIECE):
            p = c[i : i + PIECE + max(LENGTHS) - 1]
            h = np.zeros(len(p), np.uint32)
            for n in range(1, max(LENGTHS) + 1):
                if len(p) < n:
                    break
                h = h[: len(p) - n + 1] * np.uint32(0x01000193) + p[n - 1 :] * np.uint32(0x9E3779B1)
                if n in LENGTHS:
                    self.held[(h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - TABLE_BITS)] = True
        at = np.flatnonzero(self.held)
        self.held[at] = False
        return at


class Model:
    """Weights of the features and a bias; the weights already hold the log-count ratios."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[features].sum(dtype=np.float64), -500, 500))))


def examples(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, toxic, weight, fold, text of the labelled rows to learn from: about sample rows of each class, chosen by a hash of doc_id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.avg(F.col("toxic").cast("int")) >= 0.5).cast("int").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {c: min(1.0, sample / n) for c, n in totals.items()}
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    by_class = lambda v: F.when(F.col("toxic") == 1, F.lit(v.get(1, 0.0))).otherwise(F.lit(v.get(0, 0.0)))
    chosen = known.where(place < by_class(share)).withColumn("weight", by_class({c: 1 / s for c, s in share.items()}))
    chosen = chosen.withColumn("fold", F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fold")), F.lit(FOLDS)).cast("int"))
    # no more than about two samples of ids and numbers
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "weight", "fold").agg(F.min("text").alias("text"))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in batches:
        own = [features(t).astype(np.int32) for t in batch.column("text").to_pylist()]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(own) if own else np.zeros(0, np.int32)))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("toxic", "weight", "fold")), lists], ["toxic", "weight", "fold", "features"])


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each row, its features one after another, and the row of each."""
    lists = batch.column("features")
    n = lists.value_lengths().to_numpy(zero_copy_only=False)
    return batch.column("toxic").to_numpy(), lists.flatten().to_numpy(), np.repeat(np.arange(len(n)), n)


def counted(table: DataFrame) -> np.ndarray:
    """Texts of each class (row) that hold each feature (column)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, _TABLE), np.int64)
        for batch in batches:
            y, flat, row = _rows(batch)
            n += np.bincount(y[row] * _TABLE + flat, minlength=2 * _TABLE).reshape(2, _TABLE)
        at = np.flatnonzero(n.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[0, at]), pa.array(n[1, at])], ["feature", "n0", "n1"])

    got = table.mapInArrow(task, "feature int, n0 bigint, n1 bigint").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    out = np.zeros((2, _TABLE))
    for k, c in enumerate(("n0", "n1")):
        out[k, got.column("feature").to_numpy()] = got.column(c).to_numpy()
    return out


def ratios(counts: np.ndarray) -> np.ndarray:
    """Log-count ratios; zero for features that too few texts hold."""
    share = counts.sum(1, keepdims=True) / counts.sum()
    smooth = np.log(counts + 2 * SMOOTH * share) - np.log(share)
    return np.where(counts.sum(0) >= LEAST_TEXTS, smooth[1] - smooth[0], 0.0)


def _gradient(table: DataFrame, held: np.ndarray, model: np.ndarray, by_class: tuple[float, float]) -> tuple[float, np.ndarray]:
    """Loss over the rows of a model (a weight for each place that is held, and the bias), and its gradient. held: the table's places with a weight, as bits. by_class: what a row of class 1 and of
    class 0 counts. Places without a weight stay away from the tasks and from what they send."""
    weights, bias = model[:-1].astype(np.float32), float(model[-1])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(held, count=_TABLE)
        place = np.where(bits, np.cumsum(bits, dtype=np.int32), 0)  # 0 has no weight
        own = np.append(np.float32(0), weights)
        loss, grad, first = 0.0, np.zeros(len(own)), 0.0
        for batch in batches:
            y, flat, row = _rows(batch)
            at = place[flat]
            weight = np.where(y == 1, *by_class)
            z = bias + np.bincount(row, own[at], len(y))
            loss += float((weight * (np.logaddexp(0, z) - y * z)).sum())
            slope = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
            grad += np.bincount(at, slope[row], len(own))
            first += slope.sum()
        grad = np.append(grad[1:], first)
        yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([grad.astype(np.float32).tobytes()], pa.binary())], ["loss", "grad"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = sorted((r["loss"], r["grad"]) for batch in batches for r in batch.to_pylist())
        grad = sum((np.frombuffer(g, np.float32).astype(float) for _, g in parts), np.zeros(len(weights) + 1))
        yield pa.RecordBatch.from_arrays([pa.array([sum(x for x, _ in parts)], pa.float64()), pa.array([grad.astype(np.float32).tobytes()], pa.binary())], ["loss", "grad"])

    # one vector of fixed length from each of STEP_PARTS tasks meet in a task; the driver gets their sum
    whole = table.coalesce(STEP_PARTS).mapInArrow(task, "loss double, grad binary").repartition(1).mapInArrow(added, "loss double, grad binary").first()
    return whole["loss"], np.frombuffer(whole["grad"], np.float32).astype(float)


def minimised(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = STEPS, memory: int = MEMORY) -> np.ndarray:
    """A minimum of a convex f (value and gradient) by limited-memory quasi-Newton steps with halving."""
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, used = grad.copy(), []
        for s, y in reversed(past):
            a = (s @ way) / (s @ y)
            way -= a * y
            used.append(a)
        if past:
            s, y = past[-1]
            way *= (s @ y) / (y @ y)
        else:
            way /= max(1.0, np.abs(grad).sum())
        for (s, y), a in zip(past, reversed(used), strict=True):
            way += (a - (y @ way) / (s @ y)) * s
        size, slope = 1.0, grad @ way
        for _ in range(8):
            new_value, new_grad = f(x - size * way)
            if new_value <= value - 1e-4 * size * slope:
                break
            size /= 4
        else:
            return x
        s, y = -size * way, new_grad - grad
        if s @ y > 1e-12:
            past = [*past[1 - memory :], (s, y)]
        done = value - new_value < 1e-5 * abs(value)
        x, value, grad = x + s, new_value, new_grad
        if done:
            break
    return x


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """From the labelled rows that are not held out. The driver holds the table's weights, and a gradient of each task of the sample."""
    small_batches(docs.sparkSession)
    table = written(examples(docs, labels, sample).repartition(SAMPLE_PARTS, "doc_id").mapInArrow(_featured, "toxic int, weight double, fold int, features array<int>")).coalesce(SAMPLE_PARTS)
    fitted, rest = table.where("fold > 0"), table.where("fold = 0")
    rows = {r["toxic"]: r for r in table.groupBy("toxic").agg(F.sum("weight").alias("w"), F.sum((F.col("fold") > 0).cast("int")).alias("fitted")).collect()}
    if len(rows) < 2 or not all(r["fitted"] for r in rows.values()):
        n = {c: r["w"] for c, r in rows.items()}
        return Model(np.zeros(_TABLE), np.log((n.get(1, 0.0) + 1) / (n.get(0, 0.0) + 1)))
    ratio = ratios(counted(fitted))
    by_class = tuple(sum(r["fitted"] for r in rows.values()) / (2 * rows[c]["fitted"]) for c in (1, 0))

    at = np.flatnonzero(ratio)  # a place without a ratio has no gradient; its weight stays zero
    held, scale = np.packbits(ratio != 0), np.append(ratio[at], 1.0)

    def f(point: np.ndarray) -> tuple[float, np.ndarray]:
        loss, grad = _gradient(fitted, held, point * scale, by_class)
        grad *= scale
        grad[:-1] += PENALTY * point[:-1]
        return loss + PENALTY / 2 * float(point[:-1] @ point[:-1]), grad

    point = minimised(f, np.zeros(len(scale)))
    weights = np.zeros(_TABLE)
    weights[at] = point[:-1] * ratio[at]
    return calibrated(rest, Model(weights, point[-1]))


def calibrated(table: DataFrame, model: Model) -> Model:
    """model with slope and bias of the least weighted loss over the table; a penalty holds them near one and zero where rows are few."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, flat, row = _rows(batch)
            z = model.bias + np.bincount(row, model.weights[flat], batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("weight"), pa.array(z, pa.float64())], ["toxic", "weight", "z"])

    got = table.mapInArrow(task, "toxic int, weight double, z double").toPandas()  # a number for each of about 2 * SAMPLE / FOLDS rows
    y, w, z = (got[c].to_numpy(float) for c in ("toxic", "weight", "z"))

    def f(point: np.ndarray) -> tuple[float, np.ndarray]:
        t = point[0] * z + point[1]
        slope = w * (1 / (1 + np.exp(-np.clip(t, -500, 500))) - y)
        off = point - np.array([1.0, 0.0])
        return float((w * (np.logaddexp(0, t) - y * t)).sum() + off @ off / 2), np.array([slope @ z, slope.sum()]) + off

    slope, bias = minimised(f, np.array([1.0, 0.0]), 100)
    return Model(model.weights * slope, model.bias * slope + bias)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            score = np.array([model.score(features(t.as_py())) for t in batch.column(2)], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    small_batches(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(task, "doc_id bigint, held_out boolean, score double, predicted int")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, learn(docs, labels))
