"""Toxicity by a character n-gram linear classifier with naive Bayes features.

A text is the counts of its hashed character n-grams, on a log scale. Every feature is scaled
by its naive Bayes log-count ratio, learnt from document counts of the two classes and shrunk
towards zero by its standard error, so that what few documents show counts little, but counts.
Scaled texts have length one, and a logistic regression over them gives the score.

The classifier learns from at most ``SAMPLE`` labelled documents of each class, chosen by a
hash of the id among those that have a document; where a class has more, the bias is corrected
for the shares of the classes. It keeps the ``KEPT`` features with the strongest evidence, and
learns from the ``STRONGEST`` of them in a document.
Scoring reads every text whole.

Defined results: null and empty texts score like a text without known features; labels that
are null or have no document are not used, of repeated labels of a document the highest and of
repeated documents of an id the greatest text counts; where only one class is labelled
everything scores 0 or 1 as that class does, and 0 without any label; a score of 0.5 counts as
toxic; repeated rows and equal texts score alike; an empty table gives an empty result; only
the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake.llm.common import held_out, query, settle, table

ORDERS = (3, 4, 5)
BIN_BITS = 20
BINS = 1 << BIN_BITS
# Most labelled documents of a class that the classifier learns from, and most features it has.
SAMPLE = 6_000
KEPT = 16_384
# Most features of one document that the regression gets, the strongest; with the bounds above
# the driver holds 150 MB at most.
STRONGEST = 2_048
# Code points hashed at once; longer texts are hashed in overlapping pieces.
PIECE = 1 << 20
SMOOTHING = 0.5
# A ratio of so many standard errors is halved.
DOUBT = 3.0
RIDGE = 1e-5
# Features that one step of the regression adds up at a time.
BLOCK = 500_000


def hashed(text: str) -> Iterator[np.ndarray]:
    """Bins of all n-grams of a lower-cased text with a space at either end, with repeats."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    overlap = max(ORDERS) - 1
    for start in range(0, max(1, len(points) - overlap), PIECE):
        part = points[start:start + PIECE + overlap]
        value = part
        for n in range(2, max(ORDERS) + 1):
            if len(value) < 2:
                break
            value = value[:-1] * np.uint64(0x100000001B3) + part[n - 1:]
            if n in ORDERS:
                mixed = (value ^ (value >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
                yield mixed >> np.uint64(64 - BIN_BITS)


def counts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bins of a text and how often each occurs."""
    parts = list(hashed(text))
    if not parts:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    bins, counts = np.unique(np.concatenate(parts), return_counts=True)
    return bins.astype(np.int32), counts.astype(np.int32)


@dataclass
class Classifier:
    """Ratio and coefficient of each bin, and the bias."""
    ratios: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        total = self.bias
        if text and self.ratios.any():
            found = [bins[self.ratios[bins] != 0] for bins in hashed(text)]
            bins, counts = np.unique(np.concatenate(found), return_counts=True) if found else ([], [])
            if len(bins):
                value = self.ratios[bins] * np.log1p(counts)
                total += float(value @ self.weights[bins] / np.sqrt(value @ value))
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def constant(share: float) -> Classifier:
    """Everything scores as the only class."""
    return Classifier(np.zeros(BINS), np.zeros(BINS), 500.0 if share else -500.0)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """Ids that have a label and a document, stored with their label (0 or 1)."""
    there = docs.select(F.col(id_col).alias("id")).filter(F.col("id").isNotNull())
    known = (labels.filter(F.col(label).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.max((F.col(label) > 0).cast("int")).alias("label")))
    return settle(known.join(there, "id", "left_semi"), "labelled")


def features(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Label, bins and counts of at most ``size`` documents of each class."""
    def collect(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [counts_of(t) for t in frame["text"]]
            yield pd.DataFrame({"label": frame["label"], "bins": [b for b, _ in found],
                                "counts": [n for _, n in found]})

    parts = [known.filter(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(size)
             for c in (0, 1)]
    sample = settle(parts[0].union(parts[1]), "sample")
    # The sample has a fixed bound, so the hint is safe.
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(sample), "id")
    once = chosen.groupBy("id").agg(F.first("label").alias("label"),
                                    F.coalesce(F.max("text"), F.lit("")).alias("text"))
    return once.select("label", "text").mapInPandas(
        collect, "label int, bins array<int>, counts array<int>")


def class_counts(found: DataFrame) -> DataFrame:
    """Documents of either class per bin, added up within each task first."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((2, BINS), np.int32)
        for frame in frames:
            for label, bins in zip(frame["label"], frame["bins"]):
                totals[label, bins] += 1
        used = np.flatnonzero(totals.any(axis=0))
        yield pd.DataFrame({"bin": used, "clean": totals[0, used], "toxic": totals[1, used]})

    return (found.mapInPandas(count, "bin long, clean long, toxic long").groupBy("bin")
            .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))


def ratios(counts: DataFrame, clean: int, toxic: int, kept: int = KEPT) -> np.ndarray:
    """Log-count ratios by bin, shrunk by their standard errors; zero beyond the ``kept`` best.

    Evidence is the shrunk ratio times the root of the number of documents.
    """
    p, q = F.col("toxic") + F.lit(SMOOTHING), F.col("clean") + F.lit(SMOOTHING)
    ratio = (F.log(p / F.lit(toxic + 2 * SMOOTHING)) - F.log(q / F.lit(clean + 2 * SMOOTHING)))
    doubt = F.lit(DOUBT ** 2) * (F.lit(1.0) / p + F.lit(1.0) / q)
    shrunk = counts.withColumn("ratio", ratio).select(
        "bin", "clean", "toxic",
        (F.col("ratio") * F.col("ratio") ** 2 / (F.col("ratio") ** 2 + doubt)).alias("ratio"))
    evidence = F.abs("ratio") * F.sqrt(F.col("clean") + F.col("toxic"))
    best = shrunk.orderBy(evidence.desc(), "bin").limit(kept).toPandas()
    out = np.zeros(BINS)
    out[best["bin"].to_numpy()] = best["ratio"].to_numpy()
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label: str = "toxic", size: int = SAMPLE, kept: int = KEPT) -> Classifier:
    known = labelled(docs, labels, id_col, label)
    there = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    clean, toxic = there.get(0, 0), there.get(1, 0)
    if not clean or not toxic:
        return constant(float(toxic > 0))
    found = settle(features(docs, known, id_col, text_col, size), "toxic-features")
    some = {0: min(clean, size), 1: min(toxic, size)}
    scale = ratios(class_counts(found), some[0], some[1], kept)
    shared = docs.sparkSession.sparkContext.broadcast(scale)

    def strongest(bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        strength = np.abs(shared.value[bins] * np.log1p(counts))
        known = np.flatnonzero(strength)
        if len(known) > STRONGEST:
            known = np.sort(known[np.argsort(-strength[known], kind="stable")[:STRONGEST]])
        return known

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            use = [strongest(b, n) for b, n in zip(frame["bins"], frame["counts"])]
            yield pd.DataFrame({
                "label": frame["label"],
                "bins": [b[u].astype(np.int32).tobytes() for b, u in zip(frame["bins"], use)],
                "counts": [np.minimum(n[u], 65_535).astype(np.uint16).tobytes()
                           for n, u in zip(frame["counts"], use)]})

    # One row per sampled document, with the kept features only, task by task.
    bins, counts, marks = [], [], []
    for row in found.mapInPandas(cut, "label int, bins binary, counts binary").toLocalIterator():
        bins.append(np.frombuffer(row["bins"], np.int32))
        counts.append(np.frombuffer(row["counts"], np.uint16))
        marks.append(row["label"])
    weights, bias = regress(bins, counts, np.array(marks), scale)
    return Classifier(scale, weights, bias + float(np.log(toxic / clean) - np.log(some[1] / some[0])))


def regress(bins: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray,
            scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression over the scaled features of length one, by L-BFGS.

    Features of all rows lie in two narrow arrays, and sums over them go block by block.
    """
    # A fixed order of the rows, so that sums and the result do not depend on tasks.
    order = sorted(range(len(bins)), key=lambda i: (
        labels[i], len(bins[i]), bins[i].tobytes(), counts[i].tobytes()))
    labels = labels[order].astype(float)
    ends = np.cumsum([len(bins[i]) for i in order])
    used = np.flatnonzero(scale)
    place = np.zeros(len(scale), np.int32)
    place[used] = np.arange(len(used))
    index, data = np.empty(ends[-1], np.int32), np.empty(ends[-1], np.float32)
    for end, i in zip(ends, order):
        value = scale[bins[i]] * np.log1p(counts[i])
        index[end - len(value):end] = place[bins[i]]
        data[end - len(value):end] = value / max(np.sqrt(value @ value), 1e-300)
    n, k = len(order), len(used)
    cuts = np.unique([0, *np.searchsorted(ends, np.arange(BLOCK, ends[-1], BLOCK)), n])
    starts = np.append(0, ends)

    def loss(w):
        cost, slope = 0.0, np.zeros(k + 1)
        for first, after in zip(cuts, cuts[1:]):
            part = slice(starts[first], starts[after])
            owner = np.repeat(np.arange(after - first), np.diff(starts[first:after + 1]))
            at, x, y = index[part], data[part], labels[first:after]
            margin = np.bincount(owner, x * w[at], after - first) + w[k]
            error = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y
            cost += (np.logaddexp(0, margin) - y * margin).sum()
            slope[:k] += np.bincount(at, x * error[owner], k)
            slope[k] += error.sum()
        slope /= n
        slope[:k] += RIDGE * w[:k]
        return cost / n + RIDGE / 2 * (w[:k] ** 2).sum(), slope

    w = lbfgs(loss, np.zeros(k + 1))
    weights = np.zeros(len(scale))
    weights[used] = w[:k]
    return weights, float(w[k])


def lbfgs(loss, w: np.ndarray, steps: int = 80, memory: int = 8) -> np.ndarray:
    cost, slope = loss(w)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, used = -slope, []
        for s, y in reversed(pairs):
            a = (s @ direction) / (s @ y)
            direction = direction - a * y
            used.append(a)
        if pairs:
            s, y = pairs[-1]
            direction = direction * ((s @ y) / (y @ y))
        for (s, y), a in zip(pairs, reversed(used)):
            direction = direction + (a - (y @ direction) / (s @ y)) * s
        step, descent = 1.0, slope @ direction
        while True:
            new = w + step * direction
            new_cost, new_slope = loss(new)
            if new_cost <= cost + 1e-4 * step * descent or step < 1e-10:
                break
            step /= 2
        s, y = new - w, new_slope - slope
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        done = cost - new_cost < 1e-9 * max(1.0, abs(cost))
        w, cost, slope = new, new_cost, new_slope
        if done:
            break
    return w


def scorer(spark: SparkSession, classifier: Classifier):
    """Column function from text to score."""
    shared = spark.sparkContext.broadcast(classifier)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series([model.score(t) for t in texts], dtype=float)

    def of(text: Column) -> Column:
        return score(text)
    return of


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Classifier of the production parameters: labels of held-out documents stay unseen."""
    return fit(docs, labels.filter(~held_out("doc_id")))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    score = scorer(spark, train(docs, table(spark, folder, "labels")))
    return docs.select("doc_id", held_out("doc_id").alias("held_out"),
                       score(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
