"""Toxicity by non-negative positive-unlabelled learning.

A logistic model over the presence of words and word beginnings is fitted with
numpy from confirmed toxic texts and unlabelled ones.  The risk of the unseen
negatives is that of the unlabelled texts less the class prior's share of the
positives; where that estimate falls below zero the step goes against it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Codes, at_hand, fold, slices, stored, texts_of, with_text, words, worker_cache

#: Bounds of the sample that the model is fitted on, and features that it keeps.
SAMPLE_POSITIVE = 4_000
SAMPLE_UNLABELLED = 10_000
FEATURES = 1_024
_BITS = 20
_BEGINNINGS = (4, 5, 6)


def features_of(word: bytes) -> list[int]:
    """Hashed features of a word: itself and its beginnings."""
    text = word.decode("utf-8", "replace").lower()
    parts = [f"={text}", *(text[:k] for k in _BEGINNINGS if len(text) >= k)]
    return [zlib.crc32(p.encode()) & ((1 << _BITS) - 1) for p in parts]


@dataclass(frozen=True)
class Model:
    weights: dict[int, float]
    bias: float

    def of_word(self, word: bytes) -> list[int]:
        return [f for f in features_of(word) if f in self.weights]


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_cache("toxicity sample", None, dict)
    cache: dict[bytes, list[int]] = {}
    for batch in batches:
        for piece in slices(batch, size=1 << 20):
            if len(cache) > 50_000:
                cache.clear()
            found = []
            for text in texts_of(piece):
                held: set[int] = set()
                for w in set(words(text)):
                    f = cache.get(w)
                    if f is None:
                        f = cache[w] = features_of(w)
                    held.update(f)
                found.append(sorted(held))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(2), pa.array(found, pa.list_(pa.int32()))],
                names=["positive", "doc_id", "features"],
            )


def _slope(z: np.ndarray) -> np.ndarray:
    """Slope of log(1 + exp(-z))."""
    return -1.0 / (1.0 + np.exp(np.clip(z, -60, 60)))


def _loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, -z)


def fit_nnpu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 80, rate: float = 0.05
) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic model with the least non-negative risk (Adam)."""
    x = np.concatenate([positive, unlabelled]).astype(np.float32)
    n_p, n_u = len(positive), len(unlabelled)
    w, b = np.zeros(x.shape[1]), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        z = x @ w + b
        zp, zu = z[:n_p], z[n_p:]
        # Risk of the negatives, and its slope; below zero the step goes against it.
        negative = _loss(-zu).mean() - prior * _loss(-zp).mean()
        slope = np.r_[prior * _slope(-zp) / n_p, -_slope(-zu) / n_u]
        if negative >= 0:
            slope[:n_p] += prior * _slope(zp) / n_p
        else:
            slope = -slope
        g = np.r_[x.T @ slope + 1e-5 * w, slope.sum()]
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w -= move[:-1]
        b -= move[-1]
    return w, float(b)


def _chosen_features(sample: DataFrame, n_p: int, n_u: int) -> list[int]:
    """Features that mark positive texts most, and some that mark unlabelled ones, by the difference of their shares."""
    holds = sample.select("positive", F.explode("features").alias("feature"))
    counts = holds.groupBy("feature").agg(
        F.count_if("positive").alias("c_p"), F.count_if(~F.col("positive")).alias("c_u")
    )
    p, u = F.col("c_p") / n_p, F.col("c_u") / n_u
    both = (F.col("c_p") + F.col("c_u")) / (n_p + n_u)
    spread = F.sqrt(F.greatest(both * (1 - both), F.lit(1e-9)) * (1 / n_p + 1 / n_u))
    rated = counts.select("feature", ((p - u) / spread).alias("z"))
    # As many rows as the model has features.
    more = rated.where("z > 2").orderBy(F.desc("z"), "feature").limit(FEATURES // 2)
    less = rated.orderBy("z", "feature").limit(FEATURES // 8)
    return [r.feature for r in more.union(less).select("feature").distinct().orderBy("feature").collect()]


def learn(documents: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    """Fit on a bounded sample of the documents: at most ``SAMPLE_POSITIVE`` confirmed toxic ones and
    ``SAMPLE_UNLABELLED`` of all, those with the least hash of their ids.  Of several rows of an id the one with
    the least text is in the sample.

    The features of the sample are counted and chosen by Spark; the driver gets those of each text that the
    model has, at most ``FEATURES``, whatever the length of the texts.

    ``prior``: share of toxic texts; by default that of the labelled ones.
    """
    at_hand(documents.sparkSession)
    rows = documents.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    ids = rows.select("doc_id").distinct()
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    marked = ids.join(marks, "doc_id")
    if prior is None:
        row = marked.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("p")).first()
        prior = row["p"] or 0.0
    order = F.xxhash64("doc_id")
    positives = marked.where("toxic = 1").select("doc_id", F.lit(True).alias("positive"))
    unlabelled = ids.select("doc_id", F.lit(False).alias("positive"))
    chosen = (
        positives.orderBy(order, "doc_id")
        .limit(SAMPLE_POSITIVE)
        .unionAll(unlabelled.orderBy(order, "doc_id").limit(SAMPLE_UNLABELLED))
    )
    sample = stored(
        # At most SAMPLE_POSITIVE + SAMPLE_UNLABELLED ids.
        rows.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "positive")
        .agg(F.min("text").alias("text"))
        .select("positive", "text", "doc_id")
        .mapInArrow(_featured, "positive boolean, doc_id long, features array<int>"),
        "toxicity-sample",
    )
    n_p, n_u = sample.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    if not n_p or not n_u or not 0 < prior < 1:
        return Model({}, -10.0 if prior < 1 else 10.0)
    kept = _chosen_features(sample, n_p, n_u)
    held = F.array_intersect("features", F.lit(np.array(kept, np.int32)))
    table = sample.select("positive", "doc_id", held.alias("features")).orderBy("positive", "doc_id").toArrow()
    positive = table["positive"].to_numpy(zero_copy_only=False).astype(bool)
    lists = table["features"].combine_chunks()
    lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    x = np.zeros((len(lengths), len(kept)), np.float32)
    x[np.repeat(np.arange(len(lengths)), lengths), np.searchsorted(kept, lists.flatten().to_numpy())] = 1
    w, b = fit_nnpu(x[positive], x[~positive], prior)
    return Model({int(f): float(a) for f, a in zip(kept, w, strict=True)}, b)


def _codes(model: Model) -> Codes:
    key = (model.bias, tuple(model.weights.items()))
    return worker_cache("toxicity", key, lambda: Codes(model.of_word, most=200_000))


def _scored(shared, names, column, kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        codes = _codes(model)
        weight = np.zeros(1 << _BITS)
        for f, a in model.weights.items():
            weight[f] = a
        for batch in batches:
            for piece in slices(batch, column, size=1 << 20):
                codes.trim()
                held: list[int] = []
                ends = [0]
                for text in texts_of(piece, column):
                    held += map(codes.__getitem__, words(text))
                    ends.append(len(held))
                n = piece.num_rows
                found, sizes = codes.runs(np.array(held, np.int64))
                doc = np.repeat(np.repeat(np.arange(n), np.diff(ends)), sizes)
                pairs = np.unique((doc << 32) | found)
                z = model.bias + np.bincount(pairs >> 32, weight[pairs & 0xFFFFFFFF], n)
                score = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[:kept], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    names=[*piece.schema.names[:kept], *names],
                )

    return run


def scored(
    documents: DataFrame, model: Model, keep: list[str], names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """Columns ``keep`` of the documents with score and prediction, so named; a NULL text scores as an empty one."""
    at_hand(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows, column = with_text(documents, keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)])
    return rows.mapInArrow(_scored(shared, names, column, len(keep)), f"{fields}, `{names[0]}` double, `{names[1]}` int")


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row.

    ``documents``: ``doc_id, text``; ``labels``: ``doc_id, toxic``; other
    columns are ignored.  Labels of held-out documents (a fifth, by the hash of
    the id) are not learnt from.  Without a confirmed toxic text nothing is
    toxic.  A NULL id is not held out and not learnt from; a NULL label is none;
    of several labels of an id the largest counts.
    """
    training = documents.where(fold("doc_id") != 0)
    model = learn(training, labels)
    rows = documents.select(
        F.col("doc_id").cast("long"), F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "text"
    )
    return scored(rows, model, ["doc_id", "held_out"])
