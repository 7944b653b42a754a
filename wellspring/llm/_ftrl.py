"""Logistic regression with follow-the-regularised-leader updates, trained on a
bounded sample of labelled documents and scored as sparse dot products.

The sample (at most ``max_rows`` labelled rows, chosen by a hash of the id, so
reruns agree) is dealt to ``shards`` groups. Each group runs per-coordinate
FTRL-Proximal over its rows in hash order, and a coordinate's weight is the
mean of the groups that saw it. Weights are a vector of fixed size ``DIM``.
Their scale and bias are then calibrated on the sample (Platt), so a score is
the probability of label 1 and a threshold on it means what it says.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.llm._stage import store, take

BITS = 20
BATCH_BYTES = 2 << 20  # of text turned to features at once: a worker holds about 30 times that
DIM = 1 << BITS  # hashed coordinates; coordinate 0 is the bias
SHARDS = 8


def slots(hashes: np.ndarray) -> np.ndarray:
    """Hashes to coordinates 1 ... DIM - 1."""
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64) % (DIM - 1) + 1


class Ftrl:
    """w = 0 where |z| <= l1, else (sign(z) * l1 - z) / ((beta + sqrt(n)) / alpha + l2)."""

    def __init__(self, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(DIM), np.zeros(DIM)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, l1 = self.z[at], np.where(at == 0, 0.0, self.l1)  # the bias isn't pulled to zero
        w = (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        w = self.weights(at)
        p = sigmoid(np.dot(w, x))
        g = (p - label) * x
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def sample_labels(labels: DataFrame, label: str, usable: Column, max_rows: int) -> DataFrame:
    """``(doc_id, label, turn)`` of at most ``max_rows`` usable labelled rows, in hash order."""
    rows = take(labels, "doc_id", label).select("doc_id", F.col(label).cast("int").alias("label"))
    turn = F.xxhash64("doc_id")
    return (rows.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).filter(usable)
            .withColumn("turn", turn).orderBy("turn", "doc_id", "label").limit(max_rows))


def train(features: DataFrame, epochs: int, shards: int = SHARDS, **settings: float) -> np.ndarray:
    """Weights from ``features(turn, label, at array<int>, x array<float>)``. At
    most DIM weights, and a margin for each sampled row, reach the driver. Without
    rows all weights are zero."""
    features = store(features, "ftrl_features")

    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["turn", "label"], kind="stable")
        ftrl = Ftrl(**settings)
        for _ in range(epochs):
            for at, x, y in zip(part["at"], part["x"], part["label"], strict=True):
                ftrl.learn(np.append(at, 0), np.append(x, 1.0), y)  # and the bias
        seen = np.flatnonzero(ftrl.n)
        return pd.DataFrame({"at": seen, "w": ftrl.weights(seen)})

    dealt = features.withColumn("shard", F.pmod(F.hash("turn"), F.lit(shards)))
    parts = dealt.groupBy("shard").applyInPandas(one, "at long, w double")
    mean = parts.groupBy("at").agg(F.avg("w").alias("w")).filter("w <> 0").toPandas()
    weights = np.zeros(DIM, np.float32)
    weights[mean["at"].to_numpy(np.int64)] = mean["w"].to_numpy()
    sent = features.sparkSession.sparkContext.broadcast(weights)  # DIM floats

    def margins(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            m = [float(np.dot(sent.value[np.asarray(a, np.int64)], x))
                 for a, x in zip(part["at"], part["x"], strict=True)]
            yield pd.DataFrame({"margin": m, "label": part["label"]})

    seen = features.mapInPandas(margins, "margin double, label int").toPandas()
    scale, bias = calibrated(seen["margin"].to_numpy(), seen["label"].to_numpy())
    weights *= np.float32(scale)
    weights[0] = bias
    return weights


def calibrated(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Scale and bias of the logistic curve through the margins, by Newton steps
    on Platt's smoothed targets; (1, 0) without rows."""
    if not len(margin):
        return 1.0, 0.0
    ones, zeros = (label == 1).sum(), (label != 1).sum()
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    mid, spread = margin.mean(), margin.std() or 1.0
    x = np.stack([(margin - mid) / spread, np.ones(len(margin))])

    def loss(t):
        m = t @ x
        return np.sum(np.logaddexp(0, m) - target * m) + 1e-3 * t[0] ** 2

    theta = np.array([0.0, np.log((ones + 1) / (zeros + 1))])
    for _ in range(100):
        p = sigmoid(theta @ x)
        slope = x @ (p - target) + np.array([2e-3 * theta[0], 0.0])
        bend = (x * (p * (1 - p))) @ x.T + np.diag([2e-3, 1e-9])
        move, now, size = np.linalg.solve(bend, slope), loss(theta), 1.0
        while size > 1e-6 and loss(theta - size * move) > now:
            size /= 2
        theta = theta - size * move
        if np.abs(size * move).max() < 1e-8:
            break
    scale = max(theta[0], 0.0) / spread
    return float(scale), float(theta[1] - scale * mid)


def labelled(docs: DataFrame, sample: DataFrame, max_rows: int) -> DataFrame:
    """``(text binary, turn, label)`` of the documents that the sample's labels belong to, ``max_rows`` at most.

    The sample's size is bounded, so it is broadcast. A sampled id that many rows share could still bring all
    of these in: rows that agree in id, text and label are one, and of the others the first ``max_rows`` by id's hash and
    text's hash stay. Hashes alone are sorted for that (``max_rows`` of them a task); the texts that stay move once.
    """
    joined = docs.join(F.broadcast(sample), "doc_id").withColumn("digest", F.xxhash64("text"))
    keys = joined.select("turn", "digest", "label").distinct().orderBy("turn", "digest", "label").limit(max_rows)
    last = keys.agg(F.max(F.struct("turn", "digest", "label")).alias("m")).first()["m"]
    if last is None:
        return joined.select(F.col("text").cast("binary").alias("text"), "turn", "label").limit(0)
    top = F.struct(F.lit(last["turn"]).alias("turn"), F.lit(last["digest"]).alias("digest"),
                   F.lit(last["label"]).alias("label"))
    within = joined.filter(F.struct("turn", "digest", "label") <= top)
    # one row of those that agree: a task's first ones are found before the shuffle
    one = within.groupBy("turn", "digest", "label").agg(F.first("text").alias("text"))
    return one.select(F.col("text").cast("binary").alias("text"), "turn", "label")


def held_out(modulus: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod ``modulus`` = ``remainder``; false for a null id."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))
