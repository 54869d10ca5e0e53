"""Follow-the-regularised-leader (proximal) for sparse logistic and softmax regression.

Training is data-parallel: the bounded sample of labelled rows is dealt to shards by a
hash of the row, every shard runs FTRL over its rows, and the shards' weights are
averaged by Spark. What reaches the driver is the model (at most dim x classes numbers).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Features = Callable[[str], tuple[np.ndarray, np.ndarray]]


class Ftrl:
    """Per-coordinate FTRL state; ``classes`` is 1 for logistic regression."""

    def __init__(self, dim: int, classes: int = 1, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.01,
                 l2: float = 0.01):
        self.z = np.zeros((dim, classes))
        self.n = np.zeros((dim, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        """One example: distinct coordinates ``at``, their values, target per class."""
        w = self.weights(at)
        g = x[:, None] * (probabilities(x @ w) - y)[None, :]
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def probabilities(logits: np.ndarray) -> np.ndarray:
    """Sigmoid for one class, softmax for several (last axis)."""
    if logits.shape[-1] == 1:
        return 1.0 / (1.0 + np.exp(-np.clip(logits, -35, 35)))
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str,
                    bound: int) -> tuple[DataFrame, int]:
    """About ``bound`` labelled documents (all, if fewer): rank, text, y; and how many labels that is.

    Ids whose label rows disagree, or are not 0/1, are left out. Which ids are in depends only on
    a hash of the id (of any type). The ids are at most about ``bound``, which bounds what is broadcast. ``rank``, a
    hash of id and text, is the order in which rows are learned from.
    """
    known = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.min(label).alias("y"), F.max(label).alias("y_")).where("y = y_").select("id", "y"))
    n = known.count()
    if n > bound:
        known = known.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) < int(bound / n * (1 << 30)))
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return text.join(F.broadcast(known), "id").select(
        F.xxhash64("id", "text").alias("rank"), "text", F.col("y").cast("int").alias("y")), min(n, bound)


#: rows of the sample that one shard trains on (about)
SHARD_ROWS = 4_000


def train(sample: DataFrame, features: Features, dim: int, rows: int, classes: int = 1, epochs: int = 3,
          **settings) -> np.ndarray:
    """Averaged weights (dim x classes) of FTRL over the shards of ``sample`` (rank, text, y), about ``rows`` rows."""
    shards = -(-max(rows, 1) // SHARD_ROWS)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = []
        for b in batches:
            for i, t, y in zip(b["rank"], b["text"], b["y"]):
                at, x = features(t)
                own.append((i, len(at), int(y), at.astype(np.int32), x.astype(np.float32)))
        if not own:
            return
        own.sort(key=lambda r: r[:3])  # the same order on every run, ids mixed
        model = Ftrl(dim, classes, **settings)
        for _ in range(epochs):
            for _, _, y, at, x in own:
                model.update(at, x.astype(float), np.array([y]) if classes == 1 else np.arange(classes) == y)
        w = model.weights()
        at, k = np.nonzero(w)
        # a shard always answers, so that the average counts it
        yield pd.DataFrame({"at": np.append(at, -1), "k": np.append(k, 0), "w": np.append(w[at, k], 1.0)})

    dealt = sample.repartition(shards, F.pmod("rank", F.lit(shards)))
    parts = dealt.mapInPandas(fit, "at long, k int, w double").groupBy("at", "k").agg(F.sum("w").alias("w")).toPandas()
    weights = np.zeros((dim, classes))
    counted = parts["at"].to_numpy() < 0
    n = float(parts["w"].to_numpy()[counted].sum()) or 1.0
    rest = parts[~counted]
    weights[rest["at"].to_numpy(), rest["k"].to_numpy()] = rest["w"].to_numpy() / n
    return weights
