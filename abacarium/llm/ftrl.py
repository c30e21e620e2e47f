"""Sparse multinomial logistic regression by follow-the-regularised-leader.

Per-coordinate FTRL-Proximal with L1 and L2 penalties. The training rows are dealt
over shards; each shard passes over its rows from the shared state, the shards'
states are averaged, and the next round starts from there. What the driver holds
is the state, whose size is fixed by the number of features and classes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from abacarium.llm.common import by_value


@dataclass(frozen=True)
class Penalty:
    l1: float = 0.02
    l2: float = 0.05
    alpha: float = 0.5
    beta: float = 1.0


def weights(z: np.ndarray, n: np.ndarray, p: Penalty) -> np.ndarray:
    """The weights that belong to an FTRL state; exactly zero where L1 outweighs the gradients."""
    return np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _pass(rows: pd.DataFrame, z: np.ndarray, n: np.ndarray, p: Penalty) -> None:
    for idx, val, target in zip(rows["idx"], rows["val"], rows["target"], strict=True):
        x = np.asarray(val, np.float64)[:, None]
        at = np.asarray(idx, np.int64)
        w = weights(z[at], n[at], p)
        g = x * (softmax((x * w).sum(axis=0)) - np.asarray(target))[None, :]
        n1 = n[at] + g * g
        z[at] += g - (np.sqrt(n1) - np.sqrt(n[at])) / p.alpha * w
        n[at] = n1


def _learner(state: Broadcast, turn: int, p: Penalty):
    def learn(part: pd.DataFrame) -> pd.DataFrame:
        z, n = (a.copy() for a in state.value)
        _pass(part.sort_values("order").sample(frac=1.0, random_state=turn), z, n, p)
        used = np.flatnonzero((n > 0).any(axis=1))
        return pd.DataFrame({"shard": [part["shard"].iloc[0]], "used": [used.tolist()], "rows": [len(part)],
                             "z": [z[used].ravel().tolist()], "n": [n[used].ravel().tolist()]})

    return learn


def train(rows: DataFrame, features: int, classes: int, penalty: Penalty | None = None, rounds: int = 3, shards: int = 6) -> np.ndarray:
    """Weights of shape ``(features, classes)`` from ``order``, ``idx``, ``val``, ``target`` rows.

    ``idx`` and ``val`` are arrays of feature numbers and values, ``target`` an array
    with the probability of each class. ``order`` (an integer) decides the shard and
    the order within; rows must be bounded in number. No rows give zero weights.
    """
    p = penalty or Penalty()
    context = rows.sparkSession.sparkContext
    z, n = np.zeros((features, classes)), np.zeros((features, classes))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("order"), F.lit(shards)))
    for turn in range(rounds):
        state = context.broadcast((z, n))

        got = dealt.groupBy("shard").applyInPandas(
            _learner(state, turn, p), "shard bigint, used array<bigint>, rows bigint, z array<double>, n array<double>").toPandas()
        state.unpersist()
        total = max(1, int(got["rows"].sum()))
        z, n = np.zeros_like(z), np.zeros_like(n)
        for row in got.itertuples():
            at = np.asarray(row.used, np.int64)
            z[at] += np.asarray(row.z).reshape(len(at), classes) * (row.rows / total)
            n[at] += np.asarray(row.n).reshape(len(at), classes) * (row.rows / total)
    return weights(z, n, p)


def _log_loss(t: float) -> Column:
    scaled = F.transform("logits", lambda v: v / t)
    top = F.array_max(scaled)
    total = F.aggregate(F.transform(scaled, lambda v: F.exp(v - top)), F.lit(0.0), lambda a, v: a + v)
    return F.log(total) + top - F.element_at(scaled, F.col("label") + 1)


def temperature(logits: DataFrame) -> float:
    """The temperature with the least log loss over ``logits`` (array) and ``label`` (class number) rows.

    The losses of a grid of temperatures are added up by Spark; without rows it is 1.
    """
    grid = [round(0.05 * 1.12 ** i, 5) for i in range(48)]
    losses = [F.sum(_log_loss(t)) for t in grid]
    found = logits.agg(*losses).first()
    if found is None or found[0] is None:
        return 1.0
    return grid[int(np.argmin([float(v) for v in found]))]


by_value(__name__)
