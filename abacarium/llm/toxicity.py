"""Toxicity by weak supervision.

1. Voters: words and dense word beginnings that training rows mark as toxic, found
   by their counts per class; the share of such words in the text, at several
   levels; a few fixed patterns. A voter fires or not.
2. Label model: every voter has a rate of firing in toxic and in clean texts, fitted
   by expectation maximisation on votes alone (labels only give the start), and a
   correlation with every other voter, measured on what the class leaves
   unexplained. A voter among correlated ones counts for less.
3. A linear classifier (FTRL) is trained on the posterior labels of the model and
   scores every whole text.

Words are counted over all labelled rows, in the one pass over their texts that also
hands out the sample. The label model and the classifier are fitted on at most about
``per_class`` rows of each class, drawn by a hash of key and text; the rate of toxic
rows comes from all labelled rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from abacarium.llm.common import among, by_value, small_batches, stored, texts
from abacarium.llm.ftrl import Penalty, train

#: Lengths of word beginnings that may be voters.
STEMS = (3, 4, 5, 6, 7)
#: A word beginning fires from this share of a text's words on, and from two words on.
DENSE = 1 / 200
#: Shares of words of the whole lexicon, one voter each.
SHARES = (0.004, 0.008, 0.012, 0.016, 0.02, 0.03)
#: Different terms that a task holds before it hands on their counts.
FLUSH = 200_000
_WORD = re.compile(r"[^\W\d_]+")
#: Common English insults.
INSULTS = ("idiot", "moron", "loser", "stupid", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "dumb", "fool", "jerk")
_INSULT = "|".join(INSULTS)
PATTERNS = (
    ("two insults", re.compile(rf"(?i)\b(?:{_INSULT})s?\b.*?\b(?:{_INSULT})s?\b", re.S)),
    ("insult after you", re.compile(rf"(?i)\byou(?:'re| are)?\s+(?:an?\s+|such\s+an?\s+|all\s+)?(?:\w+\s+)?(?:{_INSULT})s?\b")),
    ("shouted insult", re.compile(rf"\b(?:{_INSULT.upper()})S?\s*!+")),
)
FIXED = len(SHARES) + len(PATTERNS)


def terms(text: str) -> tuple[int, dict[str, int], dict[str, int]]:
    """The number of words of a text, its words and, marked by a star, their beginnings with their numbers."""
    words = Counter(_WORD.findall(text.lower()))
    stems: dict[str, int] = {}
    for word, n in words.items():
        for size in STEMS:
            if len(word) >= size:
                key = word[:size] + "*"
                stems[key] = stems.get(key, 0) + n
    return words.total(), words, stems


def _fires(term: str, n: int, total: int) -> bool:
    return n >= 2 and n >= DENSE * total if term.endswith("*") else n >= 1


def votes(text: str, voters: dict[str, int]) -> list[int]:
    """The numbers of the voters that fire: terms, then shares of the lexicon, then fixed patterns."""
    words = Counter(_WORD.findall(text.lower()))
    total, known, found = words.total(), 0, {}
    for word, n in words.items():
        own = [t for t in (word, *[word[:size] + "*" for size in STEMS if len(word) >= size]) if t in voters]
        known += n * bool(own)
        for term in own:
            found[term] = found.get(term, 0) + n
    out = [voters[t] for t, n in found.items() if _fires(t, n, total)]
    out += [len(voters) + i for i, share in enumerate(SHARES) if known >= 2 and known >= share * total]
    if any(word in words for word in INSULTS):
        out += [len(voters) + len(SHARES) + i for i, (_, pattern) in enumerate(PATTERNS) if pattern.search(text)]
    return sorted(out)


def _read_labelled(labelled: DataFrame) -> DataFrame:
    """One pass over ``key``, ``text``, ``toxic``, ``pick``: counts of terms per class, and the picked rows.

    Terms count in how many rows they occur; the row without a term has the number of rows.
    A picked row that repeats in a task is handed on once.
    """
    names = ["kind", "term", "n", "toxic", "order", "text"]
    types = [pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string()]

    def batch_of(*columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def packed(clean: Counter, toxic: Counter) -> pa.RecordBatch:
        words, size = [*clean, *toxic], len(clean) + len(toxic)
        return batch_of([0] * size, words, [*clean.values(), *toxic.values()], [0] * len(clean) + [1] * len(toxic), [None] * size, [None] * size)

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean, toxic, seen = Counter(), Counter(), set()
        for batch in source:
            picked = []
            for value, label, pick, order in zip(texts(batch), *(batch.column(c).to_pylist() for c in ("toxic", "pick", "order")), strict=True):
                total, words, stems = terms(value)
                own = toxic if label else clean
                own[None] += 1
                own.update(w for w in words if len(w) <= 40)
                own.update(s for s, n in stems.items() if len(s) <= 40 and _fires(s, n, total))
                if pick and order not in seen:
                    seen.add(order)
                    picked.append((order, value, label))
                if len(clean) + len(toxic) > FLUSH:
                    yield packed(clean, toxic)
                    clean, toxic = Counter(), Counter()
            if picked:
                size = len(picked)
                yield batch_of([1] * size, [None] * size, [None] * size, [r[2] for r in picked], [r[0] for r in picked], [r[1] for r in picked])
        yield packed(clean, toxic)

    return labelled.mapInArrow(read, "kind int, term string, n bigint, toxic int, order bigint, text string")


def _mine(counted: DataFrame, most: int) -> dict[str, int]:
    """The terms that set toxic rows apart: the largest lower bounds of the log odds, seen often enough."""
    counts = counted.groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("hit"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("miss"))
    counts = stored(counts.where("hit >= 3 OR term IS NULL"), "terms")
    size = counts.where("term IS NULL").first()
    bad, good = (size["hit"], size["miss"]) if size else (0, 0)
    if not bad:
        return {}
    a, b = F.col("hit") + 0.5, F.col("miss") + 0.5
    odds = F.log(a / (bad - F.col("hit") + 0.5)) - F.log(b / (good - F.col("miss") + 0.5))
    error = F.sqrt(1 / a + 1 / b + 1 / (bad - F.col("hit") + 0.5) + 1 / (good - F.col("miss") + 0.5))
    floor = odds - 2 * error
    best = counts.where("hit >= 3 AND term IS NOT NULL").withColumn("floor", floor).where("floor > 1").withColumn(
        "worth", F.col("floor") * F.sqrt("hit")).orderBy(F.desc("worth"), "term").limit(most)
    return {row["term"]: i for i, row in enumerate(best.select("term").collect())}


class LabelModel:
    """Rates ``hit`` and ``miss`` of firing in toxic and clean rows, weights against double counting, a prior."""

    def __init__(self, fired: np.ndarray, start: np.ndarray, prior: float, rounds: int = 12):
        self.prior = min(max(prior, 1e-4), 1 - 1e-4)
        post = start.astype(float)
        for _ in range(rounds):
            self.hit, self.miss = self._rates(fired, post), self._rates(fired, 1 - post)
            self.weight = self._weights(fired, post)
            post = self.posterior(fired, float(start.mean()))

    @staticmethod
    def _rates(fired: np.ndarray, mass: np.ndarray) -> np.ndarray:
        return (mass @ fired + 0.02) / (mass.sum() + 1.0)

    def _weights(self, fired: np.ndarray, post: np.ndarray) -> np.ndarray:
        """One over the number of voters that a voter stands for, itself included."""
        expected = post[:, None] * self.hit + (1 - post)[:, None] * self.miss
        rest = fired - expected
        cov = rest.T @ rest / max(1, len(fired))
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        self.correlation = np.clip(cov / scale[:, None] / scale[None, :], -1, 1)
        return 1 / np.maximum(1.0, np.maximum(self.correlation, 0).sum(axis=1))

    def posterior(self, fired: np.ndarray, prior: float | None = None) -> np.ndarray:
        """The chance that a row is toxic given its votes."""
        prior = min(max(self.prior if prior is None else prior, 1e-4), 1 - 1e-4)
        on = np.log(self.hit / self.miss)
        off = np.log((1 - self.hit) / (1 - self.miss))
        logit = np.log(prior / (1 - prior)) + fired @ (self.weight * (on - off)) + (self.weight * off).sum()
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


class ToxicityModel:
    def __init__(self, voters: dict[str, int], weights: np.ndarray, bias: float):
        self.voters, self.weights, self.bias = voters, weights, bias

    def score(self, text: str) -> float:
        logit = self.bias + sum(self.weights[i] for i in votes(text, self.voters))
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = 5000, voters: int = 200) -> ToxicityModel:
    """A model from ``docs`` and the labels of training rows (NULL labels are ignored, of several of one key the largest counts).

    Terms are counted over all labelled rows, and so is the rate of toxic ones. The label
    model and the classifier are fitted on at most about ``per_class`` rows of each class,
    drawn by a hash of key and text, equal ones once; there are at most ``voters`` terms.
    Without a toxic training row the voters are the fixed patterns alone and every score
    stays below one half.
    """
    marks = labels.select(F.col(key).cast("long").alias("key"), F.col(label).cast("int").alias("toxic")).where("toxic IN (0, 1)")
    marks = stored(marks.groupBy("key").agg(F.max("toxic").alias("toxic")), "marks")
    rows = small_batches(docs).select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    # The same join at every size: texts of labelled ids are dealt once, and not sorted.
    labelled = among(rows, "key", marks).join(marks.hint("shuffle_hash"), "key")
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    parts = 1 << 20
    limit = F.lit(0)
    for mark, size in sizes.items():
        limit = F.when(F.col("toxic") == mark, int(parts * min(1.0, per_class / size))).otherwise(limit)
    order = F.xxhash64("key", "text", F.lit("toxicity"))
    pick = F.pmod(F.shiftright("order", 8), F.lit(parts)) < limit
    read = stored(_read_labelled(labelled.withColumn("order", order).select("text", "toxic", "order", pick.alias("pick"))), "labelled")
    sample = read.where("kind = 1").select("order", "text", "toxic").dropDuplicates(["order"])
    known = _mine(read.where("kind = 0").select("term", "n", "toxic"), voters)
    size = len(known) + FIXED

    def cast(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            yield pa.RecordBatch.from_arrays(
                [batch.column("order"), batch.column("toxic"), pa.array([votes(v, known) for v in texts(batch)], pa.list_(pa.int32()))], ["order", "toxic", "fired"])

    cast_rows = stored(sample.mapInArrow(cast, "order bigint, toxic int, fired array<int>"), "votes")
    got = cast_rows.orderBy("order").toArrow()
    if not got.num_rows or not sizes.get(1):
        return ToxicityModel(known, np.zeros(size), -3.0)
    fired = np.zeros((got.num_rows, size))
    for i, own in enumerate(got["fired"].to_pylist()):
        fired[i, own] = 1
    rate = sizes[1] / sum(sizes.values())
    model = LabelModel(fired, got["toxic"].to_numpy(), rate)
    here = float(got["toxic"].to_numpy().mean())
    shared = docs.sparkSession.sparkContext.broadcast((model.hit, model.miss, model.weight, here))

    def targets(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LabelModel.__new__(LabelModel)
        own.hit, own.miss, own.weight, own.prior = shared.value
        for batch in source:
            rows = batch.column("fired").to_pylist()
            x = np.zeros((len(rows), size))
            for i, r in enumerate(rows):
                x[i, r] = 1
            p = own.posterior(x)
            yield pa.RecordBatch.from_arrays([
                batch.column("order"), pa.array([[size, *r] for r in rows], pa.list_(pa.int32())),
                pa.array([[1.0] * (len(r) + 1) for r in rows], pa.list_(pa.float32())),
                pa.array([[1 - v, v] for v in p], pa.list_(pa.float64()))], ["order", "idx", "val", "target"])

    soft = cast_rows.mapInArrow(targets, "order bigint, idx array<int>, val array<float>, target array<double>")
    w = train(soft, size + 1, 2, Penalty(l1=0.001, l2=0.01, alpha=0.3), rounds=4)
    line = w[:, 1] - w[:, 0]
    # The sample may hold more toxic rows than the whole; the bias is moved to the whole's rate.
    shift = np.log(rate / (1 - rate)) - np.log(here / (1 - here)) if 0 < here < 1 and 0 < rate < 1 else 0.0
    return ToxicityModel(known, line[:size], float(line[size] + shift))


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text", *more: Column) -> DataFrame:
    """key, the columns in ``more``, ``score`` (0 to 1) and ``predicted`` (1 from one half on) per row.

    NULL and empty texts get the score of a text without votes; repeated rows get
    equal scores; an empty table works; other columns are no input.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.voters, model.weights, model.bias))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ToxicityModel(*shared.value)
        for batch in source:
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([own.score(v) for v in texts(batch)], pa.float64())], ["key", "score"])

    rows = small_batches(docs).select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "key bigint, score double").select(
        F.col("key").alias(key), *more, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


by_value(__name__)
