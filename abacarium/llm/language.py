"""Language of a text: character n-grams, TF-IDF, sparse multinomial logistic regression, calibration.

1. Character n-grams (1 to 3) of the lower-cased text are hashed to ``2 ** BITS``
   features. Document frequencies are counted over all training documents.
2. A bounded number of training documents per language fits the weights with FTRL
   and elastic-net penalties; a fifth of them is kept back for the temperature.
3. A document's feature is its n-gram's share of the text times its inverse
   document frequency, so its logits are sums over the positions of the whole
   text: long texts are read in pieces, without a cap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from abacarium.llm.common import by_value, small_batches, stored, texts
from abacarium.llm.ftrl import Penalty, softmax, temperature, train
from abacarium.llm.grams import mix

BITS, SIZES = 15, (1, 2, 3)
PIECE = 1 << 19
SCALE = 20.0
_LETTER = regex.compile(r"\p{L}")


def features(text: str) -> Iterator[np.ndarray]:
    """The feature numbers of all n-grams of a text, piece by piece."""
    text = " " + text.lower() + " "
    for lo in range(0, len(text) - 1, PIECE):
        codes = np.frombuffer(text[lo : lo + PIECE + max(SIZES) - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        with np.errstate(over="ignore"):
            gram = np.zeros(len(codes), np.uint64)
            for size in range(1, max(SIZES) + 1):
                if len(codes) < size:
                    break
                gram = gram[: len(codes) - size + 1] * np.uint64(0x110000) + codes[size - 1 :] + np.uint64(1)
                if size in SIZES:
                    yield (mix(gram[:PIECE] + np.uint64(size)) >> np.uint64(64 - BITS)).astype(np.int64)


def _frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training documents each feature occurs; each task adds up its own first."""

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(1 << BITS, np.int64), 0
        for batch in source:
            for value in texts(batch):
                here = np.zeros(1 << BITS, bool)
                for part in features(value):
                    here[part] = True
                total += here
                rows += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"feature": pa.array([-1, *used], pa.int64()), "n": pa.array([rows, *total[used]], pa.int64())})

    got = docs.select("text").mapInArrow(count, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    feature, n = got["feature"].to_numpy(), got["n"].to_numpy()
    out = np.zeros(1 << BITS, np.int64)
    out[feature[feature >= 0]] = n[feature >= 0]
    return out, int(n[feature < 0].sum())


def _vectors(sample: DataFrame, idf: np.ndarray, classes: list[str]) -> DataFrame:
    """The training rows as sparse vectors with their target."""
    shared = sample.sparkSession.sparkContext.broadcast(idf)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in source:
            fresh = [order not in seen and not seen.add(order) for order in batch.column("order").to_pylist()]
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            idx, val = [], []
            for value in texts(batch):
                total = np.zeros(1 << BITS)
                for part in features(value):
                    total += np.bincount(part, minlength=1 << BITS)
                at = np.flatnonzero(total)
                idx.append(at)
                val.append(total[at] / max(1.0, total.sum()) * shared.value[at] * SCALE)
            label = [classes.index(v) for v in batch.column("lang").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("order"), pa.array(label, pa.int32()), pa.array(idx, pa.list_(pa.int32())), pa.array(val, pa.list_(pa.float32())),
                pa.array([[float(i == k) for i in range(len(classes))] for k in label], pa.list_(pa.float64()))],
                ["order", "label", "idx", "val", "target"])

    return sample.select("order", "lang", "text").mapInArrow(run, "order bigint, label int, idx array<int>, val array<float>, target array<double>")


class LanguageModel:
    """Classes, weights (feature by class, the inverse document frequency worked in), temperature."""

    def __init__(self, classes: list[str], table: np.ndarray, heat: float):
        self.classes, self.table, self.heat = classes, table, heat

    def logits(self, text: str) -> np.ndarray:
        total, rows = np.zeros(len(self.classes)), 0
        for part in features(text):
            total += self.table[part].sum(axis=0, dtype=np.float64)
            rows += len(part)
        return total * (SCALE / max(1, rows))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.classes or not _LETTER.search(text):
            return "und", 0.0
        chance = softmax(self.logits(text) / self.heat)
        return self.classes[int(chance.argmax())], float(chance.max())


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 1500,
        penalty: Penalty | None = None) -> LanguageModel:
    """A model from all rows with a text and a language.

    Document frequencies and language sizes come from all rows. The weights come from
    at most about ``per_language`` rows of each language, drawn by a hash of key and
    text, equal ones once; the key is used for nothing else. No usable rows give a model that answers ``und``.
    """
    known = small_batches(rows).select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"),
                        F.xxhash64(F.col(key).cast("string"), F.col(text).cast("string"), F.lit("language")).alias("order")).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    classes = sorted(sizes)
    if not classes:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), 1.0)
    seen, total = _frequencies(known)
    idf = np.log((1 + total) / (1 + seen)) + 1
    parts = 1 << 20
    limit = F.lit(0)
    for name, size in sizes.items():
        limit = F.when(F.col("lang") == name, int(parts * min(1.0, per_language / size))).otherwise(limit)
    place = F.pmod(F.shiftright("order", 8), F.lit(parts))
    # Rows that repeat in a task are gone by now, those of other tasks go here.
    sample = stored(_vectors(known.where(place < limit), idf, classes), "language").dropDuplicates(["order"])
    kept_back = F.pmod("order", F.lit(5)) == 0
    table = train(sample.where(~kept_back), 1 << BITS, len(classes), penalty)
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = [(np.asarray(v, np.float64)[:, None] * shared.value[np.asarray(i, np.int64)]).sum(axis=0)
                   for i, v in zip(batch.column("idx").to_pylist(), batch.column("val").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.float64())), batch.column("label")], ["logits", "label"])

    heat = temperature(sample.where(kept_back).select("idx", "val", "label").mapInArrow(score, "logits array<double>, label int"))
    return LanguageModel(classes, (table * idf[:, None]).astype(np.float32), heat)


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text", *more: Column) -> DataFrame:
    """key, ``lang_pred``, ``score`` per row, and the columns in ``more``.

    NULL and empty texts and texts without a letter are ``und`` with score 0. Other
    columns are no input; repeated rows get equal answers; an empty table works.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.classes, model.table, model.heat))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageModel(*shared.value)
        for batch in source:
            found = [own.predict(v) for v in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["key", "lang_pred", "score"])

    rows = small_batches(docs).select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "key bigint, lang_pred string, score double").select(
        F.col("key").alias(key), *more, "lang_pred", "score")


def recognised(docs: DataFrame, model: LanguageModel, text: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose language is recognised with a score of ``least`` or more, all columns kept.

    Rows without a text or a letter go. The rows pass through one scan, without a join.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.classes, model.table, model.heat))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageModel(*shared.value)
        for batch in source:
            found = [own.predict(v) for v in texts(batch, text)]
            yield batch.filter(pa.array([lang != "und" and score >= least for lang, score in found], pa.bool_()))

    return small_batches(docs).mapInArrow(run, docs.schema)


by_value(__name__)
