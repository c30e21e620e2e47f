"""Near copies of documents by b-bit MinHash.

1. Every set of word shingles gets ``MINIMA`` minima under different hashes. ``BANDS``
   bands of ``ROWS`` minima propose pairs; of each minimum only ``BITS`` bits are kept,
   packed into a few longs. At similarity 0.85 a pair shares a band with a chance of
   1 - 5e-7. Equal sets become one, known by the digest of the set.
2. In a bucket of up to ``FEW`` sets all are paired; in a larger one each is paired
   with the bucket's head alone, so that a bucket of any size gives about as many
   pairs as sets.
3. Bit counts of two packed signatures tell how many minima agree. Unequal minima
   agree in ``BITS`` bits by chance in one of ``2 ** BITS``, which the estimate takes
   off. Pairs estimated ``MARGIN`` (six standard errors) or more below the wanted
   similarity go.
4. What is left is confirmed on whole sets; components are taken over the links.
5. Large buckets whose sets are not all connected by then are open: their documents go
   through the exact join on prefixes, which begins with the components known by then. So
   no bucket is cut short, and none is expanded into all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from abacarium.llm.common import by_value, small_batches, stored, texts
from abacarium.llm.components import components
from abacarium.llm.grams import mix, shingle_set
from abacarium.llm.jaccard import confirmed, joined, set_digest, whole_sets

MINIMA, BITS = 128, 4
BANDS, ROWS = 25, 5
FEW = 16
#: Six standard errors of the estimate where it varies most, at a similarity near 0.8.
MARGIN = 6 * math.sqrt(0.8 * 0.2 / MINIMA) / (1 - 2.0**-BITS)
_LONGS = MINIMA * BITS // 64
_BLOCK = 2048
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _hashes() -> tuple[np.ndarray, np.ndarray]:
    """An odd factor and a summand for every minimum."""
    with np.errstate(over="ignore"):
        seeds = mix(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64) * _STEP)
    return seeds[:MINIMA] | np.uint64(1), seeds[MINIMA:]


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of every hash over a set, block by block, so that memory stays small for long texts."""
    factor, summand = _hashes()
    out = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for lo in range(0, len(shingles), _BLOCK):
            part = shingles[lo : lo + _BLOCK, None] * factor + summand
            np.minimum(out, part.min(axis=0), out=out)
    return out


def packed(low: np.ndarray) -> np.ndarray:
    """``BITS`` bits of each minimum, sixteen to a long."""
    bits = (mix(low) & np.uint64((1 << BITS) - 1)).reshape(_LONGS, -1)
    return np.bitwise_or.reduce(bits << (np.arange(bits.shape[1], dtype=np.uint64) * np.uint64(BITS)), axis=1).view(np.int64)


def bands(low: np.ndarray) -> np.ndarray:
    """One hash per band, of its number and its minima."""
    part = low[: BANDS * ROWS].reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(ROWS):
            out = mix(out * _STEP + part[:, i])
    return out.view(np.int64)


def estimate(left: Column, right: Column) -> Column:
    """The similarity of two sets from their packed signatures, corrected for chance agreement."""
    def unlike(i: int) -> Column:
        x = F.element_at(left, i).bitwiseXOR(F.element_at(right, i))
        any_bit = reduce(Column.bitwiseOR, [F.shiftrightunsigned(x, s) for s in range(1, BITS)], x)
        ones = sum(1 << s for s in range(0, 64, BITS))
        return F.bit_count(any_bit.bitwiseAND(F.lit(ones)))

    agree = 1 - sum(unlike(i) for i in range(1, _LONGS + 1)) / F.lit(float(MINIMA))
    chance = 2.0**-BITS
    return (agree - chance) / (1 - chance)


def _signed(base: DataFrame, shingle: int) -> DataFrame:
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            sizes, names, signs, keys = [], [], [], []
            for value in texts(batch):
                own = shingle_set(value, shingle)
                low = minima(own) if len(own) else None
                sizes.append(len(own))
                names.append(set_digest(own) if len(own) else b"")
                signs.append([] if low is None else packed(low))
                keys.append([] if low is None else bands(low))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
                 pa.array(signs, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))], ["key", "n", "sid", "sig", "bands"])

    return base.mapInArrow(run, "key bigint, n bigint, sid binary, sig array<bigint>, bands array<bigint>")


def _candidates(sets: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a < b`` of sets that meet in a bucket and whose estimate is not too low."""
    few = met.where(F.col("size") <= FEW).select("band", "sid")
    close = few.join(few.withColumnRenamed("sid", "other"), "band").where("sid < other").select("sid", "other")
    star = met.where((F.col("size") > FEW) & (F.col("sid") != F.col("head"))).select("sid", F.col("head").alias("other"))
    pairs = close.unionByName(star).select(F.least("sid", "other").alias("a"), F.greatest("sid", "other").alias("b")).distinct()
    first = sets.select(F.col("sid").alias("a"), F.col("sig").alias("x"), F.col("n").alias("n"))
    second = sets.select(F.col("sid").alias("b"), F.col("sig").alias("y"), F.col("n").alias("m"))
    sized = pairs.join(first, "a").join(second, "b").where(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
    return sized.where(estimate(F.col("x"), F.col("y")) > percent / 100 - MARGIN).select("a", "b")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: key, ``n_shingles``, ``component_id``, ``kept``.

    Words are what white space separates, A-Z lower-cased. Two texts are linked if
    100 times the shared shingles is at least ``percent`` times all their shingles;
    ``component_id`` is the smallest key reachable over links, its own included, and
    ``kept`` tells whether that is the row's key. A text with fewer words than a
    shingle is one shingle; NULL and empty texts have none and stay alone. Repeated
    rows fall into one component; NULL keys are ignored in the minimum, and a row
    with a NULL key is kept if all keys of its component are NULL. An empty table
    gives no rows; other columns are ignored. Bands are laid out for ``percent`` of 80
    or more: a link at 0.8 is met with a chance of 0.99995.
    """
    base = small_batches(docs).select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    rows = stored(_signed(base, shingle), "signatures")
    sets = stored(rows.where("n > 0").groupBy("sid").agg(F.min("key").alias("key"), *[F.first(c).alias(c) for c in ("n", "sig", "bands")]), "sets")

    postings = sets.select("sid", F.explode("bands").alias("band"))
    buckets = postings.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("sid").alias("head")).where("size > 1")
    met = stored(postings.join(buckets, "band"), "met")
    pairs = stored(_candidates(sets, met, percent), "pairs")
    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct().join(sets.select("sid", "key"), "sid").select("key")
    whole = stored(whole_sets(base, shingle, wanted).dropDuplicates(["sid"]), "whole")
    label = stored(components(confirmed(pairs, whole, percent)), "label")

    large = met.where(F.col("size") > FEW).select("band", "sid").join(label.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
        "root", F.coalesce("root", "sid"))
    apart = large.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("band")
    open_sets = stored(large.join(apart, "band", "left_semi").select("sid").distinct(), "open")
    if not open_sets.isEmpty():
        label = _united(base, sets, open_sets, label, shingle, percent)

    of_set = sets.select("sid", "key").join(label.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    lowest = of_set.groupBy("root").agg(F.min("key").alias("low"))
    found = of_set.join(lowest, "root").select("sid", "low")
    component = F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("key"))
    return rows.select("key", "n", "sid").join(found, "sid", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"))


def _united(base: DataFrame, sets: DataFrame, open_sets: DataFrame, label: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``label`` with the links of an exact join among the sets of open buckets; what ``label`` unites is not joined again."""
    keys = sets.join(open_sets, "sid", "left_semi").select(F.col("key").alias("wanted")).distinct()
    chosen = stored(base.join(keys, F.col("key").eqNullSafe(F.col("wanted")), "left_semi"), "open_texts")
    return joined(chosen, shingle, percent, label)[1]


by_value(__name__)
