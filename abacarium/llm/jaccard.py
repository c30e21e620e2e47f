"""Documents whose shingle sets are alike, by a join on adaptive multi-match prefixes.

A set of ``n`` shingles, ordered rare first, must share ``l`` of its first
``n - ceil(t n) + l`` shingles with every set that is similar to it, for any ``l``.
Each document picks its own ``l``: a longer prefix reads more postings but asks for
more shared shingles, so fewer candidates are left to verify. The choice minimises
the estimated cost, from the frequencies of the shingles concerned. A pair has to
share the smaller of its two numbers within the prefixes that belong to the pair.

1. Frequencies of all shingles are counted over all documents in packed blocks. The
   most frequent ones (a bounded number) are broadcast, and a bitmap of fixed size
   tells shingles that occur once, which cannot join and come first in the order.
   Any order gives the same result, so neither bound touches the result.
2. Equal sets become one, known by the digest of the set.
3. In every posting list, members are compared with the list's most central member
   only; each set is verified against the one it meets most often.
4. The full join skips pairs that are connected already, counts shared prefix
   shingles, and verifies what is left on whole sets. No link that joins two
   components is lost, and a group of near copies is not expanded into its pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from abacarium.llm.common import bit_slots, by_value, most_frequent, small_batches, stored, texts
from abacarium.llm.components import components
from abacarium.llm.grams import shingle_set

FLUSH = 1_000_000
SLOT_BITS = 26
ID_BITS = 23
HEAVY, HEAVY_FROM = 1 << 19, 8
LONGEST = 6


def set_digest(shingles: np.ndarray) -> bytes:
    """The name of a set, from its sorted shingles."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _packed(parts: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """Distinct shingles of many documents by their upper ``bits``, the next 32 as integers, with counts."""
    key = np.sort(np.concatenate(parts) >> np.uint64(32 - bits))
    first = np.flatnonzero(np.diff(key, prepend=key[0] ^ np.uint64(1)))
    counts, key = np.diff(first, append=len(key)).astype(np.uint32), key[first]
    bucket = (key >> np.uint64(32)).astype(np.int64)
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(cut[1:], len(key))
    low = key.astype(np.uint32)
    yield pa.RecordBatch.from_pydict({
        "bucket": pa.array(bucket[cut], pa.int64()),
        "low": pa.array([low[a:b].tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary()),
        "more": pa.array([_repeated(counts[a:b]) for a, b in zip(cut, ends, strict=True)], pa.binary()),
    })


def _repeated(counts: np.ndarray) -> bytes:
    """Place and number of the counts above one."""
    at = np.flatnonzero(counts > 1).astype(np.uint32)
    return np.stack([at, counts[at]]).tobytes()


def _frequencies(docs: DataFrame, shingle: int) -> tuple[DataFrame, int]:
    """Per bucket: a bitmap of the shingles in several documents, and the frequent ones with their numbers."""
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = max(4, min(18, math.ceil(math.log2(size / 6 / (1 << 20) + 1))))

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, seen = [], 0, set()
        for batch in source:
            for value in texts(batch):
                own = shingle_set(value, shingle)
                mark = set_digest(own)
                if not len(own) or mark in seen:
                    continue
                seen.add(mark)
                parts.append(own)
                held += len(own)
                if held > FLUSH:
                    yield from _packed(parts, bits)
                    parts, held, seen = [], 0, set()
        if parts:
            yield from _packed(parts, bits)

    def merge(table: pa.Table) -> pa.Table:
        lows, numbers = [], []
        for low, more in zip(table["low"], table["more"], strict=True):
            own = np.frombuffer(low.as_py(), np.uint32)
            n = np.ones(len(own), np.int64)
            at, times = np.frombuffer(more.as_py(), np.uint32).reshape(2, -1)
            n[at] = times
            lows.append(own)
            numbers.append(n)
        low, n = np.concatenate(lows), np.concatenate(numbers)
        order = np.argsort(low)
        low, n = low[order], n[order]
        first = np.flatnonzero(np.diff(low, prepend=low[0] ^ 1))
        low, n = low[first], np.add.reduceat(n, first)
        mask = np.zeros(1 << (SLOT_BITS - bits), bool)
        mask[low[n > 1] >> np.uint32(32 - SLOT_BITS + bits)] = True
        heavy = n >= HEAVY_FROM
        bucket = table["bucket"][0].as_py()
        return pa.table({
            "bucket": pa.array([bucket], pa.int64()), "mask": pa.array([np.packbits(mask).tobytes()], pa.binary()),
            "heavy": pa.array([[{"key": bucket << 32 | int(k), "n": int(c)} for k, c in zip(low[heavy], n[heavy], strict=True)]],
                              pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())])))})

    packed = docs.select("text").mapInArrow(count, "bucket bigint, low binary, more binary")
    merged = packed.groupBy("bucket").applyInArrow(merge, "bucket bigint, mask binary, heavy array<struct<key:bigint,n:bigint>>")
    return stored(merged, "frequency"), bits


def choose(found: np.ndarray, n: int, need: int) -> int:
    """The number of shared shingles to ask for, by estimated cost.

    ``found`` estimates the partners of each shingle in the longest prefix. Reading a
    prefix costs its postings. Documents that share ``l`` of its shingles are about as
    many as the ``l``-th most frequent one has, since frequent shingles tend to come
    from one passage; each costs a verification in proportion to the set.
    """
    most = min(LONGEST, need)
    if not found.any():
        return 1
    cost = []
    for ask in range(1, most + 1):
        own = np.sort(found[: n - need + ask])[::-1]
        cost.append(own.sum() + (own[ask - 1] if ask <= len(own) else 0) * (1 + n / 16))
    return int(np.argmin(cost)) + 1


def _prefixes(docs: DataFrame, shingle: int, percent: int, mask: bytes, heavy: pa.Table, bits: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    key = heavy["key"].to_numpy()
    order = np.argsort(key)
    shared = context.broadcast((mask, key[order].tobytes(), heavy["n"].to_numpy()[order].tobytes()))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(shared.value[0], np.uint8)
        keys, numbers = np.frombuffer(shared.value[1], np.int64), np.frombuffer(shared.value[2], np.int64)
        for batch in source:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                out = [_prefix(shingle_set(v, shingle), percent, flags, keys, numbers, bits) for v in texts(part)]
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([
                    part.column("key"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int32()),
                    pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.list_(pa.int32()))],
                    ["key", "n", "sid", "need", "tok", "pos"])

    return docs.mapInArrow(run, "key bigint, n bigint, sid binary, need int, tok array<bigint>, pos array<int>")


def _prefix(own: np.ndarray, percent: int, flags: np.ndarray, keys: np.ndarray, numbers: np.ndarray, bits: int) -> tuple:
    n = len(own)
    if not n:
        return 0, b"", 0, [], []
    need = -(-percent * n // 100)
    place = (own >> np.uint64(32 - bits)).astype(np.int64)
    df = np.zeros(n, np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, place), len(keys) - 1)
        df = np.where(keys[at] == place, numbers[at], 0)
    slot = own >> np.uint64(64 - SLOT_BITS)
    hit = (flags[(slot >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8))) & 1 > 0
    df = np.where(hit, np.maximum(df, 1), 0)
    order = np.argsort(df, kind="stable")[: min(n, n - need + LONGEST)]
    ask = choose(df[order], n, need)
    size = min(n, n - need + ask)
    pos = np.flatnonzero(hit[order[:size]])
    return n, set_digest(own), ask, own[order[pos]].view(np.int64), pos.astype(np.int32)


def whole_sets(docs: DataFrame, shingle: int, wanted: DataFrame) -> DataFrame:
    """The whole sets of the documents whose keys are in ``wanted`` (and a few more, by a bitmap of fixed size)."""
    place = F.pmod(F.xxhash64("key"), F.lit(1 << ID_BITS))
    shared = docs.sparkSession.sparkContext.broadcast(bit_slots(wanted.select(place.alias("slot")), ID_BITS))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(shared.value, np.uint8)
        for batch in source:
            at = batch.column("place").to_numpy()
            keep = np.flatnonzero(flags[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            for lo in range(0, len(keep), 256):
                own = [shingle_set(batch.column("text")[i].as_py() or "", shingle) for i in keep[lo : lo + 256].tolist()]
                own = [s for s in own if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_digest(s) for s in own], pa.binary()), pa.array([s.tobytes() for s in own], pa.binary())], ["sid", "items"])

    return docs.select(place.alias("place"), "text").mapInArrow(run, "sid binary, items binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are alike."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = sets.select(F.col("sid").alias("a"), F.col("items").alias("x"))
    second = sets.select(F.col("sid").alias("b"), F.col("items").alias("y"))
    return pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def _may_join(percent: int, n1: Column, n2: Column, pos1: Column, pos2: Column, ask: Column) -> Column:
    """Sizes allow the similarity, and both places lie in the prefixes that belong to this pair."""
    overlap = F.ceil((n1 + n2) * percent / (100 + percent) - F.lit(1e-9))
    return ((F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent)
            & (pos1 < n1 - overlap + ask) & (pos2 < n2 - overlap + ask))


def _met_apart(known: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a < b`` of different roots that share as many prefix shingles as asked for.

    Posting lists of one root are left out, and in the others roots are paired before
    their members, so that members of one root do not meet. The smaller set of a pair
    shares ``2 percent / (100 + percent)`` of its shingles at least, which shortens its
    prefix to what no template without own words fits into. Sizes that cannot be alike
    do not meet either: a step of ``log n`` is as wide as the similarity allows.
    """
    several = known.groupBy("tok").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("tok")
    known = known.join(several, "tok", "left_semi").withColumn("step", F.floor(F.log(F.col("n")) / math.log(100.0001 / percent)).cast("int"))
    known = stored(known, "several")
    small = known.where(F.col("pos") < F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent) - F.lit(1e-9)) + F.col("need"))
    left, right = (rows.select("tok", "step", *[F.col(c).alias(c + end) for c in ("sid", "root", "n", "need", "pos")])
                   for rows, end in ((small, "1"), (known, "2")))
    left = left.withColumn("step", F.explode(F.array("step", F.col("step") + 1)))
    first, second = (rows.groupBy("tok", "step", "root" + end).agg(
        F.min("n" + end).alias("low" + end), F.max("n" + end).alias("high" + end), F.max("need" + end).alias("most" + end),
        F.min("pos" + end).alias("at" + end)) for rows, end in ((left, "1"), (right, "2")))
    # What some pair of members might satisfy; exact for roots of one set.
    overlap = F.ceil((F.col("low1") + F.col("low2")) * percent / (100 + percent) - F.lit(1e-9))
    most = F.least("most1", "most2")
    may = ((F.col("high1") * 100 >= F.col("low2") * percent) & (F.col("low1") <= F.col("high2"))
           & (F.col("at1") < F.col("high1") - overlap + most) & (F.col("at2") < F.col("high2") - overlap + most))
    met = first.join(second, ["tok", "step"]).where("root1 <> root2").where(may).select("tok", "step", "root1", "root2")
    asked = F.least("need1", "need2")
    pairs = left.join(met, ["tok", "step", "root1"]).join(right, ["tok", "step", "root2"]).where("n1 < n2 OR n1 = n2 AND sid1 < sid2").where(
        _may_join(percent, F.col("n1"), F.col("n2"), F.col("pos1"), F.col("pos2"), asked))
    pairs = pairs.groupBy(F.least("sid1", "sid2").alias("a"), F.greatest("sid1", "sid2").alias("b")).agg(
        F.count(F.lit(1)).alias("met"), F.max(asked).alias("asked"))
    return pairs.where("met >= asked").select("a", "b")


def _merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """``node``, ``root`` of ``label`` after its classes were united over ``links`` (``a``, ``b``) of sets."""
    named = links.join(label.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left").join(
        label.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
    more = components(named.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    lifted = label.join(more.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select(
        "node", F.coalesce("top", "root").alias("root"))
    return stored(lifted.unionByName(more.join(label, "node", "left_anti")), "label")


def joined(base: DataFrame, shingle: int, percent: int, label: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The sets of ``base`` (``key``, ``text``) by row, and ``node``, ``root`` of the sets that are linked.

    ``label`` has classes that are known already; they are united with those found here.
    """
    frequency, bits = _frequencies(base, shingle)
    mask = bytearray(1 << (SLOT_BITS - 3))
    width = 1 << (SLOT_BITS - 3 - bits)
    for row in frequency.select("bucket", "mask").toArrow().to_pylist():
        mask[row["bucket"] * width : (row["bucket"] + 1) * width] = row["mask"]
    heavy = most_frequent(frequency.select(F.explode("heavy").alias("h")).select("h.key", "h.n"), HEAVY, HEAVY_FROM).toArrow()
    rows = stored(_prefixes(base, shingle, percent, bytes(mask), heavy, bits), "prefixes")

    postings = _sets_of(rows, "n", "need", "tok", "pos").select("sid", "key", "n", "need", F.explode(F.arrays_zip("tok", "pos")).alias("p")).select(
        "sid", "key", "n", "need", F.col("p.tok").alias("tok"), F.col("p.pos").alias("pos"))
    lists = postings.groupBy("tok").agg(F.min(F.struct("pos", "n", "sid", "need")).alias("head"), F.count(F.lit(1)).alias("size"))
    met = stored(postings.join(lists.where("size > 1").drop("size"), "tok"), "met")
    # Sorted by name once, before they are written: each read would sort whole sets again.
    sets = stored(whole_sets(base, shingle, met.select("key").distinct()).dropDuplicates(["sid"]), "sets")

    ask = F.least("need", "head.need")
    star = met.where(F.col("sid") != F.col("head.sid")).where(
        _may_join(percent, F.col("n"), F.col("head.n"), F.col("pos"), F.col("head.pos"), ask))
    star = star.groupBy("sid", F.col("head.sid").alias("b")).count().groupBy("sid").agg(
        F.max(F.struct("count", "b")).alias("best")).select(F.col("sid").alias("a"), F.col("best.b").alias("b"))
    star = stored(star, "star")
    # Written, and the pairs below too: a plan that holds all steps takes much of the driver's memory each time it is adapted.
    close = confirmed(star, sets, percent)
    label = stored(components(close), "label") if label is None else _merged(label, close)

    known = met.drop("head", "key").join(label.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    pairs = _met_apart(known, percent)
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = confirmed(stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs"), sets, percent)
    return rows, _merged(label, links)


def _sets_of(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.where("n > 0").groupBy("sid").agg(F.min("key").alias("key"), *[F.first(c).alias(c) for c in columns])


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, percent: int = 90) -> DataFrame:
    """One row per row of ``docs``: key, ``n_shingles``, ``component_id``.

    Words are what white space separates, A-Z lower-cased. Two texts are linked if
    100 times the shared shingles is at least ``percent`` times all their shingles;
    ``component_id`` is the smallest key reachable over links, its own included. A
    text with fewer words than a shingle is one shingle; NULL and empty texts have
    none and stay alone. Repeated rows fall into one component; NULL keys are
    ignored in the minimum. An empty table gives no rows; other columns are ignored.
    """
    base = small_batches(docs).select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    rows, label = joined(base, shingle, percent)
    of_set = _sets_of(rows).join(label.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    of_set = stored(of_set, "classes")
    lowest = of_set.groupBy("root").agg(F.min("key").alias("low"))
    found = of_set.join(lowest, "root").select("sid", "low")
    return rows.select("key", "n", "sid").join(found, "sid", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("key")).alias("component_id"))


by_value(__name__)
