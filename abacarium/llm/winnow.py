"""Benchmark passages in documents, found by winnowing.

Of every 9 successive hashes of 5 words the smallest is kept as a fingerprint, for
documents and benchmark items alike. Two texts that share 13 words share a whole
window of 9 hashes, hence a fingerprint. Shared fingerprints are joined and each
hit is extended over equal words; the words themselves are compared, so that
hashes never decide. An item of fewer than 13 words is one window and has one
fingerprint, its whole hash, which documents look up at every position.

A document only reports fingerprints that hit a bitmap of the benchmark's
fingerprints. The bitmap has a fixed size; a false hit in it costs one row in the
join and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from abacarium.llm.common import bit_slots, by_value, small_batches, stored
from abacarium.llm.grams import ALNUM, mix, ngrams, word_hashes, words

WINDOW, GRAM = 13, 5
GUARD = WINDOW - GRAM + 1
BITS = 22

_HIT = "fp bigint, at int, anchor int, need int, near string"
_HIT_TYPE = pa.struct([("fp", pa.int64()), ("at", pa.int32()), ("anchor", pa.int32()), ("need", pa.int32()), ("near", pa.string())])


def fingerprints(grams: np.ndarray) -> np.ndarray:
    """The places of the smallest hash of each window, the rightmost of equals."""
    if len(grams) < GUARD:
        return np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, GUARD)[:, ::-1]
    out = []
    for lo in range(0, len(views), 1 << 17):
        part = views[lo : lo + (1 << 17)]
        out.append(lo + np.arange(len(part)) + GUARD - 1 - part.argmin(axis=1))
    return np.unique(np.concatenate(out))


def _whole_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of ``n`` words taken as a whole item, apart from the 5-word hashes."""
    with np.errstate(over="ignore"):
        return mix(ngrams(hashes, n) + np.uint64(n))


def _slot(fp: np.ndarray) -> np.ndarray:
    return (fp >> np.uint64(64 - BITS)).astype(np.int64)


def item_prints(text: str) -> list[dict]:
    """The fingerprints of one benchmark item with the words around them."""
    data, starts, ends = words(text, ALNUM)
    n = len(starts)
    if not n:
        return []
    hashes = word_hashes(data, starts, ends)
    if n < WINDOW:
        fp = _whole_hash(hashes, n).astype(np.int64)[0]
        return [{"fp": int(fp), "at": 0, "anchor": 0, "need": n, "near": _near(data, starts, ends, 0, n)}]
    grams = ngrams(hashes, GRAM)
    return [_print(grams, data, starts, ends, int(p)) for p in fingerprints(grams)]


def _near(data, starts, ends, lo: int, hi: int) -> str:
    raw = data.tobytes() if len(data) < 1 << 16 else None
    return " ".join(
        (raw[starts[i] : ends[i]] if raw else data[starts[i] : ends[i]].tobytes()).decode("utf-8", "replace")
        for i in range(lo, min(hi, len(starts))))


def _print(grams, data, starts, ends, p: int) -> dict:
    lo = max(0, p - GUARD + 1)
    return {"fp": int(grams[p].astype(np.int64)), "at": lo, "anchor": p - lo, "need": WINDOW,
            "near": _near(data, starts, ends, lo, p + WINDOW)}


def document_prints(text: str, bitmap: np.ndarray, lengths: list[int]) -> tuple[int, list[dict]]:
    """The number of words, and the fingerprints that hit the bitmap."""
    data, starts, ends = words(text, ALNUM)
    n, out = len(starts), []
    if not n or n < min(lengths, default=WINDOW):
        return n, out
    hashes = word_hashes(data, starts, ends)
    if n >= WINDOW:
        grams = ngrams(hashes, GRAM)
        places = fingerprints(grams)
        out += [_print(grams, data, starts, ends, int(p)) for p in places[bitmap[_slot(grams[places])]]]
    for size in lengths:
        if size < WINDOW and n >= size:
            whole = _whole_hash(hashes, size)
            out += [{"fp": int(whole[p].astype(np.int64)), "at": int(p), "anchor": 0, "need": size,
                     "near": _near(data, starts, ends, int(p), int(p) + size)} for p in np.flatnonzero(bitmap[_slot(whole)])]
    return n, out


def _scan(find: Callable[[str], tuple[int, list[dict]]], keep: list[str], schema: pa.Schema):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = [find(t.as_py() or "") for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array([f[0] for f in found], pa.int64()),
                     pa.array([f[1] for f in found], pa.list_(_HIT_TYPE))], schema=schema)
    return run


def _extend(near_doc: pd.Series, anchor_doc: pd.Series, near_item: pd.Series, anchor_item: pd.Series,
            need: pd.Series) -> pd.DataFrame:
    """The run of equal words around a shared fingerprint; NULL if it is shorter than ``need``."""
    starts, ends = [], []
    for a, i, b, j, least in zip(near_doc, anchor_doc, near_item, anchor_item, need, strict=True):
        a, b = a.split(" "), b.split(" ")
        lo = 0
        while lo < min(i, j) and a[i - lo - 1] == b[j - lo - 1]:
            lo += 1
        hi = 0
        while i + hi < len(a) and j + hi < len(b) and a[i + hi] == b[j + hi]:
            hi += 1
        ok = lo + hi >= least and hi > 0
        starts.append(i - lo if ok else -1)
        ends.append(i + hi if ok else -1)
    return pd.DataFrame({"start": starts, "stop": ends}, dtype="int32")


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    A word is hit if it lies in an occurrence of 13 successive words of an item, or
    of a whole item that has fewer. ``contaminated``: at least one word and 5 % of
    the words are hit. NULL and empty texts have no words and no hits; items
    without words never occur; repeated items count by their distinct ids, NULL ids
    are left out of the list; repeated keys are judged row by row; empty tables
    work. Other columns of either table are ignored.
    """
    spark = docs.sparkSession
    source = items.select(F.col(item_key).cast("string").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    prints = source.mapInArrow(_scan(lambda t: (0, item_prints(t)), ["item_id"], _schema("item_id", pa.string())),
                               f"item_id string, n_words bigint, hits array<struct<{_spec()}>>")
    prints = stored(prints.select("item_id", F.explode("hits").alias("h")).select("item_id", "h.fp", "h.anchor", "h.need", "h.near"), "items")
    bitmap = spark.sparkContext.broadcast(bit_slots(prints.select(F.shiftrightunsigned("fp", 64 - BITS).alias("slot")), BITS))
    lengths = sorted(r[0] for r in prints.select("need").distinct().collect())

    def find(value: str) -> tuple[int, list[dict]]:
        flags = find.__dict__.get("flags")
        if flags is None:
            flags = find.flags = np.unpackbits(np.frombuffer(bitmap.value, np.uint8), bitorder="little").astype(bool)
        return document_prints(value, flags, lengths)

    rows = small_batches(docs).select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    seen = rows.mapInArrow(_scan(find, ["key"], _schema("key", pa.int64())),
                           f"key bigint, n_words bigint, hits array<struct<{_spec()}>>")
    seen = stored(seen.withColumn("row", F.monotonically_increasing_id()), "prints")

    here = seen.select("row", F.explode("hits").alias("h")).select(
        "row", "h.fp", "h.at", F.col("h.anchor").alias("i"), F.col("h.need").alias("need"), F.col("h.near").alias("a"))
    forms = prints.select("fp", F.col("near").alias("b"), F.col("anchor").alias("j"), F.col("need").alias("least")).distinct()
    extend = F.pandas_udf(_extend, "start int, stop int")
    runs = (
        here.join(forms, "fp").where("need = least")
        .withColumn("run", extend("a", "i", "b", "j", "need")).where("run.start >= 0")
        .select("row", "fp", "b", "j", (F.col("at") + F.col("run.start")).alias("start"), (F.col("at") + F.col("run.stop")).alias("stop"))
    )
    runs = stored(runs, "runs")
    covered = runs.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    covered = covered.select("row", F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("stop")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(acc["stop"], s["start"]))).cast("long").alias("n"),
            F.greatest(acc["stop"], s["stop"]).alias("stop")), lambda acc: acc["n"]).alias("n_hit"))
    named = prints.select("fp", F.col("near").alias("b"), F.col("anchor").alias("j"), "item_id").distinct()
    listed = runs.select("row", "fp", "b", "j").distinct().join(named, ["fp", "b", "j"]).groupBy("row").agg(
        F.sort_array(F.collect_set("item_id")).alias("ids"))
    hit, words_ = F.coalesce("n_hit", F.lit(0).cast("long")), F.col("n_words")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return (
        seen.select("row", "key", "n_words").join(covered.join(listed, "row", "left"), "row", "left")
        .select(F.col("key").alias(key), "n_words", hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
                ((hit > 0) & (hit * 20 >= words_)).alias("contaminated"))
    )


def _spec() -> str:
    return _HIT.replace(" ", ":").replace(",:", ",")


def _schema(name: str, kind: pa.DataType) -> pa.Schema:
    return pa.schema([(name, kind), ("n_words", pa.int64()), ("hits", pa.list_(_HIT_TYPE))])


by_value(__name__)
