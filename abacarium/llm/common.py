"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from abacarium.session import stored

__all__ = ["by_value", "stored", "read_table", "vocabulary_path", "remainder", "whole_text", "bit_slots", "among", "most_frequent", "small_batches", "texts"]


def by_value(module: str) -> None:
    """Ship the functions of ``module`` to executors inside the task, not by import."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed public tokenizers keep a vocabulary file; only the driver reads it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL ids count as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % parts


def whole_text(text: str = "text") -> Column:
    """The text, NULL as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def bit_slots(slots: DataFrame, bits: int) -> bytes:
    """A bitmap of ``2 ** bits`` bits in which the values of column ``slot`` are set.

    Its size is fixed by ``bits`` whatever the input, and so is what the driver
    receives: at most ``2 ** (bits - 6)`` words of eight bytes.
    """
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(slot % 64 AS INT)))").alias("mask"))
    got = words.toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got["word"].to_numpy()] = got["mask"].to_numpy()
    return out.tobytes()


def among(rows: DataFrame, column: str, wanted: DataFrame, bits: int = 24) -> DataFrame:
    """The rows whose ``column`` is in ``wanted`` and a few more, by a bitmap of ``2 ** bits`` bits.

    The bitmap has at most ``2 ** (bits - 6)`` rows, hence the broadcast.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(1 << bits))
    words = wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(slot % 64 AS INT)))").alias("mask"))
    marked = rows.withColumn("slot", slot).withColumn("word", F.shiftright("slot", 6))
    return marked.join(F.broadcast(words), "word").where(F.expr("getbit(mask, CAST(slot % 64 AS INT)) = 1")).drop("word", "slot", "mask")


def most_frequent(counts: DataFrame, size: int, least: int) -> DataFrame:
    """Rows of ``counts`` with the largest ``n``: at most ``size``, each of ``least`` or more.

    The limit is found from a histogram of ``n`` in steps of an eighth of a doubling,
    so nothing is sorted and the driver sees a few hundred numbers.
    """
    kept = stored(counts.where(F.col("n") >= least).withColumn("step", F.floor(F.log2("n") * 8).cast("int")), "counts")
    room, cut = size, 1 << 30
    for row in sorted(kept.groupBy("step").count().collect(), reverse=True):
        if row["count"] > room:
            break
        room, cut = room - row["count"], row["step"]
    return kept.where(F.col("step") >= cut).drop("step")


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, in a session that hands texts to Python in batches of at most 1,000 rows.

    Spark's 10,000 rows of long texts take hundreds of MB in every task, in the JVM and
    again in Python. A setting of the session's owner below that is left alone.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(docs.sparkSession.conf.get(name)) <= 1000:
        docs.sparkSession.conf.set(name, "1000")
    return docs


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """The texts of a batch one by one, NULL as the empty text."""
    for value in batch.column(column):
        yield value.as_py() or ""


by_value(__name__)
