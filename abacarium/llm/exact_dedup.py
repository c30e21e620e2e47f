"""Exact copies: local merge, salted merge, global merge, comparing whole texts each time.

1. Every task groups its own rows by (digest, salt, text) before any shuffle; the
   salt is the task's number modulo ``salts``, so a group of copies that holds a
   third of all rows leaves each task as one row.
2. Rows with equal (digest, salt, text) are merged; a group meets in at most
   ``salts`` reducers.
3. The at most ``salts`` winners of a text meet by digest and are merged by text.

The text itself is a grouping key in all three steps, so texts that only share a
digest stay apart. The verdicts (no texts) are written once and joined back to
the rows by digest; a digest with several texts also compares the text there.
Only built-in functions run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from abacarium.llm.common import stored, whole_text

#: Characters that do not count, as fixed by the rule: blank, tab to carriage return.
IGNORED = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    for char in IGNORED:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def text_digest(text: Column) -> Column:
    """The digest that ``exact_groups`` reports for a text."""
    return F.sha2(normalised(F.coalesce(text, F.lit(""))), 256)


def _rank(chars: Column, key: Column) -> Column:
    """One number that is larger for more code points, then for a smaller key; NULL keys come last."""
    scale = F.lit("100000000000000000000").cast("decimal(21,0)")
    place = F.lit("10000000000000000000").cast("decimal(20,0)") - F.coalesce(key.cast("decimal(19,0)"), F.lit("9999999999999999999").cast("decimal(19,0)"))
    return (chars.cast("decimal(10,0)") * scale + place).cast("decimal(38,0)")


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = 16,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if they are the same without white space. Of equal texts the
    one with the most code points stays, then the smallest integer key. NULL texts
    count as empty; all empty texts are one group; a repeated key is one document
    whose rows get the same verdict each; a NULL key loses against any other and
    is never ``kept`` unless its whole group has NULL keys. An empty table gives
    an empty result. Other columns of ``docs`` are ignored, whatever their names.
    """
    base = docs.select(F.col(key).cast("long").alias("_key"), whole_text(text).alias("_raw")).select(
        "_key", F.length("_raw").alias("_chars"), normalised(F.col("_raw")).alias("_text"))
    base = base.select("_key", "_text", digest(F.col("_text")).alias("_digest"), _rank(F.col("_chars"), F.col("_key")).alias("_rank"))
    salt = F.spark_partition_id() % salts
    local = base.withColumn("_salt", salt).groupBy("_digest", "_salt", "_text").agg(
        F.max("_rank").alias("_rank"), F.count(F.lit(1)).alias("_rows"))
    whole = local.repartition("_digest").groupBy("_digest", "_text").agg(
        F.max("_rank").alias("_rank"), F.sum("_rows").alias("_rows"))
    # Same partitioning, hence no further shuffle: how many texts share a digest.
    texts = whole.groupBy("_digest").agg(
        F.count(F.lit(1)).alias("_texts"), F.max("_rank").alias("_rank"), F.max("_rows").alias("_rows"))
    verdicts = stored(texts, "exact")
    clash = verdicts.where("_texts > 1")
    rows = base.select("_key", "_digest", F.sha2("_text", 256).alias("text_sha256"))
    plain = rows.join(verdicts.where("_texts = 1").drop("_texts"), "_digest")
    if not clash.isEmpty():
        shared = stored(whole.join(clash.select("_digest"), "_digest", "left_semi"), "clash")
        more = base.drop("_rank").join(shared, ["_digest", "_text"])
        plain = plain.unionByName(more.select("_digest", "_key", F.sha2("_text", 256).alias("text_sha256"), "_rank", "_rows"))
    place = F.lit("10000000000000000000").cast("decimal(20,0)") - (F.col("_rank") % F.lit("100000000000000000000").cast("decimal(21,0)"))
    keep = F.when(place <= F.lit("9223372036854775807").cast("decimal(19,0)"), place.cast("long"))
    return plain.select(
        F.col("_key").alias(key), keep.alias("keep_id"), F.col("_rows").alias("group_size"),
        F.col("_key").eqNullSafe(keep).alias("kept"), "text_sha256")
