"""Token totals for every context limit, from one exact histogram of encoded lengths.

Documents are encoded once and aggregated by their number of tokens. Suffix sums
over the distinct lengths then answer, for any limit: how many documents are
longer, the total, the total after cutting each document at the limit, quantiles.
The suffix sums run in blocks of lengths; blocks carry their totals, so no task
holds more than a block whatever the range of lengths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abacarium.llm.common import stored

BLOCK = 4096


def length_histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row per distinct length, see ``suffix_sums``. NULL lengths count as 0."""
    return lengths.groupBy(F.coalesce(F.col(length).cast("long"), F.lit(0).cast("long")).alias("length")).agg(
        F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """``length``, ``n_docs``, ``n_tokens`` and, for the length taken as a context limit:

    ``docs_from`` and ``tokens_from`` (documents of at least this length and their
    tokens), ``docs_total`` and ``tokens_total`` (all documents), ``tokens_cut`` (all
    tokens if every document is cut at this length), ``share_below`` (the share of
    documents up to this length). An empty histogram gives no rows.
    """
    rows = stored(histogram.withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("block", F.expr(f"length div {BLOCK}")), "lengths")
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    # One row per BLOCK lengths, hence the single task.
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    carry = blocks.select(
        "block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_after"),
        F.sum("d").over(every).alias("docs_total"), F.sum("t").over(every).alias("tokens_total"))
    inside = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.join(carry, "block").withColumns({
        "docs_from": F.sum("n_docs").over(inside) + F.col("d_after"), "tokens_from": F.sum("n_tokens").over(inside) + F.col("t_after")})
    longer_or_equal = F.col("length") * F.col("docs_from")
    return out.select(
        "length", "n_docs", "n_tokens", "docs_from", "tokens_from", "docs_total", "tokens_total",
        (F.col("tokens_total") - F.col("tokens_from") + longer_or_equal).alias("tokens_cut"),
        ((F.col("docs_total") - F.col("docs_from") + F.col("n_docs")) / F.col("docs_total")).alias("share_below"))


def truncated_totals(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context``, ``tokens_cut``, ``docs_over`` for any context limits, from the suffix sums alone."""
    # All rows at or above the limit come from the shortest length that is not below it.
    cols: list[Column] = []
    for limit in limits:
        cols.append(F.min(F.when(F.col("length") >= limit, F.struct("length", "docs_from", "tokens_from", "n_docs"))).alias(f"at{limit}"))
    one = sums.agg(F.max("tokens_total").alias("total"), *cols)
    parts = []
    for limit in limits:
        at = F.col(f"at{limit}")
        over = F.coalesce(at["docs_from"] - F.when(at["length"] == limit, at["n_docs"]).otherwise(0), F.lit(0))
        cut = F.col("total") - F.coalesce(at["tokens_from"], F.lit(0)) + F.coalesce(at["docs_from"], F.lit(0)) * limit
        parts.append(F.struct(F.lit(limit).cast("long").alias("context"), cut.alias("tokens_cut"), over.alias("docs_over")))
    return one.select(F.inline(F.array(*parts)))


def length_quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share``, ``length``: the smallest length that at least this share of documents does not exceed."""
    cols = [F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("share_below") >= s, F.col("length"))).alias("length")) for s in shares]
    return sums.agg(F.array(*cols).alias("q")).select(F.inline("q"))
