"""Upsert of a dimension and surrogate keys.

Parquet has no MERGE, so a merge yields the whole new snapshot with an
``action`` per row: INSERT, UPDATE, KEEP (or DEACTIVATE with soft deletes).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from abacarium.operators.ordering import global_index
from abacarium.operators.windows import dedupe_latest
from abacarium.session import stored


def assign_keys(
    df: DataFrame, order: Sequence[str], name: str = "surrogate_key", after: Column | int = 0
) -> DataFrame:
    """Surrogate keys ``after + 1, after + 2, ...`` in ``order`` (total)."""
    start = F.lit(after) if isinstance(after, int) else after
    return global_index(df, list(order), "_index").select(
        (F.col("_index") + F.coalesce(start.cast("long"), F.lit(0))).alias(name), *df.columns
    )


def merge_dimension(
    target: DataFrame,
    feed: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: dt.datetime | Column,
    latest: Sequence[str] = (),
    surrogate: str | None = None,
    newer: Sequence[str] = (),
    soft_delete: bool = False,
) -> DataFrame:
    """The snapshot of ``target`` after merging ``feed``.

    ``target`` has ``key``, the ``tracked`` columns, ``is_active``, ``created_at``,
    ``updated_at``, the ``newer`` columns and the ``surrogate`` key if named.
    The feed is reduced to one row per key first (the latest by ``latest``); rows
    without a key are left out. A row counts as changed only if a tracked column
    differs, NULL being a value like any other. With ``newer``, a feed row updates
    only if it is newer than the target row by these columns. With
    ``soft_delete``, active rows missing from the feed become inactive.
    """
    stamp = as_of if isinstance(as_of, Column) else F.lit(as_of)
    carried = [*tracked, *[c for c in newer if c not in tracked]]
    fresh = dedupe_latest(
        feed.where(F.col(key).isNotNull()).select(key, *dict.fromkeys([*carried, *latest])), [key], latest
    ).select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in carried])

    joined = target.join(fresh, F.col(key) == F.col("_key"), "full_outer")
    same = F.struct(*tracked).eqNullSafe(F.struct(*[F.col(f"_new_{c}") for c in tracked]))
    update = ~same
    if newer:
        update = update & (F.struct(*[F.col(f"_new_{c}") for c in newer]) > F.struct(*newer))
    action = F.when(F.col(key).isNull(), "INSERT").when(F.col("_key").isNull(), _absent(soft_delete))
    joined = joined.withColumn("action", action.when(update, "UPDATE").otherwise("KEEP"))

    takes_new = F.col("action").isin("INSERT", "UPDATE")
    inserted = F.col("action") == "INSERT"
    # A newer row without a change still moves the row's own age forward.
    moves = takes_new | ((F.struct(*[F.col(f"_new_{c}") for c in newer]) > F.struct(*newer)) if newer else F.lit(False))
    columns: list[Column] = [F.coalesce(key, "_key").alias(key)]
    for c in carried:
        use_new = takes_new if c in tracked else F.coalesce(moves, F.lit(False))
        columns.append(F.when(use_new, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
    columns += [
        F.when(F.col("action") == "DEACTIVATE", F.lit(False))
        .otherwise(F.coalesce("is_active", F.lit(True))).alias("is_active"),
        F.coalesce("created_at", stamp).alias("created_at"),
        F.when(F.col("action") == "KEEP", F.col("updated_at")).otherwise(stamp).alias("updated_at"),
        "action",
    ]
    if surrogate is None:
        return joined.select(*columns)
    # Numbering reads the new rows more than once; the join is not repeated for it.
    joined = stored(joined, "merge")
    kept = joined.where(~inserted).select(F.col(surrogate).cast("long").alias(surrogate), *columns)
    new_rows = joined.where(inserted).select(*columns)
    highest = target.agg(F.max(surrogate)).scalar()
    return kept.unionByName(assign_keys(new_rows, [key], surrogate, highest))


def _absent(soft_delete: bool) -> Column:
    if not soft_delete:
        return F.lit("KEEP")
    return F.when(F.col("is_active"), F.lit("DEACTIVATE")).otherwise(F.lit("KEEP"))


def rows_without_key(feed: DataFrame, key: str) -> DataFrame:
    """The feed rows that a merge leaves out because they have no key."""
    return feed.where(F.col(key).isNull())


def dropped_duplicates(feed: DataFrame, key: str) -> DataFrame:
    """How many feed rows the reduction to one row per key leaves out."""
    per_key = feed.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("dropped"))


def merge_stats(snapshot: DataFrame) -> DataFrame:
    """Rows per action."""
    return snapshot.groupBy("action").agg(F.count(F.lit(1)).alias("rows"))


def dimension_stats(snapshot: DataFrame) -> DataFrame:
    """Rows of the dimension and how many of them were ever updated."""
    return snapshot.agg(
        F.count(F.lit(1)).alias("dim_rows"),
        F.count_if(F.col("updated_at") > F.col("created_at")).alias("updated_rows"),
    )
