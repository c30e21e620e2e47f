"""Global order and running sums without a single-task window.

``Window.orderBy`` without ``partitionBy`` moves all rows to one task, and
``Window.partitionBy(key)`` moves a hot key to one task. The functions here give
the same numbers from many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abacarium.session import stored

# monotonically_increasing_id() puts the partition number above the lower 33 bits.
_PLACE_BITS = 33



def global_index(df: DataFrame, order: Sequence[Column | str], name: str = "row_num") -> DataFrame:
    """Number all rows 1, 2, ... in ``order``, which must be total.

    The rows are range-partitioned by the order and stored once together with
    their place, so that the per-slice counts and the numbering see the same
    layout. The offsets have one row per slice, hence the broadcast.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    laid = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "index",
    )
    slice_no = F.shiftright("_at", _PLACE_BITS)
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    counts = laid.groupBy(slice_no.alias("_slice")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        laid.withColumn("_slice", slice_no)
        .join(F.broadcast(offsets), "_slice")
        .select(*df.columns, (F.col("_offset") + place + 1).alias(name))
    )


def global_ranks(
    df: DataFrame,
    order: Sequence[Column],
    order_columns: Sequence[str],
    tie_break: Sequence[Column | str],
    within: Sequence[str] = (),
    row_number: str | None = "row_num",
    rank: str | None = "rnk",
    dense_rank: str | None = "dense_rnk",
    slices: int | None = None,
) -> DataFrame:
    """ROW_NUMBER, RANK and DENSE_RANK by ``order``, per ``within`` if given.

    ``order`` sorts by ``order_columns`` (for example descending); ``tie_break``
    makes the row number total. The rows are range-partitioned once; every group is
    ranked inside each slice, and one small row per group and slice carries what
    came before: the rows, the distinct values, and where a run of ties that goes
    on across a slice began. Neither a large group nor many ties meet in one task. ``slices``
    sets the number of slices.
    """
    keys = list(within)
    slots = {f"_v{i}": F.col(c) for i, c in enumerate(order_columns)}
    ranged = df.withColumns(slots).repartitionByRange(*([slices] if slices else []), *keys, *order, *tie_break)
    laid = stored(ranged.withColumn("_slice", F.spark_partition_id()), "ranks")
    piece = [*keys, "_slice"]
    sorted_ = Window.partitionBy(*piece).orderBy(*order, *tie_break)
    peers = Window.partitionBy(*piece).orderBy(*order)
    local = laid.withColumns({
        "_row": F.row_number().over(sorted_), "_rank": F.rank().over(peers), "_dense": F.dense_rank().over(peers)})
    value = F.struct(*slots)
    per_piece = local.groupBy(*piece).agg(
        F.max("_row").alias("_rows"), F.max("_dense").alias("_values"), F.max("_rank").alias("_last_rank"),
        F.min_by(value, "_row").alias("_first"), F.max_by(value, "_row").alias("_last"))
    along = Window.partitionBy(*keys).orderBy("_slice")
    before, so_far = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(Window.unboundedPreceding, 0)
    carried = per_piece.withColumns({
        "_rows_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
        "_goes_on": F.coalesce(F.lag("_last").over(along).eqNullSafe(F.col("_first")) & F.lag("_rows").over(along).isNotNull(), F.lit(False)),
    }).withColumns({
        "_values_before": F.coalesce(F.sum("_values").over(before), F.lit(0)) - F.sum(F.col("_goes_on").cast("int")).over(so_far),
        # Where the last run of ties of a piece begins, unless all of the piece belongs to a run that began earlier.
        "_began": F.when(~F.col("_goes_on") | (F.col("_values") > 1), F.col("_rows_before") + F.col("_last_rank")),
    }).withColumn("_run_start", F.last("_began", ignorenulls=True).over(before))
    joined = join_null_safe(local, carried.select(*piece, "_rows_before", "_goes_on", "_values_before", "_run_start"), piece)
    results = {
        row_number: F.col("_rows_before") + F.col("_row"),
        rank: F.when(F.col("_goes_on") & (F.col("_dense") == 1), F.col("_run_start")).otherwise(F.col("_rows_before") + F.col("_rank")),
        dense_rank: F.col("_values_before") + F.col("_dense"),
    }
    return joined.select(*df.columns, *[expr.cast("long").alias(name) for name, expr in results.items() if name])


def ntile(df: DataFrame, order: Sequence[Column | str], tiles: int, name: str = "tile") -> DataFrame:
    """NTILE over all rows: the first ``rows mod tiles`` tiles hold one row more."""
    indexed = global_index(df, order, "_row")
    total = indexed.agg(F.max("_row")).scalar()
    place = F.col("_row") - 1
    small = F.expr(f"_total div {tiles}")
    extra = F.col("_total") % tiles
    in_large = place < extra * (small + 1)
    # The divisor of the second form is only used when small tiles are not empty.
    large_tile = F.expr(f"(_row - 1) div (_total div {tiles} + 1)")
    small_tile = F.expr(
        f"(_total % {tiles}) + (_row - 1 - (_total % {tiles}) * (_total div {tiles} + 1))"
        f" div greatest(_total div {tiles}, 1)"
    )
    return (
        indexed.withColumn("_total", total)
        .withColumn(name, F.when(in_large, large_tile).otherwise(small_tile) + 1)
        .drop("_row", "_total")
    )


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    sums: Mapping[str, Column],
    slices: int | None = None,
) -> DataFrame:
    """Running sums per key in ``order`` (total), inclusive of the current row.

    The rows are range-partitioned by key and order and stored once, so every key
    is cut into pieces of bounded size, whatever its number of rows. A piece is
    summed by a window of its own; the totals of the key's earlier pieces (one row
    per piece) are carried into it by an equi-join. ``slices`` sets their number.
    """
    keys = list(keys)
    added = df.withColumns({f"_add_{name}": expr for name, expr in sums.items()})
    ranged = added.repartitionByRange(*([slices] if slices else []), *keys, *order)
    laid = stored(ranged.withColumn("_piece", F.spark_partition_id()), "running")
    piece = [*keys, "_piece"]
    totals = laid.groupBy(*piece).agg(*[F.sum(f"_add_{name}").alias(f"_sum_{name}") for name in sums])
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*piece, *[F.sum(f"_sum_{name}").over(before).alias(f"_carry_{name}") for name in sums])
    inside = Window.partitionBy(*piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = laid.withColumns({f"_add_{name}": F.sum(f"_add_{name}").over(inside) for name in sums})
    joined = join_null_safe(local, carried, piece)
    results = [
        F.when(F.col(f"_carry_{name}").isNull(), F.col(f"_add_{name}"))
        .otherwise(F.col(f"_add_{name}") + F.col(f"_carry_{name}")).alias(name)
        for name in sums
    ]
    return joined.select(*df.columns, *results)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; keeps the left keys."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])
