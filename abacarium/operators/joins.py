"""Join shapes that stay parallel when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def without_match(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of ``left`` with no partner in ``right`` (NOT EXISTS).

    ``on`` maps left to right columns. The right keys are made distinct first:
    the map-side combine shrinks a hot key to one row per task, and the result
    has the partitioning that the join wants.
    """
    return left.join(_distinct_keys(right, on), _key_condition(on), "left_anti")


def with_match(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of ``left`` with a partner in ``right`` (EXISTS, IN)."""
    return left.join(_distinct_keys(right, on), _key_condition(on), "left_semi")


def not_in(left: DataFrame, column: str, right: DataFrame, right_column: str) -> DataFrame:
    """SQL ``column NOT IN (SELECT right_column ...)`` with its NULL rules.

    Nothing qualifies once the right side holds a NULL, everything if it is
    empty. Spark plans the SQL form as a null-aware join that broadcasts the
    right side whatever its size; here two scalar subqueries carry the NULL
    rules and a plain anti join does the rest.
    """
    values = right.select(F.col(right_column).alias("_value"))
    has_null = values.agg(F.coalesce(F.bool_or(F.col("_value").isNull()), F.lit(False))).scalar()
    is_empty = values.agg(F.count(F.lit(1)) == 0).scalar()
    candidates = left.where(~has_null).where(F.col(column).isNotNull() | is_empty)
    return candidates.join(
        values.where(F.col("_value").isNotNull()).distinct(), F.col(column) == F.col("_value"), "left_anti"
    )


def full_outer_rows(one: DataFrame, many: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """All rows of both sides, matched where possible, duplicates removed.

    ``on`` maps columns of ``one`` to columns of ``many``. A full outer join
    cannot split a skewed key; an outer join from the ``many`` side can, and an
    anti join adds the rows of ``one`` that found no partner.
    """
    both = many.join(one, [F.col(l) == F.col(r) for l, r in on.items()], "left")
    alone = without_match(one, many, on)
    columns = [*one.columns, *many.columns]
    alone = alone.select(
        *one.columns, *[F.lit(None).cast(many.schema[c].dataType).alias(c) for c in many.columns]
    )
    return both.select(*columns).unionByName(alone.select(*columns)).distinct()


def pair_counts(
    lines: DataFrame, basket: str, item: str, names: tuple[str, str, str] = ("item_a", "item_b", "times"),
) -> DataFrame:
    """How often two items share a basket, each unordered pair once.

    The items of a basket are made distinct first. Both sides of the self-join read
    one shuffle, whose large partitions adaptive execution can split. Counts are
    combined before they are shuffled.
    """
    items = lines.select(F.col(basket).alias("_basket"), F.col(item).alias(names[0])).distinct()
    meet = items.join(items.withColumnRenamed(names[0], names[1]), "_basket").where(F.col(names[0]) < F.col(names[1]))
    return meet.groupBy(names[0], names[1]).agg(F.count(F.lit(1)).alias(names[2]))


def bought_all(lines: DataFrame, who: str | Sequence[str], what: str, wanted: Sequence) -> DataFrame:
    """The keys ``who`` that have every value of ``wanted`` in ``what`` (relational division)."""
    keys = [who] if isinstance(who, str) else list(who)
    return (
        lines.where(F.col(what).isin(*wanted))
        .select(*keys, what)
        .distinct()
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_found"))
        .where(F.col("_found") == len(set(wanted)))
        .select(*keys)
    )


def above_average(df: DataFrame, total: str, weight: str | None = None) -> DataFrame:
    """Rows whose average ``total / weight`` exceeds the average over all rows.

    ``weight`` is the number of values in ``total`` (one if not named). The two
    numbers of the comparison are scalar subqueries, there is no cross join; it is
    made on products, so that it is exact in decimals.
    """
    number = F.col(weight) if weight else F.lit(1)
    all_totals = df.agg(F.sum(total)).scalar()
    all_numbers = df.agg(F.sum(number) if weight else F.count(total)).scalar()
    return df.where(F.col(total) * all_numbers > all_totals * number)


def _distinct_keys(right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    return right.select(*[F.col(r).alias(f"_k{i}") for i, r in enumerate(on.values())]).distinct()


def _key_condition(on: Mapping[str, str]) -> list[Column]:
    return [F.col(l) == F.col(f"_k{i}") for i, l in enumerate(on)]
