"""Updates, deletes and schema changes as snapshot rewrites."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StructType

from abacarium.operators.joins import with_match, without_match


def conditional_update(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE: rows of an unknown condition stay as they are."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(*[
        F.when(hit, changes[c].cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in changes else c
        for c in df.columns
    ])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE ... WHERE: rows of an unknown condition stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


@dataclass(frozen=True)
class Link:
    """A foreign key and what deleting its parent does: cascade, set null or restrict."""

    child: str
    child_column: str
    parent: str
    parent_column: str
    on_delete: str


def propagate_delete(
    tables: Mapping[str, DataFrame], links: Sequence[Link], root: str, key: str, doomed: DataFrame
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Delete the rows ``doomed`` of ``root`` (unique ``key``) and follow the links.

    Returns the tables afterwards, and per RESTRICT link the child rows that
    forbid the delete (the caller must not use the tables unless all of these
    are empty). Links must be listed parents first.
    """
    after = dict(tables)
    going: dict[str, DataFrame] = {root: doomed}
    forbidding: dict[str, DataFrame] = {}
    for link in links:
        if link.parent not in going:
            continue
        on = {link.child_column: link.parent_column}
        child, gone = tables[link.child], going[link.parent]
        if link.on_delete == "cascade":
            hit = with_match(child, gone, on)
            going[link.child] = going[link.child].unionByName(hit) if link.child in going else hit
            after[link.child] = without_match(after[link.child], gone, on)
        elif link.on_delete == "set null":
            keys = gone.select(F.col(link.parent_column).alias("_gone")).distinct()
            rows, known = after[link.child], F.col(link.child_column).isNotNull()
            # Rows without a parent stay out of the join, where they would be one hot key.
            joined = rows.where(known).join(keys, F.col(link.child_column) == F.col("_gone"), "left")
            cut = joined.withColumn(
                link.child_column, F.when(F.col("_gone").isNull(), F.col(link.child_column))
            ).drop("_gone")
            after[link.child] = cut.unionByName(rows.where(~known))
        else:
            forbidding[f"{link.child}.{link.child_column}"] = with_match(child, gone, on)
    after[root] = without_match(after[root], doomed, {key: key})
    return after, forbidding


def apply_defaults(df: DataFrame, schema: StructType, defaults: Mapping[str, Column]) -> DataFrame:
    """Add omitted columns with their default, or NULL; explicit NULLs stay NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def evolve_schema(
    df: DataFrame,
    add: Mapping[str, Column] | None = None,
    widen: Mapping[str, DataType | str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """ALTER TABLE: add columns with a default, change types, drop columns."""
    out = df.withColumns(dict(add)) if add else df
    if widen:
        out = out.withColumns({name: F.col(name).cast(kind) for name, kind in widen.items()})
    return out.drop(*drop)


def reset_table(df: DataFrame, path: str) -> DataFrame:
    """Leave an empty table of the same schema at ``path`` and return it."""
    df.limit(0).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def next_key(last_key: int, truncated: bool) -> int:
    """The next key after emptying a table: TRUNCATE restarts the counter, DELETE does not."""
    return 1 if truncated else last_key + 1
