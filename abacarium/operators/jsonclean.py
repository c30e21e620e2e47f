"""Nested JSON records to a flat, clean table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructType

from abacarium.functions import parse_or_null
from abacarium.sources.files import sink_csv

# Columns kept from a repository record, in output order, and the text for a missing description.
REPOSITORY_COLUMNS = (
    "id", "name", "full_name", "owner.login", "html_url", "description", "language", "stargazers_count",
    "forks_count", "open_issues_count", "created_at", "updated_at",
)
NO_DESCRIPTION = "No description"


@dataclass(frozen=True)
class CleanConfig:
    """What :func:`clean` keeps, parses, fills and renames; dotted names for nested fields."""

    columns: Sequence[str] = REPOSITORY_COLUMNS
    dates: Sequence[str] = ("created_at", "updated_at")
    fills: Mapping[str, str] = field(default_factory=lambda: {"description": NO_DESCRIPTION})
    renames: Mapping[str, str] = field(default_factory=lambda: {"owner.login": "owner"})
    drop_empty_columns: bool = False


def read_records(spark: SparkSession, path: str, record: StructType, multi_line: bool = True) -> DataFrame:
    """Records of landed JSON payloads: ``{"items": [...]}``, one object or a bare list.

    ``multi_line=False`` reads one payload per line, which splits large files.
    """
    schema = StructType([*record.fields]).add("items", ArrayType(record))
    payloads = (
        spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    )
    alone = F.array(F.struct(*[F.col(f"`{f.name}`") for f in record.fields]))
    return payloads.select(F.inline(F.coalesce("items", alone)))


def quoted(name: str) -> str:
    """A column name that may hold dots and backticks, as Spark's ``col`` takes it."""
    return "`" + name.replace("`", "``") + "`"


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs to columns with dotted names; lists stay as they are."""
    return df.select(*_leaves(df.schema, ()))


def _leaves(schema: StructType, path: tuple[str, ...]) -> list[Column]:
    found = []
    for f in schema.fields:
        here = (*path, f.name)
        if isinstance(f.dataType, StructType):
            found += _leaves(f.dataType, here)
        else:
            found.append(F.col(".".join(quoted(part) for part in here)).alias(".".join(here)))
    return found


def clean(records: DataFrame, config: CleanConfig | None = None) -> DataFrame:
    """Flatten, keep listed columns, drop duplicates, parse dates, fill and rename.

    With ``drop_empty_columns`` columns without any value vanish, before the fill;
    that looks at the data first, in one aggregate.
    """
    config = config or CleanConfig()
    flat = flatten(records)
    kept = [c for c in config.columns if c in flat.columns] or flat.columns
    out = flat.select(*[F.col(quoted(c)) for c in kept])
    if config.drop_empty_columns:
        # Counted with the duplicates, which cannot change whether a column is empty.
        filled = out.agg(*[F.count(quoted(c)).alias(c) for c in kept]).first()
        kept = [c for c in kept if filled[c] > 0]
    final = []
    for c in kept:
        value = F.col(quoted(c))
        if c in config.dates:
            value = parse_or_null(value)
        if c in config.fills:
            value = F.coalesce(value, F.lit(config.fills[c]))
        final.append(value.alias(config.renames.get(c, c)))
    return out.dropDuplicates().select(*final)


def json_etl(
    spark: SparkSession, source: str, target: str, record: StructType, config: CleanConfig | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read payloads, clean them, write CSV files with a header, return the clean rows."""
    rows = clean(read_records(spark, source, record, multi_line), config)
    sink_csv(rows, target)
    return rows
