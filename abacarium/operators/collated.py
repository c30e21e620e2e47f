"""Text columns that ignore case, or case and accents, wherever they are compared.

The collation belongs to the column's type, so joins, groups, distinct rows, windows,
sorts and predicates follow it without ``lower()`` around each use. Parquet keeps the
type. Which of several spellings a group shows is open; take ``min`` of the plain
column beside it where that matters.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

#: Ignores case, and still allows LIKE.
CASELESS = "UTF8_LCASE"
#: Ignores case and accents, by the Unicode rules.
ACCENTLESS = "UNICODE_CI_AI"
PLAIN = "UTF8_BINARY"


def collated_schema(schema: StructType, collation: str = CASELESS, columns: Iterable[str] | None = None) -> StructType:
    """``schema`` with the text columns (those in ``columns``, or all, also nested ones) under ``collation``."""
    wanted = None if columns is None else set(columns)
    if wanted is not None and wanted - set(schema.fieldNames()):
        raise ValueError(f"no such columns: {sorted(wanted - set(schema.fieldNames()))}")
    return StructType([
        StructField(f.name, _collated(f.dataType, collation) if wanted is None or f.name in wanted else f.dataType, f.nullable, f.metadata)
        for f in schema.fields])


def _collated(kind: DataType, collation: str) -> DataType:
    if isinstance(kind, StringType):
        return StringType(collation)
    if isinstance(kind, ArrayType):
        return ArrayType(_collated(kind.elementType, collation), kind.containsNull)
    if isinstance(kind, StructType):
        return collated_schema(kind, collation)
    return kind


def read_collated(spark: SparkSession, path: str, schema: StructType, collation: str = CASELESS, columns: Iterable[str] | None = None) -> DataFrame:
    """A Parquet table whose text columns compare under ``collation``; the files need not know it."""
    return spark.read.schema(collated_schema(schema, collation, columns)).parquet(path)


def with_collation(df: DataFrame, collation: str = CASELESS, columns: Iterable[str] | None = None) -> DataFrame:
    """``df`` with its text columns under ``collation``; ``UTF8_BINARY`` takes it off again."""
    schema = collated_schema(df.schema, collation, columns)
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
