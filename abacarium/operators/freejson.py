"""JSON records whose fields nobody declared.

Payloads are parsed into Spark's VARIANT, which keeps every field of every record.
One distributed aggregate unites the fields and types of all records (the result has
the size of the schema); then each nested path is one typed expression, and from
there the table is cleaned like a declared one. Both steps scan the payloads; nothing
but the schema comes to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, NullType, StringType, StructType, VariantType

from abacarium.operators.jsonclean import CleanConfig, clean, quoted
from abacarium.sources.files import sink_csv

#: Records whose keys are data rather than names would make a column of each key.
MOST_COLUMNS = 2000
_QUOTED_OR_OBJECT = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<")


def read_free(spark: SparkSession, path: str, multi_line: bool = True, envelope: str = "items") -> DataFrame:
    """``record`` (VARIANT) per record of landed payloads: one object, a bare list, or a list under ``envelope``.

    ``multi_line=False`` reads a payload per line, which splits large files. Blank
    payloads have no record; one that is no JSON fails the read.
    """
    return free_records(spark.read.text(path, wholetext=multi_line), "value", envelope)


def free_records(payloads: DataFrame, column: str, envelope: str = "items") -> DataFrame:
    """``record`` per record of the payloads in a text column; a NULL payload has none.

    An object whose ``envelope`` is no list is a record of its own.
    """
    parsed = payloads.where(F.trim(F.regexp_replace(column, r"\s+", " ")) != "").select(F.parse_json(column).alias("payload"))
    inner = F.try_variant_get("payload", _path((envelope,)), "array<variant>")
    bare = F.try_variant_get("payload", "$", "array<variant>")
    return parsed.select(F.explode(F.coalesce(inner, bare, F.array("payload"))).alias("record"))


def _path(names: tuple[str, ...]) -> str:
    """The path of nested fields; names may hold dots and blanks."""
    out = "$"
    for name in names:
        mark = '"' if '"' not in name else "'"
        if mark in name:
            raise ValueError(f"a field name with both kinds of quotes: {name}")
        out += f"[{mark}{name}{mark}]"
    return out


def record_schema(records: DataFrame, column: str = "record") -> StructType:
    """The fields of all records, united; a field with several types is VARIANT, one that is always null VOID."""
    found = records.agg(F.schema_of_variant_agg(column)).first()[0]
    kind = DataType.fromDDL(_QUOTED_OR_OBJECT.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found))
    if isinstance(kind, NullType):
        return StructType()
    if not isinstance(kind, StructType):
        raise ValueError(f"records have to be objects, not {found[:200]}")
    return kind


def _leaves(schema: StructType, path: tuple[str, ...] = ()) -> Iterable[tuple[tuple[str, ...], DataType]]:
    for f in schema.fields:
        if isinstance(f.dataType, StructType) and f.dataType.fields:
            yield from _leaves(f.dataType, (*path, f.name))
        else:
            yield (*path, f.name), f.dataType


def _plain(kind: DataType) -> bool:
    """Whether all values of a list have one type."""
    if isinstance(kind, ArrayType):
        return _plain(kind.elementType)
    if isinstance(kind, StructType):
        return bool(kind.fields) and all(_plain(f.dataType) for f in kind.fields)
    return not isinstance(kind, (NullType, VariantType))


def _value(column: str, path: tuple[str, ...], kind: DataType, as_text: bool) -> Column:
    at = _path(path)
    if isinstance(kind, NullType):
        return F.lit(None).cast(StringType())
    if as_text or isinstance(kind, (VariantType, StructType)) or isinstance(kind, ArrayType) and not _plain(kind):
        # Scalars of mixed types as their text, lists and objects as JSON.
        return F.try_variant_get(column, at, "string")
    return F.try_variant_get(column, at, kind.simpleString())


def flatten_free(records: DataFrame, schema: StructType | None = None, columns: Iterable[str] | None = None,
                 text: Iterable[str] = (), column: str = "record") -> DataFrame:
    """Nested fields to columns with dotted names; lists stay whole.

    ``columns``: only these, where present (all, if none is). Columns in ``text`` become
    strings. Lists of one type are arrays; mixed ones, and fields with values of several
    types, are strings. Two paths with one dotted name are an error, and so are more
    than ``MOST_COLUMNS`` columns.
    """
    schema = record_schema(records, column) if schema is None else schema
    found = [(".".join(path), path, kind) for path, kind in _leaves(schema)]
    wanted = set(columns or ())
    kept = [f for f in found if f[0] in wanted] or found
    if len(kept) > MOST_COLUMNS:
        raise ValueError(f"{len(kept)} columns: keys of these records are data; list the columns to keep")
    if len({name for name, _, _ in kept}) < len(kept):
        raise ValueError("two fields have the same dotted name")
    return records.select(*[_value(column, path, kind, name in set(text)).alias(name) for name, path, kind in kept])


def infer_clean(records: DataFrame, config: CleanConfig | None = None, column: str = "record") -> DataFrame:
    """``clean`` for records without a declared type; columns without any value vanish, as they have no type.

    No record at all gives an empty table without columns.
    """
    config = config or CleanConfig()
    schema = record_schema(records, column)
    if not schema.fields:
        return records.sparkSession.createDataFrame([], StructType())
    flat = flatten_free(records, schema, config.columns, (*config.dates, *config.fills), column)
    void = {".".join(path) for path, kind in _leaves(schema) if isinstance(kind, NullType)}
    return clean(flat.select(*[F.col(quoted(c)) for c in flat.columns if c not in void]), config)


def infer_etl(spark: SparkSession, source: str, target: str, config: CleanConfig | None = None, multi_line: bool = True) -> DataFrame:
    """Read payloads, find their fields, clean them, write CSV files with a header, return the clean rows.

    CSV has no lists; they are written as JSON.
    """
    rows = infer_clean(read_free(spark, source, multi_line), config)
    nested = [f.name for f in rows.schema.fields if isinstance(f.dataType, (ArrayType, StructType))]
    if rows.columns:
        sink_csv(rows.withColumns({c: F.to_json(F.col(quoted(c))) for c in nested}), target)
    return rows
