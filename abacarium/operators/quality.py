"""Declared constraints as data-quality rules.

Parquet tables enforce no keys, references or checks, so a rule set is run over
the data and yields its violations: ``rule, table, key, detail``. All row rules
of a table share one scan; key and reference rules combine before they shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from abacarium.operators.joins import with_match


@dataclass(frozen=True)
class NotNull:
    name: str
    table: str
    column: str
    kind: str = field(default="not null", init=False)

    def broken(self) -> Column:
        return F.col(self.column).isNull()

    def detail(self) -> Column:
        return F.lit(f"{self.column} is missing")

    def clause(self) -> str:
        return f"{self.column} IS NOT NULL"


@dataclass(frozen=True)
class Check:
    """A SQL condition; as in SQL an unknown result passes."""

    name: str
    table: str
    condition: str
    kind: str = field(default="check", init=False)

    def broken(self) -> Column:
        return F.coalesce(~F.expr(self.condition), F.lit(False))

    def detail(self) -> Column:
        return F.lit(f"not ({self.condition})")

    def clause(self) -> str:
        return self.condition


@dataclass(frozen=True)
class Domain:
    name: str
    table: str
    column: str
    values: tuple
    kind: str = field(default="domain", init=False)

    def broken(self) -> Column:
        return F.coalesce(~F.col(self.column).isin(*self.values), F.lit(False))

    def detail(self) -> Column:
        return F.concat(F.lit(f"{self.column} = "), F.col(self.column).cast("string"))

    def clause(self) -> str:
        return f"{self.column} IN ({', '.join(map(str, self.values))})"


@dataclass(frozen=True)
class Unique:
    """No two rows agree in ``columns``; rows with a NULL there never collide.

    ``where`` restricts the rule to some rows; ``ignore_case`` compares text as a
    case-insensitive collation does.
    """

    name: str
    table: str
    columns: tuple[str, ...]
    where: str | None = None
    ignore_case: bool = False
    kind: str = field(default="unique", init=False)

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        df = tables[self.table]
        if self.where:
            df = df.where(self.where)
        text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
        keys = [
            (F.lower(c) if self.ignore_case and c in text else F.col(c)).alias(f"_{i}")
            for i, c in enumerate(self.columns)
        ]
        named = [f"_{i}" for i in range(len(self.columns))]
        return (
            df.select(*keys)
            .na.drop(subset=named)
            .groupBy(*named)
            .agg(F.count(F.lit(1)).alias("_rows"))
            .where("_rows > 1")
            .select(*_as_violation(self, _key_text(named), F.concat(F.col("_rows").cast("string"), F.lit(" rows"))))
        )

    def clause(self) -> str:
        return f"({', '.join(self.columns)})" + (f" WHERE {self.where}" if self.where else "")


@dataclass(frozen=True)
class ForeignKey:
    """Every non-NULL reference has a parent; one violation per missing parent."""

    name: str
    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    kind: str = field(default="foreign key", init=False)

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        named = [f"_{i}" for i in range(len(self.columns))]
        children = (
            tables[self.table]
            .select(*[F.col(c).alias(n) for c, n in zip(self.columns, named, strict=True)])
            .na.drop(subset=named)
            .groupBy(*named)
            .agg(F.count(F.lit(1)).alias("_rows"))
        )
        parents = (
            tables[self.parent]
            .select(*[F.col(c).alias(n) for c, n in zip(self.parent_columns, named, strict=True)])
            .distinct()
        )
        return children.join(parents, named, "left_anti").select(
            *_as_violation(self, _key_text(named), F.concat(F.col("_rows").cast("string"), F.lit(" rows")))
        )

    def clause(self) -> str:
        return f"({', '.join(self.columns)}) REFERENCES {self.parent} ({', '.join(self.parent_columns)})"


ROW_RULES = (NotNull, Check, Domain)
Rule = NotNull | Check | Domain | Unique | ForeignKey


def _key_text(columns: Sequence[str]) -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in columns])


def _as_violation(rule: Rule, key: Column, detail: Column) -> list[Column]:
    return [F.lit(rule.name).alias("rule"), F.lit(rule.table).alias("table"), key.alias("key"), detail.alias("detail")]


def row_violations(df: DataFrame, rules: Sequence[Rule], key: Sequence[str]) -> DataFrame:
    """One row per broken row rule, all rules in one scan."""
    found = F.array(*[
        F.when(rule.broken(), F.struct(*_as_violation(rule, _key_text(key), rule.detail()))) for rule in rules
    ])
    return df.select(F.inline(F.array_compact(found)))


def apply_rules(
    tables: Mapping[str, DataFrame], rules: Sequence[Rule], keys: Mapping[str, Sequence[str]]
) -> DataFrame:
    """The violations of all ``rules``; ``keys`` names the columns that identify a row."""
    parts = []
    for table in dict.fromkeys(rule.table for rule in rules):
        of_rows = [rule for rule in rules if rule.table == table and isinstance(rule, ROW_RULES)]
        if of_rows:
            parts.append(row_violations(tables[table], of_rows, keys[table]))
    parts += [rule.violations(tables) for rule in rules if not isinstance(rule, ROW_RULES)]
    return reduce(DataFrame.unionByName, parts)


def split_rows(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all row rules, and the others with ``broken_rules``."""
    broken = F.array_compact(F.array(*[F.when(rule.broken(), F.lit(rule.name)) for rule in rules]))
    marked = df.withColumn("broken_rules", broken)
    return marked.where(F.size("broken_rules") == 0).drop("broken_rules"), marked.where(F.size("broken_rules") > 0)


def blocked_deletes(doomed: DataFrame, child: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of ``doomed`` that may not go because a child row refers to them (RESTRICT)."""
    return with_match(doomed, child, on)


def rule_catalog(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules as a table: ``table, rule, kind, clause``."""
    rows = [(rule.table, rule.name, rule.kind, rule.clause()) for rule in rules]
    return spark.createDataFrame(rows, "table string, rule string, kind string, clause string")


def rule_report(
    spark: SparkSession, tables: Mapping[str, DataFrame], rules: Sequence[Rule]
) -> DataFrame:
    """The catalogue with the number of violations of each rule."""
    counts = reduce(DataFrame.unionByName, _counts(tables, rules))
    return (
        rule_catalog(spark, rules)
        .join(counts, ["table", "rule"], "left")
        .withColumn("violations", F.coalesce("violations", F.lit(0).cast("long")))
    )


def _counts(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> list[DataFrame]:
    """``table, rule, violations``; all row rules of a table are counted in one aggregate over one scan."""
    parts = []
    for table in dict.fromkeys(rule.table for rule in rules):
        of_rows = [rule for rule in rules if rule.table == table and isinstance(rule, ROW_RULES)]
        if of_rows:
            one = tables[table].agg(*[F.count_if(rule.broken()).alias(f"_{i}") for i, rule in enumerate(of_rows)])
            parts.append(one.select(F.lit(table).alias("table"), F.inline(F.array(*[
                F.struct(F.lit(rule.name).alias("rule"), F.col(f"_{i}").alias("violations")) for i, rule in enumerate(of_rows)]))))
    for rule in rules:
        if not isinstance(rule, ROW_RULES):
            parts.append(rule.violations(tables).agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(rule.table).alias("table"), F.lit(rule.name).alias("rule"), "violations"))
    return parts
