"""Data-quality rules on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abacarium.operators.grading import MARK_RULE
from abacarium.operators.quality import (
    Check, Domain, ForeignKey, NotNull, Unique, apply_rules, blocked_deletes, row_violations, rule_report, split_rows,
)
from abacarium.plans.catalog import query
from abacarium.plans.tables import Tables

UNIQUE_LINE = Unique("line number once per order", "lineitem", ("l_orderkey", "l_linenumber"))
UNIQUE_RETURN = Unique("one return per order", "lineitem", ("l_orderkey",), where="l_returnflag = 'R'")
UNIQUE_NAME = Unique("part names differ", "part", ("p_name",), ignore_case=True)
UNIQUE_ORDER = Unique("one order per customer and day", "orders", ("o_custkey", "o_orderdate"))
GIVEN_PRIORITY = NotNull("priority given", "orders", "priority")
QUANTITY = Check("quantity up to 45", "lineitem", "l_quantity <= 45")
DISCOUNT = Check("discount below 9 percent", "lineitem", "l_discount BETWEEN 0 AND 0.08")
NAME_FORM = Check("name is two words without a double letter", "part", "p_name RLIKE '^[a-z]+ [a-z]+$' AND NOT p_name RLIKE 'rr|ll|ee|tt|oo'")
NAME_LENGTH = Check("name has ten letters", "part", "char_length(p_name) >= 10")
KNOWN_STATUS = Domain("status known", "orders", "o_orderstatus", ("F", "O"))
KNOWN_PART = ForeignKey("line refers to a small part", "lineitem", ("l_partkey",), "small_part", ("p_partkey",))
KNOWN_ORDER = ForeignKey("line refers to a valid order", "lineitem", ("l_orderkey",), "valid_order", ("o_orderkey",))

RULES = [
    UNIQUE_LINE, UNIQUE_RETURN, UNIQUE_NAME, UNIQUE_ORDER, GIVEN_PRIORITY, QUANTITY, DISCOUNT, NAME_FORM, NAME_LENGTH,
    KNOWN_STATUS, KNOWN_PART, KNOWN_ORDER,
]
KEYS = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "part": ["p_partkey"]}


def _tables(t: Tables) -> dict[str, DataFrame]:
    return {
        "lineitem": t.lineitem, "part": t.part,
        "orders": t.orders.withColumn("priority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))),
        "valid_order": t.orders.where(F.col("o_orderstatus") != "P"),
        "small_part": t.part.where("p_size < 48"),
    }


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _found(rule: str, table: str, key: str, detail: str, source: str) -> str:
    return f"SELECT '{rule}' AS rule, '{table}' AS \"table\", {key} AS key, {detail} AS detail FROM {source}"


_LINE_KEY = "l_orderkey || '-' || l_linenumber"
_SQL = {
    UNIQUE_LINE: _found(UNIQUE_LINE.name, "lineitem", _LINE_KEY, "COUNT(*) || ' rows'",
                        "lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"),
    UNIQUE_RETURN: _found(UNIQUE_RETURN.name, "lineitem", "CAST(l_orderkey AS VARCHAR)", "COUNT(*) || ' rows'",
                          "lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey HAVING COUNT(*) > 1"),
    UNIQUE_NAME: _found(UNIQUE_NAME.name, "part", "lower(p_name)", "COUNT(*) || ' rows'",
                        "part GROUP BY lower(p_name) HAVING COUNT(*) > 1"),
    UNIQUE_ORDER: _found(UNIQUE_ORDER.name, "orders", "o_custkey || '-' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "COUNT(*) || ' rows'",
                         "orders GROUP BY o_custkey, o_orderdate HAVING COUNT(*) > 1"),
    GIVEN_PRIORITY: _found(GIVEN_PRIORITY.name, "orders", "CAST(o_orderkey AS VARCHAR)", "'priority is missing'",
                           "orders WHERE o_orderpriority = '5-LOW'"),
    QUANTITY: _found(QUANTITY.name, "lineitem", _LINE_KEY, "'not (l_quantity <= 45)'", "lineitem WHERE l_quantity > 45"),
    DISCOUNT: _found(DISCOUNT.name, "lineitem", _LINE_KEY, "'not (l_discount BETWEEN 0 AND 0.08)'",
                     "lineitem WHERE NOT (l_discount BETWEEN 0 AND 0.08)"),
    NAME_FORM: _found(NAME_FORM.name, "part", "CAST(p_partkey AS VARCHAR)", f"'not ({_quoted(NAME_FORM.condition)[1:-1]})'",
                      "part WHERE NOT (regexp_full_match(p_name, '[a-z]+ [a-z]+') AND NOT regexp_matches(p_name, 'rr|ll|ee|tt|oo'))"),
    NAME_LENGTH: _found(NAME_LENGTH.name, "part", "CAST(p_partkey AS VARCHAR)", "'not (char_length(p_name) >= 10)'",
                        "part WHERE length(p_name) < 10"),
    KNOWN_STATUS: _found(KNOWN_STATUS.name, "orders", "CAST(o_orderkey AS VARCHAR)", "'o_orderstatus = ' || o_orderstatus",
                         "orders WHERE o_orderstatus NOT IN ('F', 'O')"),
    KNOWN_PART: _found(KNOWN_PART.name, "lineitem", "CAST(l_partkey AS VARCHAR)", "COUNT(*) || ' rows'",
                       "lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 48) GROUP BY l_partkey"),
    KNOWN_ORDER: _found(KNOWN_ORDER.name, "lineitem", "CAST(l_orderkey AS VARCHAR)", "COUNT(*) || ' rows'",
                        "lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey"),
}


def _union(*rules) -> str:
    return " UNION ALL ".join(_SQL[rule] for rule in rules)


@query("dq_unique", _union(UNIQUE_LINE, UNIQUE_RETURN, UNIQUE_NAME, UNIQUE_ORDER))
def dq_unique(t: Tables) -> DataFrame:
    return apply_rules(_tables(t), [UNIQUE_LINE, UNIQUE_RETURN, UNIQUE_NAME, UNIQUE_ORDER], KEYS)


@query("dq_not_null", _SQL[GIVEN_PRIORITY])
def dq_not_null(t: Tables) -> DataFrame:
    return apply_rules(_tables(t), [GIVEN_PRIORITY], KEYS)


@query("dq_check", _union(QUANTITY, DISCOUNT, NAME_FORM, NAME_LENGTH))
def dq_check(t: Tables) -> DataFrame:
    return apply_rules(_tables(t), [QUANTITY, DISCOUNT, NAME_FORM, NAME_LENGTH], KEYS)


@query("dq_check_marks", """
SELECT 'marks in 0..100' AS rule, 'marks' AS "table", o_custkey || '-' || o_orderkey AS key,
       'not (marks BETWEEN 0 AND 100)' AS detail FROM orders WHERE o_orderkey % 103 > 100""")
def dq_check_marks(t: Tables) -> DataFrame:
    marks = t.orders.select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 103).alias("marks"))
    return row_violations(marks, [MARK_RULE], ["o_custkey", "o_orderkey"])


@query("dq_domain", _SQL[KNOWN_STATUS])
def dq_domain(t: Tables) -> DataFrame:
    return apply_rules(_tables(t), [KNOWN_STATUS], KEYS)


@query("dq_foreign_key", _union(KNOWN_PART, KNOWN_ORDER))
def dq_foreign_key(t: Tables) -> DataFrame:
    return apply_rules(_tables(t), [KNOWN_PART, KNOWN_ORDER], KEYS)


@query("dq_restrict", """
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'
  AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def dq_restrict(t: Tables) -> DataFrame:
    doomed = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")
    return blocked_deletes(doomed, t.orders, {"c_custkey": "o_custkey"})


@query("dq_split", """
SELECT l_returnflag, COUNT(*) FILTER (WHERE l_quantity <= 45 AND l_discount BETWEEN 0 AND 0.08) AS good,
       COUNT(*) FILTER (WHERE NOT (l_quantity <= 45 AND l_discount BETWEEN 0 AND 0.08)) AS bad,
       COUNT(*) FILTER (WHERE l_quantity > 45 AND NOT l_discount BETWEEN 0 AND 0.08) AS bad_twice
FROM lineitem GROUP BY l_returnflag""")
def dq_split(t: Tables) -> DataFrame:
    good, bad = split_rows(t.lineitem, [QUANTITY, DISCOUNT])
    both = good.select("l_returnflag", F.lit(0).alias("broken")).unionByName(
        bad.select("l_returnflag", F.size("broken_rules").alias("broken")))
    return both.groupBy("l_returnflag").agg(
        F.count_if(F.col("broken") == 0).alias("good"),
        F.count_if(F.col("broken") > 0).alias("bad"), F.count_if(F.col("broken") == 2).alias("bad_twice"))


_CATALOG = ", ".join(
    f"({_quoted(rule.table)}, {_quoted(rule.name)}, {_quoted(rule.kind)}, {_quoted(rule.clause())})" for rule in RULES)


@query("dq_catalog", f"""
WITH found AS ({_union(*_SQL)}), n AS (SELECT rule, COUNT(*) AS violations FROM found GROUP BY rule)
SELECT c."table", c.rule, c.kind, c.clause, COALESCE(n.violations, 0) AS violations
FROM (VALUES {_CATALOG}) c("table", rule, kind, clause) LEFT JOIN n ON n.rule = c.rule""")
def dq_catalog(t: Tables) -> DataFrame:
    return rule_report(t.spark, _tables(t), RULES)
