"""Pieces of SQL that the checks share."""

from __future__ import annotations

LINES = """li AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS gross,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net,
         ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS net_amount,
         CAST(l_quantity AS BIGINT) AS units, strftime(l_shipdate, '%Y-%m') AS ym
  FROM lineitem)"""

SUMMARY = LINES + """, os AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, SUM(gross) AS gross_amount,
         ROUND(SUM(net), 2) AS net_amount
  FROM orders JOIN li ON l_orderkey = o_orderkey
  GROUP BY o_orderkey, o_custkey, o_orderstatus, o_orderdate),
sales AS (SELECT * FROM os WHERE o_orderstatus IN ('F', 'O'))"""

MONTHS = LINES + """, months AS (SELECT ym, SUM(net_amount) AS revenue FROM li GROUP BY ym)"""

VALID_LINES = LINES + """, vl AS (
  SELECT * FROM li JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('F', 'O'))"""

LEDGER = """led AS (
  SELECT user_id AS account_id, ts, event_id AS seq, event_type AS type, CAST(value AS DECIMAL(12,2)) AS amount,
         CASE WHEN event_type IN ('signup', 'purchase') THEN CAST(value AS DECIMAL(12,2))
              WHEN event_type IN ('click', 'error') THEN -CAST(value AS DECIMAL(12,2)) ELSE 0 END AS delta
  FROM events)"""

ACCOUNTS = """acc AS (
  SELECT account_id, CASE account_id % 3 WHEN 0 THEN 'base' WHEN 1 THEN 'savings' ELSE 'current' END AS kind,
         CASE account_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 500 ELSE -1000 END AS floor
  FROM (SELECT DISTINCT user_id AS account_id FROM events))"""


def dbl(expr: str) -> str:
    """Money as a double with two decimals."""
    return f"CAST(ROUND({expr}, 2) AS DOUBLE)"


def rounded(numerator: str, denominator: str, times: int = 1) -> str:
    """``times * a / b`` rounded to two decimals, exact in whole numbers."""
    n, d = f"CAST(({numerator}) * 10000 AS HUGEINT)", f"NULLIF(CAST(({denominator}) * 10000 AS HUGEINT), 0)"
    return (
        f"CAST(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END"
        f" * ((ABS({n}) * {200 * times} + ABS({d})) // (2 * ABS({d}))) AS DOUBLE) / 100"
    )


def mean(total: str, count: str) -> str:
    return rounded(total, count)


def pct(numerator: str, denominator: str) -> str:
    return rounded(numerator, denominator, 100)
