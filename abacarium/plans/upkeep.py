"""Tables that are kept up: collated text, summaries by deltas, single partitions, sketches, bands, dirty files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from abacarium.functions import from_cents, month_label, to_double
from abacarium.operators.bandjoin import band_join
from abacarium.operators.collated import read_collated, with_collation
from abacarium.operators.facts import partition_audit, route
from abacarium.operators.ordering import global_index
from abacarium.operators.partitions import archive_partitions, partition_files, replace_partitions
from abacarium.operators.sketches import sketch_table, united
from abacarium.operators.summaries import MonthlySummary, signed_delta
from abacarium.operators.windows import dedupe_latest
from abacarium.plans.catalog import query
from abacarium.plans.checks import LINES, dbl
from abacarium.plans.tables import DECLARED, SCHEMAS, Tables
from abacarium.session import scratch_path, stored
from abacarium.sources.clustered import clustered_lookup, rows_scanned, write_clustered
from abacarium.sources.dirty import load_tolerant

# Text that ignores case.


def _typed(name: str, number: str) -> Column:
    """A name as people type it: as it is, in small letters, in mixed case."""
    n = F.col(number) % 3
    return F.when(n == 0, F.col(name)).when(n == 1, F.lower(name)).otherwise(F.initcap(name))


@query("ci_join", """
SELECT n_name, COUNT(*) AS customers, COUNT(DISTINCT c_custkey % 3) AS spellings FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def ci_join(t: Tables) -> DataFrame:
    named = t.customer.withColumn("name", F.concat(F.lit("NATION_"), "c_nationkey"))
    typed = with_collation(named.select("c_custkey", _typed("name", "c_custkey").alias("typed")), columns=["typed"])
    nation = read_collated(t.spark, f"{t.folder}/nation.parquet", StructType.fromDDL(SCHEMAS["nation"]))
    joined = typed.join(nation, typed["typed"] == nation["n_name"])
    spelled = F.count_distinct(F.col("typed").cast("string collate UTF8_BINARY"))
    counts = joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"), spelled.alias("spellings"))
    return with_collation(counts, "UTF8_BINARY")


@query("ci_distinct", "SELECT c_mktsegment AS segment, COUNT(*) AS customers, ROW_NUMBER() OVER (ORDER BY c_mktsegment) AS place FROM customer GROUP BY 1")
def ci_distinct(t: Tables) -> DataFrame:
    typed = with_collation(t.customer.select(_typed("c_mktsegment", "c_custkey").alias("segment")))
    counts = typed.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    shown = with_collation(counts, "UTF8_BINARY").withColumn("segment", F.upper("segment"))
    return global_index(shown, ["segment"], "place").select("segment", "customers", F.col("place").cast("long").alias("place"))


@query("ci_latest", """
SELECT lower(p_name) AS name, MAX(p_partkey) AS p_partkey, ANY_VALUE(n) AS spelled FROM part
JOIN (SELECT lower(p_name) AS k, COUNT(*) AS n FROM part GROUP BY 1) ON k = lower(p_name) GROUP BY 1""")
def ci_latest(t: Tables) -> DataFrame:
    # DISTINCT ON and a window over names that differ in case alone.
    typed = with_collation(t.part.select(_typed("p_name", "p_partkey").alias("name"), "p_partkey"), columns=["name"])
    counts = typed.groupBy("name").agg(F.count(F.lit(1)).alias("spelled"))
    latest = dedupe_latest(typed, ["name"], ["p_partkey"]).join(counts, "name")
    return with_collation(latest, "UTF8_BINARY").select(F.lower("name").alias("name"), "p_partkey", "spelled")


# A summary by deltas.

_DELTA_SALES = f"""{LINES}, turned AS (SELECT *, l_orderkey % 10 AS turn, ym BETWEEN '1996-01' AND '1996-03' AS spring FROM li), kept AS (
  SELECT CASE WHEN spring AND turn = 3 THEN '1997-02' ELSE ym END AS month, p_type AS category, l_orderkey,
         net_amount * CASE WHEN spring AND turn = 4 THEN 2 ELSE 1 END AS revenue, units
  FROM turned JOIN part ON p_partkey = l_partkey
  WHERE ym NOT IN ('1998-05', '1998-06') OR turn <> 5 AND NOT (turn = 6 AND l_linenumber = 1))"""


@query("summary_by_deltas", f"""
WITH {_DELTA_SALES}
SELECT month, category, {dbl("SUM(revenue)")} AS revenue, SUM(units) AS units, COUNT(DISTINCT l_orderkey) AS orders FROM kept GROUP BY month, category""")
def summary_by_deltas(t: Tables) -> DataFrame:
    rows = t.lines.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        month_label("l_shipdate").alias("month"), F.col("p_type").alias("category"), "l_orderkey", "l_linenumber",
        F.col("net_cents").alias("cents"), "units")
    rows, turn = stored(rows, "sales"), F.col("l_orderkey") % 10
    late, spring, summer = (turn == 7) & (F.col("month") >= "1998-10"), F.col("month").between("1996-01", "1996-03"), F.col("month").isin("1998-05", "1998-06")
    columns = ["month", "category", "l_orderkey", "cents", "units"]
    table = MonthlySummary(t.spark, scratch_path(t.spark, "summary"), {"category": "string"}, ("l_orderkey", "bigint"), ["cents", "units"])
    table.apply(signed_delta(rows.where(~late).select(*columns)), 1)
    # What came late; orders that moved to another month and lines with another price; orders and lines that were taken back.
    table.apply(signed_delta(rows.where(late).select(*columns)), 2)
    changed = rows.where(spring & turn.isin(3, 4))
    table.apply(signed_delta(changed.withColumns({
        "month": F.when(turn == 3, "1997-02").otherwise(F.col("month")), "cents": F.when(turn == 4, F.col("cents") * 2).otherwise(F.col("cents"))}).select(*columns),
        changed.select(*columns)), 3)
    table.apply(signed_delta(deleted=rows.where(summer & ((turn == 5) | (turn == 6) & (F.col("l_linenumber") == 1))).select(*columns)), 4)
    return table.read().select("month", "category", to_double(from_cents("cents")).alias("revenue"), "units", "orders")


# Single partitions.

_PART = "CASE WHEN strftime(l_shipdate, '%Y-%m') BETWEEN '1996-01' AND '1996-12' THEN strftime(l_shipdate, '%Y-%m') ELSE 'default' END"


def _fact(t: Tables) -> tuple[DataFrame, str]:
    rows = route(t.lines.select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", from_cents("gross_cents").alias("amount")), "l_shipdate", DECLARED)
    path = scratch_path(t.spark, "fact")
    rows.hint("rebalance", "order_month").write.partitionBy("order_month").parquet(path)
    return t.spark.read.schema(rows.schema).parquet(path), path


@query("replace_month", f"""
WITH {LINES}, a AS (SELECT {_PART} AS order_month, * FROM li)
SELECT order_month, COUNT(*) AS row_count, {dbl("SUM(gross)")} AS revenue, order_month <> '1996-03' AS same_files
FROM a WHERE NOT (order_month = '1996-03' AND l_returnflag = 'R') GROUP BY order_month""")
def replace_month(t: Tables) -> DataFrame:
    # March is delivered again without the lines that were returned.
    fact, path = _fact(t)
    before = stored(partition_files(fact, "order_month"), "files")
    after = replace_partitions(t.spark, fact.where("order_month = '1996-03' AND l_returnflag <> 'R'"), path, "order_month")
    files = partition_files(after, "order_month")
    same = files.join(before, ["order_month", "file", "changed"], "left_semi").groupBy("order_month").agg(F.count(F.lit(1)).alias("same"))
    every = before.unionByName(files).distinct().groupBy("order_month").agg(F.count(F.lit(1)).alias("every"))
    kept = every.join(same, "order_month", "left").select("order_month", F.col("every").eqNullSafe(F.col("same")).alias("same_files"))
    return partition_audit(after, "amount").withColumn("revenue", to_double("revenue")).join(kept, "order_month")


@query("archive_month", f"""
WITH {LINES}, a AS (SELECT {_PART} AS order_month, * FROM li)
SELECT CASE WHEN order_month IN ('1996-01', '1996-02') THEN 'archive' ELSE 'table' END AS held_in, order_month, COUNT(*) AS row_count,
       {dbl("SUM(gross)")} AS revenue FROM a GROUP BY 1, 2""")
def archive_month(t: Tables) -> DataFrame:
    fact, path = _fact(t)
    left, archived = archive_partitions(t.spark, path, fact.schema, "order_month", ["1996-01", "1996-02"], scratch_path(t.spark, "archive"))
    parts = [partition_audit(df, "amount").withColumns({"held_in": F.lit(name), "revenue": to_double("revenue")}) for name, df in (("table", left), ("archive", archived))]
    return parts[0].unionByName(parts[1])


# Sketches.

@query("customers_by_sketch", """
WITH o AS (SELECT c_nationkey, CAST(year(o_orderdate) AS INT) AS yr, o_custkey FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT c_nationkey, yr, COUNT(DISTINCT o_custkey) AS customers, true AS close FROM o GROUP BY ALL""")
def customers_by_sketch(t: Tables) -> DataFrame:
    """A sketch per month and nation, united for years, against the exact count."""
    orders = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select("c_nationkey", month_label("o_orderdate").alias("month"), "o_custkey")
    orders = stored(orders, "orders")
    sketches = stored(sketch_table(orders, ["month", "c_nationkey"], "o_custkey"), "sketches")
    year = F.substring("month", 1, 4).cast("int").alias("yr")
    guess = united(sketches, ["c_nationkey", year], "estimate")
    exact = orders.select("c_nationkey", year, "o_custkey").distinct().groupBy("c_nationkey", "yr").agg(F.count(F.lit(1)).alias("customers"))
    close = F.abs(F.col("estimate") - F.col("customers")) <= F.greatest(F.lit(1.0), F.col("customers") * 0.03)
    return exact.join(guess, ["c_nationkey", "yr"]).select("c_nationkey", "yr", "customers", close.alias("close"))


# Bands from a table.

@query("band_join", """
WITH b AS (SELECT c_custkey * 250.0 AS low, c_custkey * 250.0 + 100 + c_custkey % 150 AS high, c_name AS label FROM customer)
SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice END AS price, label
FROM orders LEFT JOIN b ON o_orderkey % 50 <> 0 AND o_totalprice >= low AND o_totalprice < high""")
def bands(t: Tables) -> DataFrame:
    # One band per customer, with gaps between them; every fiftieth order has no price.
    edge = F.col("c_custkey") * 250
    table = t.customer.select(edge.cast("double").alias("low"), (edge + 100 + F.col("c_custkey") % 150).cast("double").alias("high"), F.col("c_name").alias("label"))
    values = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice")).alias("price"))
    return band_join(values, "price", table)


# Files with bad lines.

_DIRTY = "event_id % 101 IN (7, 50, 77)"


@query("load_bad_lines", f"""
WITH e AS (SELECT *, {_DIRTY} AS dirty FROM events)
SELECT event_type, COUNT(*) FILTER (WHERE NOT dirty) AS good, {dbl("COALESCE(SUM(value) FILTER (WHERE NOT dirty), 0)")} AS value,
       COUNT(*) FILTER (WHERE dirty) AS bad, true AS adds_up, true AS numbered FROM e GROUP BY event_type""")
def load_bad_lines(t: Tables) -> DataFrame:
    # The events as CSV; some lines have a word for a number, some a field too many, some are cut off.
    turn, comma = F.col("event_id") % 101, F.lit(",")
    line = F.concat_ws(",", F.when(turn == 7, "number").otherwise(F.col("event_id").cast("string")), "event_type", F.format_string("%.2f", "value"))
    line = F.when(turn == 50, F.concat(line, comma, F.lit("more"))).when(turn == 77, F.concat_ws(",", "event_id", "event_type")).otherwise(line)
    path, schema = scratch_path(t.spark, "dirty"), StructType.fromDDL("event_id bigint, event_type string, value decimal(12,2)")
    lines = stored(t.events.select(line.alias("value"), "event_type", "event_id"), "landed")
    lines.select("value").write.text(path)
    good, bad = load_tolerant(t.spark, path, schema, most_bad=lines.count(), header=False)
    total = good.count() + bad.count() == lines.count()
    # The line with that number in the file is the rejected one.
    numbers = bad.groupBy("file").agg(F.count_distinct("line_no").alias("a"), F.count(F.lit(1)).alias("b"), F.min("line_no").alias("low"))
    numbered = numbers.where("a <> b OR low < 1").isEmpty()
    counts = good.groupBy("event_type").agg(F.count(F.lit(1)).alias("good"), F.sum("value").cast("double").alias("value"))
    rejects = bad.groupBy(F.split("line", ",")[1].alias("event_type")).agg(F.count(F.lit(1)).alias("bad"))
    return counts.join(rejects, "event_type", "full_outer").select(
        "event_type", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "value", "bad")], F.lit(total).alias("adds_up"), F.lit(numbered).alias("numbered"))


# Point lookups.

@query("point_lookup_clustered", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS units, true AS skipped FROM lineitem
WHERE l_orderkey = (SELECT CAST(quantile_disc(o_orderkey, 0.5) AS BIGINT) FROM orders)""")
def point_lookup_clustered(t: Tables) -> DataFrame:
    path = write_clustered(t.lineitem, scratch_path(t.spark, "clustered"), ["l_orderkey", "l_linenumber"], ["l_partkey"], group_bytes=64 << 10, distinct=5000)
    middle = t.orders.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY o_orderkey)")).first()[0]
    found = clustered_lookup(t.spark, path, l_orderkey=int(middle))
    skipped = rows_scanned(found) < 0.6 * t.lineitem.count()
    return found.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("units"), F.lit(skipped).alias("skipped"))
