"""Ledger, JSON record and grading queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from abacarium.functions import amount, to_double
from abacarium.operators import ledger as led
from abacarium.operators.freejson import infer_clean, read_free
from abacarium.operators.grading import graded, report_card as cards
from abacarium.operators.jsonclean import NO_DESCRIPTION, CleanConfig, clean, json_etl as etl, read_records
from abacarium.operators.ordering import running_sums
from abacarium.operators.replay import replay
from abacarium.operators.transfers import settle_transfers
from abacarium.plans.catalog import query
from abacarium.plans.checks import ACCOUNTS, LEDGER, dbl, mean as sql_mean
from abacarium.plans.tables import LEDGER_IN, LEDGER_OUT, Tables
from abacarium.session import scratch_path
from abacarium.sources.files import scan_csv, sink_csv

_RUNNING = LEDGER + """, run AS (
  SELECT *, SUM(delta) OVER (PARTITION BY account_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS balance,
         ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY ts, seq) AS entry_no FROM led)"""


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: to_double(c) for c in columns})


def _recorded(t: Tables) -> DataFrame:
    """A recorded ledger, whose balances leave out the error entries."""
    balances = {"balance_after": led.signed(LEDGER_IN, ["click"])}
    return running_sums(t.ledger, ["account_id"], ["ts", "seq"], balances)


_RECORDED = LEDGER + """, rec AS (
  SELECT *, SUM(CASE WHEN type = 'error' THEN 0 ELSE delta END) OVER w AS balance_after, SUM(delta) OVER w AS computed
  FROM led WINDOW w AS (PARTITION BY account_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING))"""


@query("ledger_by_type", f"""
WITH {LEDGER} SELECT type, COUNT(amount) AS count, {dbl("SUM(amount)")} AS sum,
       {sql_mean("SUM(amount)", "COUNT(amount)")} AS mean FROM led GROUP BY type""")
def by_type(t: Tables) -> DataFrame:
    return _money(led.by_type(t.ledger), "sum", "mean")


@query("ledger_by_account", f"""
WITH {_RECORDED}
SELECT account_id, COUNT(amount) AS total_transactions,
       {dbl("SUM(CASE WHEN type IN ('signup', 'purchase') THEN amount ELSE 0 END)")} AS total_deposited,
       {dbl("SUM(CASE WHEN type IN ('click', 'error') THEN amount ELSE 0 END)")} AS total_withdrawn,
       {dbl("arg_max(balance_after, seq)")} AS final_balance FROM rec GROUP BY account_id""")
def by_account(t: Tables) -> DataFrame:
    report = led.by_account(_recorded(t), LEDGER_IN, LEDGER_OUT)
    return _money(report, "total_deposited", "total_withdrawn", "final_balance")


@query("ledger_largest", f"""
WITH {LEDGER} SELECT ts, account_id, type, CAST(amount AS DOUBLE) AS amount, seq FROM led
ORDER BY led.amount DESC, seq LIMIT 5""")
def largest(t: Tables) -> DataFrame:
    return _money(led.largest(t.ledger, 5), "amount")


@query("ledger_net_flow", f"WITH {LEDGER} SELECT {dbl('SUM(delta)')} AS net_flow FROM led")
def net_flow(t: Tables) -> DataFrame:
    return _money(led.net_flow(t.ledger, LEDGER_IN, LEDGER_OUT), "net_flow")


@query("ledger_balance", f"""
WITH {_RUNNING} SELECT account_id, ts, seq, type, CAST(amount AS DOUBLE) AS amount, {dbl("balance")} AS balance FROM run""")
def balance(t: Tables) -> DataFrame:
    return _money(led.running_balance(t.ledger, LEDGER_IN, LEDGER_OUT), "amount", "balance")


@query("ledger_reconcile", f"""
WITH {_RECORDED} SELECT account_id, seq, {dbl("balance_after")} AS balance_after, {dbl("computed")} AS computed_balance
FROM rec WHERE balance_after IS DISTINCT FROM computed""")
def reconcile(t: Tables) -> DataFrame:
    wrong = led.reconcile(_recorded(t), LEDGER_IN, LEDGER_OUT)
    return _money(wrong.select("account_id", "seq", "balance_after", "computed_balance"), "balance_after", "computed_balance")


@query("ledger_rules", f"""
WITH {_RUNNING}, {ACCOUNTS}
SELECT account_id, seq, ts, type, CAST(amount AS DOUBLE) AS amount, {dbl("balance")} AS balance,
       CASE kind WHEN 'savings' THEN 'below minimum balance' WHEN 'current' THEN 'overdraft limit exceeded'
            ELSE 'insufficient funds' END AS violation
FROM run JOIN acc USING (account_id) WHERE type IN ('click', 'error') AND balance < floor""")
def rules(t: Tables) -> DataFrame:
    return _money(led.audit_rules(t.ledger, t.accounts, LEDGER_IN, LEDGER_OUT), "amount", "balance")


def _requests(t: Tables) -> DataFrame:
    """The events as requests: clicks and errors withdraw, all others deposit."""
    kind = F.when(F.col("type").isin(*LEDGER_OUT), F.lit("WITHDRAWAL")).otherwise(F.lit("DEPOSIT"))
    return t.ledger.withColumn("type", kind)


@query("ledger_replay", f"""
WITH RECURSIVE {LEDGER}, {ACCOUNTS}, e AS (
  SELECT led.account_id, ts, seq, kind, floor * 100 AS floor, CAST(amount * 100 AS BIGINT) AS cents,
         type IN ('click', 'error') AS takes, ROW_NUMBER() OVER (PARTITION BY led.account_id ORDER BY ts, seq) AS rn
  FROM led JOIN acc ON acc.account_id = led.account_id),
r AS (
  SELECT *, NOT takes OR 0 - cents >= floor AS accepted,
         CASE WHEN NOT takes THEN cents WHEN 0 - cents >= floor THEN -cents ELSE 0 END AS balance FROM e WHERE rn = 1
  UNION ALL
  SELECT e.*, NOT e.takes OR r.balance - e.cents >= e.floor,
         r.balance + CASE WHEN NOT e.takes THEN e.cents WHEN r.balance - e.cents >= e.floor THEN -e.cents ELSE 0 END
  FROM r JOIN e ON e.account_id = r.account_id AND e.rn = r.rn + 1)
SELECT account_id, ts, seq, CASE WHEN takes THEN 'WITHDRAWAL' ELSE 'DEPOSIT' END AS type,
       CAST(cents AS DOUBLE) / 100 AS amount, accepted, CAST(balance AS DOUBLE) / 100 AS balance_after,
       CASE WHEN accepted THEN NULL WHEN kind = 'savings' THEN 'below minimum balance'
            WHEN kind = 'current' THEN 'overdraft limit exceeded' ELSE 'insufficient funds' END AS reason FROM r""")
def ledger_replay(t: Tables) -> DataFrame:
    return _money(replay(_requests(t), t.accounts), "amount", "balance_after")


def _transfers(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'purchase'").select(
        F.col("event_id").alias("seq"), "ts", F.col("user_id").alias("from_account"),
        F.get_json_object("props", "$.k").cast("long").alias("to_account"), amount("value").alias("amount"))


@query("ledger_transfers", """
WITH p AS (SELECT event_id AS seq, ts, user_id, CAST(props->>'$.k' AS BIGINT) AS other, value FROM events
           WHERE event_type = 'purchase')
SELECT seq, ts, user_id AS account_id, 'TRANSFER_OUT' AS type, value AS amount FROM p
UNION ALL SELECT seq, ts, other, 'TRANSFER_IN', value FROM p""")
def transfers(t: Tables) -> DataFrame:
    return _money(led.transfer_legs(_transfers(t)), "amount")


@query("ledger_unpaired_transfers", """
SELECT event_id AS seq, 1 AS out_legs, 0 AS in_legs, -value AS difference
FROM events WHERE event_type = 'purchase' AND value >= 100""")
def unpaired(t: Tables) -> DataFrame:
    # The credits of large transfers went missing.
    legs = led.transfer_legs(_transfers(t)).where("type = 'TRANSFER_OUT' OR amount < 100")
    return _money(led.unpaired_transfers(legs), "difference")


def _mixed_requests(t: Tables) -> DataFrame:
    """The events as requests: purchases pay another user, clicks and errors withdraw, all others deposit."""
    kind = F.when(F.col("event_type") == "purchase", "TRANSFER").when(F.col("event_type").isin(*LEDGER_OUT), "WITHDRAWAL").otherwise("DEPOSIT")
    other = F.when(F.col("event_type") == "purchase", F.get_json_object("props", "$.k").cast("long"))
    return t.events.select(F.col("event_id").alias("seq"), "ts", kind.alias("type"), F.col("user_id").alias("account_id"),
                           other.alias("to_account"), amount("value").alias("amount"))


@query("ledger_transfer_replay", f"""
WITH RECURSIVE {ACCOUNTS}, named AS (SELECT *, ROW_NUMBER() OVER (ORDER BY account_id) AS i FROM acc),
e AS (
  SELECT event_id AS seq, ts, CASE WHEN event_type = 'purchase' THEN 'TRANSFER' WHEN event_type IN ('click', 'error') THEN 'WITHDRAWAL' ELSE 'DEPOSIT' END AS type,
         user_id AS account_id, CASE WHEN event_type = 'purchase' THEN CAST(props->>'$.k' AS BIGINT) END AS to_account,
         CAST(CAST(value AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents, a.i AS own, b.i AS other, a.kind, a.floor * 100 AS floor,
         ROW_NUMBER() OVER (ORDER BY ts, event_id) AS rn
  FROM events JOIN named a ON a.account_id = user_id LEFT JOIN named b ON event_type = 'purchase' AND b.account_id = CAST(props->>'$.k' AS BIGINT)),
r AS (
  SELECT CAST(0 AS BIGINT) AS rn, false AS accepted, (SELECT list_transform(range(COUNT(*)), lambda x: CAST(0 AS BIGINT)) FROM named) AS b
  UNION ALL
  SELECT e.rn, CASE WHEN type = 'DEPOSIT' THEN cents > 0 WHEN type = 'TRANSFER' AND other IS NULL THEN false ELSE cents > 0 AND b[own] - cents >= floor END,
         CASE WHEN type = 'DEPOSIT' AND cents > 0 THEN list_transform(b, lambda x, i: CASE WHEN i = own THEN x + cents ELSE x END)
              WHEN type <> 'DEPOSIT' AND (type = 'WITHDRAWAL' OR other IS NOT NULL) AND cents > 0 AND b[own] - cents >= floor
              THEN list_transform(b, lambda x, i: x - CASE WHEN i = own THEN cents ELSE 0 END + CASE WHEN i = coalesce(other, 0) THEN cents ELSE 0 END)
              ELSE b END
  FROM r JOIN e ON e.rn = r.rn + 1)
SELECT seq, ts, type, account_id, to_account, CAST(cents AS DOUBLE) / 100 AS amount, accepted,
       CASE WHEN type = 'TRANSFER' AND other IS NULL THEN NULL
            -- A transfer to oneself is credited after its debit, which is what the row shows.
            ELSE CAST(b[own] - CASE WHEN accepted AND other = own THEN cents ELSE 0 END AS DOUBLE) / 100 END AS balance_after,
       CASE WHEN accepted THEN NULL WHEN type = 'TRANSFER' AND other IS NULL THEN 'unknown account to pay to' WHEN cents <= 0 THEN 'amount not positive'
            WHEN kind = 'savings' THEN 'below minimum balance' WHEN kind = 'current' THEN 'overdraft limit exceeded' ELSE 'insufficient funds' END AS reason
FROM r JOIN e USING (rn)""")
def transfer_replay(t: Tables) -> DataFrame:
    return _money(settle_transfers(_mixed_requests(t), t.accounts), "amount", "balance_after")


@query("ledger_interest", f"""
WITH {LEDGER}, {ACCOUNTS}, b AS (SELECT account_id, SUM(delta) AS balance FROM led GROUP BY account_id),
c AS (SELECT account_id, CAST(balance * 100 AS BIGINT) AS cents FROM b JOIN acc USING (account_id) WHERE kind = 'savings'),
i AS (SELECT *, cents * 4 // 100 + CASE WHEN cents * 4 % 100 > 50 OR (cents * 4 % 100 = 50 AND cents * 4 // 100 % 2 = 1)
      THEN 1 ELSE 0 END AS interest FROM c WHERE cents > 0)
SELECT account_id, TIMESTAMP '2024-02-01' AS ts, 'DEPOSIT' AS type, CAST(interest AS DOUBLE) / 100 AS amount,
       CAST(cents + interest AS DOUBLE) / 100 AS balance_after FROM i WHERE interest > 0""")
def interest(t: Tables) -> DataFrame:
    balances = led.current_balances(t.ledger, LEDGER_IN, LEDGER_OUT)
    return _money(led.interest_postings(balances, t.accounts, "2024-02-01"), "amount", "balance_after")


@query("ledger_statement", f"""
WITH {_RUNNING} SELECT account_id, ts, seq, type, CAST(amount AS DOUBLE) AS amount, entry_no, {dbl("balance")} AS balance
FROM run""")
def statement(t: Tables) -> DataFrame:
    return _money(led.statement(t.ledger, LEDGER_IN, LEDGER_OUT), "amount", "balance").orderBy("account_id", "entry_no")


@query("ledger_current_balances", f"""
WITH {LEDGER} SELECT account_id, {dbl("SUM(delta)")} AS balance FROM led GROUP BY account_id""")
def current_balances(t: Tables) -> DataFrame:
    return _money(led.current_balances(t.ledger, LEDGER_IN, LEDGER_OUT), "balance")


@query("ledger_export", f"""
WITH {_RECORDED} SELECT ts, seq, account_id, type, CAST(amount AS DOUBLE) AS amount,
       {dbl("balance_after")} AS balance_after, {dbl("balance_after")} AS balance_of_file FROM rec""")
def export(t: Tables) -> DataFrame:
    # The balance is worked out again from the file, which only its order makes possible.
    path = led.export(_recorded(t), scratch_path(t.spark, "export"))
    back = led.running_balance(led.read(t.spark, path), LEDGER_IN, ["click"], "balance_of_file")
    return _money(back.withColumn("account_id", F.col("account_id").cast("long")), "amount", "balance_after", "balance_of_file")


@query("ledger_account_csv", f"""
WITH {_RECORDED}
SELECT CAST(account_id AS VARCHAR) AS account_id, COUNT(amount) AS total_transactions,
       {dbl("SUM(CASE WHEN type IN ('signup', 'purchase') THEN amount ELSE 0 END)")} AS total_deposited,
       {dbl("SUM(CASE WHEN type IN ('click', 'error') THEN amount ELSE 0 END)")} AS total_withdrawn,
       {dbl("arg_max(balance_after, seq)")} AS final_balance FROM rec GROUP BY account_id""")
def account_csv(t: Tables) -> DataFrame:
    # The report as the file that it is delivered in, read back.
    report = _money(led.by_account(_recorded(t), LEDGER_IN, LEDGER_OUT), "total_deposited", "total_withdrawn", "final_balance")
    path = sink_csv(report.orderBy("account_id"), scratch_path(t.spark, "account-report"))
    return scan_csv(t.spark, path, StructType([
        StructField("account_id", StringType()), StructField("total_transactions", LongType()),
        StructField("total_deposited", DoubleType()), StructField("total_withdrawn", DoubleType()),
        StructField("final_balance", DoubleType())]))


# ---- JSON records ----------------------------------------------------------------------------------------------

EVENT_RECORD = StructType([
    StructField("id", LongType()),
    StructField("owner", StructType([StructField("login", StringType())])),
    StructField("kind", StringType()),
    StructField("description", StringType()),
    StructField("props", StructType([StructField("k", IntegerType())])),
    StructField("tags", ArrayType(StringType())),
    StructField("created_at", StringType()),
])
EVENT_CLEAN = CleanConfig(
    columns=("id", "owner.login", "kind", "description", "props.k", "created_at"), dates=("created_at",),
    fills={"description": NO_DESCRIPTION}, renames={"owner.login": "owner", "props.k": "k"})


def _land(t: Tables, envelope: str) -> str:
    """Write the events as JSON payloads, one per line; some have no description or no valid time.

    ``envelope``: a payload is one ``object``, or each record twice in a bare ``list`` or under ``items``.
    """
    valid = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    record = F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.concat(F.lit("user"), F.col("user_id")).alias("login")).alias("owner"),
        F.col("event_type").alias("kind"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("a "), F.col("event_type"))).alias("description"),
        F.from_json("props", "k INT").alias("props"),
        F.array("event_type").alias("tags"),
        F.when(F.col("event_type") != "click", valid).otherwise(F.lit("yesterday")).alias("created_at"),
    )
    twice = F.array(record, record)
    payload = {"object": record, "list": twice, "items": F.struct(twice.alias("items"))}[envelope]
    path = scratch_path(t.spark, "payloads")
    t.events.select(F.to_json(payload).alias("value")).write.text(path)
    return path


_RECORD = """SELECT event_id AS id, 'user' || user_id AS owner, event_type AS kind,
  CASE WHEN event_type <> 'error' THEN 'a ' || event_type END AS description, CAST(props->>'$.k' AS INT) AS k,
  CASE WHEN event_type <> 'click' THEN date_trunc('second', ts) END AS created_at FROM events"""


@query("json_records", f"""
WITH r AS ({_RECORD}) SELECT id, owner AS login, kind, k FROM r UNION ALL SELECT id, owner, kind, k FROM r""")
def json_records(t: Tables) -> DataFrame:
    records = read_records(t.spark, _land(t, "items"), EVENT_RECORD, multi_line=False)
    return records.select("id", "owner.login", "kind", "props.k")


_CLEAN = f"WITH r AS ({_RECORD}) SELECT * REPLACE (COALESCE(description, '{NO_DESCRIPTION}') AS description) FROM r"


@query("json_clean", _CLEAN)
def json_clean(t: Tables) -> DataFrame:
    records = read_records(t.spark, _land(t, "items"), EVENT_RECORD, multi_line=False)
    return clean(records, EVENT_CLEAN).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("json_drop_empty", "SELECT id, owner, kind FROM (" + _RECORD + ")")
def json_drop_empty(t: Tables) -> DataFrame:
    # Bare lists; no record has a homepage, so that column goes.
    record = StructType([*EVENT_RECORD.fields, StructField("homepage", StringType())])
    records = read_records(t.spark, _land(t, "list"), record, multi_line=False)
    config = CleanConfig(columns=("id", "owner.login", "kind", "homepage"), fills={"homepage": NO_DESCRIPTION},
                         renames={"owner.login": "owner"}, drop_empty_columns=True)
    return clean(records, config)


@query("json_etl", _CLEAN)
def json_etl(t: Tables) -> DataFrame:
    target = scratch_path(t.spark, "etl") + "/new/folder"
    rows = etl(t.spark, _land(t, "object"), target, EVENT_RECORD, EVENT_CLEAN, multi_line=False)
    back = t.spark.read.schema(rows.schema).option("header", True).csv(target)
    return back.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def _land_free(t: Tables) -> str:
    """Payloads in which fields come and go and change their type, in all three envelopes, one per line."""
    n = F.col("event_id")
    record = F.struct(
        n.alias("id"), F.struct(F.concat(F.lit("user"), F.col("user_id")).alias("login"), F.when(n % 7 == 0, F.lit(True)).alias("site_admin")).alias("owner"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("description"),
        F.parse_json("props").alias("props"), F.lit(None).cast("string").alias("homepage"),
        F.parse_json(F.when(n % 3 == 0, n.cast("string")).when(n % 3 == 1, F.format_string('"c%d"', n))).alias("code"),
        F.when(n % 2 == 0, F.array("event_type", F.lit("x"))).alias("topics"),
        F.parse_json(F.when(n % 5 == 0, F.format_string('[%d, "%s", {"a": null}]', n, "event_type"))).alias("mixed"),
        F.when(n % 11 == 0, F.struct(F.struct(n.alias("depth")).alias("inner"))).alias("meta"),
        F.when(F.col("event_type") != "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("yesterday").alias("created_at"))
    payload = F.when(n % 4 == 0, F.to_json(F.struct(F.array(record, record).alias("items")))).when(n % 4 == 1, F.to_json(F.array(record))).otherwise(F.to_json(record))
    path = scratch_path(t.spark, "payloads")
    t.events.select(payload.alias("value")).write.text(path)
    return path


@query("json_infer_clean", f"""
SELECT event_id AS id, 'user' || user_id AS owner, CASE WHEN event_id % 7 = 0 THEN true END AS admin,
       COALESCE(CASE WHEN event_type <> 'error' THEN event_type END, '{NO_DESCRIPTION}') AS description, CAST(props->>'$.k' AS BIGINT) AS k,
       CASE event_id % 3 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN 'c' || event_id END AS code,
       CASE WHEN event_id % 2 = 0 THEN event_type || ',x' END AS topics,
       CASE WHEN event_id % 5 = 0 THEN '[' || event_id || ',"' || event_type || '",{{"a":null}}]' END AS mixed,
       CASE WHEN event_id % 11 = 0 THEN event_id END AS depth,
       CASE WHEN event_type <> 'click' THEN date_trunc('second', ts) END AS created_at FROM events""")
def json_infer_clean(t: Tables) -> DataFrame:
    config = CleanConfig(
        columns=("id", "owner.login", "owner.site_admin", "description", "props.k", "homepage", "code", "topics", "mixed", "meta.inner.depth", "created_at"),
        dates=("created_at",), renames={"owner.login": "owner", "owner.site_admin": "admin", "props.k": "k", "meta.inner.depth": "depth"})
    rows = infer_clean(read_free(t.spark, _land_free(t), multi_line=False), config)
    return rows.withColumns({"topics": F.array_join("topics", ","), "created_at": F.col("created_at").cast("timestamp_ntz")})


# ---- grades ----------------------------------------------------------------------------------------------------

_GRADE = ("CASE WHEN {0} >= 90 THEN 'A+' WHEN {0} >= 80 THEN 'A' WHEN {0} >= 70 THEN 'B' WHEN {0} >= 60 THEN 'C' "
          "WHEN {0} >= 50 THEN 'D' WHEN {0} >= 40 THEN 'E' ELSE 'F' END")


def _marks(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("student"), F.col("o_orderpriority").alias("subject"),
        (F.col("o_orderkey") % 101).cast("double").alias("marks"), "o_orderkey")


@query("grade_band", f"""
SELECT o_orderkey, o_custkey AS student, o_orderpriority AS subject, CAST(o_orderkey % 101 AS DOUBLE) AS marks,
       {_GRADE.format("o_orderkey % 101")} AS grade FROM orders""")
def bands(t: Tables) -> DataFrame:
    return graded(_marks(t))


@query("report_card", f"""
WITH c AS (SELECT o_custkey AS student, CAST(SUM(o_orderkey % 101) AS DOUBLE) AS total_marks,
                  COUNT(*) * 100 AS total_possible, CAST(SUM(o_orderkey % 101) AS DOUBLE) / COUNT(*) AS average
           FROM orders GROUP BY o_custkey)
SELECT *, {_GRADE.format("average")} AS overall_grade FROM c""")
def report_card(t: Tables) -> DataFrame:
    return cards(_marks(t))
