"""Account ledgers: summaries, running balances, audits and generated postings.

A ledger has ``account_id, ts, seq, type, amount`` and, if it was recorded,
``balance_after``. ``(ts, seq)`` orders the entries; times alone are too coarse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from abacarium.functions import amount as as_amount, mean
from abacarium.operators.ordering import global_index, running_sums
from abacarium.schemas import LEDGER_CSV
from abacarium.session import stored
from abacarium.sources.files import scan_csv, sink_csv

# Entry types that add to and take from a balance, account kinds and their limits.
IN_TYPES = ("DEPOSIT", "TRANSFER_IN")
OUT_TYPES = ("WITHDRAWAL", "TRANSFER_OUT")
SAVINGS_RATE = "0.04"
SAVINGS_MIN_BALANCE = "500"
CURRENT_OVERDRAFT = "1000"
CSV_COLUMNS = ("timestamp", "account_id", "type", "amount", "balance_after")
CSV_TIME = "yyyy-MM-dd HH:mm:ss"
CSV_EXACT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _one_of(types: Sequence[str]) -> Column:
    return F.col("type").isin(*types)


def _sum_where(types: Sequence[str]) -> Column:
    return F.coalesce(F.sum(F.when(_one_of(types), F.col("amount"))), as_amount(F.lit(0)))


def signed(ins: Sequence[str] = IN_TYPES, outs: Sequence[str] = OUT_TYPES) -> Column:
    """The effect of an entry on the balance; other types have none."""
    return (
        F.when(_one_of(ins), F.col("amount"))
        .when(_one_of(outs), -F.col("amount"))
        .otherwise(as_amount(F.lit(0)))
    )


def by_type(ledger: DataFrame) -> DataFrame:
    """Count, sum and mean per entry type."""
    return ledger.groupBy("type").agg(
        F.count("amount").alias("count"),
        F.sum("amount").alias("sum"),
        mean(F.sum("amount"), F.count("amount")).alias("mean"),
    )


def by_account(
    ledger: DataFrame, ins: Sequence[str] = IN_TYPES, outs: Sequence[str] = OUT_TYPES
) -> DataFrame:
    """Entries, sum in, sum out and last recorded balance per account."""
    return ledger.groupBy("account_id").agg(
        F.count("amount").alias("total_transactions"),
        _sum_where(ins).alias("total_deposited"),
        _sum_where(outs).alias("total_withdrawn"),
        F.max_by("balance_after", F.struct("ts", "seq")).alias("final_balance"),
    )


def largest(ledger: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` largest entries; equal amounts in ledger order."""
    return ledger.orderBy(F.desc("amount"), "seq").limit(n).select("ts", "account_id", "type", "amount", "seq")


def net_flow(ledger: DataFrame, ins: Sequence[str] = IN_TYPES, outs: Sequence[str] = OUT_TYPES) -> DataFrame:
    """All money in minus all money out, one row."""
    return ledger.agg((_sum_where(ins) - _sum_where(outs)).alias("net_flow"))


def running_balance(
    ledger: DataFrame, ins: Sequence[str] = IN_TYPES, outs: Sequence[str] = OUT_TYPES,
    name: str = "balance", slices: int | None = None,
) -> DataFrame:
    """The balance after each entry."""
    return running_sums(ledger, ["account_id"], ["ts", "seq"], {name: signed(ins, outs)}, slices)


def reconcile(
    ledger: DataFrame, ins: Sequence[str] = IN_TYPES, outs: Sequence[str] = OUT_TYPES, slices: int | None = None
) -> DataFrame:
    """Entries whose recorded balance differs from the computed one."""
    computed = running_balance(ledger, ins, outs, "computed_balance", slices)
    return computed.where(~F.col("balance_after").eqNullSafe(F.col("computed_balance")))


def balance_floor() -> Column:
    """The lowest balance a withdrawal may leave, by the account's kind and limits."""
    return (
        F.when(F.col("kind") == "savings", F.greatest(F.col("min_balance"), F.lit(0)))
        .when(F.col("kind") == "current", -F.col("overdraft_limit"))
        .otherwise(F.lit(0))
        .cast("decimal(12,2)")
    )


def refusal_reason() -> Column:
    """Why a withdrawal below the floor is refused, by the account's kind."""
    return (
        F.when(F.col("kind") == "savings", F.lit("below minimum balance"))
        .when(F.col("kind") == "current", F.lit("overdraft limit exceeded"))
        .otherwise(F.lit("insufficient funds"))
    )


def audit_rules(
    ledger: DataFrame, accounts: DataFrame, ins: Sequence[str] = IN_TYPES, outs: Sequence[str] = OUT_TYPES
) -> DataFrame:
    """Entries that break a rule: amounts must be positive, money out must respect the floor."""
    balances = running_balance(ledger, ins, outs)
    checked = balances.join(accounts, "account_id").withColumn(
        "violation",
        F.when(F.col("amount") <= 0, F.lit("amount not positive"))
        .when(_one_of(outs) & (F.col("balance") < balance_floor()), refusal_reason()),
    )
    return checked.where(F.col("violation").isNotNull()).select(
        "account_id", "seq", "ts", "type", "amount", "balance", "violation"
    )


def transfer_legs(transfers: DataFrame) -> DataFrame:
    """Both entries of each accepted transfer ``(seq, ts, from_account, to_account, amount)``."""
    leg = F.explode(F.array(
        F.struct(F.col("from_account").alias("account_id"), F.lit("TRANSFER_OUT").alias("type")),
        F.struct(F.col("to_account").alias("account_id"), F.lit("TRANSFER_IN").alias("type")),
    ))
    return transfers.select("seq", "ts", "amount", leg.alias("leg")).select(
        "seq", "ts", "leg.account_id", "leg.type", "amount"
    )


def unpaired_transfers(legs: DataFrame) -> DataFrame:
    """Transfers whose two legs are not one OUT and one IN of the same amount."""
    out_leg, in_leg = F.col("type") == "TRANSFER_OUT", F.col("type") == "TRANSFER_IN"
    return (
        legs.where(out_leg | in_leg)
        .groupBy("seq")
        .agg(
            F.count_if(out_leg).alias("out_legs"),
            F.count_if(in_leg).alias("in_legs"),
            F.sum(F.when(in_leg, F.col("amount")).otherwise(-F.col("amount"))).alias("difference"),
        )
        .where("out_legs <> 1 OR in_legs <> 1 OR difference <> 0")
    )


def current_balances(
    ledger: DataFrame, ins: Sequence[str] = IN_TYPES, outs: Sequence[str] = OUT_TYPES
) -> DataFrame:
    """The balance of each account: one sum, no running balance needed."""
    return ledger.groupBy("account_id").agg(F.sum(signed(ins, outs)).alias("balance"))


def interest_postings(balances: DataFrame, accounts: DataFrame, as_of) -> DataFrame:
    """A DEPOSIT of ``round(balance * interest_rate, 2)`` per savings account, if positive."""
    interest = F.bround(F.col("balance") * F.col("interest_rate"), 2).cast("decimal(12,2)")
    return (
        balances.join(accounts.where(F.col("kind") == "savings"), "account_id")
        .select(
            "account_id", F.lit(as_of).cast("timestamp_ntz").alias("ts"), F.lit("DEPOSIT").alias("type"),
            interest.alias("amount"), (F.col("balance") + interest).alias("balance_after"),
        )
        .where(F.col("amount") > 0)
    )


def statement(
    ledger: DataFrame, ins: Sequence[str] = IN_TYPES, outs: Sequence[str] = OUT_TYPES
) -> DataFrame:
    """Each account's entries with their number and the balance after them."""
    return running_sums(
        ledger, ["account_id"], ["ts", "seq"],
        {"entry_no": F.lit(1).cast("long"), "balance": signed(ins, outs)},
    )


def default_accounts(accounts: DataFrame) -> DataFrame:
    """Fill the limits that ``accounts (account_id, kind)`` leaves out."""
    defaults = {
        "interest_rate": F.lit(SAVINGS_RATE).cast("decimal(6,4)"),
        "min_balance": F.lit(SAVINGS_MIN_BALANCE).cast("decimal(12,2)"),
        "overdraft_limit": F.lit(CURRENT_OVERDRAFT).cast("decimal(12,2)"),
    }
    filled = accounts
    for name, default in defaults.items():
        filled = filled.withColumn(name, F.coalesce(name, default) if name in accounts.columns else default)
    return filled


def export(
    ledger: DataFrame, path: str, columns: Sequence[str] = (*CSV_COLUMNS, "seq"), timestamp_format: str = CSV_EXACT_TIME
) -> str:
    """Write the ledger as CSV files in global order; one file per range, no single task.

    ``seq`` and the fractions of a second go along, since only they order entries of one second.
    """
    ordered = ledger.orderBy("ts", "seq").withColumnRenamed("ts", "timestamp").select(*columns)
    return sink_csv(ordered, path, timestamp_format)


def read(spark: SparkSession, path: str, timestamp_format: str = CSV_EXACT_TIME, has_seq: bool = True) -> DataFrame:
    """A recorded ledger: ``timestamp, account_id, type, amount, balance_after[, seq]``.

    Without a ``seq`` column the entries are numbered in the order of the file names
    and of the lines in them: by file, by the place of the split in its file, and by
    the place of the line in its split.
    """
    if has_seq:
        return scan_csv(spark, path, LEDGER_CSV, timestamp_format).withColumnRenamed("timestamp", "ts")
    schema = StructType([f for f in LEDGER_CSV.fields if f.name != "seq"])
    rows = scan_csv(spark, path, schema, timestamp_format).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"))
    # Stored first: the line numbers belong to this scan's splits.
    numbered = global_index(stored(rows, "entries"), ["_file", "_block", "_line"], "seq")
    return numbered.drop("_file", "_block", "_line").withColumnRenamed("timestamp", "ts")
