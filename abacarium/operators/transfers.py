"""Requests with transfers between accounts, all or nothing, in one global order.

A transfer is refused like a withdrawal, and a refused one leaves no trace in either
account. So what an account can pay depends on what others could pay to it before.

Execution is optimistic. All transfers are taken to arrive; every account is replayed
with these credits (``replay``, exact and in parallel); transfers that turn out to be
refused take their credits back, and transfers that turn out to be accepted after all
give them; the accounts whose credits changed are replayed again, until no verdict
changes. Then all verdicts agree with each other, and since each depends on earlier
requests alone, they are the ones that a replay one by one would give.

A verdict is final when all earlier verdicts on which it depends are, so the rounds
follow the longest chain of *changed* verdicts from account to account, not the
transfers: without a refusal there is one round, whatever the transfers. Each further
round replays only accounts with changed credits. A chain can be built that needs a
round for each of its links; then ``max_rounds`` ends the run with an error that says
how many verdicts are open, and no result is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from abacarium.operators.replay import replay
from abacarium.session import stored

_LEG = ["account_id", "ts", "seq", "type", "amount"]


class ChainTooLong(RuntimeError):
    """Verdicts still changed after the last round allowed."""


def _own_leg() -> Column:
    return F.when(F.col("type") == "TRANSFER", "WITHDRAWAL").otherwise(F.col("type"))


def _prepared(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """Requests with ``early``, the reason why a transfer is refused whatever the balances."""
    known = accounts.select(F.col("account_id").alias("to_account"), F.lit(True).alias("known")).distinct()
    rows = requests.select("seq", "ts", "type", "account_id", "to_account", F.col("amount").cast("decimal(12,2)").alias("amount"))
    early = F.when((F.col("type") == "TRANSFER") & F.col("known").isNull(), F.lit("unknown account to pay to"))
    return stored(rows.join(known, "to_account", "left").withColumn("early", early).drop("known"), "requests")


def _legs(rows: DataFrame, refused: DataFrame) -> DataFrame:
    """What replays: each request in its own account, and the credits of transfers not refused.

    The credit comes right after its debit; hence even and odd numbers.
    """
    asked = rows.where("early IS NULL")
    own = asked.select("account_id", "ts", (F.col("seq") * 2).alias("seq"), _own_leg().alias("type"), "amount")
    paid = asked.where("type = 'TRANSFER' AND amount > 0").join(refused, "seq", "left_anti")
    credit = paid.select(F.col("to_account").alias("account_id"), "ts", (F.col("seq") * 2 + 1).alias("seq"), F.lit("DEPOSIT").alias("type"), "amount")
    return own.unionByName(credit)


def _verdicts(rows: DataFrame, done: DataFrame) -> DataFrame:
    """The transfers that a replay refused."""
    sent = rows.where("type = 'TRANSFER' AND early IS NULL").select("seq", "account_id")
    out = done.where("seq % 2 = 0 AND NOT accepted").select(F.expr("seq div 2").alias("seq"))
    return sent.join(out, "seq", "left_semi")


def _settled(rows: DataFrame, accounts: DataFrame, slices: int | None, max_rounds: int, rounds: list[int] | None) -> DataFrame:
    """The legs of all requests as replayed with the final verdicts."""
    refused = rows.where("false").select("seq", "account_id")
    touched = None
    for _ in range(max_rounds):
        legs = _legs(rows, refused)
        legs = legs if touched is None else legs.join(touched, "account_id", "left_semi")
        found = stored(_verdicts(rows, replay(legs, accounts, slices)), "refused")
        after = found if touched is None else stored(refused.join(touched, "account_id", "left_anti").unionByName(found), "refused")
        changed = refused.select("seq").exceptAll(after.select("seq")).union(after.select("seq").exceptAll(refused.select("seq")))
        changed = stored(rows.where("type = 'TRANSFER' AND amount > 0").join(changed, "seq", "left_semi").select("to_account"), "changed")
        open_ = changed.count()
        if rounds is not None:
            rounds.append(open_)
        refused, touched = after, changed.select(F.col("to_account").alias("account_id")).distinct()
        if not open_:
            return replay(_legs(rows, refused), accounts, slices)
    raise ChainTooLong(f"{open_} verdicts still changed in round {max_rounds}: refusals depend on one another in a long chain from account to account")


def settle_transfers(requests: DataFrame, accounts: DataFrame, slices: int | None = None, max_rounds: int = 60,
                     rounds: list[int] | None = None) -> DataFrame:
    """Decide every request in ``(ts, seq)`` order.

    ``requests``: ``seq`` (unique), ``ts``, ``type`` (DEPOSIT, WITHDRAWAL or TRANSFER),
    ``account_id``, ``to_account`` (of transfers), ``amount``. ``accounts`` as in
    ``replay``. Returns one row per request with ``accepted``, ``balance_after`` of its
    account and ``reason``. A transfer to an account that is not there is refused, and
    its ``balance_after`` is NULL, as no account looked at it. ``rounds``, if given,
    receives the number of verdicts that each round changed.
    """
    rows = _prepared(requests, accounts)
    done = _settled(rows, accounts, slices, max_rounds, rounds)
    own = done.where("seq % 2 = 0").select(F.expr("seq div 2").alias("seq"), "accepted", "balance_after", "reason")
    return rows.join(own, "seq", "left").select(
        "seq", "ts", "type", "account_id", "to_account", "amount", F.coalesce("accepted", F.lit(False)).alias("accepted"), "balance_after",
        F.coalesce("early", "reason").alias("reason"))


def settled_entries(requests: DataFrame, accounts: DataFrame, slices: int | None = None, max_rounds: int = 60) -> DataFrame:
    """The ledger after all requests: both entries of accepted transfers, the others as asked, refusals left out."""
    rows = _prepared(requests, accounts)
    done = _settled(rows, accounts, slices, max_rounds, None).where("accepted")
    kinds = rows.select("seq", F.col("type").alias("kind"))
    label = F.when(F.col("kind") != "TRANSFER", F.col("kind")).when(F.col("seq") % 2 == 0, "TRANSFER_OUT").otherwise("TRANSFER_IN")
    return done.withColumn("request", F.expr("seq div 2")).join(kinds.withColumnRenamed("seq", "request"), "request").select(
        "account_id", "ts", F.col("request").alias("seq"), label.alias("type"), "amount", "balance_after")
