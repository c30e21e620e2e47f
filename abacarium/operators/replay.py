"""Replay of account requests in which a refusal leaves no trace.

Whether a withdrawal is accepted depends on the balance, hence on all earlier
decisions about the account. Requests are laid out once in (account, time) order
and cut into slices of bounded size. The part of an account in one slice, a piece,
has a net amount and a lowest running sum if everything in it is accepted; both are
window sums. A piece whose opening balance plus that lowest sum does not fall below
the account's floor is calm: it has no refusal, and its net is known.

Any other piece is a step function from its opening to its closing balance, with
breakpoints where a withdrawal begins to be accepted. Three passes over the requests
do, however many slices an account spans:

1. Interval arithmetic bounds what a piece may close with if it is not calm. Where the
   lowest sum is reached, such balances lie within one withdrawal of the floor, so the
   bounds are narrow; they limit the openings of the pieces that follow.
2. Pieces that may refuse something are turned into step functions over the openings
   in their range, some hundred requests at a time, and composed. Walking along the
   functions of an account, one row per slice, gives every opening.
3. Calm pieces are summed by windows, the others replayed from their openings.

Transfers between accounts are decided by ``operators/transfers.py`` on top of this.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from abacarium.operators.ledger import balance_floor, default_accounts, refusal_reason
from abacarium.operators.ordering import join_null_safe
from abacarium.session import stored

_ORDER = ["account_id", "ts", "seq"]
_PIECE = ["account_id", "slice"]


def replay(requests: DataFrame, accounts: DataFrame, slices: int | None = None) -> DataFrame:
    """Decide every request in ``(ts, seq)`` order.

    ``requests``: ``seq`` (unique), ``ts``, ``account_id``, ``type`` (DEPOSIT or
    WITHDRAWAL), ``amount``; any other type is refused. ``accounts``: ``account_id``,
    ``kind`` (base, savings or current) and optionally ``opening`` and the limits.
    Returns one row per request; a refused one has a reason and the unchanged balance.
    """
    layout = _lay_out(requests, accounts, slices)
    pieces = settle(layout)
    calm = F.col("start") + F.col("low") >= F.col("floor")
    marked = join_null_safe(layout, pieces.select(*_PIECE, "start", "low"), _PIECE)
    inside = Window.partitionBy(*_PIECE).orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = marked.where(calm).withColumns({
        "accepted": F.col("early").isNull(), "balance": F.col("start") + F.sum(_effect()).over(inside), "reason": F.col("early")})
    columns = [*_ORDER, "type", "amount", "accepted", "balance", "reason"]
    decided = plain.select(*columns).unionByName(_fold(marked.where(~calm), _walker(), _decisions(marked)).select(*columns))
    return decided.select(
        "account_id", "ts", "seq", "type", "amount", "accepted",
        (F.col("balance").cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,2)").alias("balance_after"), "reason",
    )


def _effect() -> Column:
    """What a request adds if it is not refused early."""
    return F.when(F.col("early").isNull(), F.col("cents")).otherwise(F.lit(0))


def _lay_out(requests: DataFrame, accounts: DataFrame, slices: int | None) -> DataFrame:
    rules = default_accounts(accounts)
    if "opening" not in rules.columns:
        rules = rules.withColumn("opening", F.lit(0).cast("decimal(12,2)"))
    rules = rules.select(
        "account_id", balance_floor().alias("floor"), refusal_reason().alias("floor_reason"), "opening"
    )
    amount = F.col("amount").cast("decimal(12,2)")
    early = (
        # An account without rules refuses everything.
        F.when(F.col("floor").isNull(), F.lit("unknown account"))
        .when(~F.col("type").isin("DEPOSIT", "WITHDRAWAL"), F.lit("unknown type"))
        .when(~F.coalesce(F.col("amount") > 0, F.lit(False)), F.lit("amount not positive"))
    )
    rows = requests.select(*_ORDER, "type", amount.alias("amount")).join(rules, "account_id", "left").withColumns({
        "early": early,
        "cents": (F.coalesce(F.when(F.col("type") == "DEPOSIT", amount).otherwise(-amount), F.lit(0)) * 100).cast("long"),
        "floor": (F.coalesce("floor", F.lit(0)) * 100).cast("long"),
        "opening": (F.coalesce("opening", F.lit(0)) * 100).cast("long"),
    })
    ranged = rows.repartitionByRange(slices, *_ORDER) if slices else rows.repartitionByRange(*_ORDER)
    return stored(ranged.withColumn("slice", F.spark_partition_id()), "replay")


def settle(layout: DataFrame) -> DataFrame:
    """Per piece its ``start``, ``floor`` and ``low``: the balance it opens with, and what it must not fall below."""
    inside = Window.partitionBy(*_PIECE).orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = layout.withColumn("sum", F.sum(_effect()).over(inside))
    pieces = sums.groupBy(*_PIECE).agg(
        F.max("opening").alias("opening"), F.max("floor").alias("floor"), F.sum(_effect()).alias("free"),
        # Only withdrawals are refused; a piece without any can have no refusal.
        F.coalesce(F.min(F.when((F.col("cents") < 0) & F.col("early").isNull(), F.col("sum"))), F.lit(1 << 62)).alias("low"))
    # Nothing opens with what an account's last piece closes with, so accounts inside one slice need neither pass.
    follower = F.lead("slice").over(Window.partitionBy("account_id").orderBy("slice"))
    pieces = stored(pieces.withColumn("goes_on", follower.isNotNull()), "pieces")
    kind = layout.schema["account_id"].dataType.simpleString()

    # Round 1: what a piece may close with if it is not calm.
    hard = pieces.where("goes_on").where(F.least("floor", "opening") + F.col("low") < F.col("floor")).select(*_PIECE, "low")
    bounds = _fold(join_null_safe(layout.where(_effect() != 0), hard, _PIECE), _bounder(), f"account_id {kind}, slice int, least bigint, most bigint")
    bounded = stored(join_null_safe(pieces, bounds, _PIECE, "left").fillna(0, ["least", "most"]), "bounds")
    ranges = stored(_along(bounded, _ranger(), f"account_id {kind}, slice int, lowest bigint, highest bigint"), "ranges")
    # Round 2: the step functions of pieces that may refuse something.
    known = join_null_safe(pieces, ranges, _PIECE)
    unsure = known.where("goes_on").where(F.col("lowest") + F.col("low") < F.col("floor")).select(*_PIECE, "lowest", "highest")
    steps = _fold(join_null_safe(layout.where(_effect() != 0), unsure, _PIECE), _stepper(), f"account_id {kind}, slice int, at array<bigint>, moves array<bigint>")
    functions = stored(join_null_safe(pieces, steps, _PIECE, "left"), "functions")
    starts = _along(functions, _opener(), f"account_id {kind}, slice int, start bigint")
    opened = join_null_safe(pieces.select(*_PIECE, "opening", "floor", "low"), starts, _PIECE, "left")
    return stored(opened.select(*_PIECE, F.coalesce("start", "opening").alias("start"), "floor", "low"), "starts")


def _along(pieces: DataFrame, walk: Callable, schema: str) -> DataFrame:
    """Walk along the pieces of each account, one small row per slice, as a stream; a NULL account accepts nothing."""
    return pieces.where("account_id IS NOT NULL").repartition("account_id").sortWithinPartitions("account_id", "slice").mapInPandas(walk, schema)


def _fold(rows: DataFrame, walk: Callable, schema: str) -> DataFrame:
    """Replay each piece from its opening balance, streaming over sorted rows.

    One piece is one run of rows in one task, and a slice is bounded by its range partition.
    """
    return rows.repartition(*_PIECE).sortWithinPartitions(*_PIECE, "ts", "seq").mapInPandas(walk, schema)


def _decisions(rows: DataFrame) -> str:
    kind, time = (rows.schema[c].dataType.simpleString() for c in ("account_id", "ts"))
    return (f"account_id {kind}, slice int, ts {time}, seq bigint, type string, amount decimal(12,2), "
            "accepted boolean, balance bigint, reason string")


def _steps() -> Callable[[pd.DataFrame, tuple, int], tuple]:
    """The decisions of one batch. Inner functions are shipped by value, so executors need not have this package."""

    def steps(batch: pd.DataFrame, piece: tuple | None, balance: int) -> tuple:
        accepted, balances, reasons = [], [], []
        columns = (batch[c].tolist() for c in ("account_id", "slice", "cents", "floor", "start", "early", "floor_reason"))
        for account, slice_no, cents, floor, start, early, floor_reason in zip(*columns, strict=True):
            if (account, slice_no) != piece:
                piece, balance = (account, slice_no), start
            reason = early if isinstance(early, str) else None
            if reason is None and cents < 0 and balance + cents < floor:
                reason = floor_reason
            if reason is None:
                balance += cents
            accepted.append(reason is None)
            balances.append(balance)
            reasons.append(reason)
        return piece, balance, accepted, balances, reasons

    return steps


def _walker() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    steps = _steps()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece, balance = None, 0
        for batch in batches:
            piece, balance, accepted, balances, reasons = steps(batch, piece, balance)
            out = batch[["account_id", "slice", "ts", "seq", "type", "amount"]].copy()
            out["accepted"], out["balance"], out["reason"] = accepted, balances, reasons
            yield out

    return walk


def _bounder() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The least and the greatest closing balance of a piece over all openings with which it is not calm."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece, least, most = None, 0, 0
        for batch in batches:
            done = []
            columns = (batch[c].tolist() for c in ("account_id", "slice", "cents", "floor", "opening", "low"))
            for account, slice_no, cents, floor, opening, low in zip(*columns, strict=True):
                if (account, slice_no) != piece:
                    if piece is not None:
                        done.append((*piece, least, most))
                    piece, least, most = (account, slice_no), min(floor, opening), floor - low - 1
                if cents > 0 or least + cents >= floor:
                    least, most = least + cents, most + cents
                elif most + cents >= floor:
                    # Some openings are refused, the others leave the floor at least.
                    least, most = min(least, floor), max(floor - cents - 1, most + cents)
            yield pd.DataFrame(done, columns=["account_id", "slice", "least", "most"])
        if piece is not None:
            yield pd.DataFrame([(*piece, least, most)], columns=["account_id", "slice", "least", "most"])

    return walk


def _ranger() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The range of balances with which each piece may open, from the bounds of the pieces before."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, low, high, none = None, 0, 0, True
        for batch in batches:
            out = []
            columns = (batch[c].tolist() for c in ("account_id", "slice", "opening", "floor", "free", "low", "least", "most"))
            for account, slice_no, opening, floor, free, lowest_sum, least, most in zip(*columns, strict=True):
                if none or account != last:
                    last, low, high, none = account, opening, opening, False
                out.append((account, slice_no, low, high))
                calm_from = floor - lowest_sum
                if low >= calm_from:
                    low, high = low + free, high + free
                elif high >= calm_from:
                    low, high = min(int(least), calm_from + free), max(int(most), high + free)
                else:
                    low, high = int(least), int(most)
            yield pd.DataFrame(out, columns=["account_id", "slice", "lowest", "highest"])

    return walk


def _stepper() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Each piece as a step function: from the opening ``at[i]`` on, the balance moves by ``moves[i]``."""
    block = 256

    def merged(at: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = np.append(True, moves[1:] != moves[:-1])
        return at[keep], moves[keep]

    def steps(cents: list[int], floor: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """The function of a few requests over openings from ``low`` to ``high``."""
        at, moves = np.array([low]), np.array([0])
        for change in cents:
            if change > 0:
                moves = moves + change
                continue
            need = floor - change
            ends = np.append(at[1:] - 1, high)
            first = at + moves
            cut = np.flatnonzero((first < need) & (ends + moves >= need))
            if len(cut):
                at, moves = np.insert(at, cut + 1, need - moves[cut]), np.insert(moves, cut + 1, moves[cut])
            moves = moves + np.where(at + moves >= need, change, 0)
        return merged(at, moves)

    def then(at: np.ndarray, moves: np.ndarray, high: int, cents: list[int], floor: int) -> tuple[np.ndarray, np.ndarray]:
        """The function followed by some more requests."""
        ends = np.append(at[1:] - 1, high)
        next_at, next_moves = steps(cents, floor, int((at + moves).min()), int((ends + moves).max()))
        begin = np.searchsorted(next_at, at + moves, "right") - 1
        parts = np.searchsorted(next_at, ends + moves, "right") - begin
        own = np.repeat(np.arange(len(at)), parts)
        other = np.repeat(begin - np.append(0, np.cumsum(parts)[:-1]), parts) + np.arange(len(own))
        return merged(np.maximum(at[own], next_at[other] - moves[own]), moves[own] + next_moves[other])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece, held, at, moves, floor, high = None, [], None, None, 0, 0

        def result() -> tuple:
            done = then(at, moves, high, held, floor)
            return (*piece, done[0].tolist(), done[1].tolist())

        for batch in batches:
            out = []
            columns = (batch[c].tolist() for c in ("account_id", "slice", "cents", "floor", "lowest", "highest"))
            for account, slice_no, cents, own_floor, lowest, highest in zip(*columns, strict=True):
                if (account, slice_no) != piece:
                    if piece is not None:
                        out.append(result())
                    piece, held, floor, high = (account, slice_no), [], own_floor, highest
                    at, moves = np.array([lowest]), np.array([0])
                held.append(cents)
                if len(held) == block:
                    at, moves = then(at, moves, high, held, floor)
                    held = []
            yield pd.DataFrame(out, columns=["account_id", "slice", "at", "moves"])
        if piece is not None:
            yield pd.DataFrame([result()], columns=["account_id", "slice", "at", "moves"])

    return walk


def _opener() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The balance with which each piece opens, by the functions of the pieces before."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, balance, none = None, 0, True
        for batch in batches:
            out = []
            columns = (batch[c].tolist() for c in ("account_id", "slice", "opening", "floor", "free", "low", "at", "moves"))
            for account, slice_no, opening, floor, free, low, at, moves in zip(*columns, strict=True):
                if none or account != last:
                    last, balance, none = account, opening, False
                out.append((account, slice_no, balance))
                if balance + low >= floor:
                    balance += free
                elif at is not None:
                    balance += int(moves[bisect.bisect_right(at, balance) - 1])
            yield pd.DataFrame(out, columns=["account_id", "slice", "start"])

    return walk
