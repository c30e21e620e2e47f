"""Ledger reports against known results, and replay against a plain loop."""

from __future__ import annotations

import bisect
import datetime as dt
import random
from decimal import Decimal as D

import pandas as pd
import pytest
from pyspark.sql import functions as F

from abacarium.operators import ledger as led
from abacarium.operators.replay import _stepper, replay
from abacarium.operators.transfers import ChainTooLong, settle_transfers, settled_entries
from abacarium.session import scratch_path

NOW = dt.datetime(2026, 9, 15, 9, 41, 40)
# The recorded entries; all have the same time, so only the position orders them.
ENTRIES = """
ACC1001 DEPOSIT 5000 5000 | ACC1001 DEPOSIT 1500 6500 | ACC1001 WITHDRAWAL 800 5700 | ACC1001 TRANSFER_OUT 1000 4700
ACC1002 DEPOSIT 1000 1000 | ACC1002 WITHDRAWAL 1300 -300 | ACC1002 TRANSFER_IN 1000 700 | ACC1002 DEPOSIT 200 900
ACC1003 DEPOSIT 2000 2000 | ACC1003 DEPOSIT 300 2300 | ACC1003 DEPOSIT 92 2392
"""
SCHEMA = ("ts timestamp_ntz, account_id string, type string, amount decimal(12,2), balance_after decimal(12,2), "
          "seq bigint")


@pytest.fixture(scope="module")
def ledger(spark):
    parts = [p.split() for p in ENTRIES.strip().replace("\n", "|").split("|")]
    rows = [(NOW, a, kind, D(amount), D(balance), i) for i, (a, kind, amount, balance) in enumerate(parts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def accounts(spark):
    rows = [("ACC1001", "savings", D("0.05"), D(500), D(0)), ("ACC1002", "current", D(0), D(0), D(500)),
            ("ACC1003", "savings", D("0.04"), D(500), D(0))]
    return spark.createDataFrame(rows, "account_id string, kind string, interest_rate decimal(6,4), "
                                       "min_balance decimal(12,2), overdraft_limit decimal(12,2)")


def test_by_account(ledger):
    rows = {r[0]: tuple(r)[1:] for r in led.by_account(ledger).collect()}
    assert rows == {"ACC1001": (4, D(6500), D(1800), D(4700)), "ACC1002": (4, D(2200), D(1300), D(900)),
                    "ACC1003": (3, D(2392), D(0), D(2392))}


def test_by_type_and_net_flow(ledger):
    rows = {r["type"]: (r["count"], r["sum"], r["mean"]) for r in led.by_type(ledger).collect()}
    assert rows == {"DEPOSIT": (7, D(10092), D("1441.71")), "WITHDRAWAL": (2, D(2100), D(1050)),
                    "TRANSFER_IN": (1, D(1000), D(1000)), "TRANSFER_OUT": (1, D(1000), D(1000))}
    assert led.net_flow(ledger).first()[0] == D("7992.00")


def test_largest_keeps_ledger_order_for_ties(ledger):
    rows = led.largest(ledger, 5).collect()
    assert [(r["amount"], r["seq"]) for r in rows] == [(5000, 0), (2000, 8), (1500, 1), (1300, 5), (1000, 3)]


@pytest.mark.parametrize("slices", [1, 5, None])
def test_running_balance_reconciles(ledger, slices):
    assert led.reconcile(ledger, slices=slices).count() == 0
    wrong = ledger.withColumn("balance_after", F.when(F.col("seq") == 5, 0).otherwise(F.col("balance_after")))
    assert [r["seq"] for r in led.reconcile(wrong).collect()] == [5]
    cut = led.running_balance(ledger, slices=7)
    assert cut.where("balance <> balance_after").count() == 0


def test_rules_and_interest(ledger, accounts):
    assert led.audit_rules(ledger, accounts).count() == 0
    strict = accounts.withColumn("overdraft_limit", F.lit(100).cast("decimal(12,2)"))
    found = led.audit_rules(ledger, strict).collect()
    assert [(r["seq"], r["violation"]) for r in found] == [(5, "overdraft limit exceeded")]
    early = ledger.where("account_id = 'ACC1003' AND seq < 10")
    posted = led.interest_postings(led.current_balances(early), accounts, "2026-09-15").collect()
    assert [(r["account_id"], r["amount"], r["balance_after"]) for r in posted] == [("ACC1003", D("92.00"), D("2392.00"))]


def test_transfers_pair_up(ledger, spark):
    rows = [(1, NOW, "a", "b", D(10)), (2, NOW, "b", "a", D(5))]
    legs = led.transfer_legs(spark.createDataFrame(
        rows, "seq bigint, ts timestamp_ntz, from_account string, to_account string, amount decimal(12,2)"))
    assert legs.count() == 4 and led.unpaired_transfers(legs).count() == 0
    broken = led.unpaired_transfers(legs.where("NOT (seq = 2 AND type = 'TRANSFER_IN')")).collect()
    assert [(r["seq"], r["out_legs"], r["in_legs"], r["difference"]) for r in broken] == [(2, 1, 0, D(-5))]


def test_export_and_read_back(spark, ledger):
    path = scratch_path(spark, "ledger")
    led.export(ledger, path)
    again = led.read(spark, path)
    assert sorted(again.select("seq", "account_id", "balance_after").collect()) == sorted(
        ledger.select("seq", "account_id", "balance_after").collect())
    assert again.where(F.col("ts") == F.lit(NOW)).count() == 11
    assert sorted(led.by_account(again).collect()) == sorted(led.by_account(ledger).collect())


@pytest.mark.parametrize("keep_seq", [True, False])
def test_a_large_export_keeps_its_order(spark, keep_seq):
    i = F.col("id")
    rows = spark.range(20_000).select(
        F.lit(NOW).alias("ts"), F.concat(F.lit("A"), i % 3).alias("account_id"), F.lit("DEPOSIT").alias("type"),
        F.lit(1).cast("decimal(12,2)").alias("amount"), (F.expr("id div 3") + 1).cast("decimal(12,2)").alias("balance_after"), i.alias("seq"))
    path = scratch_path(spark, "ledger")
    led.export(rows, path, [*led.CSV_COLUMNS, "seq"] if keep_seq else led.CSV_COLUMNS)
    again = led.read(spark, path, has_seq=keep_seq)
    assert {r["account_id"]: r["final_balance"] for r in led.by_account(again).collect()} == {"A0": 6667, "A1": 6667, "A2": 6666}
    assert led.reconcile(again).count() == 0


def _write_entries(path, first, last):
    lines = [f"2026-09-15 09:41:40,ACC,DEPOSIT,1,{i}" for i in range(first, last + 1)]
    path.write_text("\n".join(["timestamp,account_id,type,amount,balance_after", *lines]) + "\n")


def test_files_are_taken_in_the_order_of_their_names(spark, tmp_path):
    _write_entries(tmp_path / "a.csv", 1, 3)
    _write_entries(tmp_path / "b.csv", 4, 2003)
    recorded = led.read(spark, str(tmp_path), led.CSV_TIME, has_seq=False)
    assert led.reconcile(recorded).count() == 0
    assert led.by_account(recorded).first()["final_balance"] == 2003


def test_position_in_the_file_orders_entries(spark, ledger, tmp_path):
    lines = ["timestamp,account_id,type,amount,balance_after"]
    lines += [f"2026-09-15 09:41:40,{r['account_id']},{r['type']},{r['amount']},{r['balance_after']}"
              for r in ledger.orderBy("seq").collect()]
    (tmp_path / "entries.csv").write_text("\n".join(lines) + "\n")
    recorded = led.read(spark, str(tmp_path / "entries.csv"), led.CSV_TIME, has_seq=False)
    assert led.reconcile(recorded).count() == 0
    assert {r[0]: r[4] for r in led.by_account(recorded).collect()} == {"ACC1001": 4700, "ACC1002": 900, "ACC1003": 2392}


def test_statement_numbers_entries(ledger):
    rows = led.statement(ledger).where("account_id = 'ACC1002'").orderBy("entry_no").collect()
    assert [(r["entry_no"], r["balance"]) for r in rows] == [(1, 1000), (2, -300), (3, 700), (4, 900)]


REQUESTS = "seq bigint, ts timestamp_ntz, account_id string, type string, amount decimal(12,2)"


def test_replay_of_the_recorded_session(spark, accounts):
    requests = [("ACC1001", "DEPOSIT", 1500), ("ACC1001", "WITHDRAWAL", 800), ("ACC1002", "WITHDRAWAL", 1300),
                ("ACC1003", "DEPOSIT", 300), ("ACC1003", "DEPOSIT", 92), ("ACC1002", "DEPOSIT", 200), ("ACC1003", "WITHDRAWAL", 5000)]
    rows = [(i, NOW, account, kind, D(value)) for i, (account, kind, value) in enumerate(requests)]
    opened = accounts.withColumn("opening", F.expr(
        "CASE account_id WHEN 'ACC1001' THEN 5000 WHEN 'ACC1002' THEN 1000 ELSE 2000 END").cast("decimal(12,2)"))
    found = {r["seq"]: r for r in replay(spark.createDataFrame(rows, REQUESTS), opened).collect()}
    assert [found[i]["balance_after"] for i in range(7)] == [6500, 5700, -300, 2300, 2392, -100, 2392]
    assert [found[i]["accepted"] for i in range(7)] == [True] * 6 + [False]
    assert found[6]["reason"] == "below minimum balance"


def _loop(requests, floors, opening=None):
    """All requests one after the other."""
    balance, out = {**dict.fromkeys(floors, 0), **(opening or {})}, {}
    for seq, _, account, kind, value in requests:
        value = int(value * 100)
        ok = value > 0 and (kind == "DEPOSIT" or balance[account] - value >= floors[account])
        balance[account] += (value if kind == "DEPOSIT" else -value) * ok
        out[seq] = (ok, balance[account])
    return out


@pytest.mark.parametrize("seed, slices", [(1, 7), (2, 23), (3, None)])
def test_replay_matches_a_loop(spark, seed, slices):
    """One account holds a third of the requests, slices cut accounts."""
    rng = random.Random(seed)
    floors = {"a": 0, "b": 50_000, "c": -100_000, "d": 0, "e": 50_000}
    kinds = {"a": "base", "b": "savings", "c": "current", "d": "base", "e": "savings"}
    requests = []
    for seq in range(400):
        account = "a" if rng.random() < 1 / 3 else rng.choice(list(floors))
        value = D(rng.randint(-2, 900)) + D(rng.randint(0, 99)) / 100
        requests.append((seq, NOW + dt.timedelta(seconds=seq // 5), account, rng.choice(["DEPOSIT", "WITHDRAWAL", "WITHDRAWAL"]), value))
    accounts = spark.createDataFrame(list(kinds.items()), "account_id string, kind string")
    done = replay(spark.createDataFrame(requests, REQUESTS), accounts, slices)
    assert {r["seq"]: (r["accepted"], int(r["balance_after"] * 100)) for r in done.collect()} == _loop(requests, floors)


@pytest.mark.parametrize("slices", [8, 32, 128])
def test_one_busy_account_over_many_slices(spark, slices):
    """6,400 requests of one account, hundreds refused; the passes do not depend on the slices."""
    rng = random.Random(4)
    requests = [(i, NOW, "a", rng.choice(["DEPOSIT", "WITHDRAWAL"]), D(rng.randint(1, 900))) for i in range(6400)]
    accounts = spark.createDataFrame([("a", "base")], "account_id string, kind string")
    done = replay(spark.createDataFrame(requests, REQUESTS), accounts, slices)
    expected = _loop(requests, {"a": 0})
    assert {r["seq"]: (r["accepted"], int(r["balance_after"] * 100)) for r in done.collect()} == expected
    assert sum(not ok for ok, _ in expected.values()) > 50


def _functions(cents, floor, low, high):
    """The step function of requests in one piece, as the second pass makes it."""
    rows = pd.DataFrame({"account_id": "a", "slice": 0, "cents": cents, "floor": floor, "lowest": low, "highest": high})
    return [r for batch in _stepper()(iter([rows])) for r in batch.itertuples()][0]


def test_step_functions_give_the_closing_balance_of_every_opening():
    rng = random.Random(6)
    for size in (1, 5, 40, 700):
        cents = [rng.choice([-1, 1, -1]) * rng.randint(1, 60) for _ in range(size)]
        floor = rng.choice([-50, 0, 20])
        found = _functions(cents, floor, floor, floor + 400)
        for opening in range(floor, floor + 401):
            balance = opening
            for c in cents:
                balance += c if c > 0 or balance + c >= floor else 0
            assert opening + found.moves[bisect.bisect_right(found.at, opening) - 1] == balance


def test_calm_pieces_and_pieces_below_the_floor(spark):
    """An opening below the minimum, and one that nothing can empty."""
    requests = [(i, NOW, a, k, D(v)) for i, (a, k, v) in enumerate(
        [("s", "WITHDRAWAL", 1), ("s", "DEPOSIT", 450), ("s", "WITHDRAWAL", 40), ("s", "DEPOSIT", 30), ("s", "WITHDRAWAL", 40)] * 40
        + [("r", "WITHDRAWAL", 5)] * 50)]
    accounts = spark.createDataFrame([("s", "savings", D(100)), ("r", "base", D(9_000_000))], "account_id string, kind string, opening decimal(12,2)")
    done = {r["seq"]: (r["accepted"], int(r["balance_after"] * 100)) for r in replay(spark.createDataFrame(requests, REQUESTS), accounts, 9).collect()}
    assert done == _loop(requests, {"s": 50_000, "r": 0}, {"s": 10_000, "r": 900_000_000})


def test_requests_that_cannot_be_served_are_refused(spark, accounts):
    rows = [(1, NOW, "ghost", "DEPOSIT", D(5)), (2, NOW, None, "WITHDRAWAL", D(5)), (3, NOW, "ACC1001", "TRANSFER", D(5)),
            (4, NOW, "ACC1001", "DEPOSIT", None)]
    found = {r["seq"]: (r["accepted"], r["reason"]) for r in replay(spark.createDataFrame(rows, REQUESTS), accounts, 3).collect()}
    assert found == {1: (False, "unknown account"), 2: (False, "unknown account"), 3: (False, "unknown type"),
                     4: (False, "amount not positive")}


MIXED = "seq bigint, ts timestamp_ntz, type string, account_id string, to_account string, amount decimal(12,2)"


def _settle_by_hand(requests, floors, opening):
    balance, out = dict(opening), {}
    for seq, _, kind, account, other, value in requests:
        value = int(value * 100)
        if kind == "TRANSFER" and other not in floors:
            out[seq] = (False, None)
            continue
        ok = value > 0 and (kind == "DEPOSIT" or balance[account] - value >= floors[account])
        balance[account] += (value if kind == "DEPOSIT" else -value) * ok
        out[seq] = (ok, balance[account])
        if ok and kind == "TRANSFER":
            balance[other] += value
    return out, balance


def _settled(frame):
    return {r["seq"]: (r["accepted"], None if r["balance_after"] is None else int(r["balance_after"] * 100)) for r in frame.collect()}


@pytest.fixture(scope="module")
def payers(spark):
    return spark.createDataFrame([(a, "base", D(60)) for a in "abcdefgh"], "account_id string, kind string, opening decimal(12,2)")


def test_transfers_to_and_fro_match_a_loop(spark, payers):
    rng = random.Random(12)
    requests = [(i, NOW + dt.timedelta(seconds=i // 4), rng.choice(["TRANSFER"] * 6 + ["DEPOSIT", "WITHDRAWAL"]), rng.choice("abcdefgh"),
                 rng.choice("abcdefgh" * 4 + "?"), D(rng.randint(-2, 90))) for i in range(160)]
    requests = [(i, t, k, a, o if k == "TRANSFER" else None, v) for i, t, k, a, o, v in requests]
    frame = spark.createDataFrame(requests, MIXED)
    expected, left = _settle_by_hand(requests, dict.fromkeys("abcdefgh", 0), dict.fromkeys("abcdefgh", 6000))
    assert 20 < sum(not ok for ok, _ in expected.values()) < 140
    rounds = []
    assert _settled(settle_transfers(frame, payers, 4, rounds=rounds)) == expected
    assert len(rounds) < 60
    entries = settled_entries(frame, payers, 4)
    assert led.unpaired_transfers(entries).count() == 0
    held = {r["account_id"]: int(r["balance"] * 100) for r in led.current_balances(entries).collect()}
    assert {a: 6000 + held.get(a, 0) for a in left} == left


def test_rounds_follow_refusals_not_transfers(spark, payers):
    """Money that goes round fifty times takes one round; a refusal that stops a chain takes one per link."""
    ring = [(i, NOW, "TRANSFER", "abcdefgh"[i % 8], "abcdefgh"[(i + 1) % 8], D(60)) for i in range(400)]
    rounds = []
    done = settle_transfers(spark.createDataFrame(ring, MIXED), payers, rounds=rounds)
    assert done.where("NOT accepted").count() == 0 and rounds == [0]
    # All but the first have nothing of their own, and the first one is refused.
    poor = payers.withColumn("opening", F.lit(0).cast("decimal(12,2)"))
    chain = [(i, NOW, "TRANSFER", "abcdefgh"[i], "abcdefgh"[i + 1], D(60)) for i in range(3)]
    rounds.clear()
    done = settle_transfers(spark.createDataFrame(chain, MIXED), poor, rounds=rounds)
    assert done.where("accepted").count() == 0 and rounds == [1, 1, 1, 0]
    with pytest.raises(ChainTooLong, match="still changed in round 2"):
        settle_transfers(spark.createDataFrame(chain, MIXED), poor, max_rounds=2)


def test_a_transfer_to_oneself_and_to_nobody(spark, payers):
    rows = [(1, NOW, "TRANSFER", "a", "a", D(60)), (2, NOW, "TRANSFER", "a", None, D(5)), (3, NOW, "TRANSFER", "a", "zz", D(5)),
            (4, NOW, "TRANSFER", "zz", "a", D(5)), (5, NOW, "WITHDRAWAL", "a", None, D(60)), (6, NOW, "TRANSFER", "b", "c", None)]
    found = {r["seq"]: (r["accepted"], r["reason"]) for r in settle_transfers(spark.createDataFrame(rows, MIXED), payers).collect()}
    assert found == {1: (True, None), 2: (False, "unknown account to pay to"), 3: (False, "unknown account to pay to"), 4: (False, "unknown account"),
                     5: (True, None), 6: (False, "amount not positive")}
