"""The calls of the library under the names that reports and loads use."""

from __future__ import annotations

from abacarium.functions import grade_band, month_range, year_range
from abacarium.operators.facts import fact_scan, insert_if_absent
from abacarium.operators.grading import report_card
from abacarium.operators.jsonclean import clean as json_clean, json_etl, read_records as json_records
from abacarium.operators.ledger import (
    by_account as ledger_by_account, by_type as ledger_by_type, export as ledger_export,
    interest_postings as ledger_interest, largest as ledger_largest, net_flow as ledger_net_flow, read as read_ledger,
    statement as ledger_statement, transfer_legs as ledger_transfers,
)
from abacarium.operators.merge import assign_keys, merge_dimension as merge_dim
from abacarium.operators.quality import apply_rules
from abacarium.operators.replay import replay as ledger_replay
from abacarium.operators.reports import order_summary
from abacarium.operators.rollups import rollup_report
from abacarium.operators.warehouse import run_load
from abacarium.operators.windows import period_over_period, top_k_per_group
from abacarium.sources.files import bulk_load, sink_csv

__all__ = [
    "apply_rules", "assign_keys", "bulk_load", "fact_scan", "grade_band", "insert_if_absent", "json_clean", "json_etl",
    "json_records", "ledger_by_account", "ledger_by_type", "ledger_export", "ledger_interest", "ledger_largest",
    "ledger_net_flow", "ledger_replay", "ledger_statement", "ledger_transfers", "merge_dim", "month_range",
    "order_summary", "period_over_period", "read_ledger", "report_card", "rollup_report", "run_load", "sink_csv",
    "top_k_per_group", "year_range",
]
