"""Every status, rule, family, style and change occurs in what the queries are compared with."""

import pytest

from archivekit.plans.oracles import ORACLES
from compare import connect


@pytest.fixture(scope="module")
def con():
    return connect("/root/testdata/sf0.01")


@pytest.mark.parametrize("query, column, values", [
    ("day_plan_statuses", "status", {"OK", "PRESENT", "EMPTY", "NO_RULES", "UNKNOWN_RECORDER"}),
    ("failed_days", "status", {"OK", "FAILED"}),
    ("select_cascade_gecko", "rule", {"local", "telemetered", "patched"}),
    ("choose_files", "keep", {"all", "underscored"}),
    ("days_changed", "change", {"new", "changed", "same"}),
    ("parse_names", "style", {"underscored", "spaced"}),
    ("recorder_type", "recorder", {"echo", "gecko"}),
])
def test_branch_occurs(con, query, column, values):
    found = {r[0] for r in con.execute(f"SELECT DISTINCT {column} FROM ({ORACLES[query]})").fetchall()}
    assert values <= found
