"""A cross-section of the registered queries against their SQL; `python -m tests.oracle_check` runs all of them."""

import pytest

from tallyspark import catalog
from tests.conftest import SF
from tests.oracle_check import compare, connect

KEYS = ["trial_balance", "pl_monthly", "pl_monthly_ddl", "balance_sheet_wide", "cashflow_indirect", "kpi_profitability", "kpi_liquidity", "kpi_cashflow",
        "kpi_project", "variance_analysis", "consolidated_pl", "stage_gl", "fx_exact_date", "fx_asof", "ic_flag_effective_dated", "resolve_dimensions",
        "scan_json_journal", "sink_merge_by_key", "dq_log", "dq_detail_json", "alert_evaluate", "alert_cooldown", "scd2_snapshot", "variance_fact_pack",
        "m_revenue_rag", "forecast_seasonal", "stream_session_activity", "stream_alert_cooldown", "restatement_late_ids"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", KEYS)
def test_matches_sql(spark, con, key):
    problem, _ = compare(catalog.queries()[key](spark, SF), catalog.oracle_sql()[key], con)
    assert problem is None


def test_only_forests_lack_an_oracle():
    missing = set(catalog.queries()) - set(catalog.oracle_sql())
    assert missing == {"anomaly_isolation_forest", "anomaly_queue"}


def test_entry(spark):
    import __spark_entry__ as e
    assert e.entry(spark).count() > 0


def test_registry_loads_without_a_session():
    import subprocess
    import sys
    code = "import sys; sys.path.insert(0, '.'); import __spark_entry__ as e; print(len(e.queries()) > 300, len(e.oracle_sql()) > 290)"
    root = __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True).stdout.split() == ["True", "True"]
