"""A cross-section of the registered queries against their SQL twins on the smallest tables.

``python -m checks.compare`` runs all of them.
"""

from pathlib import Path

import pytest

from checks import registry
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
CROSS_SECTION = [
    "flow_rate", "flow_history", "flow_matrix", "daily_roll", "kpi_status", "alert_base", "tab_response_by_region",
    "alert_report", "cash_count_check", "over_title_limit", "fraud_checklist", "compliance_features", "audit_sample",
    "reminders_audit_issue", "previous_contracts", "date_functions",
]

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not found")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(registry.spark_queries()) == set(registry.sql_twins())


@pytest.mark.parametrize("name", CROSS_SECTION)
def test_query(spark, con, name):
    _, problem = compare(spark, con, registry.spark_queries()[name], registry.sql_twins()[name], SF)
    assert problem is None, problem


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
