"""All registered queries with their SQL twins."""

from __future__ import annotations

from . import alert_queries, compliance_queries, flow_queries, operator_queries, rule_queries, storage_queries
from .portable import portable

MODULES = [flow_queries, alert_queries, rule_queries, compliance_queries, operator_queries, storage_queries]


def _as_portable(fn):
    return lambda spark, sf: portable(fn(spark, sf))


def spark_queries() -> dict:
    return {name: _as_portable(fn) for module in MODULES for name, fn in module.QUERIES.items()}


def sql_twins() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
