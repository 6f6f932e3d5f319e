"""Name -> (Spark plan, reference SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan; without ``sql`` only its rows are checked."""

    def keep(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"{name} registered twice")
        PLANS[name] = plan
        if sql is not None:
            SQL[name] = sql.strip()
        return plan

    return keep
