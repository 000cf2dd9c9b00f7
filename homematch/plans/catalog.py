"""Register of queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from homematch.plans.sqltext import with_views
from homematch.plans.views import Tables

RUNS: dict[str, Callable[[Tables], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = "") -> Callable:
    """Register a query; ``views`` names the views its SQL reads."""

    def register(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in RUNS:
            raise ValueError(f"{name} is registered twice")
        RUNS[name] = run
        if sql:
            CHECKS[name] = with_views(views.split(), sql)
        return run

    return register


def runnable() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries as functions of a session and a data folder."""
    from homematch.plans import q_features, q_jobs, q_joins, q_model, q_profile, q_scalars, q_stores  # noqa: F401

    return {name: (lambda spark, folder, run=run: run(Tables(spark, folder))) for name, run in RUNS.items()}


def checks() -> dict[str, str]:
    runnable()
    return dict(CHECKS)


def rounded(value: Column | str, places: int = 6) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, places)


def whole(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("bigint")


def day(value: Column | str) -> Column:
    return F.date_format(value, "yyyy-MM-dd")
