"""A named query: a Spark plan over the views and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from layerlint.plans.views import Tables


@dataclass(frozen=True)
class Query:
    plan: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.plan(Tables(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a plan under a name."""

    def register(plan: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = Query(plan, sql)
        return plan

    return register
