"""All registered queries and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import discovery, roundtrips  # noqa: F401 (register their queries)
from .plans.queries import QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
