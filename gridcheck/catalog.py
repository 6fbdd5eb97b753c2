"""Registry of the queries over the driver's tables, with their SQL oracles.

Each module of gridcheck.queries lists (name, function, SQL or None).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridcheck.queries import batch, checks, labels, repairs, scores, shapes, truths, votes

FLAGSHIP = "verify_summary"
MODULES = (checks, votes, labels, scores, repairs, shapes, truths, batch)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f, _ in m.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, _, sql in m.QUERIES if sql}
