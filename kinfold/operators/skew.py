"""Look up one value per key for a table in which a few keys may hold most of the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot above this many rows and above this share of all rows, so at most
# 1 / HOT_SHARE keys can be hot however large the table is.
HOT_ROWS = 50_000
HOT_SHARE = 0.001

#: Rows of a task that expands them or deals them out. A writer holds the rows of its task, and a small file is one task.
SPREAD_ROWS = 50_000


def spread(rows: DataFrame, total: int, column: str, most: int = SPREAD_ROWS) -> DataFrame:
    """``rows``, of which there are ``total``, in tasks of about ``most`` rows by hash of ``column``; few rows stay as they are."""
    tasks = math.ceil(total / most)
    return rows.repartition(tasks, column) if tasks > 1 else rows


def hot_limit(total_rows: int, hot_rows: int = HOT_ROWS) -> float:
    return max(hot_rows, total_rows * HOT_SHARE)


def lookup(
    rows: DataFrame,
    values: DataFrame,
    on: list[str],
    weight: str,
    total_rows: int,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``rows`` with ``values``, which has one row per key and its row count in ``weight``.

    Hot keys are at most ``1 / HOT_SHARE`` rows of ``values``; they are broadcast, and only the other
    rows are shuffled by key. Keys are compared null-safe and ``weight`` is dropped.
    """
    limit = hot_limit(total_rows, hot_rows)
    cold_values = values.drop(weight)
    if total_rows <= limit:
        return _join(rows, cold_values, on, how)
    hot = values.filter(F.col(weight) > limit).drop(weight)
    hot = rows.sparkSession.createDataFrame(hot.collect(), hot.schema)  # at most 1 / HOT_SHARE rows
    if hot.isEmpty():
        return _join(rows, cold_values, on, how)
    fast = _join(rows, F.broadcast(hot), on, "inner")
    rest = rows.join(F.broadcast(hot.select(*[F.col(c).alias(f"_{c}") for c in on])), _same(on), "left_anti")
    return fast.unionByName(_join(rest, cold_values, on, how))


def _same(on: list[str]) -> Column:
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return condition


def _join(rows: DataFrame, values: DataFrame, on: list[str], how: str) -> DataFrame:
    renamed = values.withColumnsRenamed({c: f"_{c}" for c in on})
    return rows.join(renamed, _same(on), how).drop(*[f"_{c}" for c in on])
