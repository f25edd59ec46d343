"""Pairwise quality of an assignment of records to groups.

Counts follow from group sizes; no pair is listed to measure precision and recall.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators.blocking import Rule, block_pairs
from kinfold.schema import RECORD_ID


def group_pairs(assignment: DataFrame, group: str, id_column: str = RECORD_ID) -> DataFrame:
    """Every pair of records of one group."""
    return block_pairs(assignment.select(id_column, group), Rule.on(group), id_column)


def _pairs() -> Column:
    n = F.col("n").cast("decimal(20,0)")
    return F.coalesce(F.sum(F.floor(n * (n - 1) / 2)), F.lit(0)).cast("bigint")


def linkage_quality(predicted: DataFrame, truth: DataFrame, id_column: str = RECORD_ID) -> DataFrame:
    """Pairwise precision, recall and F1 of ``cluster_id`` against ``truth``; 0 where undefined.

    Records that share both labels are the pairs found and true, so all three counts are sums of
    n (n - 1) / 2 over groups.
    """
    both = predicted.select(id_column, "cluster_id").join(truth.select(id_column, "truth"), id_column)
    cells = both.groupBy("cluster_id", "truth").agg(F.count("*").alias("n"))
    parts = [
        predicted.groupBy("cluster_id").agg(F.count("*").alias("n")).agg(_pairs().alias("predicted_pairs")),
        truth.groupBy("truth").agg(F.count("*").alias("n")).agg(_pairs().alias("true_pairs")),
        cells.agg(_pairs().alias("found_pairs")),
    ]
    merged = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    names = ("predicted_pairs", "true_pairs", "found_pairs")
    totals = merged.agg(*[F.max(c).alias(c) for c in names])
    p, t, f = (F.col(c) for c in names)
    return totals.select(
        *names,
        F.when(p == 0, 0.0).otherwise(f / p).alias("precision"),
        F.when(t == 0, 0.0).otherwise(f / t).alias("recall"),
        F.when(p + t == 0, 0.0).otherwise(2.0 * f / (p + t)).alias("f1"),
    )


def partition_check(records: DataFrame, members: DataFrame, id_column: str = RECORD_ID) -> DataFrame:
    """Records, listed members, and how many are missing, unknown or listed more than once."""
    listed = members.groupBy(id_column).agg(F.count("*").alias("times"))
    known = records.select(F.col(id_column).alias("_id"))
    joined = known.join(listed, F.col("_id") == F.col(id_column), "full")
    times = F.coalesce("times", F.lit(0))
    return joined.agg(
        F.count("_id").alias("records"),
        F.sum(times).alias("listed"),
        F.count_if(times == 0).alias("missing"),
        F.count_if(F.col("_id").isNull()).alias("unknown"),
        F.count_if(times > 1).alias("repeated"),
    )
