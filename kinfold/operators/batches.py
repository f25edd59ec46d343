"""High-water marks and ordered batches of records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.schema import RECORD_ID
from kinfold.scratch import Scratch

BATCH_ROWS = 50_000
_LOCAL_ROW = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in the low 33 bits


def select_new_records(records: DataFrame, mark: str | None, id_column: str = RECORD_ID) -> DataFrame:
    """Records after the mark, in text order; all of them when there is none."""
    return records if mark is None else records.filter(F.col(id_column) > mark)


def high_water_mark(records: DataFrame, id_column: str = RECORD_ID) -> DataFrame:
    return records.agg(F.max(id_column).alias("highest_record_id"))


def record_batches(
    records: DataFrame,
    batch_size: int = BATCH_ROWS,
    id_column: str = RECORD_ID,
    scratch: Scratch | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``batch_no``: consecutive batches of ``batch_size`` records in id order.

    Records are range-partitioned and sorted by id; a record's rank is its row number within its range
    plus the size of all earlier ranges. Only the sizes of the ranges come together.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    spark = records.sparkSession
    scratch = scratch or Scratch(spark, "batches")
    # Without a number Spark merges small neighbouring ranges, which keeps their order.
    ranged = records.repartitionByRange(*([ranges] if ranges else []), id_column)
    ordered = ranged.sortWithinPartitions(id_column)
    ordered = ordered.withColumns(
        {
            "_range": F.spark_partition_id(),
            "_row": F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_ROW)),
        }
    )
    # Written once: a second run of the range shuffle could cut the ranges elsewhere.
    ordered = scratch.materialise(ordered, "ordered")
    sizes = {r["_range"]: r["count"] for r in ordered.groupBy("_range").count().collect()}  # one row per range
    starts, seen = [], 0
    for number in sorted(sizes):
        starts.append((number, seen))
        seen += sizes[number]
    offsets = F.broadcast(spark.createDataFrame(starts, "_range int, _start bigint"))
    rank = F.col("_start") + F.col("_row")
    numbered = ordered.join(offsets, "_range").withColumn("batch_no", F.floor(rank / batch_size).cast("bigint"))
    return numbered.drop("_range", "_row", "_start")
