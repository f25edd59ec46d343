"""Survivorship: one golden record per cluster.

Each field takes the most frequent value that is not blank, the smallest of them on a tie, and ``""`` when
all are blank. A cluster id is its smallest member id.

Ordinary clusters are merged in one aggregation. A cluster above ``large_rows`` members takes a second
path: its votes are counted per value before they meet, and its member list is sorted in ranges over many
tasks, so that only the finished row is ever in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.text import strip
from kinfold.schema import FIELDS, GOLDEN_COLUMNS, GOLDEN_SCHEMA, RECORD_ID

LARGE_ROWS = 10_000
_BROADCAST_CLUSTERS = 100_000


def _require_unique(df: DataFrame, column: str, what: str) -> None:
    repeated = df.groupBy(column).count().filter("count > 1").select(column).limit(3).collect()
    if repeated:
        shown = ", ".join(sorted(str(r[0]) for r in repeated))
        raise ValueError(f"{column} must be unique in the {what}; repeated: {shown}")


def attach_clusters(records: DataFrame, clusters: DataFrame, check_unique: bool = True) -> DataFrame:
    """Records with their ``cluster_id``; a record without one stands alone."""
    if check_unique:
        _require_unique(records, RECORD_ID, "records")
        _require_unique(clusters, RECORD_ID, "clusters")
    known = clusters.select(F.col(RECORD_ID).alias("_id"), "cluster_id")
    joined = records.join(known, F.col(RECORD_ID) == F.col("_id"), "left").drop("_id")
    return joined.withColumn("cluster_id", F.coalesce("cluster_id", RECORD_ID))


def _ballot(column: str) -> Column:
    return F.when(strip(column) != "", F.col(column))


def _merge(members: DataFrame) -> DataFrame:
    elected = [F.coalesce(F.mode(_ballot(c), True), F.lit("")).alias(c) for c in FIELDS]
    ids = F.array_sort(F.collect_list(RECORD_ID))
    merged = members.groupBy("cluster_id").agg(*elected, ids.alias("ids"))
    return merged.select(
        F.col("ids")[0].alias("cluster_id"),
        *FIELDS,
        F.size("ids").cast("bigint").alias("source_record_count"),
        F.concat_ws(",", "ids").alias("source_record_ids"),
    )


def _elect_large(members: DataFrame) -> DataFrame:
    ballots = F.array(*[F.struct(F.lit(c).alias("field"), _ballot(c).alias("value")) for c in FIELDS])
    votes = members.select("cluster_id", F.inline(ballots)).filter("value is not null")
    counted = votes.groupBy("cluster_id", "field", "value").agg(F.count("*").alias("n"))
    # The least of (-votes, value) is the most frequent value, the smallest on a tie.
    order = F.struct((-F.col("n")).alias("n"), F.col("value"))
    winners = [F.min(F.when(F.col("field") == c, order)).alias(c) for c in FIELDS]
    best = counted.groupBy("cluster_id").agg(*winners)
    return best.select("cluster_id", *[F.coalesce(F.col(f"{c}.value"), F.lit("")).alias(c) for c in FIELDS])


def _list_large(members: DataFrame, parts: int) -> DataFrame:
    ranged = members.select("cluster_id", RECORD_ID).repartitionByRange(parts, "cluster_id", RECORD_ID)
    ranged = ranged.withColumn("part", F.spark_partition_id())
    pieces = ranged.groupBy("cluster_id", "part").agg(
        F.count("*").alias("n"),
        F.min(RECORD_ID).alias("first_id"),
        F.concat_ws(",", F.array_sort(F.collect_list(RECORD_ID))).alias("ids"),
    )
    # A range comes before the next one, so joining the sorted pieces in order sorts the whole list.
    in_order = F.array_sort(F.collect_list(F.struct("part", "ids")))
    return pieces.groupBy("cluster_id").agg(
        F.sum("n").alias("source_record_count"),
        F.min("first_id").alias("least_id"),
        F.concat_ws(",", F.transform(in_order, lambda p: p["ids"])).alias("source_record_ids"),
    )


def _merge_large(members: DataFrame, records: int, large_rows: int) -> DataFrame:
    lists = _list_large(members, max(1, -(-records // large_rows)))
    # A cluster whose every field is blank has a list but no election result.
    joined = lists.join(_elect_large(members), "cluster_id", "left")
    return joined.select(
        F.col("least_id").alias("cluster_id"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in FIELDS],
        "source_record_count",
        "source_record_ids",
    )


def merge_clusters(members: DataFrame, large_rows: int = LARGE_ROWS) -> DataFrame:
    """Golden records of records that already carry their ``cluster_id``."""
    sizes = members.groupBy("cluster_id").agg(F.count("*").alias("n")).filter(F.col("n") > large_rows)
    large = sizes.limit(_BROADCAST_CLUSTERS + 1).collect()
    if not large:
        return _merge(members)
    if len(large) <= _BROADCAST_CLUSTERS:
        found = members.sparkSession.createDataFrame(large, sizes.schema)
        ids = F.broadcast(found.select(F.col("cluster_id").alias("_large")))
    else:
        ids = sizes.select(F.col("cluster_id").alias("_large"))  # strategy by the sizes at run time
    is_large = F.col("cluster_id") == F.col("_large")
    rows = sizes.agg(F.sum("n")).first()[0]  # the list above may be cut
    ordinary = _merge(members.join(ids, is_large, "left_anti"))
    return ordinary.unionByName(_merge_large(members.join(ids, is_large, "left_semi"), rows, large_rows))


def build_golden_records(records: DataFrame, clusters: DataFrame, check_unique: bool = True) -> DataFrame:
    """One row per cluster of the unfolded records, with the surviving values and its member ids."""
    return merge_clusters(attach_clusters(records, clusters, check_unique))


def to_golden_contract(golden: DataFrame) -> DataFrame:
    """Golden columns in order and type; a null in a required column fails the job."""
    required = {f.name for f in GOLDEN_SCHEMA if not f.nullable}
    columns = []
    for field in GOLDEN_SCHEMA:
        value = F.col(field.name).cast(field.dataType)
        if field.name in required:
            message = F.lit(f"golden record without {field.name}")
            value = F.when(value.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return golden.select(*columns)


def cluster_members(golden: DataFrame) -> DataFrame:
    """``(cluster_id, record_id)`` for each id in the member list of a golden record."""
    return golden.select("cluster_id", F.explode(F.split("source_record_ids", ",")).alias(RECORD_ID))


def run_metrics(golden: DataFrame) -> DataFrame:
    """Input and golden records, clusters of more than one record, and records merged away."""
    count = F.col("source_record_count")
    totals = golden.agg(
        F.coalesce(F.sum(count), F.lit(0)).cast("bigint").alias("input_records"),
        F.count("*").alias("golden_records"),
        F.count_if(count > 1).alias("duplicate_clusters"),
    )
    return totals.withColumn("records_merged_away", F.col("input_records") - F.col("golden_records"))


def golden_order(golden: DataFrame) -> DataFrame:
    return golden.select(*GOLDEN_COLUMNS).orderBy("cluster_id")
