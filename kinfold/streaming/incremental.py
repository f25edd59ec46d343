"""Continuous resolution: files that arrive in a folder become appended golden records.

Each micro-batch is resolved on its own. Its rows, the new high-water mark and the batch number are
published in one step before the stream commits the batch, so a restarted stream neither loses nor repeats
one. Records at or below the mark came late and are dropped, but counted.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinfold.config import Settings
from kinfold.operators.batches import select_new_records
from kinfold.operators.model import Model
from kinfold.plans.resolve import resolve_records
from kinfold.plans.run import golden_of
from kinfold.schema import RECORD_ID, RECORD_SCHEMA
from kinfold.scratch import Scratch
from kinfold.sources.files import check_ids, csv_options, has_comma, path_exists, to_records
from kinfold.sources.snapshots import Mark, SnapshotTable


@dataclass(frozen=True)
class BatchOutcome:
    batch: int
    records: int
    late_records: int
    golden_records: int
    published: bool


def resolve_batch(
    batch: DataFrame,
    number: int,
    stream: str,
    table: SnapshotTable,
    settings: Settings,
    model: Model | None = None,
) -> BatchOutcome:
    """Resolve and append one micro-batch, unless it was published before."""
    if table.has_batch(stream, number):
        return BatchOutcome(number, 0, 0, 0, False)
    scratch = Scratch(batch.sparkSession, f"batch-{number}")
    arrived = scratch.materialise(to_records(batch), "arrived")
    base = table.manifest()
    mark = base.mark
    records = select_new_records(arrived, mark.highest_record_id if mark else None)
    fresh = F.lit(True) if mark is None else F.col(RECORD_ID) > mark.highest_record_id
    seen = arrived.agg(
        F.count_if(fresh).alias("new"), F.count_if(~fresh).alias("late"), F.count_if(fresh & has_comma()).alias("commas"), F.max(RECORD_ID).alias("greatest")
    ).first()
    if not seen["new"]:
        return BatchOutcome(number, 0, seen["late"], 0, False)
    check_ids(records, seen["commas"])
    linkage = resolve_records(records, settings, model)
    golden, counts = golden_of(records, linkage, scratch)
    table.publish(
        golden, append=True, mark=Mark(seen["greatest"], linkage.input_records), stream_batch=(stream, number), base=base
    )
    return BatchOutcome(number, linkage.input_records, seen["late"], counts["golden_records"], True)


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint folder; a new folder numbers its batches from 0 again."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def start_stream(
    spark: SparkSession,
    source: str,
    table: SnapshotTable,
    checkpoint: str,
    settings: Settings,
    source_format: str = "parquet",
    stream: str = "records",
    model: Model | None = None,
    files_per_batch: int | None = None,
    outcomes: list[BatchOutcome] | None = None,
    multi_line: bool = True,
) -> StreamingQuery:
    """Process all files that are there now, then stop; start again with the same checkpoint to resume.

    Columns and their types come from the files, as in a batch read: further columns are ignored, numbers become text.
    """
    options = csv_options(multi_line) if source_format == "csv" else {}
    found = path_exists(spark, source)
    schema = spark.read.format(source_format).options(**options).load(source).schema if found else RECORD_SCHEMA
    reader = spark.readStream.format(source_format).options(**options).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def publish(batch: DataFrame, number: int) -> None:
        name = f"{stream}@{_checkpoint_id(spark, checkpoint)}"
        outcome = resolve_batch(batch, number, name, table, settings, model)
        if outcomes is not None:
            outcomes.append(outcome)

    writer = reader.load(source).writeStream.queryName(stream).foreachBatch(publish)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
