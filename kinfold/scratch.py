"""Intermediate tables in the shared checkpoint folder of the session.

Iterative steps write each state as Parquet and read it back. That cuts the lineage, survives the loss
of executors and gives the next plan real sizes instead of estimates that grow with every round.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="kinfold-")
    sc.setCheckpointDir(root)
    return root


class Scratch:
    """One run's folder; every table in it is written once under its own name."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"

    def materialise(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def discard(self, name: str) -> None:
        """Drop a table that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
