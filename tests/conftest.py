from __future__ import annotations

import sys
from dataclasses import dataclass
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kinfold.config import Settings  # noqa: E402
from kinfold.operators.survivorship import build_golden_records  # noqa: E402
from kinfold.plans.resolve import Linkage, resolve_records  # noqa: E402
from kinfold.schema import RECORD_COLUMNS  # noqa: E402
from kinfold.sources.generator import generate_records  # noqa: E402

PEOPLE = 300
SEED = 1729


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("kinfold-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@dataclass
class Sample:
    records: DataFrame
    truth: DataFrame
    linkage: Linkage
    golden: DataFrame


@pytest.fixture(scope="session")
def sample(spark) -> Sample:
    """300 invented people, resolved once."""
    generated = generate_records(spark, PEOPLE, seed=SEED).cache()
    records = generated.select(*RECORD_COLUMNS)
    linkage = resolve_records(records, Settings())
    golden = build_golden_records(records, linkage.clusters).cache()
    return Sample(records, generated.select("record_id", "truth"), linkage, golden)


def rows(df: DataFrame) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())
