from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

SF_DIR = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


#: Nulls in every column, empty, very short and very long texts, ties and repeated rows.
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ROWS = [
    (1, PASSAGE + " one end", "en", "a", 1),
    (2, "start two " + PASSAGE, "en", "b", 1),
    (3, "", "en", "a", 0),
    (4, None, None, None, None),
    (None, "orphan text of a row without id", "fr", "a", 1),
    (5, LONG, "en", "a", 1),
    (6, LONG, "en", "c", 1),
    (7, "é à ü ß 日本語 \x1c ", None, "c", 1),
    (8, "two words", "de", None, 1),
    (8, "two words", "de", None, 1),
    (9, " \n\t ", "de", "b", 1),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(ROWS, DOC).select("*", *[f"1 as {c}" for c in ()])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)
