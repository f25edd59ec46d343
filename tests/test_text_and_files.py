from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import kinfold.sources.files as files
from conftest import rows
from kinfold.functions.text import clean_records, linkage_view, strip
from kinfold.operators.batches import record_batches, select_new_records
from kinfold.schema import RECORD_COLUMNS
from kinfold.scratch import Scratch
from kinfold.sources.files import InputError, read_records, write_csv

HEADER = ",".join(RECORD_COLUMNS)


def _csv(tmp_path, *lines: str, name: str = "records.csv", end: str = "\n") -> str:
    path = tmp_path / name
    path.write_bytes((end.join((HEADER, *lines)) + end).encode())
    return str(path)


def test_csv_keeps_every_value_as_text(spark, tmp_path):
    path = _csv(
        tmp_path,
        "r1,Ann,Lee,ann@example.com,01234,NA",
        'r2,null,"O""Neil","a,b@example.com",P1,""',
        'r3,"two\nlines",Day,,P2,Ashby',
    )
    found = {r["record_id"]: r for r in read_records(spark, path).collect()}
    assert found["r1"]["postcode"] == "01234"
    assert found["r1"]["city"] == "NA"
    assert found["r2"]["first_name"] == "null"
    assert found["r2"]["last_name"] == 'O"Neil'
    assert found["r2"]["email"] == "a,b@example.com"
    assert found["r2"]["city"] == ""
    assert found["r3"]["first_name"] == "two\nlines"
    assert found["r3"]["email"] == ""


def test_csv_with_crlf_extra_and_reordered_columns(spark, tmp_path):
    path = tmp_path / "records.CSV"
    path.write_bytes(
        b"city,extra,record_id,first_name,last_name,email,postcode\r\nAshby,x,r1,Ann,Lee,a@example.com,01\r\n"
    )
    assert rows(read_records(spark, str(path))) == [("r1", "Ann", "Lee", "a@example.com", "01", "Ashby")]


def test_parquet_matches_csv_and_casts_numbers(spark, tmp_path):
    df = spark.createDataFrame(
        [(7, "Ann", None, "a@example.com", 1234, " Ashby ")],
        "record_id int, first_name string, last_name string, email string, postcode int, city string",
    )
    path = str(tmp_path / "records.parquet")
    df.write.parquet(path)
    assert rows(read_records(spark, path)) == [("7", "Ann", "", "a@example.com", "1234", "Ashby")]


def test_strip_covers_all_white_space(spark):
    df = spark.createDataFrame([("\t  a b \n", None)], "x string, y string")
    assert rows(clean_records(df)) == [("a b", "")]


def test_linkage_view_folds_email_and_nulls_blanks(spark):
    df = spark.createDataFrame(
        [("r1", "Ann", " ", " A@Example.com ", "", "Ashby")], ",".join(f"{c} string" for c in RECORD_COLUMNS)
    )
    assert rows(linkage_view(df)) == [("r1", "Ann", None, "a@example.com", None, "Ashby")]


@pytest.mark.parametrize(
    ("lines", "message"),
    [
        ((), "no records"),
        (("r1,a,b,c,d,e", " r1 ,a,b,c,d,e"), "unique"),
        (('"r1,r2",a,b,c,d,e',), "comma"),
    ],
)
def test_contract_violations(spark, tmp_path, lines, message):
    with pytest.raises(InputError, match=message):
        read_records(spark, _csv(tmp_path, *lines))


def test_the_source_is_read_once(spark, tmp_path, monkeypatch):
    """Rows that pass the scan are counted where they are read."""
    path = _csv(tmp_path, *(f"r{i:03d},a,b,c,d,e" for i in range(90, 0, -1)))
    passed = spark.sparkContext.accumulator(0)

    def counted(i):
        passed.add(1)
        return i

    plain = files.scan
    count = F.udf(counted).asNondeterministic()
    monkeypatch.setattr(files, "scan", lambda *args: plain(*args).withColumn("record_id", count("record_id")))
    loaded = files.load_records(spark, path, Scratch(spark, "test"))
    assert (passed.value, loaded.rows, loaded.greatest_id, loaded.records.count()) == (90, 90, "r090", 90)
    assert passed.value == 90


def test_records_come_in_order_of_their_ids(spark, tmp_path):
    path = _csv(tmp_path, *(f"r{i * 37 % 101:03d},a,b,c,d,e" for i in range(101)))
    found = [r["record_id"] for r in read_records(spark, path).collect()]
    assert found == sorted(found) and len(found) == 101


def test_missing_column_file_and_format(spark, tmp_path):
    path = tmp_path / "records.csv"
    path.write_text("record_id,first_name,last_name,postcode,city\nr1,a,b,c,d\n")
    with pytest.raises(InputError, match="email"):
        read_records(spark, str(path))
    with pytest.raises(InputError, match="not found"):
        read_records(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(InputError, match="unsupported"):
        read_records(spark, str(tmp_path / "records.txt"))


def test_written_csv_reads_back(spark, tmp_path):
    df = spark.createDataFrame(
        [("r1", 'quo"te', "com,ma", "", "01", "x"), ("r2", "two\nlines", "b", "c", "d", "")],
        ",".join(f"{c} string" for c in RECORD_COLUMNS),
    )
    path = write_csv(df, str(tmp_path / "out.csv"))
    assert rows(read_records(spark, path)) == rows(df)


def test_batches_cover_every_record_once_in_order(spark):
    ids = [f"r{(i * 617) % 1000:05d}" for i in range(1000)]
    df = spark.createDataFrame([(i,) for i in ids], "record_id string").repartition(7)
    found = [(r["record_id"], r["batch_no"]) for r in record_batches(df, 25).orderBy("record_id").collect()]
    assert found == [(f"r{i:05d}", i // 25) for i in range(1000)]
    with pytest.raises(ValueError, match="at least 1"):
        record_batches(df, 0)


def test_new_records_compare_as_text(spark):
    df = spark.createDataFrame([("r9",), ("r10",), ("r91",)], "record_id string")
    assert rows(select_new_records(df, "r9")) == [("r91",)]
    assert select_new_records(df, None).count() == 3


def test_strip_takes_what_str_strip_takes(spark):
    spaces = [chr(i) for i in range(0x110000) if chr(i).isspace()]
    data = [(i, f"{c}a{c}b{c}") for i, c in enumerate(spaces)] + [(len(spaces), "".join(spaces)), (len(spaces) + 1, "\u200ba\u200b")]
    got = spark.createDataFrame(data, "i int, t string").select("t", strip("t").alias("s")).collect()
    assert all(r["s"] == r["t"].strip() for r in got)
