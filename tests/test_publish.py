from __future__ import annotations

import pytest

from conftest import rows
from kinfold import Settings, run
from kinfold.schema import GOLDEN_SCHEMA, RECORD_COLUMNS, RECORD_SCHEMA
from kinfold.sources.files import write_csv
from kinfold.sources.generator import generate_records
from kinfold.sources.snapshots import Mark, Overtaken, SnapshotTable
from kinfold.streaming.incremental import resolve_batch, start_stream

ROWS = [("r1", "Ann", "Lee", "a@example.com", "01", "Ashby", 3, "r1,r2,r3"), ("r4", "Bo", "Ek", "", "", "", 1, "r4")]


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "warehouse"), "people", "golden")


@pytest.fixture
def golden(spark):
    return spark.createDataFrame(ROWS, GOLDEN_SCHEMA)


def test_empty_table_has_the_columns(table):
    assert table.read().columns == GOLDEN_SCHEMA.fieldNames()
    assert table.read().count() == 0


def test_round_trip_and_schema(table, golden):
    summary = table.publish(golden)
    assert (summary.rows, summary.writes) == (2, 1)
    assert [tuple(r) for r in table.read().collect()] == ROWS
    assert [(f.name, f.dataType) for f in table.read().schema] == [(f.name, f.dataType) for f in GOLDEN_SCHEMA]


def test_replacing_twice_leaves_the_rows_once(table, golden):
    table.publish(golden)
    assert table.publish(golden).writes == 2
    assert table.read().count() == 2


def test_append_adds(table, golden):
    table.publish(golden.limit(1))
    table.publish(golden.filter("cluster_id = 'r4'"), append=True)
    assert [tuple(r) for r in table.read().collect()] == ROWS


def test_a_reader_keeps_its_snapshot(table, golden):
    table.publish(golden)
    before = table.read()
    table.publish(golden.limit(1))
    assert before.count() == 2 and table.read().count() == 1


def test_two_writers_cannot_both_win(table, golden):
    table.publish(golden)
    stale = table.manifest()
    table.publish(golden)
    from dataclasses import replace

    with pytest.raises(Exception, match="(?i)exist"):
        table._commit(replace(stale, version=stale.version + 1, parts=()))
    assert table.read().count() == 2


def test_a_failed_write_changes_nothing(table, golden):
    table.publish(golden, mark=Mark("r4", 4))
    with pytest.raises(Exception, match="without cluster_id"):
        table.publish(golden.selectExpr("cast(null as string) as cluster_id", *GOLDEN_SCHEMA.fieldNames()[1:]))
    assert table.read().count() == 2 and table.load_mark() == Mark("r4", 4)


def test_mark_round_trip_clear_and_damage(spark, table, golden, tmp_path):
    assert table.load_mark() is None
    table.save_mark(Mark("r7", 7))
    assert table.load_mark() == Mark("r7", 7)
    table.publish(golden)
    assert table.load_mark() == Mark("r7", 7)
    table.clear_mark()
    assert table.load_mark() is None and table.read().count() == 2
    (tmp_path / "warehouse/people/golden/manifests/9999999999.json").write_text("{ broken")
    assert table.load_mark() is None


def _settings(tmp_path, source) -> Settings:
    return Settings(input_path=str(source), warehouse=str(tmp_path / "warehouse"))


def test_full_run_then_incremental_runs(spark, tmp_path):
    records = generate_records(spark, 80).select(*RECORD_COLUMNS).cache()
    cut = records.orderBy("record_id").collect()[99]["record_id"]
    first, later = tmp_path / "first.csv", tmp_path / "all.csv"
    write_csv(records.filter(records.record_id <= cut), str(first))
    write_csv(records, str(later))
    settings = _settings(tmp_path, first)
    table = SnapshotTable(spark, settings.warehouse, settings.namespace, settings.table)

    dry = run(spark, settings, write=False)
    assert dry.published is None and table.load_mark() is None

    full = run(spark, settings)
    assert full.published.writes == 1 and full.linkage.input_records == 100
    assert full.metrics["records_merged_away"] == 100 - full.metrics["golden_records"]
    assert table.load_mark() == Mark(cut, 100)
    assert rows(table.read()) == rows(full.golden) == rows(dry.golden)
    assert "input records: 100" in full.report() and any("pairs" in line for line in full.report())

    nothing = run(spark, settings, incremental=True)
    assert (nothing.linkage, nothing.published) == (None, None)
    assert table.load_mark() == Mark(cut, 100)

    more = run(spark, Settings.based_on(settings, input_path=str(later)), incremental=True, model=full.linkage.model)
    assert more.linkage.input_records == records.count() - 100 and more.published.writes == 2
    assert table.read().count() == full.metrics["golden_records"] + more.metrics["golden_records"]
    assert table.load_mark().highest_record_id == records.agg({"record_id": "max"}).first()[0]


def _arrive(spark, folder, name, ids):
    names = {"r0": "Olga Brandt", "r1": "Ann Lee", "r2": "Zoltan Kiss", "r3": "Mary Quigley"}
    data = [(i, *names[i].split(), f"{names[i][:3]}@example.com", f"P{i}", "X") for i in ids]
    spark.createDataFrame(data, RECORD_SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def test_stream_resumes_and_counts_late_records(spark, table, tmp_path, sample):
    source, state = str(tmp_path / "source"), str(tmp_path / "state")
    outcomes = []

    def go():
        query = start_stream(
            spark, f"{source}/*", table, state, Settings(), model=sample.linkage.model, outcomes=outcomes
        )
        query.awaitTermination()

    _arrive(spark, source, "a", ["r1", "r2"])
    go()
    assert table.read().count() == 2 and table.load_mark() == Mark("r2", 2)
    go()
    assert len(outcomes) == 1
    _arrive(spark, source, "b", ["r0", "r3"])
    go()
    assert (outcomes[1].records, outcomes[1].late_records) == (1, 1)
    assert [r["cluster_id"] for r in table.read().collect()] == ["r1", "r2", "r3"]


def test_a_replayed_batch_is_not_appended_again(spark, table, sample):
    batch = spark.createDataFrame([("r1", "Ann", "Lee", "a@example.com", "P", "X")], RECORD_SCHEMA)
    first = resolve_batch(batch, 0, "s", table, Settings(), sample.linkage.model)
    again = resolve_batch(batch, 0, "s", table, Settings(), sample.linkage.model)
    assert (first.published, again.published) == (True, False)
    assert table.read().count() == 1


def _stream(spark, table, source, state, sample, **options):
    outcomes = []
    start_stream(spark, source, table, str(state), Settings(), model=sample.linkage.model, outcomes=outcomes, **options).awaitTermination()
    return outcomes


def test_after_a_reset_a_new_checkpoint_delivers_everything(spark, table, tmp_path, sample):
    _arrive(spark, str(tmp_path / "one"), "a", ["r1"])
    _stream(spark, table, f"{tmp_path}/one/*", tmp_path / "state-1", sample)
    table.clear_mark()
    _arrive(spark, str(tmp_path / "two"), "b", ["r2"])
    outcomes = _stream(spark, table, f"{tmp_path}/two/*", tmp_path / "state-2", sample)
    assert [o.published for o in outcomes] == [True]
    assert [r["cluster_id"] for r in table.read().collect()] == ["r1", "r2"]


def test_streamed_csv_keeps_line_breaks_and_ignores_further_columns(spark, table, tmp_path, sample):
    (tmp_path / "in").mkdir()
    header = "record_id,first_name,last_name,email,postcode,city,extra\n"
    (tmp_path / "in/a.csv").write_text(header + 'r1,"An\nna",Lee,a@example.com,P,X,9\n')
    _stream(spark, table, f"{tmp_path}/in", tmp_path / "state", sample, source_format="csv")
    (row,) = table.read().collect()
    assert (row["cluster_id"], row["first_name"], row["last_name"]) == ("r1", "An\nna", "Lee")


def test_streamed_numbers_become_text(spark, table, tmp_path, sample):
    data = spark.createDataFrame([("r1", "Ann", "Lee", "a@example.com", 12345, "X")], "record_id string, first_name string, last_name string, email string, postcode int, city string")
    data.write.parquet(f"{tmp_path}/in/a")
    _stream(spark, table, f"{tmp_path}/in/*", tmp_path / "state", sample)
    assert [r["postcode"] for r in table.read().collect()] == ["12345"]


def test_two_runs_from_one_mark_publish_once(table, golden):
    base = table.manifest()
    table.publish(golden, append=True, base=base)
    with pytest.raises(Overtaken, match="exists"):
        table.publish(golden, append=True, base=base)
    assert table.read().count() == 2
