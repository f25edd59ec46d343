from __future__ import annotations

import random

import pytest

from conftest import rows
from kinfold.operators.survivorship import (
    attach_clusters,
    build_golden_records,
    cluster_members,
    merge_clusters,
    run_metrics,
    to_golden_contract,
)
from kinfold.schema import CLUSTER_SCHEMA, GOLDEN_SCHEMA, RECORD_SCHEMA


def _golden(spark, records, clusters):
    df = build_golden_records(
        spark.createDataFrame(records, RECORD_SCHEMA), spark.createDataFrame(clusters, CLUSTER_SCHEMA)
    )
    return [r.asDict() for r in df.orderBy("cluster_id").collect()]


def _record(record_id, last="Lee", city="Ashby", email="a@example.com"):
    return (record_id, "Ann", last, email, "P1", city)


def test_majority_wins(spark):
    got = _golden(spark, [_record("r1"), _record("r2", "Lee"), _record("r3", "Ele")], [(f"r{i}", "x") for i in (1, 2, 3)])
    assert len(got) == 1 and got[0]["last_name"] == "Lee" and got[0]["source_record_count"] == 3


def test_tie_goes_to_the_smallest(spark):
    got = _golden(spark, [_record("r1", "Lees"), _record("r2", "Lee")], [("r1", "x"), ("r2", "x")])
    assert got[0]["last_name"] == "Lee"


def test_upper_case_wins_a_tie_of_unfolded_emails(spark):
    records = [_record("r1", email="k@example.com"), _record("r2", email="K@Example.com")]
    assert _golden(spark, records, [("r1", "x"), ("r2", "x")])[0]["email"] == "K@Example.com"


def test_blank_never_wins(spark):
    records = [_record("r1", city=""), _record("r2", city=" \t"), _record("r3", city="Ashby")]
    assert _golden(spark, records, [(f"r{i}", "x") for i in (1, 2, 3)])[0]["city"] == "Ashby"


def test_all_blank_stays_blank(spark):
    got = _golden(spark, [_record("r1", city=""), _record("r2", city="")], [("r1", "x"), ("r2", "x")])
    assert got[0]["city"] == ""


def test_records_without_a_cluster_stand_alone(spark):
    got = _golden(spark, [_record("r1"), _record("r2")], [("r2", "r2")])
    assert [(g["cluster_id"], g["source_record_count"]) for g in got] == [("r1", 1), ("r2", 1)]


def test_cluster_id_is_the_smallest_member(spark):
    got = _golden(spark, [_record("r5"), _record("r2"), _record("r10")], [(r, "z9") for r in ("r5", "r2", "r10")])
    assert (got[0]["cluster_id"], got[0]["source_record_ids"]) == ("r10", "r10,r2,r5")


def test_repeated_keys_are_refused(spark):
    records = spark.createDataFrame([_record("r1"), _record("r1")], RECORD_SCHEMA)
    clusters = spark.createDataFrame([("r1", "r1")], CLUSTER_SCHEMA)
    with pytest.raises(ValueError, match="records"):
        attach_clusters(records, clusters)
    with pytest.raises(ValueError, match="clusters"):
        attach_clusters(records.limit(1), clusters.union(clusters))


@pytest.mark.parametrize("large_rows", [1, 20])
def test_large_clusters_give_the_same_rows(spark, large_rows):
    rng = random.Random(2)

    def value(kind):
        return rng.choice(["", " ", f"{kind}a", f"{kind}b", f"{kind}B"])

    records = [
        (f"r{i:04d}", *[value(k) for k in "flepc"], "hot" if i % 3 == 0 else f"c{i % 40}") for i in range(600)
    ]
    records += [("s1", "", "", "", "", "", "blank"), ("s2", "", "", "", "", "", "blank")]
    columns = [*RECORD_SCHEMA.fieldNames(), "cluster_id"]
    df = spark.createDataFrame(records, ", ".join(f"{c} string" for c in columns))
    assert rows(merge_clusters(df, large_rows)) == rows(merge_clusters(df))


def test_contract_types_and_required_columns(spark):
    good = spark.createDataFrame([("c", "a", "b", "e", "p", "", 1, "c")], GOLDEN_SCHEMA)
    typed = to_golden_contract(good.selectExpr("*", "1 as extra"))
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in GOLDEN_SCHEMA]
    with pytest.raises(Exception, match="without source_record_ids"):
        to_golden_contract(good.selectExpr(*[c for c in good.columns[:-1]], "cast(null as string) as source_record_ids")).collect()


def test_metrics_and_members(spark):
    golden = spark.createDataFrame(
        [("a", "", "", "", "", "", 2, "a,b"), ("c", "", "", "", "", "", 1, "c")], GOLDEN_SCHEMA
    )
    assert run_metrics(golden).first().asDict() == {
        "input_records": 3,
        "golden_records": 2,
        "duplicate_clusters": 1,
        "records_merged_away": 1,
    }
    assert rows(cluster_members(golden)) == [("a", "a"), ("a", "b"), ("c", "c")]
