from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

import fixtures
import kinfold.operators.blocking as blocking
from conftest import rows
from kinfold.operators.blocking import (
    CANDIDATE_RULES,
    TRAINING_RULES,
    Rule,
    block_pairs,
    blocking_reduction,
    candidate_count,
    candidate_pairs,
    pair_count,
    rule_counts,
)
from kinfold.operators.skew import spread
from kinfold.schema import RECORD_COLUMNS

SCHEMA = ",".join(f"{c} string" for c in RECORD_COLUMNS)


def _records(seed: int, count: int) -> list[tuple]:
    """Few values per field, a third of the emails equal, some fields missing."""
    rng = random.Random(seed)

    def value(kind: str, size: int) -> str | None:
        return None if rng.random() < 0.15 else f"{kind}{rng.randrange(size)}"

    return [
        (
            f"r{i:05d}",
            value("fi", 6),
            value("la", 6),
            "hot@example.com" if rng.random() < 0.33 else value("mail", 40),
            value("p", 25),
            value("c", 4),
        )
        for i in range(count)
    ]


def _brute_force(records: list[tuple]) -> set[tuple]:
    def agree(*pairs) -> bool:
        return all(a is not None and a == b for a, b in pairs)

    def head(text):
        return text and text[:2]

    found = set()
    for l, r in itertools.combinations(records, 2):
        tests = (
            agree((l[3], r[3])),
            agree((l[2], r[2]), (l[4], r[4])),
            agree((l[1], r[1]), (l[5], r[5])),
            agree((head(l[1]), head(r[1])), (head(l[2]), head(r[2]))),
            agree((l[4], r[4])),
        )
        if any(tests):
            found.add((l[0], r[0], tests.index(True)))
    return found


@pytest.mark.parametrize("tile_rows", [10_000, 40, 3])
def test_pairs_equal_brute_force_at_any_tile_size(spark, tile_rows):
    records = _records(5, 250)
    df = spark.createDataFrame(records, SCHEMA).repartition(3)
    assert set(rows(candidate_pairs(df, tile_rows=tile_rows))) == _brute_force(records)


def test_more_hot_blocks_than_a_broadcast_takes(spark, monkeypatch):
    monkeypatch.setattr(blocking, "_BROADCAST_BLOCKS", 0)
    records = _records(8, 250)
    df = spark.createDataFrame(records, SCHEMA).repartition(3)
    assert set(rows(candidate_pairs(df, tile_rows=5))) == _brute_force(records)


def test_blocks_can_be_left_out(spark):
    df = spark.createDataFrame(_records(5, 250), SCHEMA)
    large = blocking.hot_blocks(df, CANDIDATE_RULES, 20)
    listed = candidate_pairs(df, without=large)
    assert 0 < listed.count() < candidate_pairs(df).count()
    assert listed.join(candidate_pairs(df), ["record_id_l", "record_id_r", "match_key"], "left_anti").isEmpty()


@pytest.mark.parametrize("count", [3, 12])
def test_counts_of_many_overlapping_rules(spark, count):
    """Unions of columns merge, so the number of rules does not double the work."""
    keys = ("email", "last_name", "postcode", "first_name", "city")
    rules = [Rule.on(*(k for i, k in enumerate(keys) if mask >> i & 1)) for mask in (3, 5, 9, 17, 6, 10, 18, 12, 20, 24, 7, 28)][:count]
    df = spark.createDataFrame(_records(9, 220), SCHEMA)
    listed = {r["match_key"]: r["count"] for r in candidate_pairs(df, rules).groupBy("match_key").count().collect()}
    assert {r["match_key"]: r["pairs"] for r in rule_counts(df, rules).collect()} == {i: listed.get(i, 0) for i in range(count)}
    place = {k: k for k in keys}
    assert len(blocking._signed_sets(rules, place)) <= 2 ** len(keys)


def test_counts_follow_without_listing_pairs(spark):
    records = _records(6, 300)
    df = spark.createDataFrame(records, SCHEMA)
    want = [0] * len(CANDIDATE_RULES)
    for *_, rule in _brute_force(records):
        want[rule] += 1
    assert rows(rule_counts(df)) == list(enumerate(want))
    assert pair_count(df).first()["pairs"] == sum(want)
    total = 300 * 299 // 2
    row = blocking_reduction(df).first()
    assert (row["candidate_pairs"], row["possible_pairs"]) == (sum(want), total)
    assert row["reduction_ratio"] == pytest.approx(1 - sum(want) / total)


def test_weighted_counts_equal_counts_of_the_copies(spark):
    records = _records(7, 120)
    copies = [(f"{r[0]}{i}", *r[1:]) for n, r in enumerate(records) for i in range(1 + n % 3)]
    df = spark.createDataFrame(copies, SCHEMA)
    fields = RECORD_COLUMNS[1:]
    grouped = df.groupBy(*fields).count()
    assert rows(rule_counts(grouped, weight="count")) == rows(rule_counts(df))


def test_empty_and_single_inputs(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert candidate_pairs(empty).count() == 0
    assert pair_count(empty).first()["pairs"] == 0
    row = blocking_reduction(empty).first()
    assert (row["possible_pairs"], row["reduction_ratio"]) == (0, 0.0)


def test_nulls_never_agree(spark):
    df = spark.createDataFrame([("a", None, None, None, None, None), ("b", None, None, None, None, None)], SCHEMA)
    assert candidate_pairs(df).count() == 0


def test_rules_are_pluggable(spark):
    df = spark.createDataFrame([("a", "x1"), ("b", "x2"), ("c", "y1")], "record_id string, v string")
    assert rows(block_pairs(df, Rule.on("substr(v, 1, 1)"))) == [("a", "b")]
    assert rows(block_pairs(df, Rule.on("substr(v, 2, 1)"))) == [("a", "c")]


def test_no_join_without_an_equality(spark):
    """The plan must not hold a nested-loop or Cartesian join."""
    df = spark.createDataFrame(_records(8, 50), SCHEMA)
    for rules in (CANDIDATE_RULES, TRAINING_RULES):
        plan = candidate_pairs(df, rules)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" in plan


def test_a_small_file_is_dealt_out_before_its_rows_are_expanded(spark, monkeypatch):
    """Block rows are made in as many tasks as they need, not in the one task that reads the units."""
    monkeypatch.setattr(blocking, "_EXPANDED_ROWS", 100)
    records = _records(9, 250)
    pairs = candidate_pairs(spark.createDataFrame(records, SCHEMA).coalesce(1))
    assert set(rows(pairs)) == _brute_force(records)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [record_id") == 2  # one for each side of the join


def test_a_small_customer_file_is_dealt_out_before_persons_are_made(spark, tmp_path, monkeypatch):
    spark.range(200).selectExpr("id as c_custkey", "cast(id % 25 as int) as c_nationkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    want = rows(fixtures.persons(spark, str(tmp_path)))
    monkeypatch.setattr(fixtures, "spread", lambda df, total, column: spread(df, total, column, 50))
    found = fixtures.persons(spark, str(tmp_path))
    assert rows(found) == want and found.select(F.spark_partition_id()).distinct().count() == 4


def test_counted_candidates_equal_the_listed_ones(spark):
    """With ids that come twice and rows without an id."""
    records = _records(10, 200)
    records += [r for r in records[::7]] + [(None, *r[1:]) for r in records[::11]]
    df = spark.createDataFrame(records, SCHEMA)
    assert candidate_count(df).first()[0] == candidate_pairs(df).count() > 0
