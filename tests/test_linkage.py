from __future__ import annotations

from itertools import product
from math import prod

import pytest
from pyspark.sql import functions as F

from conftest import PEOPLE, rows
import kinfold.operators.model as model_module
from kinfold.config import Settings
from kinfold.functions.text import linkage_view
from kinfold.operators.blocking import Rule, candidate_pairs
from kinfold.operators.comparison import COMPARISONS, carried_columns, compare_pairs, gamma, with_helpers
from kinfold.operators.evaluate import linkage_quality, partition_check
from kinfold.operators.model import (
    Level,
    Model,
    fit_model,
    can_still_match,
    random_pair_levels,
    sample_records,
    sample_size,
    score_pairs,
    training_pattern_counts,
)
from kinfold.operators.blocking import all_possible_pairs
from kinfold.operators.survivorship import build_golden_records, cluster_members
from kinfold.plans.resolve import distinct_profiles, matching_profiles, resolve_records, scored_candidates
from kinfold.schema import RECORD_COLUMNS, RECORD_SCHEMA


def test_quality_floors(sample):
    found = linkage_quality(sample.linkage.clusters, sample.truth).first()
    assert found["recall"] >= 0.90
    assert found["precision"] >= 0.95


def test_clusters_come_in_order_of_the_records(sample):
    found = [r["record_id"] for r in sample.linkage.clusters.collect()]
    assert found == sorted(found)


def test_golden_records_partition_the_input(sample):
    found = partition_check(sample.records, cluster_members(sample.golden)).first()
    assert (found["missing"], found["unknown"], found["repeated"]) == (0, 0, 0)
    assert found["records"] == found["listed"] == sample.records.count()


def test_golden_count_is_near_the_number_of_people(sample):
    produced = sample.golden.count()
    assert 0.90 * PEOPLE <= produced <= 1.15 * PEOPLE < sample.records.count()


def test_blocking_removes_most_pairs(sample):
    linkage = sample.linkage
    assert linkage.candidate_pairs < 0.05 * all_possible_pairs(linkage.input_records)


def test_same_result_on_any_partitioning(spark, sample):
    want = rows(sample.golden)
    for parts in (1, 16):
        records = sample.records.repartition(parts)
        again = build_golden_records(records, resolve_records(records).clusters)
        assert rows(again) == want


def test_profiles_give_the_clusters_of_plain_pairs(spark, sample):
    """Copies, bounds and profiles must not change what scoring every pair of records gives."""
    copied = sample.records.unionByName(
        sample.records.filter("crc32(record_id) % 4 = 0").withColumn("record_id", F.concat("record_id", F.lit("x")))
    )
    linkage = resolve_records(copied, model=sample.linkage.model)
    scored = scored_candidates(linkage_view(copied), sample.linkage.model)
    matched = scored.filter("match_probability >= 0.9").select("record_id_l", "record_id_r").collect()
    assert linkage.candidate_pairs == scored.count()
    assert linkage.pairs_above_threshold == len(matched)
    parent = {r[0]: r[0] for r in copied.select("record_id").collect()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in matched:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert rows(linkage.clusters) == sorted((x, find(x)) for x in parent)


def test_a_third_of_the_table_may_be_one_record(spark, sample):
    base = sample.records.limit(1).select(*RECORD_COLUMNS[1:])
    copies = spark.range(200).select(F.format_string("x%04d", "id").alias("record_id")).join(base)
    records = sample.records.unionByName(copies.select(*RECORD_COLUMNS))
    linkage = resolve_records(records, model=sample.linkage.model)
    sizes = linkage.clusters.groupBy("cluster_id").count()
    assert sizes.agg(F.max("count")).first()[0] >= 201
    assert linkage.clusters.count() == records.count()


def test_copies_that_do_not_match_each_other_stay_apart(spark):
    """Equal records with a single weak field are candidates, but below the threshold."""
    records = spark.createDataFrame([(f"r{i}", "", "", "", "P1", "") for i in range(5)], RECORD_SCHEMA)
    model = Model(1e-6, tuple(Level(c.column, i, 0.5, 0.4, True) for c in COMPARISONS for i in range(c.top + 1)))
    linkage = resolve_records(records, model=model)
    assert rows(linkage.clusters) == [(f"r{i}", f"r{i}") for i in range(5)]
    assert (linkage.candidate_pairs, linkage.pairs_above_threshold) == (10, 0)


def test_copies_join_through_a_shared_neighbour(spark):
    records = [(f"r{i}", "Ann", "", "", "P1", "") for i in range(3)] + [("s", "Ann", "Lee", "", "P1", "X")]
    rates = {c.column: [(0.5, 0.5)] * (c.top + 1) for c in COMPARISONS}
    model = Model(0.5, tuple(Level(c, i, m, u, True) for c, r in rates.items() for i, (m, u) in enumerate(r)))
    linkage = resolve_records(spark.createDataFrame(records, RECORD_SCHEMA), Settings(match_threshold=0.5), model)
    assert {c for _, c in rows(linkage.clusters)} == {"r0"}


@pytest.mark.parametrize("threshold", [0.5, 0.9, 0.999999, 1.0])
def test_score_bound_keeps_every_match(sample, threshold):
    view = linkage_view(sample.records)
    model = sample.linkage.model
    want = scored_candidates(view, model).filter(F.col("match_probability") >= threshold)
    profiles = view.withColumn("copies", F.lit(1))
    got = matching_profiles(profiles, model, threshold)
    columns = ["record_id_l", "record_id_r"]
    assert rows(got.select(*columns)) == rows(want.select(*columns))
    pairs = candidate_pairs(with_helpers(view), carry=carried_columns())
    assert pairs.filter(can_still_match(model, 0.9)).count() < pairs.count()


def test_random_pair_levels_equal_all_pairs(spark, sample):
    view = linkage_view(sample.records.limit(120)).cache()
    units = with_helpers(view)
    left = units.select(*[F.col(c).alias(f"{c}_l") for c in units.columns])
    right = units.select(*[F.col(c).alias(f"{c}_r") for c in units.columns])
    vectors = compare_pairs(left.join(right, F.col("record_id_l") < F.col("record_id_r")))
    want = []
    for c in COMPARISONS:
        counts = vectors.filter(f"{gamma(c)} >= 0").groupBy(gamma(c)).count().collect()
        want += [(c.column, r[0], r[1]) for r in counts]
    found = random_pair_levels(view)
    assert rows(found.drop("share")) == sorted(want) and found.filter("share < 1").isEmpty()
    # Edit distances need no sample, whatever the limits are.
    few = random_pair_levels(view, max_pairs=50, max_value_pairs=50)
    assert rows(few.drop("share").filter("comparison = 'postcode'")) == sorted(w for w in want if w[0] == "postcode")
    assert {r[0]: r[3] < 1 for r in rows(few)} == {"city": False, "email": True, "first_name": True, "last_name": True, "postcode": False}


def test_equal_values_are_counted_on_all_records_however_small_the_sample(spark, sample):
    view = linkage_view(sample.records.limit(120)).cache()
    exact = {(c.column, level) for c in COMPARISONS for level, _ in c.exact}
    full, part = ({r[:2]: r[2] for r in rows(random_pair_levels(view, max_pairs=n, max_value_pairs=n))} for n in (10_000, 300))
    assert {k: n for k, n in part.items() if k in exact} == {k: n for k, n in full.items() if k in exact}
    for c in COMPARISONS:
        assert sum(n for k, n in part.items() if k[0] == c.column) == sum(n for k, n in full.items() if k[0] == c.column)


def test_sample_is_bounded_and_repeatable(spark):
    assert sample_size(10_000_000) == 4_472
    assert [sample_size(n) for n in (1, 2, 3, 5, 6)] == [2, 2, 3, 3, 4]
    df = spark.range(20_000).select(F.format_string("r%06d", "id").alias("record_id"))
    one = sample_records(df, 20_000, 500_000, 1)
    assert 800 < one.count() < 1_200
    assert rows(one) == rows(sample_records(df.repartition(5), 20_000, 500_000, 1))
    assert rows(one) != rows(sample_records(df, 20_000, 500_000, 2))


def test_weighted_patterns_equal_patterns_of_the_copies(spark, sample):
    view = linkage_view(sample.records)
    view = view.unionByName(view.withColumn("record_id", F.concat("record_id", F.lit("x")))).cache()
    plain = training_pattern_counts(view.withColumn("copies", F.lit(1)))
    assert rows(training_pattern_counts(distinct_profiles(view))) == rows(plain)


def test_training_reports_how_it_ended(spark, sample):
    training = sample.linkage.model.training
    assert [t.rule for t in training] == [0, 1, 2] and all(t.rounds >= 1 and t.log_likelihood < 0 for t in training)
    assert sample.linkage.model.training_frame(spark).filter("converged = (change < 1e-4)").count() == len(training)


def test_training_that_does_not_settle_warns(monkeypatch):
    comparisons = COMPARISONS[:2]
    names = [c.column for c in comparisons]
    u_rows = [{"comparison": n, "level": i, "u": x} for n in names for i, x in enumerate((0.9, 0.05, 0.03, 0.01, 0.01))]
    pattern_rows = [{"training_rule": 0, "gamma_first_name": i, "gamma_last_name": j, "n": 1 + 7 * i * j} for i in range(5) for j in range(5)]
    rules = (Rule.on("email"),)
    with pytest.raises(KeyError):  # a training rule of a column that is not compared
        fit_model(0.01, u_rows, pattern_rows, comparisons, rules)
    settled = fit_model(0.01, u_rows, pattern_rows, comparisons, (Rule(()),))
    monkeypatch.setattr(model_module, "MAX_ROUNDS", 1)
    with pytest.warns(UserWarning, match="still changed"):
        early = fit_model(0.01, u_rows, pattern_rows, comparisons, (Rule(()),))
    assert early.training[0].rounds == 1 and not early.training[0].converged
    assert settled.training[0].log_likelihood >= early.training[0].log_likelihood


def test_em_separates_matches_from_the_rest():
    """A block that mixes two known populations: the estimate finds the rates it was made with."""
    comparisons = (*COMPARISONS[:2], *COMPARISONS[3:])
    true_m = ([0.02, 0.03, 0.05, 0.3, 0.6], [0.02, 0.03, 0.05, 0.2, 0.7], [0.05, 0.05, 0.1, 0.8], [0.1, 0.9])
    true_u = ([0.9, 0.05, 0.03, 0.01, 0.01], [0.92, 0.04, 0.02, 0.01, 0.01], [0.9, 0.05, 0.03, 0.02], [0.9, 0.1])
    names = [c.column for c in comparisons]
    u_rows = [
        {"comparison": names[k], "level": level, "u": u} for k, shares in enumerate(true_u) for level, u in enumerate(shares)
    ]
    patterns = []
    for levels in product(*[range(c.top + 1) for c in comparisons]):
        match = prod(true_m[k][level] for k, level in enumerate(levels))
        other = prod(true_u[k][level] for k, level in enumerate(levels))
        n = round(10_000_000 * (0.3 * match + 0.7 * other))
        patterns.append({"training_rule": 0, "n": n, **{f"gamma_{c}": v for c, v in zip(names, levels, strict=True)}})
    model = fit_model(0.01, u_rows, patterns, comparisons, (Rule.on(),))
    for level in model.levels:
        assert level.m == pytest.approx(true_m[names.index(level.comparison)][level.level], abs=0.005)
        assert level.trained


def test_missing_fields_add_nothing(spark):
    model = Model(0.25, tuple(Level(c.column, i, 0.8, 0.1, True) for c in COMPARISONS for i in range(c.top + 1)))
    schema = ", ".join(f"{gamma(c)} int" for c in COMPARISONS)
    df = spark.createDataFrame([(-1, -1, -1, -1, -1), (4, -1, -1, -1, -1)], schema)
    got = [r["match_probability"] for r in score_pairs(df, model).orderBy("gamma_first_name").collect()]
    assert got == [pytest.approx(0.25), pytest.approx((8 / 3) / (1 + 8 / 3))]


def test_quality_without_pairs_is_zero(spark):
    alone = spark.createDataFrame([("a", "a", "a"), ("b", "b", "b")], "record_id string, cluster_id string, truth string")
    found = linkage_quality(alone, alone).first()
    assert (found["precision"], found["recall"], found["f1"]) == (0.0, 0.0, 0.0)


def test_empty_and_single_record(spark):
    assert resolve_records(spark.createDataFrame([], RECORD_SCHEMA)).clusters.count() == 0
    one = spark.createDataFrame([("r1", "Ann", "Lee", "a@example.com", "P1", "X")], RECORD_SCHEMA)
    assert rows(resolve_records(one).clusters) == [("r1", "r1")]
