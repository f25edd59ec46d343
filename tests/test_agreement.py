from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import kinfold.operators.agreement as agreement
from conftest import rows
from kinfold.functions.text import linkage_view
from kinfold.operators.agreement import Ranks, agreeing_pairs, agreements_of, hopeful_pairs, join_cost, minimal_sets, transversal
from kinfold.operators.blocking import CANDIDATE_RULES, Rule, candidate_pairs, hot_blocks, rows_of_blocks
from kinfold.operators.comparison import COMPARISONS, EditTiers, NameTiers, carried_columns, compare_pairs, with_helpers
from kinfold.operators.model import Level, Model, can_still_match, pairs_above_threshold, score_pairs, weight_needed
from kinfold.operators.nearness import MISSING, Agreement, deletions, least_shared, near_values, partners, similar_keys
from kinfold.plans.resolve import distinct_profiles, matching_profiles, scored_candidates
from kinfold.schema import RECORD_SCHEMA
from kinfold.scratch import Scratch

RATES = {
    "first_name": ((0.02, 0.97), (0.03, 0.02), (0.05, 0.005), (0.30, 0.003), (0.60, 0.002)),
    "last_name": ((0.02, 0.97), (0.03, 0.02), (0.05, 0.005), (0.30, 0.003), (0.60, 0.002)),
    "email": ((0.02, 0.99), (0.03, 0.004), (0.10, 0.003), (0.05, 0.002), (0.80, 0.001)),
    "postcode": ((0.10, 0.95), (0.05, 0.04), (0.15, 0.008), (0.70, 0.002)),
    "city": ((0.15, 0.93), (0.85, 0.07)),
}
MODEL = Model(0.0005, tuple(Level(c, i, m, u, True) for c, r in RATES.items() for i, (m, u) in enumerate(r)))
POSTCODE = Rule.on("postcode")
THRESHOLD = 0.9


def model_of(rng) -> Model:
    levels = []
    for c in COMPARISONS:
        m, u = (rng.dirichlet(np.ones(c.top + 1)) for _ in range(2))
        levels += [Level(c.column, i, float(m[i]), float(u[i]), True) for i in range(c.top + 1)]
    return Model(float(rng.uniform(1e-4, 0.05)), tuple(levels))


@pytest.mark.parametrize("seed", range(8))
def test_every_match_has_a_chosen_agreement(seed):
    """Of all combinations of statuses that reach the threshold, none is without a chosen agreement."""
    model = MODEL if seed == 0 else model_of(np.random.default_rng(seed))
    for rule in CANDIDATE_RULES:
        chosen = agreements_of(rule, model, THRESHOLD, COMPARISONS, {"city": 0.2})
        if chosen is None:
            continue
        free = [c for c in COMPARISONS if c.column not in rule.keys]
        given = sum(model.weights(c.column)[c.top] for c in COMPARISONS if c.column in rule.keys)
        for statuses in product(*[[MISSING, *range(c.top + 1)] for c in free]):
            weight = model.prior_weight + given + sum(model.weights(c.column).get(s, 0.0) for c, s in zip(free, statuses, strict=True))
            if weight >= weight_needed(THRESHOLD):
                at = dict(zip((c.column for c in free), statuses, strict=True))
                assert any(at[a.comparison.column] in a.statuses for a in chosen)


def test_minimal_sets_are_minimal_and_complete():
    ranks = [Ranks(c, MODEL) for c in COMPARISONS[:3]]
    needed = 9.0
    sets = minimal_sets(ranks, needed)
    for at in product(*[range(len(r.weights)) for r in ranks]):
        reaches = sum(r.weights[i] for r, i in zip(ranks, at, strict=True)) >= needed
        assert reaches == any(all(x <= y for x, y in zip(s, at, strict=True)) for s in sets)
    assert not any(a != b and all(x <= y for x, y in zip(a, b, strict=True)) for a in sets for b in sets)


def test_no_agreement_where_all_pairs_may_match():
    ranks = [Ranks(COMPARISONS[0], MODEL)]
    assert transversal(ranks, minimal_sets(ranks, -50.0), {(0, x): 0.1 for x in range(9)}) is None
    assert transversal(ranks, minimal_sets(ranks, 50.0), {(0, x): 0.1 for x in range(9)}) == []
    loose = Agreement(COMPARISONS[0], frozenset(range(1, 5)))
    assert join_cost(loose, MODEL, 0.0) == float("inf")


def _words(seed: int, n: int, alphabet: str, longest: int) -> list[str]:
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list(alphabet), rng.integers(1, longest))) for _ in range(n)]
    for w in base[: n // 2]:
        at = int(rng.integers(0, len(w)))
        base += [w[:at] + w[at + 1 :], w[:at] + "z" + w[at:], w[:at] + w[at : at + 2][::-1] + w[at + 2 :]]
    return sorted({w for w in base if w})


@pytest.mark.parametrize(("least", "alphabet", "longest"), [(3, "abcdefghij", 10), (2, "abcdefghij", 10), (2, "abc", 9), (3, "abcé日", 16), (2, "abcdefghijklmnop", 22)])
def test_similar_values_are_all_found(spark, least, alphabet, longest):
    words = _words(least + longest, 220, alphabet, longest)
    comparison = NameTiers("first_name")
    frame = spark.createDataFrame([(w,) for w in words], "value string")
    found = near_values(frame, Agreement(comparison, frozenset(range(least, 5))), Scratch(spark, "test"))
    pairs = frame.join(frame.withColumnRenamed("value", "other"), F.col("value") < F.col("other"))
    want = pairs.join(_similar(spark, words, comparison.thresholds[comparison.top - 1 - least]), ["value", "other"], "left_semi")
    assert rows(found) == rows(want)


def _similar(spark, words: list[str], least: float):
    import pyarrow as pa

    from kinfold.functions.similarity import jaro_winkler_batch

    pairs = [(a, b) for i, a in enumerate(words) for b in words[i + 1 :]]
    score = jaro_winkler_batch(pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs]))
    return spark.createDataFrame([p for p, s in zip(pairs, score, strict=True) if s >= least], "value string, other string")


@pytest.mark.parametrize("distances", [(1, 2), (1,), (2,)])
def test_values_within_some_edits_are_all_found(spark, distances):
    words = _words(5, 150, "ab1", 8) + ["x" * 45, "x" * 44 + "y", "x" * 40, "x" * 41]
    comparison = EditTiers("postcode", distances)
    frame = spark.createDataFrame([(w,) for w in words], "value string")
    pairs = frame.join(frame.withColumnRenamed("value", "other"), F.col("value") < F.col("other"))
    for level in range(1, comparison.top):
        edits = distances[comparison.top - 1 - level]
        found = near_values(frame, Agreement(comparison, frozenset(range(level, comparison.top + 1))), Scratch(spark, "test"))
        assert rows(found) == rows(pairs.filter(f"levenshtein(value, other) <= {edits}"))


def test_deletions(spark):
    left = spark.range(1).selectExpr(f"{deletions("'aab'", 2)} as d", f"{deletions("'a'", 2)} as e").first()
    assert sorted(left["d"]) == ["a", "aa", "aab", "ab", "b"] and sorted(left["e"]) == ["", "a"]
    assert least_shared(7, 7, 0.88) == 6 and similar_keys("ab", [[], [], partners(2, 0.88)]) == ["2,2,ab", "2,3,ab"]


def _one_large_block(spark, n: int = 3000, share: float = 1 / 3):
    """Records of which a third have one postcode; some are damaged copies, some lack fields."""
    rng = np.random.default_rng(11)
    syllables = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in "lnrs"]
    name = lambda: "".join(rng.choice(syllables, rng.integers(2, 4)))
    out = []
    for i in range(n):
        first, last = name(), name()
        person = [first, last, f"{first}.{last}@example.com", "P1" if i < n * share else f"P{i % 499:03d}", f"City{i % 20}"]
        copies = [person]
        if i % 4 == 0:
            copy = list(person)
            at = int(rng.integers(1, len(first) - 1))
            copy[0] = first[:at] + first[at + 1] + first[at] + first[at + 2 :] if i % 8 else first[:at] + first[at + 1 :]
            copy[2] = ["", f"{copy[0]}.{last}@example.com", f"{first}.{last}@other.org"][i // 4 % 3]
            copy[4] = "" if i % 60 == 0 else person[4]
            copies.append(copy)
        for k, c in enumerate(copies):
            out.append((f"r{i:05d}{k}", *c))
    return spark.createDataFrame(out, RECORD_SCHEMA)


def test_a_large_block_gives_the_links_of_the_full_listing_from_few_pairs(spark):
    view = linkage_view(_one_large_block(spark))
    profiles = distinct_profiles(view).cache()
    want = scored_candidates(profiles, MODEL).filter(F.col("match_probability") >= THRESHOLD)
    got = matching_profiles(profiles, MODEL, THRESHOLD)
    ids = ["record_id_l", "record_id_r"]
    assert rows(got.select(*ids)) == rows(want.select(*ids)) and got.count() > 500
    units, scratch = with_helpers(profiles), Scratch(spark, "test")
    large = hot_blocks(units, CANDIDATE_RULES)
    assert large.count() == 1
    block, _ = rows_of_blocks(units, CANDIDATE_RULES, ["record_id", *(c.column for c in COMPARISONS)])
    block = block.join(large, ["rule", "block"], "left_semi")
    chosen = agreements_of(POSTCODE, MODEL, THRESHOLD, COMPARISONS, {"city": 0.05})
    pairs = agreeing_pairs(block, chosen, "record_id", scratch)
    n = block.count()
    assert n > 1000 and pairs.count() < n * (n - 1) / 2 / 10
    assert pairs.filter("record_id_l >= record_id_r").isEmpty()


@pytest.mark.parametrize("tile_rows", [7, 50])
def test_small_chunks_give_the_same_pairs(spark, sample, tile_rows):
    view = linkage_view(sample.records)
    units, scratch = with_helpers(view.withColumn("copies", F.lit(1))), Scratch(spark, "test")
    want = scored_candidates(view, MODEL).filter(F.col("match_probability") >= THRESHOLD)
    pairs = hopeful_pairs(units, MODEL, THRESHOLD, CANDIDATE_RULES, COMPARISONS, scratch, large_rows=tile_rows)
    found = pairs_above_threshold(score_pairs(compare_pairs(pairs), MODEL), THRESHOLD)
    ids = ["record_id_l", "record_id_r", "match_key"]
    assert rows(found.select(*ids)) == rows(want.select(*ids))


def test_rows_of_one_id_in_a_large_block_keep_their_pairs(spark):
    """Every pair of rows is found as often as the listing has it, whatever the size of its block."""
    view = linkage_view(_one_large_block(spark, 300))
    units = with_helpers(view.unionByName(view.filter("record_id like '%1'")))
    listed = candidate_pairs(units, carry=carried_columns()).filter(can_still_match(MODEL, THRESHOLD))
    pairs = hopeful_pairs(units, MODEL, THRESHOLD, CANDIDATE_RULES, COMPARISONS, Scratch(spark, "test"), large_rows=20)
    want, found = (pairs_above_threshold(score_pairs(compare_pairs(p), MODEL), THRESHOLD) for p in (listed, pairs))
    ids = ["record_id_l", "record_id_r", "match_key"]
    assert rows(found.select(*ids)) == rows(want.select(*ids)) and found.count() > found.select(*ids).distinct().count()


def test_middling_blocks_are_not_listed(spark, monkeypatch):
    """A block of some hundred rows is joined on agreements, so listed pairs grow with the rows and not with their square."""
    listed = []

    def listing(*args, **kwargs):
        listed.append(candidate_pairs(*args, **kwargs))
        return listed[-1]

    monkeypatch.setattr(agreement, "candidate_pairs", listing)
    units = with_helpers(linkage_view(_one_large_block(spark, 900)))
    pairs = hopeful_pairs(units, MODEL, THRESHOLD, CANDIDATE_RULES, COMPARISONS, Scratch(spark, "test"))
    assert not pairs.isEmpty() and listed[0].filter("match_key = 4").count() < 300 * 299 / 2 / 4


def test_queries_of_matches_equal_the_scored_listing(spark, tmp_path):
    """The pairs and both counts of the listing, with customers that come twice or lack a number."""
    spark.range(600).selectExpr("if(id < 590, id % 550, null) as c_custkey", "cast(id % 25 as int) as c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    scored = registry._scored(spark, str(tmp_path))
    want = pairs_above_threshold(scored, THRESHOLD)
    queries = registry.queries()
    assert rows(queries["pairs_above_threshold"](spark, str(tmp_path))) == rows(registry._rounded_scores(want))
    assert rows(queries["pair_counts"](spark, str(tmp_path))) == [(scored.count(), want.count())] and want.count() > 0
    assert queries["pair_counts"](spark, str(tmp_path)).columns == ["candidate_pairs", "pairs_above_threshold"]


@pytest.mark.parametrize("name", ["pairs_above_threshold", "pair_counts"])
def test_queries_of_matches_grade_only_pairs_with_hope(spark, tmp_path, monkeypatch, name):
    spark.range(3000).selectExpr("id as c_custkey", "cast(id % 25 as int) as c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    graded = []

    def grade(pairs, *args):
        graded.append(pairs)
        return compare_pairs(pairs, *args)

    monkeypatch.setattr(registry, "compare_pairs", grade)
    registry.queries()[name](spark, str(tmp_path))
    every = candidate_pairs(registry._view(spark, str(tmp_path))).count()
    assert 0 < graded[0].count() < every
