"""Records to clusters: block, compare, train, score, connect."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.config import Settings
from kinfold.functions.text import linkage_view
from kinfold.operators.agreement import hopeful_pairs
from kinfold.operators.blocking import (
    CANDIDATE_RULES,
    DETERMINISTIC_RULES,
    TRAINING_RULES,
    Rule,
    candidate_pairs,
    pair_count,
)
from kinfold.operators.comparison import (
    COMPARISONS,
    Comparison,
    carried_columns,
    compare_pairs,
    with_helpers,
)
from kinfold.operators.components import assign_clusters, connected_components
from kinfold.operators.model import (
    Model,
    copies_pattern,
    fit_model,
    in_some_block,
    pairs_above_threshold,
    prior_probability,
    random_pair_levels,
    score_pairs,
    training_pattern_counts,
    u_probabilities,
)
from kinfold.operators.skew import lookup
from kinfold.schema import FIELDS, RECORD_ID
from kinfold.scratch import Scratch


@dataclass(frozen=True)
class Linkage:
    clusters: DataFrame
    model: Model
    input_records: int
    candidate_pairs: int
    pairs_above_threshold: int
    threshold: float


def distinct_profiles(view: DataFrame) -> DataFrame:
    """Records that agree on all fields as one row, with its least id and its number of ``copies``.

    The fields alone decide blocks and levels, so every later step works on profiles and counts pairs of
    copies by multiplication, and a value that was copied into a third of the table is a single row.
    """
    return view.groupBy(*FIELDS).agg(F.min(RECORD_ID).alias(RECORD_ID), F.count("*").alias("copies"))


def train_model(
    view: DataFrame,
    profiles: DataFrame,
    settings: Settings = Settings(),
    comparisons: Sequence[Comparison] = COMPARISONS,
    deterministic_rules: Sequence[Rule] = DETERMINISTIC_RULES,
    training_rules: Sequence[Rule] = TRAINING_RULES,
) -> Model:
    prior = prior_probability(profiles, deterministic_rules, settings.prior_recall, "copies").first()["prior"]
    levels = random_pair_levels(view, comparisons, settings.max_sampled_pairs, settings.seed)
    u_rows = u_probabilities(levels).collect()  # one row per level, with the share of records compared for it
    patterns = training_pattern_counts(profiles, comparisons, training_rules).collect()  # one per pattern
    model = fit_model(prior, u_rows, patterns, comparisons, training_rules)
    return replace(model, sampled_share=min((r["share"] for r in u_rows), default=1.0))


def scored_candidates(
    view: DataFrame,
    model: Model,
    rules: Sequence[Rule] = CANDIDATE_RULES,
    comparisons: Sequence[Comparison] = COMPARISONS,
) -> DataFrame:
    """Every candidate pair of records with its levels, weight and probability."""
    pairs = candidate_pairs(with_helpers(view, comparisons), rules, carry=carried_columns(comparisons))
    return score_pairs(compare_pairs(pairs, comparisons), model, comparisons)


def matching_profiles(
    profiles: DataFrame,
    model: Model,
    threshold: float,
    rules: Sequence[Rule] = CANDIDATE_RULES,
    comparisons: Sequence[Comparison] = COMPARISONS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Pairs of different profiles at or above the threshold, with the record pairs they stand for."""
    scratch = scratch or Scratch(profiles.sparkSession, "matching")
    hopeful = hopeful_pairs(with_helpers(profiles, comparisons), model, threshold, rules, comparisons, scratch, carry=["copies"])
    scored = score_pairs(compare_pairs(hopeful, comparisons), model, comparisons)
    record_pairs = (F.col("copies_l") * F.col("copies_r")).alias("record_pairs")
    return pairs_above_threshold(scored, threshold).select(f"{RECORD_ID}_l", f"{RECORD_ID}_r", record_pairs)


def matching_copies(
    profiles: DataFrame,
    model: Model,
    threshold: float,
    rules: Sequence[Rule] = CANDIDATE_RULES,
    comparisons: Sequence[Comparison] = COMPARISONS,
) -> DataFrame:
    """Profiles whose copies match each other, with the record pairs among them."""
    blocked = profiles.filter("copies > 1").filter(in_some_block(rules))
    scored = score_pairs(blocked.select(RECORD_ID, "copies", *copies_pattern(comparisons)), model, comparisons)
    among = F.floor(F.col("copies").cast("decimal(20,0)") * (F.col("copies") - 1) / 2).cast("bigint")
    return pairs_above_threshold(scored, threshold).select(RECORD_ID, among.alias("record_pairs"))


def resolve_records(
    records: DataFrame,
    settings: Settings = Settings(),
    model: Model | None = None,
    rules: Sequence[Rule] = CANDIDATE_RULES,
    comparisons: Sequence[Comparison] = COMPARISONS,
    training_rules: Sequence[Rule] = TRAINING_RULES,
    deterministic_rules: Sequence[Rule] = DETERMINISTIC_RULES,
    scratch: Scratch | None = None,
) -> Linkage:
    """Cluster records of the same person: ``record_id``, ``cluster_id`` for every record, in order of their ids.

    Pass a ``model`` of an earlier run to skip training, as for a small incremental batch.
    """
    scratch = scratch or Scratch(records.sparkSession, "resolve")
    threshold = settings.match_threshold
    view = scratch.materialise(linkage_view(records.select(RECORD_ID, *FIELDS)), "view")
    profiles = scratch.materialise(distinct_profiles(view), "profiles")
    total = profiles.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    if model is None:
        model = train_model(view, profiles, settings, comparisons, deterministic_rules, training_rules)
    candidates = pair_count(profiles, rules, "copies").first()["pairs"]

    edges = scratch.materialise(matching_profiles(profiles, model, threshold, rules, comparisons, scratch), "edges")
    copies = scratch.materialise(matching_copies(profiles, model, threshold, rules, comparisons), "copies")
    matched = edges.select("record_pairs").unionByName(copies.select("record_pairs"))
    above = matched.agg(F.coalesce(F.sum("record_pairs"), F.lit(0))).first()[0]

    components = connected_components(edges, f"{RECORD_ID}_l", f"{RECORD_ID}_r", scratch)
    # A profile's copies belong together if they match each other or all match some other profile.
    alone = copies.select(F.col(RECORD_ID).alias("node"), F.col(RECORD_ID).alias("component"))
    joint = alone.join(components.select("node"), "node", "left_anti").unionByName(components)
    joint = scratch.materialise(joint, "joint")
    clusters = scratch.materialise(_spread(view, profiles, joint, total), "clusters")
    return Linkage(clusters.orderBy(RECORD_ID), model, int(total), int(candidates), int(above), threshold)


def _spread(view: DataFrame, profiles: DataFrame, joint: DataFrame, total: int) -> DataFrame:
    """Clusters of records from the components of their profiles."""
    linked = profiles.join(joint, F.col(RECORD_ID) == F.col("node"))
    single = linked.filter("copies = 1").select(F.col(RECORD_ID).alias("node"), "component")
    several = linked.filter("copies > 1").select(*FIELDS, "copies", "component")
    if several.isEmpty():
        return assign_clusters(view, single, RECORD_ID)
    members = lookup(view, several, list(FIELDS), "copies", total)
    members = members.select(F.col(RECORD_ID).alias("node"), "component")
    return assign_clusters(view, single.unionByName(members), RECORD_ID)
