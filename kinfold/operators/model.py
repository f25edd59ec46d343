"""Match model: prior, agreement rates of matches (m) and of non-matches (u), and the score of a pair.

Spark reduces the pairs to counts per agreement pattern; there are at most a few thousand patterns however
many pairs there are. Expectation-maximisation then iterates over that small table of whole numbers,
sorted, so its result does not depend on how the data was partitioned.
"""

from __future__ import annotations

import math
import uuid
import warnings
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from statistics import median

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.operators.blocking import (
    DETERMINISTIC_RULES,
    TRAINING_RULES,
    Rule,
    candidate_pairs,
    join_tasks,
    pair_count,
    tile,
)
from kinfold.operators.comparison import (
    COMPARISONS,
    Comparison,
    EditTiers,
    answer,
    ask,
    carried_columns,
    gamma,
    with_helpers,
)
from kinfold.operators.nearness import Agreement, near_values
from kinfold.schema import RECORD_ID
from kinfold.scratch import Scratch

# Fixed values of the training recipe.
PRIOR_RECALL = 0.8
MAX_SAMPLED_PAIRS = 10_000_000
SEED = 1729
FLOOR = 1e-6
START_EXACT_M = 0.95
MAX_ROUNDS = 25
MIN_CHANGE = 1e-4

# All distinct values of a field are compared while they have at most so many pairs.
MAX_VALUE_PAIRS = 50_000_000

_SAMPLE_CHUNK = 256


@dataclass(frozen=True)
class Level:
    comparison: str
    level: int
    m: float
    u: float
    trained: bool

    @property
    def weight(self) -> float:
        return math.log2(max(self.m, FLOOR) / max(self.u, FLOOR))


@dataclass(frozen=True)
class BlockTraining:
    """How the estimation on one training block ended."""

    rule: int
    rounds: int
    #: Largest change of a rate in the last round.
    change: float
    match_rate: float
    #: Of the block's patterns, over the columns it trains.
    log_likelihood: float

    @property
    def converged(self) -> bool:
        return self.change < MIN_CHANGE


@dataclass(frozen=True)
class Model:
    prior: float
    levels: tuple[Level, ...]
    #: Least share of the records from which the u of a field's similar values was estimated.
    sampled_share: float = 1.0
    training: tuple[BlockTraining, ...] = ()

    @property
    def prior_weight(self) -> float:
        p = min(max(self.prior, 1e-15), 1 - 1e-15)
        return math.log2(p / (1 - p))

    def weights(self, comparison: str) -> dict[int, float]:
        return {x.level: x.weight for x in self.levels if x.comparison == comparison}

    def untrained(self) -> list[Level]:
        return [x for x in self.levels if not x.trained]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(x.comparison, x.level, x.m, x.u, x.trained) for x in self.levels]
        return spark.createDataFrame(rows, "comparison string, level int, m double, u double, trained boolean")

    def training_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(x.rule, x.rounds, x.change, x.match_rate, x.log_likelihood, x.converged) for x in self.training]
        return spark.createDataFrame(rows, "training_rule int, rounds int, change double, match_rate double, log_likelihood double, converged boolean")


# --- prior ------------------------------------------------------------------------------------------


def prior_probability(
    units: DataFrame,
    rules: Sequence[Rule] = DETERMINISTIC_RULES,
    recall: float = PRIOR_RECALL,
    weight: str | None = None,
) -> DataFrame:
    """Share of all pairs that match, from near-certain rules that find ``recall`` of the matches."""
    size = F.count("*") if weight is None else F.sum(weight)
    records = units.agg(size.alias("records"))
    both = pair_count(units, rules, weight).unionByName(records, allowMissingColumns=True)
    totals = both.agg(F.max("pairs").alias("pairs"), F.max("records").alias("records"))
    possible = F.col("records").cast("double") * (F.col("records") - 1) / 2
    prior = F.when(possible > 0, F.least(F.lit(1.0), F.col("pairs") / recall / possible)).otherwise(0.0)
    return totals.select(F.col("pairs").alias("deterministic_pairs"), prior.alias("prior"))


# --- u: agreement of random pairs -------------------------------------------------------------------


def sample_size(max_pairs: int) -> int:
    """Largest number of records with at most ``max_pairs`` pairs among them."""
    return (1 + math.isqrt(1 + 8 * max_pairs)) // 2


def sample_records(units: DataFrame, total: int, max_pairs: int, seed: int, id_column: str = RECORD_ID) -> DataFrame:
    """Keep records by a hash of id and seed, so the sample is the same on every run and partitioning."""
    keep = sample_size(max_pairs)
    if total <= keep:
        return units
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column))), 1, 8)
    draw = F.conv(digits, 16, 10).cast("bigint") / F.lit(float(2**32))
    return units.filter(draw < F.lit(keep / total))


def _similar_pairs(values: DataFrame, comparison: Comparison, distinct: int) -> DataFrame:
    """Record pairs per level over the pairs of different values that may agree, in tiles of the distinct values."""
    chunks = max(1, math.ceil(distinct / _SAMPLE_CHUNK))
    most = chunks * _SAMPLE_CHUNK
    tasks = join_tasks(values.sparkSession, pairs=most * most / 2, rows=most * chunks)
    carried = carried_columns([comparison])
    values = with_helpers(values, [comparison])

    def side(suffix: str) -> DataFrame:
        other, number = tile(F.lit(chunks), comparison.column, left=suffix == "l")
        copies = values.select("*", other).withColumn("tile", number)
        copies = copies.select("tile", *[F.col(c).alias(f"{c}_{suffix}") for c in ("n", *carried)])
        return copies.repartition(tasks, "tile")  # few bytes, many pairs

    pairs = side("l").join(side("r").hint("merge"), "tile")
    pairs = pairs.filter(f"{comparison.column}_l < {comparison.column}_r").filter(comparison.may_agree())
    asked = ask(pairs.withColumn("n", F.expr("n_l * n_r")).drop("n_l", "n_r"), [comparison])
    graded = answer(asked, [comparison])
    return graded.groupBy(F.col(gamma(comparison)).alias("level")).agg(F.sum("n").alias("n"))


def _edited_pairs(values: DataFrame, comparison: EditTiers, scratch: Scratch) -> DataFrame:
    """Record pairs per level over the pairs of different values within the largest edit distance, found by their keys."""
    everything = Agreement(comparison, frozenset(range(1, comparison.top + 1)))
    near = near_values(values.withColumnRenamed(comparison.column, "value"), everything, scratch, carry=["n"])
    graded = near.selectExpr(f"value as {comparison.column}_l", f"other as {comparison.column}_r", "n * other_n as n")
    levels = graded.selectExpr(f"{comparison.plain_level()} as level", "n")
    return levels.groupBy("level").agg(F.sum("n").alias("n"))


def exact_pairs(units: DataFrame, comparisons: Sequence[Comparison] = COMPARISONS) -> DataFrame:
    """Pairs of all records at each level that equal values give, and at level 0 the other non-null pairs.

    One scan and group sizes; no pair is listed.
    """
    rows = []
    for c in comparisons:
        following = [key for _, key in c.exact[1:]] + ["cast(null as string)"]
        for (level, key), after in zip(c.exact, following, strict=True):
            rows.append(f"struct('{c.column}' as comparison, {level} as level, {level} = {c.top} as top, {key} as value, {after} is not null as again)")
    values = units.selectExpr(f"inline(array({', '.join(rows)}))").filter("value is not null")
    values = values.groupBy("comparison", "level", "top", "again", "value").agg(F.count("*").cast("decimal(18,0)").alias("n"))
    sizes = values.groupBy("comparison", "level", "top").agg(
        F.expr("sum(n)").cast("decimal(18,0)").alias("records"),
        F.expr("sum(n * (n - 1)) / 2").cast("decimal(37,0)").alias("equal"),
        F.expr("coalesce(sum(n * (n - 1)) filter (where again), 0) / 2").cast("decimal(37,0)").alias("nested"),
    )
    # Pairs that are equal at a level and again at the next one belong to the first.
    places = Window.partitionBy("comparison").orderBy(F.desc("level"))
    sizes = sizes.withColumn("own", F.expr("equal") - F.coalesce(F.lag("nested").over(places), F.lit(0)))
    everything = "if(top, cast(records * (records - 1) / 2 as decimal(37,0)), 0)"
    return sizes.selectExpr(
        f"inline(array(struct(comparison, level, cast(own as decimal(38,0)) as n), struct(comparison, 0 as level, cast({everything} - own as decimal(38,0)) as n)))"
    )


def value_counts(units: DataFrame, comparisons: Sequence[Comparison]) -> DataFrame:
    """``comparison``, ``value`` and the number ``n`` of records with it, for all comparisons in one scan."""
    rows = ", ".join(f"struct('{c.column}' as comparison, {c.column} as value)" for c in comparisons)
    listed = units.selectExpr(f"inline(array({rows}))").filter("value is not null")
    return listed.groupBy("comparison", "value").agg(F.count("*").alias("n"))


def random_pair_levels(
    units: DataFrame,
    comparisons: Sequence[Comparison] = COMPARISONS,
    max_pairs: int = MAX_SAMPLED_PAIRS,
    seed: int = SEED,
    id_column: str = RECORD_ID,
    max_value_pairs: int = MAX_VALUE_PAIRS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Non-null pairs of all records per level: ``comparison``, ``level``, ``n``, and the ``share`` of records compared.

    Levels of equal values are counted over the whole table, and so are edit distances, by the keys that values within
    a few edits share. Similarities are compared between all distinct values of a field while these have at most
    ``max_value_pairs`` pairs. Beyond that the split of the other pairs into similar and different ones is measured on
    ``sample_size(max_pairs)`` records drawn by hash.
    """
    scratch = scratch or Scratch(units.sparkSession, "random-pairs")
    graded = [c for c in comparisons if len(c.exact) < c.top]
    parts = [exact_pairs(units, comparisons).selectExpr("comparison", "true as whole", "level", "n", "1D as share")]
    sizes = {}
    if graded:
        values = scratch.materialise(value_counts(units, graded), f"values-{uuid.uuid4().hex}")
        sizes = {r["comparison"]: r["n"] for r in values.groupBy("comparison").agg(F.count("*").alias("n")).collect()}  # one row for each
    for c in graded:
        if c.column not in sizes:
            continue
        distinct, share = sizes[c.column], 1.0
        own = values.filter(F.col("comparison") == c.column).select(F.col("value").alias(c.column), "n")
        if not isinstance(c, EditTiers) and distinct > sample_size(max_value_pairs):
            total, drawn = units.count(), sample_size(max_pairs)
            share = min(1.0, drawn / total)
            own = sample_records(units, total, max_pairs, seed, id_column).filter(F.col(c.column).isNotNull())
            own, distinct = own.groupBy(c.column).agg(F.count("*").alias("n")), min(distinct, drawn)
        near = _edited_pairs(own, c, scratch) if isinstance(c, EditTiers) else _similar_pairs(own, c, distinct)
        others = own.selectExpr("0 as level", "cast((sum(n) * (sum(n) - 1) - sum(n * (n - 1))) / 2 as bigint) as n")
        listed = f"level in ({', '.join(str(level) for level, _ in c.exact)})"
        near = near.filter("level > 0").selectExpr(f"if({listed}, 0, level) as level", f"if({listed}, -n, n) as n")
        found = others.unionByName(near)
        parts.append(found.selectExpr(f"'{c.column}' as comparison", "false as whole", "level", "cast(n as decimal(38,0)) as n", f"{share}D as share"))
    counts = reduce(DataFrame.unionByName, parts).groupBy("comparison", "whole", "level").agg(F.sum("n").alias("n"), F.min("share").alias("share"))
    same = Window.partitionBy("comparison")  # a few rows each
    rest = counts.withColumns({
        "rest": F.max(F.expr("if(whole and level = 0, cast(n as double), null)")).over(same),
        "sampled": F.max(F.expr("if(not whole and level = 0, cast(n as double), null)")).over(same),
        "share": F.min("share").over(same),
    })
    part = "if(share < 1, cast(round(rest * cast(n as double) / sampled) as decimal(38,0)), n)"
    split = rest.filter("whole or level > 0").selectExpr(
        "comparison",
        "share",
        f"inline(if(whole, array(struct(level, n)), array(struct(level, coalesce({part}, 0) as n), struct(0 as level, -coalesce({part}, 0) as n))))",
    )
    levels = split.groupBy("comparison", "level").agg(F.sum("n").alias("n"), F.min("share").alias("share"))
    return levels.filter("n > 0")


def u_probabilities(levels: DataFrame) -> DataFrame:
    """Share of each level: ``comparison``, ``level``, ``u``, and the ``share`` of records compared for it."""
    # A few rows for each comparison; a join with their sums would compute the levels twice.
    total = F.sum("n").over(Window.partitionBy("comparison"))
    return levels.select("comparison", "level", (F.col("n").cast("double") / total.cast("double")).alias("u"), "share")


# --- m: agreement of matches ------------------------------------------------------------------------


def copies_pattern(comparisons: Sequence[Comparison] = COMPARISONS) -> list[Column]:
    """Levels of a record paired with an exact copy of itself."""
    return [F.when(F.col(c.column).isNull(), -1).otherwise(c.top).alias(gamma(c)) for c in comparisons]


def in_some_block(rules: Sequence[Rule]) -> Column:
    """Whether all keys of at least one rule are present."""
    blocks = [reduce(Column.__and__, [F.expr(k).isNotNull() for k in rule.keys]) for rule in rules]
    return reduce(Column.__or__, blocks)


def training_pattern_counts(
    profiles: DataFrame,
    comparisons: Sequence[Comparison] = COMPARISONS,
    rules: Sequence[Rule] = TRAINING_RULES,
    id_column: str = RECORD_ID,
) -> DataFrame:
    """Pairs per training block and agreement pattern: ``training_rule``, the levels, ``n``.

    ``profiles`` are distinct records with their number of copies in ``copies``, so a pair of profiles
    stands for all pairs of their copies. The blocks overlap: their union is listed and compared once, and
    a pair belongs to every block whose columns are at their top level.
    """
    top = {c.column: c.top for c in comparisons}
    for rule in rules:
        if not set(rule.keys) <= set(top):
            raise ValueError(f"a training rule must use compared columns, got {rule.keys}")
    gammas = [gamma(c) for c in comparisons]
    carry = [*carried_columns(comparisons), "copies"]
    pairs = candidate_pairs(with_helpers(profiles, comparisons), rules, id_column, carry)
    asked = ask(pairs, comparisons)
    asked = asked.withColumn("n", F.col("copies_l") * F.col("copies_r"))
    asked = asked.drop("copies_l", "copies_r", f"{id_column}_l", f"{id_column}_r", "match_key")
    # Pairs with the same levels and the same open questions merge before Python sees them; those without
    # a question, nearly all of a large block, come down to one row per pattern.
    merged = asked.groupBy(*[c for c in asked.columns if c != "n"]).agg(F.sum("n").alias("n"))
    among = answer(merged, comparisons).select(*gammas, "n")
    copied = profiles.filter("copies > 1").filter(in_some_block(rules))
    within = copied.select(
        *copies_pattern(comparisons), F.floor(F.col("copies") * (F.col("copies") - 1) / 2).alias("n")
    )
    counts = among.unionByName(within).groupBy(*gammas).agg(F.sum("n").cast("bigint").alias("n"))
    member = [
        F.when(
            reduce(Column.__and__, [F.col(f"gamma_{k}") == top[k] for k in rule.keys]), F.lit(number)
        )
        for number, rule in enumerate(rules)
    ]
    return counts.select(F.explode(F.array_compact(F.array(*member))).alias("training_rule"), *gammas, "n")


def _train_block(
    patterns: np.ndarray,
    counts: np.ndarray,
    trained: Mapping[int, int],
    u: Mapping[int, np.ndarray],
    start_rate: float,
    rule: int,
) -> tuple[dict[int, np.ndarray], BlockTraining]:
    """EM over one block; ``trained`` maps a pattern column to its number of levels, ``u`` stays fixed."""
    m = {}
    for c, size in trained.items():
        m[c] = np.full(size, (1 - START_EXACT_M) / (size - 1))
        m[c][-1] = START_EXACT_M
    rate = min(max(start_rate, FLOOR), 1 - FLOOR)

    def odds() -> np.ndarray:
        total = np.full(len(counts), math.log(rate / (1 - rate)))
        for c in trained:
            factor = np.log(np.maximum(m[c], FLOOR) / np.maximum(u[c], FLOOR))
            total += np.where(patterns[:, c] >= 0, factor[patterns[:, c]], 0.0)
        return np.clip(total, -700, 700)

    rounds, change = 0, math.inf
    while rounds < MAX_ROUNDS and change >= MIN_CHANGE:
        rounds, change = rounds + 1, 0.0
        expected = counts / (1 + np.exp(-odds()))
        for c, size in trained.items():
            seen = patterns[:, c] >= 0
            mass = np.bincount(patterns[seen, c], weights=expected[seen], minlength=size)
            if mass.sum() > 0:
                new = mass / mass.sum()
                change = max(change, float(np.abs(new - m[c]).max()))
                m[c] = new
        rate = min(max(float(expected.sum() / counts.sum()), FLOOR), 1 - FLOOR)
    chance = np.full(len(counts), math.log(1 - rate))
    for c in trained:
        chance += np.where(patterns[:, c] >= 0, np.log(np.maximum(u[c], FLOOR))[patterns[:, c]], 0.0)
    likelihood = float((counts * (chance + np.log1p(np.exp(odds())))).sum())
    return m, BlockTraining(rule, rounds, change, rate, likelihood)


def fit_model(
    prior: float,
    u_rows: Iterable[Row],
    pattern_rows: Iterable[Row],
    comparisons: Sequence[Comparison] = COMPARISONS,
    rules: Sequence[Rule] = TRAINING_RULES,
) -> Model:
    """Model from the prior, the u shares and the training pattern counts.

    Each block leaves out the columns it fixes; a level's m is the median over the blocks that saw it, and
    its starting value when none did.
    """
    position = {c.column: i for i, c in enumerate(comparisons)}
    u = {i: np.zeros(c.top + 1) for i, c in enumerate(comparisons)}
    for row in u_rows:
        u[position[row["comparison"]]][row["level"]] = row["u"]
    gammas = [gamma(c) for c in comparisons]
    seen_m: dict[tuple[int, int], list[float]] = {}
    training: list[BlockTraining] = []
    table = sorted((r["training_rule"], *(r[g] for g in gammas), r["n"]) for r in pattern_rows)
    for number, rule in enumerate(rules):
        block = np.array([r[1:] for r in table if r[0] == number], dtype=np.int64)
        if not len(block):
            continue
        patterns, counts = block[:, :-1], block[:, -1].astype(float)
        fixed = [position[k] for k in rule.keys]
        odds = prior / max(1 - prior, FLOOR)
        for c in fixed:
            odds *= START_EXACT_M / max(u[c][-1], FLOOR)
        trained = {i: c.top + 1 for i, c in enumerate(comparisons) if i not in fixed}
        m, ended = _train_block(patterns, counts, trained, u, odds / (1 + odds), number)
        training.append(ended)
        if not ended.converged:
            warnings.warn(f"training block {number} still changed by {ended.change:.2g} after {ended.rounds} rounds", stacklevel=2)
        for c in trained:
            for level in np.unique(patterns[:, c]):
                if level >= 0:
                    seen_m.setdefault((c, int(level)), []).append(float(m[c][level]))
    levels = []
    for i, c in enumerate(comparisons):
        for level in range(c.top + 1):
            found = seen_m.get((i, level))
            start = START_EXACT_M if level == c.top else (1 - START_EXACT_M) / c.top
            levels.append(
                Level(c.column, level, median(found) if found else start, float(u[i][level]), bool(found) and bool(u[i][level] > 0))
            )
    return Model(prior, tuple(levels), training=tuple(training))


# --- score ------------------------------------------------------------------------------------------


def score_pairs(vectors: DataFrame, model: Model, comparisons: Sequence[Comparison] = COMPARISONS) -> DataFrame:
    """Add ``match_weight`` (log2 odds) and ``match_probability``; a missing value adds nothing."""
    parts = [f"{model.prior_weight}D"]
    for c in comparisons:
        cases = " ".join(f"when {level} then {w}D" for level, w in model.weights(c.column).items())
        parts.append(f"case {gamma(c)} {cases} else 0D end")
    scored = vectors.withColumn("match_weight", F.expr(" + ".join(parts)))
    return scored.withColumn("match_probability", F.expr("1D / (1D + pow(2D, -match_weight))"))


def weight_needed(threshold: float) -> float:
    """Weight with which a pair reaches the threshold, less what rounding can add."""
    needed = math.log2(threshold / (1 - threshold)) if threshold < 1 else 50.0
    return min(needed, 50.0) - 1e-6


def can_still_match(model: Model, threshold: float, comparisons: Sequence[Comparison] = COMPARISONS) -> Column:
    """Whether an ungraded pair can still score ``threshold``.

    Takes the best level that the cheap bounds leave open, so hopeless pairs are dropped before their
    similarities are computed.
    """
    best = [f"{model.prior_weight}D"]
    for c in comparisons:
        w = model.weights(c.column)
        best.append(
            f"case when {c.column}_l is null or {c.column}_r is null then 0D"
            f" when {c.column}_l = {c.column}_r then {w[c.top]}D"
            f" when {c.may_agree()} then {max(w[level] for level in range(c.top))}D else {w[0]}D end"
        )
    return F.expr(" + ".join(best)) >= weight_needed(threshold)


def pairs_above_threshold(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.filter(F.col("match_probability") >= threshold)
