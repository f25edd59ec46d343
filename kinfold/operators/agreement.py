"""Pairs that can still match: small blocks are listed, larger ones graded whole in numpy (`hope`), and the largest joined.

The rest of this module is about the largest: which agreements a match needs, and a join on them.

A pair reaches the threshold only with enough weight. The statuses of a comparison (its levels, and "missing") are ranked by
their weight; a combination of least ranks that just reaches the threshold is a minimal agreement set. Every match has
all the agreements of at least one such set, so a choice of agreements that takes one from each set (a transversal) is
met by every match, and joining a block on each chosen agreement loses none. Of all transversals the one whose
agreements are rarest between random pairs is taken; it depends on the model, the threshold and what a rule's keys
already settle.

Agreements are joined on

* equal values, for levels that only equal values give;
* values that are near each other: pairs of different values are found once, over the distinct values, by keys that two
  near values must share (`near_values`), and records are joined through them;
* a missing value, where that outranks different values: such records meet all others of their block.

Similarity levels without such keys are not chosen; where nothing else covers all sets, the block is listed as a whole.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators.blocking import (
    _BROADCAST_BLOCKS,
    _EXPANDED_ROWS,
    TILE_ROWS,
    Rule,
    block_sizes,
    candidate_pairs,
    first_rule,
    join_tasks,
    rows_of_blocks,
    tile,
)
from kinfold.operators.comparison import Comparison, carried_columns, with_open_helpers
from kinfold.operators.hope import Hope, hopeful_of_list, hopeful_of_tiles
from kinfold.operators.model import Model, can_still_match, weight_needed
from kinfold.operators.nearness import MISSING, Agreement, equal_key, exact_levels, has_keys, near_values
from kinfold.operators.skew import lookup, spread
from kinfold.schema import RECORD_ID
from kinfold.scratch import Scratch

#: Blocks up to so many rows are listed.
LISTED_ROWS = 32
#: Blocks up to so many rows are graded whole. That takes some ten nanoseconds a pair, so it grows with the square of a block.
GRADED_ROWS = 50_000
GRADED_TILE_ROWS = 4_096  # of a chunk whose pairs with itself or with another one are a tile
_GRADED_PAIRS = 50_000_000  # of a task
_GRADED_TASK_ROWS = 100_000


class Ranks:
    """Statuses of a comparison by weight, rank 0 the least."""

    def __init__(self, comparison: Comparison, model: Model):
        weights = {MISSING: 0.0} | {level: model.weights(comparison.column)[level] for level in range(comparison.top + 1)}
        self.comparison = comparison
        self.weights = sorted(set(weights.values()))
        self.statuses = [frozenset(s for s, w in weights.items() if w >= least) for least in self.weights]

    def agreement(self, rank: int) -> Agreement:
        return Agreement(self.comparison, self.statuses[rank])


def minimal_sets(ranks: Sequence[Ranks], needed: float) -> list[tuple[int, ...]]:
    """Least ranks, one for each comparison, with which the weights reach ``needed``; lowering any of them fails."""

    def total(at: Sequence[int]) -> float:
        return sum(r.weights[i] for r, i in zip(ranks, at, strict=True))

    found = []
    for at in product(*[range(len(r.weights)) for r in ranks]):
        if total(at) >= needed and all(total([*at[:i], x - 1, *at[i + 1 :]]) < needed for i, x in enumerate(at) if x):
            found.append(at)
    return found


def join_cost(agreement: Agreement, model: Model, missing: float) -> float:
    """Share of random pairs that agree, infinite where no key finds them; ``missing`` is the share of missing values."""
    if agreement.levels and not has_keys(agreement):
        return math.inf
    u = {x.level: x.u for x in model.levels if x.comparison == agreement.comparison.column}
    present = sum(u[level] for level in agreement.levels) * (1 - missing) ** 2
    return present + (1 - (1 - missing) ** 2 if MISSING in agreement.statuses else 0.0)


def transversal(ranks: Sequence[Ranks], sets: Sequence[tuple[int, ...]], cost: Mapping[tuple[int, int], float]) -> list[Agreement] | None:
    """The cheapest agreements of which every set has one; None if a set asks for nothing or nothing joins it.

    Without any set no pair can match, and no agreement is needed.
    """
    best, chosen = math.inf, None
    for at in product(*[range(len(r.weights)) for r in ranks]):
        price = sum(cost[i, x] for i, x in enumerate(at) if x)
        if price < best and all(any(0 < x <= y for x, y in zip(at, own, strict=True)) for own in sets):
            best, chosen = price, at
    if chosen is None:
        return None
    return [r.agreement(x) for r, x in zip(ranks, chosen, strict=True) if x]


def agreements_of(rule: Rule, model: Model, threshold: float, comparisons: Sequence[Comparison], missing: Mapping[str, float]) -> list[Agreement] | None:
    """Agreements of which every match in a block of ``rule`` has at least one; None if the block has to be listed."""
    equal = set(rule.keys)
    given = sum(model.weights(c.column)[c.top] for c in comparisons if c.column in equal)
    ranks = [Ranks(c, model) for c in comparisons if c.column not in equal]
    sets = minimal_sets(ranks, weight_needed(threshold) - model.prior_weight - given)
    cost = {
        (i, x): join_cost(r.agreement(x), model, missing.get(r.comparison.column, 0.0)) for i, r in enumerate(ranks) for x in range(1, len(r.weights))
    }
    return transversal(ranks, sets, cost)


# --- join -------------------------------------------------------------------------------------------


def _sides(rows: DataFrame, agreement: Agreement, number: int, scratch: Scratch) -> list[tuple[DataFrame, DataFrame]]:
    """Left and right rows that meet where they share ``meet``; ``_once`` tells that both orders of a pair come up."""
    column = agreement.comparison.column
    out = []

    def keyed(of: DataFrame, kind: str, key: str, once: str) -> DataFrame:
        return of.selectExpr(*rows.columns, f"xxhash64('{kind}', {number}, rule, block, {key}) as meet", f"{once} as _once")

    if agreement.levels in exact_levels(agreement.comparison):
        key = equal_key(agreement)
        same = keyed(rows.filter(f"{key} is not null"), "equal", key, "true")
        out.append((same, same))
    elif agreement.levels:
        present = rows.filter(f"{column} is not null")
        same = keyed(present, "equal", column, "true")
        out.append((same, same))
        values = scratch.materialise(present.select(F.col(column).alias("value")).distinct(), f"values-{column}-{uuid.uuid4().hex}")
        near = scratch.materialise(near_values(values, agreement, scratch), f"near-{column}-{uuid.uuid4().hex}")
        left = present.join(near, F.col(column) == F.col("value"))
        out.append((keyed(left, "near", "other", "false"), keyed(present, "near", column, "false")))
    if MISSING in agreement.statuses:
        missing = f"{column} is null"
        out.append((keyed(rows.filter(missing), "missing", "0", "true"), keyed(rows, "missing", "0", missing)))
    return out


def agreeing_pairs(
    rows: DataFrame, agreements: Sequence[Agreement], id_column: str, scratch: Scratch, condition: Column | None = None, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Pairs of ``rows`` (``rule``, ``block``, other columns) of one block that have an agreement, some more than once.

    Columns come as ``<name>_l`` and ``<name>_r``, the smaller id on the left. ``condition`` must not depend on the order
    of a pair. Rows that share a key with many others are
    cut into chunks, and every pair of chunks is a join key of its own.
    """
    sides = [pair for number, a in enumerate(agreements) for pair in _sides(rows, a, number, scratch)]
    left, right = (reduce(DataFrame.unionByName, [pair[i] for pair in sides]) for i in range(2))
    counted = left.groupBy("meet").agg(F.count("*").alias("n_l")).join(right.groupBy("meet").agg(F.count("*").alias("n_r")), "meet")
    total = counted.agg(F.sum(F.col("n_l").cast("double") * F.col("n_r")), F.sum("n_l"), F.sum("n_r")).first()
    tasks = join_tasks(rows.sparkSession, pairs=total[0] or 0, rows=(total[1] or 0) + (total[2] or 0))
    most = F.greatest("n_l", "n_r")
    large = counted.filter(most > tile_rows).select("meet", F.ceil(most / tile_rows).cast("int").alias("chunks"), most.alias("size"))

    def side(of: DataFrame, suffix: str) -> DataFrame:
        known = lookup(of, large, ["meet"], "size", int(max(total[1] or 0, total[2] or 0)), how="left")
        other, number = tile(F.coalesce(F.col("chunks"), F.lit(1)), id_column, left=suffix == "l")
        tiled = known.select("*", other).withColumn("tile", number)
        tiled = tiled.select("meet", "tile", *[F.col(c).alias(f"{c}_{suffix}") for c in (*rows.columns, "_once")])
        return tiled.repartition(tasks, "meet", "tile")

    pairs = side(left, "l").join(side(right, "r").hint("merge"), ["meet", "tile"])
    ids = [F.col(f"{id_column}_{s}") for s in "lr"]
    ordered = ids[0] < ids[1]
    pairs = pairs.filter((F.col("rule_l") == F.col("rule_r")) & (F.col("block_l") == F.col("block_r")))
    pairs = pairs.filter((ids[0] != ids[1]) & (ordered | ~F.col("_once_r")))
    if condition is not None:
        pairs = pairs.withColumn("rule", F.col("rule_l")).filter(condition)
    names = [c for c in rows.columns if c not in ("rule", "block")]
    swapped = [F.when(ordered, F.col(f"{c}_{x}")).otherwise(F.col(f"{c}_{y}")).alias(f"{c}_{x}") for c in names for x, y in ("lr", "rl")]
    return pairs.select(F.col("rule_l").alias("rule"), *swapped)


def graded_pairs(
    units: DataFrame, sizes: DataFrame, hope: Hope, rules: Sequence[Rule], columns: Sequence[str], id_column: str, tile_rows: int
) -> DataFrame | None:
    """Pairs of the blocks in ``sizes`` (``rule``, ``block``, ``n``) that can match, if there are blocks, with ``columns`` of both sides.

    A row goes to its block once, or once for each chunk of a block above ``tile_rows`` rows: every two chunks are a tile.
    """
    n, chunks = F.col("n").cast("double"), F.ceil(F.col("n") / tile_rows).cast("int")
    count, pairs, rows = sizes.agg(F.count("*"), F.sum(n * (n - 1) / 2), F.sum(n * chunks)).first()
    if not count:
        return None
    units = spread(units, int(rows), id_column, _EXPANDED_ROWS)
    blocks, place = rows_of_blocks(units, rules, [id_column, *columns])
    kept = [c for c in blocks.columns if c not in ("rule", "block")]
    cut = sizes.select("rule", "block", "n", chunks.alias("chunks"))
    if count <= _BROADCAST_BLOCKS:
        blocks = blocks.join(F.broadcast(cut.drop("n")), ["rule", "block"])
    else:
        blocks = lookup(blocks, cut, ["rule", "block"], "n", int(rows))
    blocks = blocks.withColumn("chunk", F.pmod(F.xxhash64(id_column), F.col("chunks")).cast("int"))
    blocks = blocks.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("_other"))
    number = F.least("chunk", "_other").cast("bigint") * F.col("chunks") + F.greatest("chunk", "_other")
    tiled = blocks.select("rule", "block", number.alias("tile"), "chunk", (F.col("chunk") != F.col("_other")).alias("across"), *kept)
    spark = units.sparkSession
    parallel = spark.sparkContext.defaultParallelism
    tasks = max(math.ceil(pairs / _GRADED_PAIRS), math.ceil(rows / _GRADED_TASK_ROWS), min(parallel, math.ceil(pairs / 1_000_000)))
    tiled = tiled.repartition(tasks, "rule", "block", "tile").sortWithinPartitions("rule", "block", "tile")
    types = {f.name: f.dataType.simpleString() for f in tiled.schema}
    schema = ", ".join([*[f"`{c}_{s}` {types[c]}" for c in kept for s in "lr"], "rule int"])
    found = tiled.mapInArrow(hopeful_of_tiles(hope, kept), schema)
    ids = [F.col(f"{id_column}_{s}") for s in "lr"]
    # Equal hashes are not yet equal keys: the rule of the row must be the first that really agrees.
    found = found.filter((ids[0] != ids[1]) & (first_rule(rules, place) == F.col("rule")))
    swapped = [F.when(ids[0] < ids[1], F.col(f"{c}_{x}")).otherwise(F.col(f"{c}_{y}")).alias(f"{c}_{x}") for c in dict.fromkeys([id_column, *columns]) for x, y in ("lr", "rl")]
    return found.select(*swapped, F.col("rule").alias("match_key"))


def hopeful_pairs(
    units: DataFrame,
    model: Model,
    threshold: float,
    rules: Sequence[Rule],
    comparisons: Sequence[Comparison],
    scratch: Scratch,
    carry: Sequence[str] = (),
    id_column: str = RECORD_ID,
    large_rows: int = LISTED_ROWS,
    graded_rows: int = GRADED_ROWS,
) -> DataFrame:
    """Candidate pairs of ``units`` (with the helpers of the comparisons) that can still reach the threshold.

    Blocks up to ``large_rows`` rows are listed, those up to ``graded_rows`` graded whole, and the others joined on the
    agreements a match in them needs. Where no such agreements are known they are graded too.
    """
    bare = list(dict.fromkeys([*[c.column for c in comparisons], *carry]))
    carry = list(dict.fromkeys([*carried_columns(comparisons), *carry]))
    hope = Hope([(c, model.weights(c.column)) for c in comparisons], weight_needed(threshold) - model.prior_weight)
    large = scratch.materialise(block_sizes(units, rules).filter(F.col("n") > large_rows), "large-blocks")
    numbers = {r["rule"] for r in large.filter(F.col("n") > graded_rows).select("rule").distinct().collect()}  # at most one row for each rule
    chosen = {}
    if numbers:
        columns = [c.column for c in comparisons]
        shares = units.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns]).first().asDict()
        chosen = {n: agreements_of(rules[n], model, threshold, comparisons, shares) for n in numbers}
    joined = (F.col("n") > graded_rows) & F.col("rule").isin([n for n, a in chosen.items() if a is not None])
    wanted = [f"{c}_{s}" for c in dict.fromkeys([id_column, *carry]) for s in "lr"]

    plain = units.select(*dict.fromkeys([id_column, *bare]))  # helpers would be most of what is shuffled
    listed = candidate_pairs(plain, rules, id_column, bare, without=large)
    found = [listed.mapInArrow(hopeful_of_list(hope), listed.schema)]
    graded = graded_pairs(plain, large.filter(~joined), hope, rules, bare, id_column, GRADED_TILE_ROWS)
    found += [] if graded is None else [graded]
    found = [with_open_helpers(pairs, comparisons).select(*wanted, "match_key") for pairs in found]
    if not any(a is not None for a in chosen.values()):
        return reduce(DataFrame.unionByName, found)
    blocks, place = rows_of_blocks(units, rules, [id_column, *carry])
    inside = blocks.join(large.filter(joined).select("rule", "block"), ["rule", "block"], "left_semi")
    # Units may repeat an id, but a unit is in a block of a rule once: its row there stands for it.
    inside = scratch.materialise(inside.withColumn("_row", F.monotonically_increasing_id()), "large-rows")
    bound = can_still_match(model, threshold, comparisons)
    for n, agreements in chosen.items():
        if agreements:  # without a set that can match there is nothing to join
            pairs = agreeing_pairs(inside.filter(F.col("rule") == n), agreements, id_column, scratch, (first_rule(rules, place) == F.col("rule")) & bound)
            found.append(pairs.dropDuplicates(["_row_l", "_row_r"]).select(*wanted, F.col("rule").alias("match_key")))
    return reduce(DataFrame.unionByName, found)
