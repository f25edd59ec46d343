"""Blocking: which pairs of records are worth comparing.

A rule is a list of key expressions; two records are candidates when all keys of at least one rule are
equal and not null. Every pair is listed once, under the first rule that yields it.

* Listing (`candidate_pairs`) is one equi-join over all rules. A block larger than ``tile_rows`` is cut
  into chunks, and every pair of chunks becomes a join key of its own, so a block that holds a third of
  the table is spread over many tasks.
* Counting (`rule_counts`, `pair_count`) lists nothing. The pairs of a key combination follow from its
  group sizes, and inclusion-exclusion over the combinations gives the exact size of the union.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators.skew import lookup, spread
from kinfold.schema import RECORD_ID

TILE_ROWS = 1_000
_SMALL_TASK = 100_000  # rows or pairs below which a task is not worth its start
_PAIRS_PER_TASK = 1_000_000
_MAX_TASKS = 100_000
_EXPANDED_ROWS = 250_000  # block rows that a task makes of the units it reads
_BROADCAST_BLOCKS = 200_000  # rows of (rule, 64-bit key, chunks), about 5 MB


@dataclass(frozen=True)
class Rule:
    """Key expressions over the record columns, as SQL text."""

    keys: tuple[str, ...]

    @staticmethod
    def on(*keys: str) -> Rule:
        return Rule(keys)


# Blocking rules in order, rules of near-certain agreement, and training blocks.
CANDIDATE_RULES = (
    Rule.on("email"),
    Rule.on("last_name", "postcode"),
    Rule.on("first_name", "city"),
    Rule.on("substr(first_name, 1, 2)", "substr(last_name, 1, 2)"),
    Rule.on("postcode"),
)
DETERMINISTIC_RULES = (Rule.on("email"), Rule.on("first_name", "last_name", "postcode"))
TRAINING_RULES = (Rule.on("email"), Rule.on("last_name", "postcode"), Rule.on("first_name", "last_name"))


def _distinct_keys(rules: Iterable[Rule]) -> list[str]:
    return list(dict.fromkeys(key for rule in rules for key in rule.keys))


def _with_keys(units: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, dict[str, str]]:
    """Units with every key expression as a column, and the column that holds each expression."""
    place = {k: k if k in units.columns else f"_key{i}" for i, k in enumerate(_distinct_keys(rules))}
    return units.withColumns({c: F.expr(k) for k, c in place.items() if c != k}), place


def _block_rows(units: DataFrame, rules: Sequence[Rule], place: dict[str, str]) -> DataFrame:
    """One row per unit and rule whose keys are all present, with the 64-bit hash of the keys."""
    entries = []
    for number, rule in enumerate(rules):
        keys = [place[k] for k in rule.keys]
        present = " and ".join(f"{k} is not null" for k in keys)
        entries.append(f"if({present}, struct({number} as rule, xxhash64({number}, {', '.join(keys)}) as block), null)")
    return units.selectExpr("*", f"inline(array_compact(array({', '.join(entries)})))")


def rows_of_blocks(units: DataFrame, rules: Sequence[Rule], columns: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """``columns`` and keys of the units, once for each block they are in, and the column that holds each key."""
    units, place = _with_keys(units, rules)
    kept = list(dict.fromkeys([*columns, *place.values()]))
    return _block_rows(units.select(*kept), rules, place), place


def block_sizes(units: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Number of rows ``n`` of each block."""
    units, place = _with_keys(units, rules)
    return _block_rows(units, rules, place).groupBy("rule", "block").agg(F.count("*").alias("n"))


def hot_blocks(units: DataFrame, rules: Sequence[Rule], tile_rows: int = TILE_ROWS) -> DataFrame:
    """Blocks above ``tile_rows`` rows with the number of chunks each is cut into."""
    large = block_sizes(units, rules).filter(F.col("n") > tile_rows)
    return large.select("rule", "block", F.ceil(F.col("n") / tile_rows).cast("int").alias("chunks"))


def join_tasks(spark: SparkSession, pairs: float, rows: float) -> int:
    """Shuffle partitions of a pair join: the configured number, fewer for little work, more for many pairs."""
    wanted = math.ceil(max(pairs, rows) / _SMALL_TASK)
    usual = min(
        int(spark.conf.get("spark.sql.shuffle.partitions")), max(spark.sparkContext.defaultParallelism, wanted)
    )
    return max(usual, min(math.ceil(pairs / _PAIRS_PER_TASK), _MAX_TASKS))


def _plan_join(units: DataFrame, rules: Sequence[Rule], tile_rows: int, without: DataFrame | None) -> tuple[DataFrame | None, int, int]:
    """Chunks of the hot blocks, if any, the number of join tasks by the pairs they have to list, and the rows of all blocks.

    The sizes of hot blocks come along only where there are too many for a broadcast.
    """
    n = F.col("n").cast("double")
    sizes = block_sizes(units, rules)
    if without is not None:
        sizes = sizes.join(without.select("rule", "block"), ["rule", "block"], "left_anti")
    found = sizes.agg(F.sum(n * (n - 1) / 2), F.count_if(F.col("n") > tile_rows), F.sum(n)).first()
    spark = units.sparkSession
    tasks = join_tasks(spark, pairs=found[0] or 0, rows=found[2] or 0)
    if not found[1]:
        return None, tasks, int(found[2] or 0)
    hot = sizes.filter(F.col("n") > tile_rows).select("rule", "block", F.ceil(F.col("n") / tile_rows).cast("int").alias("chunks"), "n")
    if found[1] > _BROADCAST_BLOCKS:
        return hot, tasks, int(found[2])
    rows = hot.drop("n").collect()  # at most _BROADCAST_BLOCKS
    return spark.createDataFrame(rows, "rule int, block bigint, chunks int"), tasks, int(found[2])


def tile(chunks: Column, id_column: str, left: bool) -> tuple[Column, Column]:
    """Explode a row into its tiles, and the tile number: chunk of the left row x chunk of the right row.

    A row lies in one chunk by hash and is copied to every tile of that chunk, so a left and a right row
    meet in exactly one tile and no tile is larger than one chunk on either side.
    """
    other = F.explode(F.sequence(F.lit(0), chunks - 1))
    mine = F.pmod(F.xxhash64(id_column), chunks)
    first, second = (mine, F.col("_other")) if left else (F.col("_other"), mine)
    return other.alias("_other"), first.cast("bigint") * chunks + second


def _tiled(blocks: DataFrame, hot: DataFrame | None, rows: int, id_column: str, left: bool) -> DataFrame:
    if hot is None:
        return blocks
    # Left join: a row of a small block meets no hot block and keeps the single tile 0.
    if "n" in hot.columns:  # too many to broadcast: the largest of them are, the others meet their rows by key
        known = lookup(blocks, hot, ["rule", "block"], "n", rows, how="left")
    else:
        known = blocks.join(F.broadcast(hot), ["rule", "block"], "left")
    other, number = tile(F.coalesce(F.col("chunks"), F.lit(1)), id_column, left)
    return known.select("*", other).withColumn("tile", number)


def first_rule(rules: Sequence[Rule], place: dict[str, str]) -> Column:
    """Number of the first rule on which the two sides of a joined pair agree."""
    agree = [" and ".join(f"{place[k]}_l = {place[k]}_r" for k in rule.keys) for rule in rules]
    return F.expr("case " + " ".join(f"when {a} then {n}" for n, a in enumerate(agree)) + " end")


def candidate_pairs(
    units: DataFrame,
    rules: Sequence[Rule] = CANDIDATE_RULES,
    id_column: str = RECORD_ID,
    carry: Sequence[str] = (),
    tile_rows: int = TILE_ROWS,
    without: DataFrame | None = None,
) -> DataFrame:
    """Pairs ``<id>_l < <id>_r`` with ``match_key``, the number of their first rule.

    ``carry`` columns come along for both sides, so comparing needs no second join. Blocks listed in ``without`` (``rule``,
    ``block``) are left out.
    """
    hot, tasks, total = _plan_join(units, rules, tile_rows, without)
    # A task that reads a few MB of file may make GB of block rows, which the shuffle to the join would hold at once.
    units = spread(units, total, id_column, _EXPANDED_ROWS)
    blocks, place = rows_of_blocks(units, rules, [id_column, *carry])
    kept = [c for c in blocks.columns if c not in ("rule", "block")]
    if without is not None:
        blocks = blocks.join(without.select("rule", "block"), ["rule", "block"], "left_anti")
    join_on = ["rule", "block"] + (["tile"] if hot is not None else [])

    def side(suffix: str) -> DataFrame:
        rows = _tiled(blocks, hot, total, id_column, left=suffix == "l")
        rows = rows.select(*join_on, *[F.col(c).alias(f"{c}_{suffix}") for c in kept])
        return rows.repartition(tasks, *join_on)  # by number of pairs: a block is small in bytes

    # Sort-merge: it spills, and a block never has to fit into a hash table or a broadcast.
    pairs = side("l").join(side("r").hint("merge"), join_on)
    pairs = pairs.filter(F.col(f"{id_column}_l") < F.col(f"{id_column}_r"))
    # Equal hashes are not yet equal keys: the rule of the row must be the first that really agrees.
    pairs = pairs.filter(first_rule(rules, place) == F.col("rule"))
    wanted = [f"{c}_{s}" for c in dict.fromkeys([id_column, *carry]) for s in "lr"]
    return pairs.select(*wanted, F.col("rule").alias("match_key"))


def block_pairs(units: DataFrame, rule: Rule, id_column: str = RECORD_ID) -> DataFrame:
    """Pairs of a single rule."""
    return candidate_pairs(units, (rule,), id_column).drop("match_key")


def _pairs(n: Column) -> Column:
    """n (n - 1) / 2 without leaving whole numbers."""
    n = n.cast("decimal(20,0)")
    return F.floor(n * (n - 1) / 2)


def _signed_sets(rules: Sequence[Rule], place: dict[str, str]) -> dict[tuple[str, ...], dict[int, int]]:
    """Inclusion-exclusion: for each set of key columns, the sign with which each rule counts its pairs.

    A pair counts for rule i when it agrees on i and on no earlier rule. With A(S) the pairs that agree on all columns of
    S, that is the sum of (-1)^n A(S + i) over all unions S of n earlier rules. Unions are built rule by rule, and equal ones
    merge at once, so their number is that of the different unions of columns, not of the sets of rules.
    """
    signs: dict[tuple[str, ...], dict[int, int]] = {}
    earlier: dict[frozenset[str], int] = {frozenset(): 1}
    for i, rule in enumerate(rules):
        columns = frozenset(place[k] for k in rule.keys)
        united: dict[frozenset[str], int] = {}
        for union, sign in earlier.items():
            united[union | columns] = united.get(union | columns, 0) + sign
        for union, sign in united.items():
            if sign:
                signs.setdefault(tuple(sorted(union)), {})[i] = sign
                earlier[union] = earlier.get(union, 0) - sign
        earlier = {union: sign for union, sign in earlier.items() if sign}
    return signs


def _pairs_per_set(units: DataFrame, sets: Sequence[tuple[str, ...]], columns: list[str], weight: str | None) -> DataFrame:
    """Pairs that agree on all columns of a set, from its group sizes: ``combo`` (number of the set), ``pairs``."""
    size = F.lit(1) if weight is None else F.col(weight)
    # Records that agree on all keys collapse before they are expanded to the sets.
    groups = units.groupBy(*columns).agg(F.sum(size).alias("n"))
    combos = []  # as SQL text: hundreds of Column objects take longer to build than to run
    for number, members in enumerate(sets):
        present = " and ".join(f"{c} is not null" for c in members)
        key = ", ".join(members)
        # Two hashes stand for the values: 128 bits, so that short rows of fixed width are shuffled.
        hashes = f"xxhash64({number}, {key}) as high, xxhash64({number}, 1, {key}) as low"
        combos.append(f"if({present}, struct({number} as combo, {hashes}), null)")
    sizes = (
        groups.selectExpr("n", f"inline(array_compact(array({', '.join(combos)})))")
        .groupBy("combo", "high", "low")
        .agg(F.sum("n").alias("n"))
    )
    return sizes.filter("n > 1").groupBy("combo").agg(F.sum(_pairs(F.col("n"))).alias("pairs"))


def rule_counts(units: DataFrame, rules: Sequence[Rule] = CANDIDATE_RULES, weight: str | None = None) -> DataFrame:
    """Pairs credited to each rule, without listing a pair: ``match_key``, ``pairs``."""
    units, place = _with_keys(units, rules)
    signs = _signed_sets(rules, place)
    sets = [s for s, by_rule in signs.items() if any(by_rule.values())]
    per_set = _pairs_per_set(units, sets, sorted(set(place.values())), weight)
    credit = [(n, i, s) for n, members in enumerate(sets) for i, s in signs[members].items() if s]
    spark = units.sparkSession
    credits = spark.createDataFrame(credit, "combo int, match_key int, sign int")
    every = spark.createDataFrame([(i,) for i in range(len(rules))], "match_key int")
    total = per_set.join(F.broadcast(credits), "combo").groupBy("match_key")  # one row per set and rule
    total = total.agg(F.sum(F.col("pairs") * F.col("sign")).alias("pairs"))
    return every.join(total, "match_key", "left").select(
        "match_key", F.coalesce(F.col("pairs").cast("bigint"), F.lit(0).cast("bigint")).alias("pairs")
    )


def pair_count(units: DataFrame, rules: Sequence[Rule] = CANDIDATE_RULES, weight: str | None = None) -> DataFrame:
    """Size of the candidate set, without listing a pair: one row ``pairs``."""
    units, place = _with_keys(units, rules)
    # Sets cancel out here, as those of a rule that is stricter than another one.
    total = {s: sum(by_rule.values()) for s, by_rule in _signed_sets(rules, place).items()}
    sets = [s for s, sign in total.items() if sign]
    columns = sorted({c for s in sets for c in s})
    per_set = _pairs_per_set(units, sets, columns, weight)
    signed = "case combo " + " ".join(f"when {n} then {total[s]}" for n, s in enumerate(sets)) + " end"
    counted = per_set.agg(F.sum(F.col("pairs") * F.expr(signed)).alias("pairs"))
    return counted.select(F.coalesce(F.col("pairs").cast("bigint"), F.lit(0).cast("bigint")).alias("pairs"))


def candidate_count(units: DataFrame, rules: Sequence[Rule] = CANDIDATE_RULES, id_column: str = RECORD_ID) -> DataFrame:
    """Number of rows of `candidate_pairs`, without listing a pair: rows of one id make no pair, nor do rows without one."""
    named = units.filter(F.col(id_column).isNotNull())
    # Few rows share their id with another one, and only they can make such a pair.
    repeated = named.groupBy(id_column).agg(F.count("*").alias("_rows")).filter("_rows > 1")
    several = repeated.agg(F.sum("_rows")).first()[0]
    found = pair_count(named, rules)
    if not several:
        return found
    sharing = lookup(named, repeated, [id_column], "_rows", several)
    same_id = pair_count(sharing, [Rule.on(*rule.keys, id_column) for rule in rules]).withColumnRenamed("pairs", "same_id")
    return found.crossJoin(same_id).select((F.col("pairs") - F.col("same_id")).alias("pairs"))  # one row each


def all_possible_pairs(records: int) -> int:
    return records * (records - 1) // 2


def blocking_reduction(records: DataFrame, rules: Sequence[Rule] = CANDIDATE_RULES) -> DataFrame:
    """Candidates, all possible pairs and the share of them that blocking removes (0 when there are none)."""
    possible = records.agg(_pairs(F.count("*")).cast("bigint").alias("possible"))
    both = pair_count(records, rules).unionByName(possible, allowMissingColumns=True)
    totals = both.agg(F.max("pairs").alias("candidate_pairs"), F.max("possible").alias("possible_pairs"))
    removed = 1.0 - F.col("candidate_pairs") / F.col("possible_pairs")
    return totals.withColumn("reduction_ratio", F.when(F.col("possible_pairs") == 0, 0.0).otherwise(removed))
