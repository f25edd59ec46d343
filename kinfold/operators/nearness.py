"""Values that are near each other: all pairs of different texts with an agreement, found by keys they must share.

* Within some edits: what is left of a text without as many characters. Two texts within d edits share such a rest.
* Similar names: the first characters, or a bag of as many characters as similar texts have in common at least.

Keys are made for distinct values and no pair is missed; texts that are too long for keys are compared in tiles.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.similarity import BOOST_ABOVE, PREFIX_LENGTH, PREFIX_WEIGHT, jaro_winkler_from
from kinfold.operators.blocking import join_tasks, tile
from kinfold.operators.comparison import Comparison, EditTiers, NameTiers
from kinfold.scratch import Scratch

# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MISSING = -1
#: Similar texts up to this length are found by the characters they share; longer ones are compared in tiles.
BAG_LENGTH = 12
#: Similar texts that share as many first characters are found by these, others by bags.
PREFIX_KEY = 3
#: Values within some edits are found by leaving out as many characters, up to this length.
EDIT_LENGTH = 40
#: Least similarity for which bags tell values apart.
LEAST_SIMILARITY = 0.85
_SLACK = 1e-9
_LONG_CHUNK = 256


@dataclass(frozen=True)
class Agreement:
    """A comparison whose status is one of ``statuses``."""

    comparison: Comparison
    statuses: frozenset[int]

    @property
    def levels(self) -> frozenset[int]:
        return self.statuses - {MISSING}


def exact_levels(comparison: Comparison) -> list[frozenset[int]]:
    """The sets of levels that equal values alone give."""
    levels = [level for level, _ in comparison.exact]
    return [frozenset(levels[: i + 1]) for i in range(len(levels)) if levels[: i + 1] == list(range(comparison.top, comparison.top - i - 1, -1))]


def _from_some_level(agreement: Agreement) -> bool:
    """Whether the levels are all from one below the top on."""
    top = agreement.comparison.top
    least = min(agreement.levels, default=top)
    return least < top and agreement.levels == frozenset(range(least, top + 1))


def _similarity(agreement: Agreement) -> float | None:
    """Least similarity of a name agreement."""
    c = agreement.comparison
    if isinstance(c, NameTiers) and _from_some_level(agreement):
        return c.thresholds[c.top - 1 - min(agreement.levels)]
    return None


def _edits(agreement: Agreement) -> int | None:
    c = agreement.comparison
    if isinstance(c, EditTiers) and _from_some_level(agreement):
        return c.distances[c.top - 1 - min(agreement.levels)]
    return None


def has_keys(agreement: Agreement) -> bool:
    if agreement.levels in exact_levels(agreement.comparison):
        return True
    similarity = _similarity(agreement)
    return _edits(agreement) is not None or (similarity is not None and similarity >= LEAST_SIMILARITY)


def equal_key(agreement: Agreement) -> str:
    """SQL of the value that records of such an agreement share, where equal values alone give it."""
    keys = [key for level, key in agreement.comparison.exact if level in agreement.levels]
    return f"coalesce({', '.join(keys[::-1])})"


def least_shared(a: int, b: int, similarity: float) -> int:
    """Characters that texts of ``a`` and ``b`` characters share if they are similar and differ in their first three.

    A Jaro similarity j has at least (3 j - 1) a b / (a + b) matches, and matched characters are shared ones. With a common
    prefix of at most two characters, ``similarity`` needs a Jaro similarity of what the boost leaves.
    """
    prefix = PREFIX_WEIGHT * min(PREFIX_KEY - 1, PREFIX_LENGTH)
    jaro = min(similarity, max(BOOST_ABOVE, (similarity - prefix) / (1 - prefix)))
    return math.ceil((3 * jaro - 1) * a * b / (a + b) - _SLACK)


def partners(length: int, similarity: float) -> list[tuple[int, int, int]]:
    """Lengths of similar texts (shorter, longer) for a text of ``length``, and the number of shared characters."""
    found = []
    for other in range(1, BAG_LENGTH + 1):
        shared = max(1, least_shared(length, other, similarity))
        if shared <= min(length, other):
            found.append((min(length, other), max(length, other), shared))
    return found


def similar_keys(text: str, of_length: list[list[tuple[int, int, int]]]) -> list[str]:
    """Keys of a text of at most ``BAG_LENGTH`` characters, given the `partners` of each length; similar texts share one."""
    keys = {f"p{text[:PREFIX_KEY]}"} if len(text) >= PREFIX_KEY else set()
    ordered = sorted(text)
    for short, long, shared in of_length[len(text)]:
        keys.update(f"{short},{long},{''.join(bag)}" for bag in combinations(ordered, shared))
    return sorted(keys)


def _similar_key_column(similarity: float):
    of_length = [[], *[partners(n, similarity) for n in range(1, BAG_LENGTH + 1)]]

    @F.pandas_udf("array<string>")
    def keys(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: similar_keys(t, of_length))

    return keys


def deletions(text: str, edits: int) -> str:
    """SQL of the distinct texts that are left without at most ``edits`` characters.

    Two texts within ``edits`` edits share one of them: what is left of both without the characters that are changed.
    """
    without_one = "transform(sequence(1, length(x)), i -> concat(substr(x, 1, i - 1), substr(x, i + 1)))"
    rounds = [f"array({text})"]
    for _ in range(edits):
        some = f"filter({rounds[-1]}, x -> x != '')"  # sequence(1, 0) would count down
        rounds.append(f"array_distinct(flatten(transform({some}, x -> {without_one})))")
    return f"array_distinct(concat({', '.join(rounds)}))"


def _pairs_by_key(values: DataFrame, keys: Column, carry: Sequence[str], scratch: Scratch) -> DataFrame:
    """Pairs that share a key, once for each one."""
    keyed = scratch.materialise(values.select("value", *carry, F.explode(keys).alias("key")), f"keys-{uuid.uuid4().hex}")
    n = F.col("n").cast("double")
    work = keyed.groupBy("key").agg(F.count("*").alias("n")).agg(F.sum(n * (n - 1) / 2), F.sum(n)).first()
    tasks = join_tasks(values.sparkSession, pairs=work[0] or 0, rows=work[1] or 0)  # few bytes, many pairs
    other = keyed.select(F.col("value").alias("other"), *[F.col(c).alias(f"other_{c}") for c in carry], "key")
    both = keyed.repartition(tasks, "key").join(other.repartition(tasks, "key").hint("merge"), "key")
    return both.filter("value < other").drop("key")


def _pairs_of_long(values: DataFrame, long: str, carry: Sequence[str]) -> DataFrame:
    """Pairs with a long value, in tiles."""
    chunks = max(1, math.ceil(values.count() / _LONG_CHUNK))
    tasks = join_tasks(values.sparkSession, pairs=float(chunks * _LONG_CHUNK) ** 2, rows=chunks * chunks * _LONG_CHUNK)

    def side(rows: DataFrame, prefix: str, left: bool) -> DataFrame:
        copies, number = tile(F.lit(chunks), "value", left)
        rows = rows.select("value", *carry, copies).withColumn("tile", number)
        return rows.select("tile", F.struct("value", *carry).alias(prefix)).repartition(tasks, "tile")

    both = side(values.filter(long), "a", True).join(side(values, "b", False).hint("merge"), "tile").filter("a.value != b.value")
    first, second = F.least("a", "b"), F.greatest("a", "b")  # by value, the first field
    return both.select(first["value"].alias("value"), *[first[c].alias(c) for c in carry], second["value"].alias("other"), *[second[c].alias(f"other_{c}") for c in carry])


def near_values(values: DataFrame, agreement: Agreement, scratch: Scratch, carry: Sequence[str] = ()) -> DataFrame:
    """Pairs ``value < other`` of different texts among the distinct ``value``s that have the agreement, all of them.

    ``carry`` columns come as ``<name>`` and ``other_<name>``.
    """
    edits, similarity = _edits(agreement), _similarity(agreement)
    size = EDIT_LENGTH if edits is not None else BAG_LENGTH
    # An empty text, which no field has, would be similar to nothing.
    values = values.filter("value != ''").select("value", *carry)
    short = values.filter(f"length(value) <= {size}")
    keys = F.expr(deletions("value", edits)) if edits is not None else _similar_key_column(similarity)("value")
    pairs = _pairs_by_key(short, keys, carry, scratch)
    long = f"length(value) > {size}"
    if not values.filter(long).isEmpty():
        pairs = pairs.unionByName(_pairs_of_long(values, long, carry))
    # Pairs come up once for each key they share: edits cost less than telling repeated pairs apart, similarities more.
    if edits is not None:
        return pairs.filter(f"levenshtein(value, other, {edits}) >= 0").distinct()
    return pairs.distinct().withColumn("_similarity", jaro_winkler_from(similarity)("value", "other")).filter(F.col("_similarity") >= F.lit(similarity)).drop("_similarity")
