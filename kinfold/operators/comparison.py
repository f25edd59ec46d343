"""Comparison levels: how well one field of a pair agrees.

A comparison grades two values into levels, 0 for "different" up to ``top`` for "equal"; -1 means that a
side is missing, which says nothing either way. It is written as SQL text over the columns ``<name>_l`` and
``<name>_r`` of a pair:

* ``helpers``: columns computed once per record, before records are paired;
* ``plain_level``: the level of two present values as far as equality and edit distance tell;
* ``questions``: text columns whose Jaro-Winkler similarity can still raise that level, each with the
  condition under which it can;
* ``tiers``: the levels that such similarities give, best first;
* ``may_agree``: a cheap bound, false only where the level is 0 for certain;
* ``exact``: the levels that equal values give, best first, each with that value; an equal value of one level
  means an equal value, or none, of the next.

Levels are found in two steps, so that pairs which raise the same questions can be merged in between:
`ask` works inside the JVM and `answer` calls Python for the questions that are left.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from kinfold.functions.similarity import bound_helpers, jaro_winkler_from, may_reach, open_bounds


Tier = tuple[str, float, int]  # text column, least similarity, level


def _cases(conditions: Sequence[tuple[str, int]], otherwise: str = "0") -> str:
    return "case " + " ".join(f"when {test} then {level}" for test, level in conditions) + f" else {otherwise} end"


@dataclass(frozen=True)
class ExactOnly:
    column: str
    top: int = 1

    @property
    def exact(self) -> tuple[tuple[int, str], ...]:
        return ((self.top, self.column),)

    def helpers(self) -> dict[str, str]:
        return {}

    def questions(self) -> dict[str, str]:
        return {}

    def tiers(self) -> list[Tier]:
        return []

    def plain_level(self) -> str:
        return _cases([(self.may_agree(), self.top)])

    def may_agree(self) -> str:
        return f"{self.column}_l = {self.column}_r"


@dataclass(frozen=True)
class EditTiers:
    """Equal, then at most 1, 2, ... single-character edits."""

    column: str
    distances: tuple[int, ...] = (1, 2)

    @property
    def top(self) -> int:
        return len(self.distances) + 1

    @property
    def exact(self) -> tuple[tuple[int, str], ...]:
        return ((self.top, self.column),)

    def helpers(self) -> dict[str, str]:
        return {}

    def questions(self) -> dict[str, str]:
        return {}

    def tiers(self) -> list[Tier]:
        return []

    @property
    def _edits(self) -> str:
        """Edit distance, -1 beyond the largest one that counts."""
        return f"levenshtein({self.column}_l, {self.column}_r, {max(self.distances)})"

    def plain_level(self) -> str:
        near = [(f"{self._edits} between 0 and {d}", self.top - 1 - i) for i, d in enumerate(self.distances)]
        return _cases([(f"{self.column}_l = {self.column}_r", self.top), *near])

    def may_agree(self) -> str:
        return f"{self._edits} >= 0"


@dataclass(frozen=True)
class NameTiers:
    """Equal, then falling Jaro-Winkler thresholds."""

    column: str
    thresholds: tuple[float, ...] = (0.92, 0.88, 0.70)

    @property
    def top(self) -> int:
        return len(self.thresholds) + 1

    @property
    def _similar(self) -> str:
        return may_reach(self.column, min(self.thresholds))

    @property
    def exact(self) -> tuple[tuple[int, str], ...]:
        return ((self.top, self.column),)

    def helpers(self) -> dict[str, str]:
        return bound_helpers(self.column, self.column)

    def questions(self) -> dict[str, str]:
        return {self.column: f"{self.column}_l != {self.column}_r and {self._similar}"}

    def tiers(self) -> list[Tier]:
        return [(self.column, t, self.top - 1 - i) for i, t in enumerate(self.thresholds)]

    def plain_level(self) -> str:
        return _cases([(f"{self.column}_l = {self.column}_r", self.top)])

    def may_agree(self) -> str:
        return f"({self.column}_l = {self.column}_r or {self._similar})"


@dataclass(frozen=True)
class EmailTiers:
    """Equal, equal local part, similar address, similar local part."""

    column: str
    threshold: float = 0.88
    top: int = 4

    @property
    def _local(self) -> str:
        return f"_local_{self.column}"

    def _similar(self, text: str) -> str:
        return may_reach(text, self.threshold)

    @property
    def _local_text(self) -> str:
        return f"nullif(regexp_extract({self.column}, '^[^@]+', 0), '')"

    @property
    def exact(self) -> tuple[tuple[int, str], ...]:
        return ((4, self.column), (3, self._local_text))

    def helpers(self) -> dict[str, str]:
        local = self._local_text
        sizes = bound_helpers(self.column, self.column) | bound_helpers(self._local, local)
        return {self._local: local, **sizes}

    def questions(self) -> dict[str, str]:
        whole, local = self.column, self._local
        differ = f"{whole}_l != {whole}_r and coalesce({local}_l != {local}_r, true)"
        return {whole: f"{differ} and {self._similar(whole)}", local: f"{differ} and {self._similar(local)}"}

    def tiers(self) -> list[Tier]:
        return [(self.column, self.threshold, 2), (self._local, self.threshold, 1)]

    def plain_level(self) -> str:
        whole, local = self.column, self._local
        return _cases([(f"{whole}_l = {whole}_r", 4), (f"{local}_l = {local}_r", 3)])

    def may_agree(self) -> str:
        whole, local = self.column, self._local
        parts = [f"{whole}_l = {whole}_r", f"{local}_l = {local}_r", self._similar(whole), self._similar(local)]
        return f"coalesce({' or '.join(parts)}, false)"


Comparison = ExactOnly | EditTiers | NameTiers | EmailTiers

COMPARISONS: tuple[Comparison, ...] = (
    NameTiers("first_name"),
    NameTiers("last_name"),
    EmailTiers("email"),
    EditTiers("postcode"),
    ExactOnly("city"),
)


def gamma(comparison: Comparison) -> str:
    return f"gamma_{comparison.column}"


def with_helpers(units: DataFrame, comparisons: Sequence[Comparison] = COMPARISONS) -> DataFrame:
    helpers = [f"{sql} as {name}" for c in comparisons for name, sql in c.helpers().items()]
    return units.selectExpr("*", *helpers)


def carried_columns(comparisons: Sequence[Comparison] = COMPARISONS) -> list[str]:
    """Columns that must accompany both sides of a pair."""
    return [name for c in comparisons for name in (c.column, *c.helpers())]


def with_open_helpers(pairs: DataFrame, comparisons: Sequence[Comparison] = COMPARISONS) -> DataFrame:
    """Pairs of bare columns with the helpers of both sides, whose bounds rule nothing out: for pairs that were graded before."""
    added = {}
    for c in comparisons:
        texts = {text for text, _, _ in c.tiers()}
        bounds = {name: sql for text in texts for name, sql in open_bounds(text).items()}
        for s in "lr":
            own = replace(c, column=f"{c.column}_{s}").helpers().values()
            added |= {f"{name}_{s}": bounds.get(name, sql) for name, sql in zip(c.helpers(), own, strict=True)}
    return pairs.selectExpr("*", *[f"{sql} as {name}" for name, sql in added.items()])


def ask(pairs: DataFrame, comparisons: Sequence[Comparison] = COMPARISONS) -> DataFrame:
    """Replace the carried columns by plain levels and, where a similarity can raise one, its two texts."""
    carried = {f"{name}_{s}" for name in carried_columns(comparisons) for s in "lr"}
    kept = [c for c in pairs.columns if c not in carried]
    levels, texts = [], []
    for c in comparisons:
        missing = f"{c.column}_l is null or {c.column}_r is null"
        levels.append(f"if({missing}, -1, {c.plain_level()}) as {gamma(c)}")
        for text, test in c.questions().items():
            texts += [f"if({test}, {text}_{s}, null) as _ask_{text}_{s}" for s in "lr"]
    return pairs.selectExpr(*kept, *levels, *texts)


def answer(asked: DataFrame, comparisons: Sequence[Comparison] = COMPARISONS) -> DataFrame:
    """Final ``gamma_<column>`` levels of pairs from `ask`."""
    least = {text: min(t for x, t, _ in c.tiers() if x == text) for c in comparisons for text in c.questions()}
    kept = [c for c in asked.columns if not c.startswith(("_ask_", "gamma_"))]
    scored = asked.withColumns({f"_sim_{t}": jaro_winkler_from(x)(f"_ask_{t}_l", f"_ask_{t}_r") for t, x in least.items()})
    levels = []
    for c in comparisons:
        raised = [(f"_sim_{text} >= {least}D", level) for text, least, level in c.tiers()]
        levels.append(f"{_cases(raised, gamma(c)) if raised else gamma(c)} as {gamma(c)}")
    return scored.selectExpr(*kept, *levels)


def compare_pairs(pairs: DataFrame, comparisons: Sequence[Comparison] = COMPARISONS) -> DataFrame:
    """Add a ``gamma_<column>`` level per comparison and drop the carried columns."""
    return answer(ask(pairs, comparisons), comparisons)
