"""Quality rules: a decision list learned by sequential covering, emitted as ordered Spark conditions.

Each text gets whole-number counts (``statistics.COUNTS``) and ratios of them. From a bounded sample of labelled texts
the learner grows a conjunction of thresholds by information gain until it covers no text of good quality, prunes it
on rows set aside, keeps it if it is right often enough there, removes what it covers and starts again. The list
rejects a text that meets any rule; the default keeps it. Fixed base rules come first.

Defined cases: a text without words has zero counts and fails the base; label rows that are null are ignored, and a
document with several counts as low quality if any says so; without labels of both kinds the list is empty; repeated
rows are judged each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import map_batches, save, workspace
from kinfold.llm.statistics import COUNTS, DDL, counts

#: Learned features: a count over another.
RATIOS = {
    "symbol_ratio": ("n_symbols", "word_chars"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "upper_ratio": ("n_upper", "word_chars"),
    "digit_ratio": ("n_digits", "word_chars"),
    "mark_ratio": ("n_marks", "word_chars"),
    "distinct_ratio": ("n_distinct_words", "n_words"),
    "stop_ratio": ("n_stops", "n_words"),
    "line_length": ("n_words", "n_lines"),
}
SAMPLE = 20_000
THRESHOLDS = 64
PRECISION = 0.8
LEAST_COVER = 3


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    limit: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.limit if self.above else x[self.feature] <= self.limit

    def column(self) -> Column:
        value = ratio(self.feature)
        return value >= F.lit(self.limit) if self.above else value <= F.lit(self.limit)


Rule = tuple[Test, ...]


def ratio(name: str) -> Column:
    part, whole = RATIOS[name]
    return F.col(part).cast("double") / F.greatest(F.col(whole), F.lit(1)).cast("double")


def features(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: x[a].astype(float) / np.maximum(x[b], 1).astype(float) for k, (a, b) in RATIOS.items()}


def covers(rule: Rule, x: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    for test in rule:
        rows = rows & test.holds(x)
    return rows


def _candidates(x: dict[str, np.ndarray], rows: np.ndarray):
    for name, values in x.items():
        seen = np.unique(values[rows])
        middles = (seen[1:] + seen[:-1]) / 2
        if len(middles) > THRESHOLDS:
            middles = middles[np.unique(np.linspace(0, len(middles) - 1, THRESHOLDS).astype(int))]
        for limit in middles:
            yield Test(name, True, float(limit))
            yield Test(name, False, float(limit))


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, longest: int = 5) -> Rule:
    rule: Rule = ()
    while len(rule) < longest:
        p, n = int((rows & bad).sum()), int((rows & ~bad).sum())
        if not p or not n:
            break
        now, best, most = np.log2(p / (p + n)), None, 1e-9
        for test in _candidates(x, rows):
            kept = rows & test.holds(x)
            p1 = int((kept & bad).sum())
            if p1:
                gain = p1 * (np.log2(p1 / int(kept.sum())) - now)
                if gain > most:
                    best, most = test, gain
        if best is None:
            break
        rule, rows = (*rule, best), rows & best.holds(x)
    return rule


def _worth(rule: Rule, x, bad, rows) -> float:
    hit = covers(rule, x, rows)
    p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, aside: np.ndarray) -> list[Rule]:
    """Rules for ``bad`` rows; ``aside`` marks the rows that only prune and test."""
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while (left & bad & ~aside).any() and len(rules) < 32:
        rule = _grow(x, bad, left & ~aside)
        if not rule:
            break
        cut = max(range(1, len(rule) + 1), key=lambda k: (_worth(rule[:k], x, bad, left & aside), -k))
        rule = rule[:cut]
        hit = covers(rule, x, left)
        test = hit & aside if (hit & aside).sum() >= LEAST_COVER else hit
        if hit.sum() < LEAST_COVER or (test & bad).sum() < PRECISION * test.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional expression: the first rule that holds rejects."""
    column = None
    for rule in rules:
        all_hold = F.lit(True)
        for test in rule:
            all_hold = all_hold & test.column()
        column = F.when(all_hold, False) if column is None else column.when(all_hold, False)
    return F.lit(True) if column is None else column.otherwise(True)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _describe(batch: pa.RecordBatch) -> dict:
    return {"doc_id": batch.column("doc_id")} | counts(batch.column("text"))


def quality_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, list[Rule]]:
    """Counts, ``base_failed`` and ``kept`` of every row of ``docs``, and the learned list.

    The list is fitted on the ``sample`` labelled texts with the least hash of their id.
    """
    scratch = workspace(docs.sparkSession, "rules")
    read = docs.select("doc_id", "text")
    kind = read.schema["doc_id"].dataType.simpleString()
    described = save(scratch, map_batches(read, _describe, f"doc_id {kind}, {DDL}"), "counts")
    marks = labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").alias("labelled")).agg(F.min("quality").alias("quality"))
    known = described.filter(~base_failed()).join(marks, F.col("doc_id") == F.col("labelled"))
    rows = known.orderBy(F.xxhash64("doc_id"), *COUNTS).limit(sample).select("quality", *COUNTS).toArrow()
    x = features({c: rows[c].to_numpy() for c in COUNTS})
    rules = learn_rules(x, rows["quality"].to_numpy() == 0, np.arange(len(rows)) % 3 == 2)
    judged = described.withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & verdict(rules)), rules
