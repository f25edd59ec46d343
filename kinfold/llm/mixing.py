"""Temperature mixing of sources.

A source's share of all tokens is raised to an exponent and normalised to its weight. The exponent is bisected until
the weights have a wanted entropy, or until no source repeats more often than a limit allows. A budget of tokens then
goes to the sources by weight. Each source fills its part with whole epochs and the head of one more, every epoch in an
order of its own given by hashes of the ids, and the streams of all sources are cut into the same number of blocks,
so that every block holds the weights.

Everything is DataFrame operations. Places in an epoch come from two sums: over buckets of the hash order, and inside
a bucket, so a source with most of the rows is spread over all buckets.

Defined cases: a null source is a source of its own; a null text has no tokens; a source without tokens is given once;
ties in the hash order go by id and length; repeated rows are rows of their own; an empty table gives no rows; columns
of ``docs`` named like the added ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.common import fresh_name, save, workspace

SEED = "mix"
BLOCK_TOKENS = 100_000
LEVELS = 5
HIGHEST = 16.0
ADDED = ("epoch", "n_tokens", "start", "block")


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _measure(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """Entropy of the weights, and the greatest over the least number of repeats, for each exponent."""
    columns = []
    for i, x in enumerate(exponents):
        weight = F.pow("share", F.lit(x))
        columns += [F.sum(weight).alias(f"z{i}"), F.sum(weight * F.log("share")).alias(f"s{i}"), F.max(weight / F.col("share")).alias(f"a{i}"), F.min(weight / F.col("share")).alias(f"b{i}")]
    row = shares.agg(*columns).first()
    return [(math.log(row[f"z{i}"]) - x * row[f"s{i}"] / row[f"z{i}"], row[f"a{i}"] / row[f"b{i}"]) for i, x in enumerate(exponents)]


def find_exponent(shares: DataFrame, target_entropy: float | None, max_repeats: float | None) -> float:
    """The least exponent whose weights are not above the entropy, or not above the spread of repeats.

    Each aggregation settles ``LEVELS`` steps of the bisection at once.
    """
    low, high = 0.0, 1.0 if max_repeats is not None else HIGHEST

    def fits(entropy: float, repeats: float) -> bool:
        return repeats <= max_repeats if max_repeats is not None else entropy <= target_entropy

    if fits(*_measure(shares, [low])[0]):
        return low
    while high - low > 1e-13:
        cells = 2**LEVELS
        points = [low + (high - low) * i / cells for i in range(1, cells)]
        good = [fits(*m) for m in _measure(shares, points)]
        first = good.index(True) if True in good else len(points)
        low, high = ([low, *points][first], [*points, high][first])
    return high


def mix(
    docs: DataFrame,
    tokens: Column,
    source: str = "source",
    id_column: str = "doc_id",
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` repeated or thinned to the weights, with ``epoch``, ``n_tokens``, ``start`` and ``block``.

    Give ``target_entropy`` (nats) or ``max_repeats``, which limits how much more often one source's documents repeat
    than another's. Without ``budget`` the least one is taken that gives every document at least once. ``start`` counts
    the tokens of the same source and epoch before the document.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give either target_entropy or max_repeats")
    scratch = workspace(docs.sparkSession, "mixing")
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    row = fresh_name(docs, "mix_row")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], tokens.cast("long").alias("n_tokens")).withColumn(row, F.monotonically_increasing_id())
    rows = save(scratch, rows, "rows")
    key = F.coalesce(F.concat(F.lit("s"), F.col(f"`{source}`").cast("string")), F.lit("n"))
    slim = rows.select(F.col(row).alias("row"), key.alias("key"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"), F.col("n_tokens").alias("n"))

    sums = save(scratch, slim.groupBy("key").agg(F.sum("n").alias("own"), F.count("*").alias("texts")), "sources")
    total = sums.agg(F.sum("own").alias("own"), F.sum("texts").alias("texts")).first()
    everything, count = total["own"] or 0, total["texts"] or 0
    shares = sums.filter("own > 0").withColumn("share", F.col("own") / F.lit(max(everything, 1)))
    if everything:
        exponent = find_exponent(shares, target_entropy, max_repeats)
        weight = F.pow("share", F.lit(exponent))
        at = shares.agg(F.sum(weight).alias("z"), F.max(F.col("own") / weight).alias("least")).first()
        scale = budget / at["z"] if budget is not None else at["least"]
        wanted = F.round(weight * F.lit(scale)).cast("long")
        spent = max(1, round(scale * at["z"]))
    else:
        wanted, spent = F.lit(0).cast("long"), 1
    blocks = max(1, math.ceil(spent / block_tokens))
    plan = shares.select("key", "own", wanted.alias("wanted")).unionByName(sums.filter("own = 0").select("key", "own", F.lit(0).cast("long").alias("wanted")))
    plan = plan.withColumn("whole", F.when(F.col("own") > 0, F.expr("wanted div own")).otherwise(1))
    plan = plan.withColumn("rest", F.col("wanted") - F.col("whole") * F.col("own"))

    buckets = 2 ** min(12, max(4, math.ceil(math.log2(max(count, 1) / 2000 + 1))))
    copies = slim.join(plan, "key").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("rest") > 0, F.col("whole")).otherwise(F.col("whole") - 1))))
    copies = copies.filter("epoch >= 0").withColumn("hash", F.md5(F.concat_ws("|", F.lit(seed), "id", F.col("epoch").cast("string")).cast("binary")))
    copies = copies.withColumn("bucket", F.conv(F.substring("hash", 1, 4), 16, 10).cast("long") * buckets / F.lit(65536)).withColumn("bucket", F.col("bucket").cast("long"))
    part = ["key", "epoch", "bucket"]
    filled = copies.groupBy(*part).agg(F.sum("n").alias("sum"))
    before = Window.partitionBy("key", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = filled.select(*part, F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*part).orderBy("hash", "id", "n", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = copies.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(offsets, part)
    placed = placed.withColumn("start", F.col("offset") + F.col("within")).filter("epoch < whole or start < rest")
    block = F.when(F.col("wanted") > 0, F.expr(f"least({blocks - 1}L, cast(((epoch * own + start) * cast({blocks} as decimal(38, 0))) div wanted as bigint))")).otherwise(0)
    chosen = placed.select(F.col("row").alias(row), F.col("epoch").cast("int").alias("epoch"), "start", block.cast("long").alias("block"))
    return rows.join(chosen, row).select(*[F.col(f"`{c}`") for c in kept], "epoch", "n_tokens", "start", "block")
