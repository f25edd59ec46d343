"""Queries over the driver tables, and the same results as DuckDB SQL where SQL can express them."""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import replace
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import fixtures  # noqa: E402
from kinfold.config import Settings  # noqa: E402
from kinfold.functions.text import blank_to_null, clean_records, linkage_view, normalise_email  # noqa: E402
from kinfold.operators.agreement import hopeful_pairs  # noqa: E402
from kinfold.operators.batches import high_water_mark, record_batches, select_new_records  # noqa: E402
from kinfold.operators.blocking import (  # noqa: E402
    CANDIDATE_RULES,
    DETERMINISTIC_RULES,
    TRAINING_RULES,
    block_pairs,
    blocking_reduction,
    candidate_count,
    candidate_pairs,
    pair_count,
    rule_counts,
)
from kinfold.operators.comparison import (  # noqa: E402
    COMPARISONS,
    carried_columns,
    compare_pairs,
    gamma,
    with_helpers,
)
from kinfold.operators.components import assign_clusters, connected_components  # noqa: E402
from kinfold.operators.evaluate import group_pairs, linkage_quality, partition_check  # noqa: E402
from kinfold.operators.model import (  # noqa: E402
    Level,
    Model,
    pairs_above_threshold,
    prior_probability,
    random_pair_levels,
    score_pairs,
    training_pattern_counts,
    u_probabilities,
)
from kinfold.operators.skew import lookup  # noqa: E402
from kinfold.operators.survivorship import (  # noqa: E402
    attach_clusters,
    build_golden_records,
    cluster_members,
    run_metrics,
    to_golden_contract,
)
from kinfold.plans.resolve import distinct_profiles, resolve_records, train_model  # noqa: E402
from kinfold.plans.run import open_table, run  # noqa: E402
from kinfold.schema import FIELDS, RECORD_COLUMNS, RECORD_ID  # noqa: E402
from kinfold.scratch import Scratch  # noqa: E402
from kinfold.sources.files import as_text, duplicate_ids, to_records  # noqa: E402
from kinfold.sources.generator import generation_counts  # noqa: E402

try:  # training-data operators, where they are installed
    import corpus_pipeline  # noqa: E402
    from kinfold.llm import queries as llm  # noqa: E402
except ModuleNotFoundError as missing:
    if (missing.name or "").split(".")[0] != "corpus_pipeline" and not (missing.name or "").startswith("kinfold.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
MARK = "r00003000"
THRESHOLD = 0.9
BATCH_ROWS = 2_500
SAMPLED_RECORDS = 4_472  # the most records with at most 10,000,000 pairs

# Match and non-match rates per level, lowest level first, for queries that need no training.
FIXED_RATES = {
    "first_name": ((0.02, 0.97), (0.03, 0.02), (0.05, 0.005), (0.30, 0.003), (0.60, 0.002)),
    "last_name": ((0.02, 0.97), (0.03, 0.02), (0.05, 0.005), (0.30, 0.003), (0.60, 0.002)),
    "email": ((0.02, 0.99), (0.03, 0.004), (0.10, 0.003), (0.05, 0.002), (0.80, 0.001)),
    "postcode": ((0.10, 0.95), (0.05, 0.04), (0.15, 0.008), (0.70, 0.002)),
    "city": ((0.15, 0.93), (0.85, 0.07)),
}
FIXED_MODEL = Model(
    0.0005,
    tuple(Level(c, i, m, u, True) for c, rates in FIXED_RATES.items() for i, (m, u) in enumerate(rates)),
)
GAMMAS = [gamma(c) for c in COMPARISONS]


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage_view(fixtures.persons(spark, sf_dir).select(*RECORD_COLUMNS))


def _padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons with spaces around some values and some values blank."""
    pad = "case when substr(record_id, 9, 1) in ('1', '5') then concat('  ', {c}, ' ') else {c} end as {c}"
    blank = "case when substr(record_id, 9, 1) = '4' then '   ' else city end as city"
    persons = fixtures.persons(spark, sf_dir)
    return persons.selectExpr("record_id", *[pad.format(c=c) for c in FIELDS if c != "city"], blank)


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = with_helpers(_view(spark, sf_dir))
    return compare_pairs(candidate_pairs(units, carry=carried_columns()))


def _levels(*columns: str) -> Query:
    """Levels of some comparisons over the candidate pairs."""
    chosen = [c for c in COMPARISONS if c.column in columns]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        units = with_helpers(_view(spark, sf_dir), chosen)
        pairs = candidate_pairs(units, carry=carried_columns(chosen)).drop("match_key")
        return compare_pairs(pairs, chosen)

    return query


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_pairs(_vectors(spark, sf_dir), FIXED_MODEL)


def _matches(view: DataFrame, scratch: Scratch) -> DataFrame:
    """Candidate pairs that reach the threshold; pairs that no level can lift to it are dropped as they are found."""
    hopeful = hopeful_pairs(with_helpers(view), FIXED_MODEL, THRESHOLD, CANDIDATE_RULES, COMPARISONS, scratch)
    return pairs_above_threshold(score_pairs(compare_pairs(hopeful), FIXED_MODEL), THRESHOLD)


def _rounded_scores(scored: DataFrame) -> DataFrame:
    ids = [f"{RECORD_ID}_l", f"{RECORD_ID}_r"]
    return scored.select(*ids, *[F.round(c, 9).alias(c) for c in ("match_weight", "match_probability")])


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters over the two strictest candidate rules, without a model."""
    view = _view(spark, sf_dir)
    scratch = Scratch(spark, "linked")
    edges = candidate_pairs(view, CANDIDATE_RULES[:2])
    components = connected_components(edges, f"{RECORD_ID}_l", f"{RECORD_ID}_r", scratch)
    return scratch.materialise(assign_clusters(view, components, RECORD_ID), "clusters")


def _golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fixtures.persons(spark, sf_dir).select(*RECORD_COLUMNS)
    return build_golden_records(records, _linked(spark, sf_dir))


def _attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the clusters of matched records only; the others stand alone."""
    clusters = _linked(spark, sf_dir)
    several = clusters.groupBy("cluster_id").count().filter("count > 1").select("cluster_id")
    matched = clusters.join(several, "cluster_id", "left_semi")
    records = fixtures.persons(spark, sf_dir).select(*RECORD_COLUMNS)
    return attach_clusters(records, matched)


def _above(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "matches")
    return _rounded_scores(_matches(scratch.materialise(_view(spark, sf_dir), "view"), scratch))


def _pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates from the sizes of their blocks, and those of them that match."""
    scratch = Scratch(spark, "counts")
    view = scratch.materialise(_view(spark, sf_dir), "view")
    candidates = candidate_count(view).withColumnRenamed("pairs", "candidate_pairs")
    above = _matches(view, scratch).agg(F.count("*").alias("pairs_above_threshold"))
    return candidates.crossJoin(above)  # one row each


def _training_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_pattern_counts(distinct_profiles(_view(spark, sf_dir)))


def _u(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = u_probabilities(random_pair_levels(_view(spark, sf_dir)))
    return shares.select("comparison", "level", F.round("u", 9).alias("u"))


def _model(spark: SparkSession, sf_dir: str) -> Model:
    scratch = Scratch(spark, "trained")
    view = scratch.materialise(_view(spark, sf_dir), "view")
    profiles = scratch.materialise(distinct_profiles(view), "profiles")
    return train_model(view, profiles)


def _trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _model(spark, sf_dir).to_frame(spark)
    return found.withColumns({c: F.round(c, 6) for c in ("m", "u")})


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _model(spark, sf_dir).training_frame(spark)
    return found.withColumns({c: F.round(c, n) for c, n in (("change", 9), ("match_rate", 6), ("log_likelihood", 3))})


def _prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prior_probability(_view(spark, sf_dir))
    return found.select("deterministic_pairs", F.round("prior", 12).alias("prior"))


def _reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = blocking_reduction(_view(spark, sf_dir))
    return found.withColumn("reduction_ratio", F.round("reduction_ratio", 9))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linkage_quality(_linked(spark, sf_dir), fixtures.persons(spark, sf_dir))
    return found.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


def _partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition_check(fixtures.persons(spark, sf_dir), cluster_members(_golden(spark, sf_dir)))


def _resolved(spark: SparkSession, sf_dir: str, model: Model | None = FIXED_MODEL) -> DataFrame:
    return resolve_records(fixtures.persons(spark, sf_dir), model=model).clusters


def _resolved_golden(spark: SparkSession, sf_dir: str, model: Model | None = FIXED_MODEL) -> DataFrame:
    records = fixtures.persons(spark, sf_dir).select(*RECORD_COLUMNS)
    return build_golden_records(records, resolve_records(records, model=model).clusters, check_unique=False)


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published run up to the mark and one over all records, which takes and appends those after the mark."""
    scratch = Scratch(spark, "incremental")
    records = fixtures.persons(spark, sf_dir).select(*RECORD_COLUMNS)
    everything = scratch.materialise(records, "all.parquet")
    scratch.materialise(everything.filter(F.col(RECORD_ID) <= MARK), "first.parquet")
    settings = Settings(input_path=f"{scratch.path}/first.parquet", warehouse=f"{scratch.path}/warehouse")
    run(spark, settings, model=FIXED_MODEL)
    run(spark, replace(settings, input_path=f"{scratch.path}/all.parquet"), incremental=True, model=FIXED_MODEL)
    return open_table(spark, settings).read()


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _events(spark, sf_dir).select(F.lpad(F.col("event_id").cast("string"), 10, "0").alias(RECORD_ID))
    batches = record_batches(keyed, BATCH_ROWS)
    return batches.groupBy("batch_no").agg(
        F.count("*").alias("records"), F.min(RECORD_ID).alias("first_id"), F.max(RECORD_ID).alias("last_id")
    )


def _duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_ids(_events(spark, sf_dir).select(F.col("user_id").cast("string").alias(RECORD_ID)))


def _document_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with equal text, linked to the first of them instead of pairwise."""
    documents = as_text(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id", "text"])
    # A digest stands for the text, so no whole text is shuffled or collected.
    documents = documents.select(F.lpad("doc_id", 12, "0").alias("doc_id"), F.sha2("text", 256).alias("digest"))
    firsts = documents.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    linked = lookup(documents, firsts, ["digest"], "copies", documents.count())
    components = connected_components(linked, "doc_id", "first_id", Scratch(spark, "documents"))
    return assign_clusters(documents, components, "doc_id")


def _text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return as_text(customer, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


def entry(spark: SparkSession, sf_dir: str = SMOKE_DIR) -> DataFrame:
    """Which customer rows are the same person, and what is the best record of each?"""
    return _resolved_golden(spark, sf_dir, None)


def queries() -> dict[str, Query]:
    persons = fixtures.persons
    rules = dict(zip(("email", "surname_postcode", "given_city", "name_prefix", "postcode"), CANDIDATE_RULES, strict=True))
    found: dict[str, Query] = {
        "scan_parquet_text": _text_scan,
        "duplicate_record_ids": _duplicates,
        "record_batches": _batches,
        "clean_records": lambda s, d: clean_records(_padded(s, d)),
        "read_contract": lambda s, d: to_records(_padded(s, d).withColumn("extra", F.lit(1))),
        "normalise_email": lambda s, d: _padded(s, d).select(RECORD_ID, normalise_email("email").alias("email")),
        "blank_to_null": lambda s, d: _padded(s, d).select(RECORD_ID, *[blank_to_null(c).alias(c) for c in FIELDS]),
        "select_new_records": lambda s, d: select_new_records(persons(s, d), MARK),
        "high_water_mark": lambda s, d: high_water_mark(persons(s, d)),
        "candidate_pairs": lambda s, d: candidate_pairs(_view(s, d)),
        "pairs_per_rule": lambda s, d: rule_counts(_view(s, d)),
        "deterministic_pairs": lambda s, d: pair_count(_view(s, d), DETERMINISTIC_RULES),
        "blocking_reduction": _reduction,
        "compare_names": _levels("first_name", "last_name"),
        "compare_email": _levels("email"),
        "compare_postcode": _levels("postcode"),
        "compare_city": _levels("city"),
        "comparison_vectors": _vectors,
        "score_fixed_params": lambda s, d: _rounded_scores(_scored(s, d)),
        "pairs_above_threshold": _above,
        "pair_counts": _pair_counts,
        "prior_probability": _prior,
        "u_probabilities": _u,
        "training_pattern_counts": _training_patterns,
        "em_m_probabilities": _trained,
        "em_convergence": _training,
        "connected_components": _linked,
        "document_copies": _document_copies,
        "attach_clusters": _attached,
        "golden_records": _golden,
        "golden_contract": lambda s, d: to_golden_contract(_golden(s, d)),
        "run_metrics": lambda s, d: run_metrics(_golden(s, d)),
        "partition_check": _partition,
        "truth_pairs": lambda s, d: group_pairs(persons(s, d), "truth"),
        "linkage_quality": _quality,
        "resolve_records": _resolved,
        "resolved_golden": _resolved_golden,
        "resolve_trained": lambda s, d: _resolved(s, d, None),
        "resolved_golden_trained": lambda s, d: _resolved_golden(s, d, None),
        "incremental_golden": _incremental,
        "generation_summary": lambda s, d: generation_counts(persons(s, d)),
    }
    for name, rule in rules.items():
        found[f"block_{name}"] = lambda s, d, rule=rule: block_pairs(_view(s, d), rule)
    if llm is not None:
        found |= {**llm.QUERIES, "pipeline": corpus_pipeline.run}
    return found


# --- the same results in DuckDB ---------------------------------------------------------------------

_VIEW = """view_ as (select record_id, nullif(trim(first_name), '') as first_name, nullif(trim(last_name), '') as last_name,
  nullif(lower(trim(email)), '') as email, nullif(trim(postcode), '') as postcode, nullif(trim(city), '') as city
  from persons)"""
_RULE_SQL = (
    "l.email = r.email",
    "l.last_name = r.last_name and l.postcode = r.postcode",
    "l.first_name = r.first_name and l.city = r.city",
    "substr(l.first_name, 1, 2) = substr(r.first_name, 1, 2) and substr(l.last_name, 1, 2) = substr(r.last_name, 1, 2)",
    "l.postcode = r.postcode",
)
_DETERMINISTIC_SQL = ("l.email = r.email", "l.first_name = r.first_name and l.last_name = r.last_name and l.postcode = r.postcode")
_TRAINING_SQL = (_RULE_SQL[0], _RULE_SQL[1], "l.first_name = r.first_name and l.last_name = r.last_name")
_PAIR_COLUMNS = ", ".join(f"l.{c} as {c}_l, r.{c} as {c}_r" for c in FIELDS)


def _pairs_sql(rules: tuple[str, ...], name: str = "pairs") -> str:
    """Pairs with the first rule that yields them, from one equi-join per rule."""
    joins = " union all ".join(
        f"select l.record_id as record_id_l, r.record_id as record_id_r, {n} as rule from view_ l join view_ r"
        f" on {rule} and l.record_id < r.record_id"
        for n, rule in enumerate(rules)
    )
    return f"{name} as (select record_id_l, record_id_r, cast(min(rule) as integer) as match_key from ({joins}) group by all)"


_FIELDS_OF_PAIRS = (
    f"wide as (select p.*, {_PAIR_COLUMNS} from pairs p join view_ l on l.record_id = p.record_id_l"
    " join view_ r on r.record_id = p.record_id_r)"
)


def _jw(a: str, b: str) -> str:
    return f"round(jaro_winkler_similarity({a}, {b}), 12)"


def _level_sql(column: str, a: str, b: str) -> str:
    """Level of two values as in the model contract."""
    missing = f"when {a} is null or {b} is null then -1"
    if column in ("first_name", "last_name"):
        s = _jw(a, b)
        cases = f"when {a} = {b} then 4 when {s} >= 0.92 then 3 when {s} >= 0.88 then 2 when {s} >= 0.7 then 1"
    elif column == "email":
        p, q = (f"nullif(regexp_extract({x}, '^[^@]+'), '')" for x in (a, b))
        cases = f"when {a} = {b} then 4 when {p} = {q} then 3 when {_jw(a, b)} >= 0.88 then 2 when {_jw(p, q)} >= 0.88 then 1"
    elif column == "postcode":
        d = f"levenshtein({a}, {b})"
        cases = f"when {a} = {b} then 3 when {d} <= 1 then 2 when {d} <= 2 then 1"
    else:
        cases = f"when {a} = {b} then 1"
    return f"cast(case {missing} {cases} else 0 end as integer)"


_GAMMA_SQL = ", ".join(f"{_level_sql(c, f'{c}_l', f'{c}_r')} as gamma_{c}" for c in FIELDS)
_VECTORS = f"vectors as (select record_id_l, record_id_r, match_key, {_GAMMA_SQL} from wide)"
_WEIGHT_SQL = " + ".join(
    ["log2(0.0005 / (1 - 0.0005))"]
    + [
        f"case gamma_{c} " + " ".join(f"when {i} then log2({m} / {u})" for i, (m, u) in enumerate(rates)) + " else 0 end"
        for c, rates in FIXED_RATES.items()
    ]
)
_SCORED = (
    f"weighted as (select *, cast({_WEIGHT_SQL} as double) as match_weight from vectors),"
    " scored as (select *, 1 / (1 + pow(2.0, -match_weight)) as match_probability from weighted)"
)
_CLUSTERS = """edges as (select record_id_l as a, record_id_r as b from pairs union select record_id_r, record_id_l from pairs),
  labels_(n, m) as (select record_id, record_id from view_ union select s.b, l.m from labels_ l join edges s on s.a = l.n and l.m < s.b),
  clusters as (select n as record_id, min(m) as cluster_id from labels_ group by n)"""

_HITS = f"hits as (select * from scored where match_probability >= {THRESHOLD})"
_HITS_OF_A_RUN = _HITS[:-1] + f" and (record_id_l <= '{MARK}') = (record_id_r <= '{MARK}'))"
_CLUSTERS_OF_HITS = _CLUSTERS.replace("from pairs", "from hits")


def _vote_sql(column: str) -> str:
    return (
        f"vote_{column} as (select cluster_id, {column} from (select cluster_id, {column}, row_number() over"
        f" (partition by cluster_id order by count(*) desc, {column}) as place from members where trim({column}) <> ''"
        f" group by cluster_id, {column}) where place = 1)"
    )


_GOLDEN = (
    "members as (select p.*, c.cluster_id from persons p join clusters c using (record_id)), "
    + ", ".join(_vote_sql(c) for c in FIELDS)
    + ", lists as (select cluster_id, count(*) as source_record_count, string_agg(record_id, ',' order by record_id)"
    " as source_record_ids from members group by cluster_id), golden as (select lists.cluster_id, "
    + ", ".join(f"coalesce(vote_{c}.{c}, '') as {c}" for c in FIELDS)
    + ", source_record_count, source_record_ids from lists "
    + " ".join(f"left join vote_{c} on vote_{c}.cluster_id = lists.cluster_id" for c in FIELDS)
    + ")"
)
_PADDED = (
    "padded as (select record_id, "
    + ", ".join(
        f"case when substr(record_id, 9, 1) in ('1', '5') then concat('  ', {c}, ' ') else {c} end as {c}"
        for c in FIELDS
        if c != "city"
    )
    + ", case when substr(record_id, 9, 1) = '4' then '   ' else city end as city from persons)"
)


_TOPS = {c.column: c.top for c in COMPARISONS}
_FIXED_BY_BLOCK = tuple(rule.keys for rule in TRAINING_RULES)


def _em_sql() -> list[str]:
    """Training as a fixed point: one row of rates per block and round, until they settle or 25 rounds are over.

    Needs ``u_`` (comparison, level, u), ``prior_`` (prior) and ``patterns`` (training_rule, levels, n).
    """
    lists = ", ".join(
        f"(select list(coalesce(u, 0) order by l) from (select unnest(range(0, {top + 1})) as l) left join u_ on comparison = '{c}' and level = l) as u_{c}"
        for c, top in _TOPS.items()
    )
    blocks = range(len(_FIXED_BY_BLOCK))
    free = {c: ", ".join(str(b) for b in blocks if c not in _FIXED_BY_BLOCK[b]) for c in _TOPS}
    odds = "p / greatest(1 - p, 1e-6)"
    starts = " union all ".join(
        f"select {b} as block, 0 as round, 1.0::double as change, x / (1 + x) as rate, "
        + ", ".join(f"[{', '.join([repr(0.05 / top) + '::double'] * top)}, 0.95::double] as m_{c}" for c, top in _TOPS.items())
        + f" from (select {odds} * " + " * ".join(f"0.95 / greatest(u_{c}[{_TOPS[c] + 1}], 1e-6)" for c in _FIXED_BY_BLOCK[b])
        + " as x from (select prior as p from prior_), us)"
        for b in blocks
    )
    used = {c: f"gamma_{c} >= 0 and block in ({free[c]})" for c in _TOPS}
    log_odds = " + ".join(
        ["ln(rate / (1 - rate))", *[f"if({used[c]}, ln(greatest(m_{c}[gamma_{c} + 1], 1e-6) / greatest(u_{c}[gamma_{c} + 1], 1e-6)), 0)" for c in _TOPS]]
    )
    background = " + ".join(["ln(1 - rate)", *[f"if({used[c]}, ln(greatest(u_{c}[gamma_{c} + 1], 1e-6)), 0)" for c in _TOPS]])
    masses = ", ".join(
        f"any_value(m_{c}) as m_{c}, sum(e) filter (gamma_{c} >= 0) as all_{c}, ["
        + ", ".join(f"coalesce(sum(e) filter (gamma_{c} = {i}), 0)" for i in range(top + 1))
        + f"] as mass_{c}"
        for c, top in _TOPS.items()
    )
    new = {c: f"if(block in ({free[c]}) and all_{c} > 0, list_transform(mass_{c}, lambda x: x / all_{c}), m_{c})" for c in _TOPS}
    change = ", ".join(f"list_max(list_transform(range(1, {top + 2}), lambda i: abs(new_{c}[i] - m_{c}[i])))" for c, top in _TOPS.items())
    return [
        f"us as (select {lists})",
        f"start_ as ({starts})",
        f"em as (select block, round, change, least(greatest(rate, 1e-6), 1 - 1e-6) as rate, {', '.join(f'm_{c}' for c in _TOPS)} from start_"
        " where block in (select training_rule from patterns) union all"
        f" select block, round + 1, greatest({change}), least(greatest(share, 1e-6), 1 - 1e-6), {', '.join(f'new_{c}' for c in _TOPS)} from"
        f" (select *, {', '.join(f'{x} as new_{c}' for c, x in new.items())} from"
        f" (select block, round, sum(e) / sum(n) as share, {masses} from"
        f" (select *, n / (1 + exp(-({log_odds}))) as e from em join patterns on training_rule = block, us where change >= 1e-4 and round < 25)"
        " group by block, round)))",
        "settled as (select * from em where round > 0 qualify row_number() over (partition by block order by round desc) = 1)",
        "ended as (select block, sum(n * (" + background + " + ln(1 + exp(" + log_odds + ")))) as log_likelihood"
        " from settled join patterns on training_rule = block, us group by block)",
        "found_m as (select comparison, level, median(m) as m from ("
        + " union all ".join(
            f"select '{c}' as comparison, g as level, m_{c}[g + 1] as m from settled join (select distinct training_rule, gamma_{c} as g from patterns)"
            f" on training_rule = block where g >= 0 and block in ({free[c]})"
            for c in _TOPS
        )
        + ") group by comparison, level)",
        "every_level as ("
        + " union all ".join(f"select '{c}' as comparison, unnest(range(0, {top + 1}))::int as level, {top} as top" for c, top in _TOPS.items())
        + ")",
        "model_ as (select comparison, level, coalesce(m, if(level = top, 0.95, 0.05 / top))::double as m, coalesce(u, 0)::double as u,"
        " m is not null and coalesce(u, 0) > 0 as trained from every_level left join found_m using (comparison, level) left join u_ using (comparison, level))",
    ]


def _trained_weight_sql() -> str:
    """``weighted`` and ``scored`` by the rates of ``model_``."""
    parts = [
        f"case when gamma_{c} >= 0 then (select list(log2(greatest(m, 1e-6) / greatest(u, 1e-6)) order by level) from model_ where comparison = '{c}')[gamma_{c} + 1] else 0 end"
        for c in _TOPS
    ]
    weight = " + ".join(["(select log2(prior / (1 - prior)) from prior_)", *parts])
    return f"weighted as (select *, cast({weight} as double) as match_weight from vectors), scored as (select *, 1 / (1 + pow(2.0, -match_weight)) as match_probability from weighted)"


def _with(*parts: str, select: str) -> str:
    return f"with recursive {', '.join((fixtures.persons_sql(), *parts))} {select}"


def oracle_sql() -> dict[str, str]:
    candidates = _pairs_sql(_RULE_SQL)
    compared = (_VIEW, candidates, _FIELDS_OF_PAIRS, _VECTORS)
    linked = (_VIEW, _pairs_sql(_RULE_SQL[:2]), _CLUSTERS)
    golden = (*linked, _GOLDEN)
    gammas = ", ".join(GAMMAS)
    sampled = (
        f"sampled as (select * from view_ where (select count(*) from view_) <= {SAMPLED_RECORDS} or"
        " cast(concat('0x', substr(md5(concat('1729:', record_id)), 1, 8)) as bigint) / 4294967296.0"
        f" < {SAMPLED_RECORDS}.0 / (select count(*) from view_))"
    )
    levels = " union all ".join(
        f"select '{c}' as comparison, {_level_sql(c, f'l.{c}', f'r.{c}')} as level, count(*) as n"
        " from sampled l join sampled r on l.record_id < r.record_id group by all"
        for c in FIELDS
    )
    local = "nullif(regexp_extract(email, '^[^@]+'), '')"
    grouped = "(select coalesce(sum(n * (n - 1) // 2), 0) from (select count(*) as n from view_ where {0} is not null group by {1}))"
    equal = [f"select '{c}' as comparison, {len(FIXED_RATES[c]) - 1} as level, {grouped.format(c, c)} as n" for c in FIELDS]
    equal.append(f"select 'email', 3, {grouped.format(local, local)} - {grouped.format(local, 'email')}")
    everything = " union all ".join(f"select '{c}' as comparison, count({c}) * (count({c}) - 1) / 2 as total from view_" for c in FIELDS)
    training = " union all ".join(
        f"select cast({n} as integer) as training_rule, {_GAMMA_SQL} from (select {_PAIR_COLUMNS} from view_ l"
        f" join view_ r on {rule} and l.record_id < r.record_id)"
        for n, rule in enumerate(_TRAINING_SQL)
    )
    found = {
        "scan_parquet_text": "select cast(c_custkey as varchar) as c_custkey, c_name,"
        " cast(c_nationkey as varchar) as c_nationkey, c_mktsegment from customer",
        "duplicate_record_ids": "select cast(user_id as varchar) as record_id from events group by user_id"
        " having count(*) > 1 order by 1 limit 3",
        "record_batches": "select batch_no, count(*) as records, min(id) as first_id, max(id) as last_id from"
        f" (select id, (row_number() over (order by id) - 1) // {BATCH_ROWS} as batch_no from"
        " (select lpad(cast(event_id as varchar), 10, '0') as id from events)) group by batch_no",
        "clean_records": _with(
            _PADDED, select="select record_id, " + ", ".join(f"trim({c}) as {c}" for c in FIELDS) + " from padded"
        ),
        "normalise_email": _with(_PADDED, select="select record_id, lower(trim(email)) as email from padded"),
        "blank_to_null": _with(
            _PADDED,
            select="select record_id, "
            + ", ".join(f"case when trim({c}) <> '' then {c} end as {c}" for c in FIELDS)
            + " from padded",
        ),
        "select_new_records": _with(select=f"select * from persons where record_id > '{MARK}'"),
        "high_water_mark": _with(select="select max(record_id) as highest_record_id from persons"),
        "candidate_pairs": _with(_VIEW, candidates, select="select * from pairs"),
        "pairs_per_rule": _with(
            _VIEW,
            candidates,
            select="select rule as match_key, count(record_id_l) as pairs from (values (0), (1), (2), (3), (4)) t(rule)"
            " left join pairs on match_key = rule group by rule",
        ),
        "deterministic_pairs": _with(_VIEW, _pairs_sql(_DETERMINISTIC_SQL), select="select count(*) as pairs from pairs"),
        "blocking_reduction": _with(
            _VIEW,
            candidates,
            select="select c as candidate_pairs, n * (n - 1) // 2 as possible_pairs,"
            " round(1 - c / (n * (n - 1) / 2.0), 9) as reduction_ratio from"
            " (select (select count(*) from pairs) as c, (select count(*) from view_) as n)",
        ),
        "comparison_vectors": _with(*compared, select="select * from vectors"),
        "score_fixed_params": _with(
            *compared,
            _SCORED,
            select="select record_id_l, record_id_r, round(match_weight, 9) as match_weight,"
            " round(match_probability, 9) as match_probability from scored",
        ),
        "pairs_above_threshold": _with(
            *compared,
            _SCORED,
            select="select record_id_l, record_id_r, round(match_weight, 9) as match_weight,"
            f" round(match_probability, 9) as match_probability from scored where match_probability >= {THRESHOLD}",
        ),
        "pair_counts": _with(
            *compared,
            _SCORED,
            select="select count(*) as candidate_pairs,"
            f" count(*) filter (where match_probability >= {THRESHOLD}) as pairs_above_threshold from scored",
        ),
        "prior_probability": _with(
            _VIEW,
            _pairs_sql(_DETERMINISTIC_SQL),
            select="select c as deterministic_pairs, round(least(1.0, c / 0.8 / (n * (n - 1) / 2.0)), 12) as prior from"
            " (select cast((select count(*) from pairs) as double) as c, cast((select count(*) from view_) as double) as n)",
        ).replace("select c as deterministic_pairs", "select cast(c as bigint) as deterministic_pairs"),
        "u_probabilities": _with(
            _VIEW,
            sampled,
            f"levels_ as ({levels})",
            f"equal_ as ({' union all '.join(equal)})",
            f"everything_ as ({everything})",
            "fixed_ as (select comparison, sum(n) as fixed from equal_ group by comparison)",
            "others_ as (select * from levels_ l where level >= 0 and not exists (select 1 from equal_ e"
            " where e.comparison = l.comparison and e.level = l.level))",
            select="select comparison, level, round(n / total, 9) as u from equal_ join everything_ using (comparison) where n > 0"
            " union all select comparison, level, round((total - fixed) / total * (n / sum(n) over (partition by comparison)), 9)"
            " from others_ join everything_ using (comparison) join fixed_ using (comparison)",
        ),
        "training_pattern_counts": _with(
            _VIEW,
            f"blocks as ({training})",
            select=f"select training_rule, {gammas}, count(*) as n from blocks group by all",
        ),
        "connected_components": _with(*linked, select="select * from clusters"),
        "document_copies": "select lpad(cast(doc_id as varchar), 12, '0') as doc_id,"
        " min(lpad(cast(doc_id as varchar), 12, '0')) over (partition by text) as cluster_id from documents",
        "attach_clusters": _with(
            *linked,
            select="select p.record_id, "
            + ", ".join(f"p.{c}" for c in FIELDS)
            + ", c.cluster_id from persons p join clusters c using (record_id)",
        ),
        "golden_records": _with(*golden, select="select * from golden"),
        "golden_contract": _with(*golden, select="select * from golden"),
        "run_metrics": _with(
            *golden,
            select="select cast(sum(source_record_count) as bigint) as input_records, count(*) as golden_records,"
            " count(*) filter (where source_record_count > 1) as duplicate_clusters,"
            " cast(sum(source_record_count) as bigint) - count(*) as records_merged_away from golden",
        ),
        "partition_check": _with(
            *golden,
            "listed as (select unnest(string_split(source_record_ids, ',')) as record_id from golden)",
            select="select (select count(*) from persons) as records, (select count(*) from listed) as listed,"
            " (select count(*) from persons where record_id not in (select record_id from listed)) as missing,"
            " (select count(*) from listed where record_id not in (select record_id from persons)) as unknown,"
            " (select count(*) from (select record_id from listed group by record_id having count(*) > 1)) as repeated",
        ),
        "truth_pairs": _with(
            select="select l.record_id as record_id_l, r.record_id as record_id_r from persons l join persons r"
            " on l.truth = r.truth and l.record_id < r.record_id"
        ),
        "linkage_quality": _with(
            *linked,
            "predicted as (select l.record_id as a, r.record_id as b from clusters l join clusters r"
            " on l.cluster_id = r.cluster_id and l.record_id < r.record_id)",
            "true_ as (select l.record_id as a, r.record_id as b from persons l join persons r"
            " on l.truth = r.truth and l.record_id < r.record_id)",
            "counts as (select (select count(*) from predicted) as p, (select count(*) from true_) as t,"
            " (select count(*) from predicted join true_ using (a, b)) as f)",
            select="select p as predicted_pairs, t as true_pairs, f as found_pairs,"
            " round(f / p, 9) as precision, round(f / t, 9) as recall, round(2.0 * f / (p + t), 9) as f1 from counts",
        ),
        "resolve_records": _with(*compared, _SCORED, _HITS, _CLUSTERS_OF_HITS, select="select * from clusters"),
        "resolved_golden": _with(*compared, _SCORED, _HITS, _CLUSTERS_OF_HITS, _GOLDEN, select="select * from golden"),
        "incremental_golden": _with(*compared, _SCORED, _HITS_OF_A_RUN, _CLUSTERS_OF_HITS, _GOLDEN, select="select * from golden"),
        "generation_summary": _with(
            "people as (select truth, count(*) as n from persons group by truth)",
            select="select cast(sum(n) as bigint) as total_rows, count(*) as distinct_people,"
            " count(*) filter (where n > 1) as people_with_duplicates, cast(sum(n - 1) as bigint) as duplicate_rows"
            " from people",
        ),
    }
    u_parts = (
        sampled,
        f"levels_ as ({levels})",
        f"equal_ as ({' union all '.join(equal)})",
        f"everything_ as ({everything})",
        "fixed_ as (select comparison, sum(n) as fixed from equal_ group by comparison)",
        "others_ as (select * from levels_ l where level >= 0 and not exists (select 1 from equal_ e where e.comparison = l.comparison and e.level = l.level))",
        "u_ as (select comparison, level, n / total as u from equal_ join everything_ using (comparison) where n > 0"
        " union all select comparison, level, (total - fixed) / total * (n / sum(n) over (partition by comparison))"
        " from others_ join everything_ using (comparison) join fixed_ using (comparison))",
    )
    trained = (
        _VIEW,
        *u_parts,
        _pairs_sql(_DETERMINISTIC_SQL, "certain"),
        "prior_ as (select least(1.0, c / 0.8 / (n * (n - 1) / 2.0)) as prior from"
        " (select cast((select count(*) from certain) as double) as c, cast((select count(*) from view_) as double) as n))",
        f"blocks as ({training})",
        f"patterns as (select training_rule, {gammas}, count(*) as n from blocks group by all)",
        *_em_sql(),
    )
    found["em_m_probabilities"] = _with(*trained, select="select comparison, level, round(m, 6) as m, round(u, 6) as u, trained from model_")
    found["em_convergence"] = _with(
        *trained,
        select="select block::int as training_rule, round::int as rounds, round(change, 9) as change, round(rate, 6) as match_rate,"
        " round(log_likelihood, 3) as log_likelihood, change < 1e-4 as converged from settled join ended using (block)",
    )
    scored_by_training = (*trained, candidates, _FIELDS_OF_PAIRS, _VECTORS, _trained_weight_sql(), _HITS, _CLUSTERS_OF_HITS)
    found["resolve_trained"] = _with(*scored_by_training, select="select * from clusters")
    found["resolved_golden_trained"] = _with(*scored_by_training, _GOLDEN, select="select * from golden")
    found["read_contract"] = found["clean_records"]
    for name, columns in {
        "names": ("first_name", "last_name"),
        "email": ("email",),
        "postcode": ("postcode",),
        "city": ("city",),
    }.items():
        chosen = ", ".join(f"gamma_{c}" for c in columns)
        found[f"compare_{name}"] = _with(*compared, select=f"select record_id_l, record_id_r, {chosen} from vectors")
    blocks = ("email", "surname_postcode", "given_city", "name_prefix", "postcode")
    for name, rule in zip(blocks, _RULE_SQL, strict=True):
        found[f"block_{name}"] = _with(
            _VIEW,
            select=f"select l.record_id as record_id_l, r.record_id as record_id_r from view_ l join view_ r on {rule}"
            " and l.record_id < r.record_id",
        )
    if llm is not None:
        found |= llm.ORACLES
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
