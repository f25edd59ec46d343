"""Registered queries of the operators, each over its whole table, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.alignment import align
from kinfold.llm.common import fold
from kinfold.llm.jaccard import near_duplicates
from kinfold.llm.language import identify
from kinfold.llm.merkle import manifest
from kinfold.llm.mixing import mix, word_count
from kinfold.llm.nearest import nearest
from kinfold.llm.packing import pack
from kinfold.llm.quality import quality
from kinfold.llm.rules import quality_rules
from kinfold.llm.substrings import remove_repeated_words
from kinfold.llm.suffixes import remove_repeats
from kinfold.llm.tokenfiles import token_files
from kinfold.llm.toxicity import toxicity

#: Vocabulary file of the packed sequences.
VOCABULARY = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def _language(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


#: No source repeats more than this many times as often as another.
MAX_REPEATS = 2.0


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = docs.select("doc_id", "source", word_count().alias("words"))
    return mix(counted, F.col("words"), max_repeats=MAX_REPEATS).drop("words")


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary()).drop("ids")


def _jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), "0.9", 3)
    return found.select("doc_id", "n_shingles", "component_id")


def _suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document by its hash has its letters A-Z in lower case when it is read again."""
    tampered = F.when(fold("doc_id", 3) == 0, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    return manifest(table(spark, sf_dir, "documents"), {"text": tampered})


#: Vocabulary that is aligned with the first one.
PIECES = "piece_bpe_32k.model"


def _alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), vocabulary(), vocabulary(PIECES))


def _token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), vocabulary())


QUERIES: dict[str, Query] = {
    "op1_mixing": _mixing,
    "op2_suffix_dedup": _suffixes,
    "op3_packing": _packing,
    "op4_quality": _quality,
    "op5_ngram_jaccard": _jaccard,
    "op6_toxicity": _toxicity,
    "op7_language_id": _language,
    "op8_quality_rules": _rules,
    "op9_substring_dedup": _substrings,
    "op10_exact_topk": _nearest,
    "op11_merkle": _manifest,
    "op12_token_files": _token_files,
    "op13_alignment": _alignment,
}

_NEAREST = """
with valid as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from valid q join valid c on q.vec_id <> c.vec_id
  where q.vec_id % 20 = 0
), ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score
  from scored
)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 20
"""

# The exponent has a closed form here: repeats differ most between the largest and the smallest share.
_MIXING = r"""
with slim as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n from documents
), sources as (
  select source, sum(n)::bigint as own, sum(n) / (select sum(n) from slim)::double as share from slim group by source
), exponent as (
  select case when max(share) / min(share) <= 2 then 0.0 else 1 - ln(2.0) / ln(max(share) / min(share)) end as x
  from sources where own > 0
), scaled as (
  select source, own, pow(share, x) as weight from sources, exponent where own > 0
), budget as (
  select max(own / weight) as scale, sum(weight) as z from scaled
), plan as (
  select source, own, round(weight * scale)::bigint as wanted, greatest(1, ceil(round(scale * z) / 100000))::bigint as blocks
  from scaled, budget
  union all
  select source, own, 0, 1 from sources where own = 0
), epochs as (
  select *, case when own > 0 then wanted // own else 1 end as whole,
    case when own > 0 then wanted % own else 0 end as rest
  from plan
), copies as (
  select s.doc_id, s.source, s.n, p.* exclude (source), unnest(range(whole + (rest > 0)::bigint)) as epoch
  from slim s join epochs p on s.source is not distinct from p.source
), placed as (
  select *, coalesce(sum(n) over (partition by source, epoch
      order by md5(concat_ws('|', 'mix', coalesce(doc_id::varchar, ''), epoch::varchar)), doc_id::varchar, n
      rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from copies
)
select doc_id, source, epoch::int as epoch, n::bigint as n_tokens, start,
  case when wanted > 0 then least(blocks - 1, ((epoch * own + start)::hugeint * blocks) // wanted) else 0 end::bigint as block
from placed where epoch < whole or start < rest
"""



def _tree_sql(nodes: str, name: str, levels: int) -> str:
    """CTEs of a tree over ``nodes`` (g, pos, h): on each level the siblings of a node, and the nodes of the next one."""
    parts = [f"{name}0 as (select *, count(*) over (partition by g) as n from {nodes})"]
    for k in range(levels):
        run = "over (partition by g, pos // 8 order by pos rows between"
        before = f"string_agg(h, '') {run} unbounded preceding and 1 preceding)"
        after = f"string_agg(h, '') {run} 1 following and unbounded following)"
        parts.append(f"{name}_sides{k} as (select g, pos, n, coalesce(if(n = 1, '', {before}), '') as b, coalesce(if(n = 1, '', {after}), '') as a from {name}{k})")
        parts.append(
            f"{name}{k + 1} as (select *, count(*) over (partition by g) as n from (select g, if(n = 1, pos, pos // 8) as pos,"
            f" if(n = 1, max(h), sha256(string_agg(h, '' order by pos))) as h from {name}{k} group by g, n, if(n = 1, pos, pos // 8)))"
        )
    return ", ".join(parts)


def _manifest_sql(levels: int = 8, group_levels: int = 4) -> str:
    """For groups of at most 8 ** levels rows."""
    field = "coalesce(strlen({0}::varchar) || ':' || {0}::varchar, '-')"
    leaf = "sha256(concat(" + ", ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + "))"
    step = "if(o >= 0, xor(c, o), if(c % 2 = 1, xor(c // 2, 3988292384), c // 2))"
    ops = "flatten(list_transform(range(1, length(doc_id::varchar) + 1), lambda i: [ord(substr(doc_id::varchar, i, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce(list_concat([4294967295::bigint], {ops}), lambda c, o: {step}), 4294967295)"
    parts = [
        f"named as (select doc_id, coalesce('s' || lang, 'n') as g, {leaf.format(text='text')} as leaf, if({crc} % 3 = 0,"
        f" {leaf.format(text=f"translate(text, '{_UPPER}', '{_LOWER}')")}, {leaf.format(text='text')}) as fresh from documents)",
        "leaves as (select *, row_number() over (partition by g order by doc_id, leaf) - 1 as pos from named)",
        "slots as (select g, pos, leaf as h from leaves)",
        _tree_sql("slots", "t", levels),
        f"tops as (select '' as g, g as own, row_number() over (order by g) - 1 as pos, h from t{levels})",
        _tree_sql("(select g, pos, h from tops)", "u", group_levels),
        f"f0 as (select l.*, l.pos as p, l.fresh as f, '' as proof, tops.pos as q, tops.h as subroot, (select h from u{group_levels}) as root from leaves l join tops on tops.own = l.g)",
    ]
    last = 0
    for side, count, at, g in (("t", levels, "p", "x.g"), ("u", group_levels, "q", "''")):
        for k in range(count):
            parts.append(
                f"f{last + 1} as (select x.* exclude (f, proof, {at}), if(s.n = 1, x.{at}, x.{at} // 8) as {at},"
                f" if(s.n = 1, x.f, sha256(concat(s.b, x.f, s.a))) as f, concat(x.proof, s.b, s.a) as proof"
                f" from f{last} x join {side}_sides{k} s on s.g = {g} and s.pos = x.{at})"
            )
            last += 1
    return f"with {', '.join(parts)} select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, f as folded_root, f = root as verified from f{last}"


ORACLES: dict[str, str] = {
    "op1_mixing": _MIXING,
    "op10_exact_topk": _NEAREST,
    "op11_merkle": _manifest_sql(),
}
