"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and on odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction
from math import ceil
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Reference

import kinfold.llm.anchors as anchors
from kinfold.llm.common import workspace
from kinfold.llm.jaccard import _homes, _pivot_pairs, differing, may_be_similar, near_duplicates, one_of_each, parity, wide_parity
from kinfold.llm.language import identify
from kinfold.llm.mixing import mix, word_count
from kinfold.llm.nearest import nearest
from kinfold.llm.packing import Tokenizer, best_fit, pack
from kinfold.llm.quality import quality
from kinfold.llm.queries import ORACLES, QUERIES, vocabulary
from kinfold.llm.rules import quality_rules
from kinfold.llm.substrings import remove_repeated_words
from kinfold.llm.suffixes import remove_repeats
from kinfold.llm.toxicity import _forms, excursions, form_counts, labelled_texts, learn, log_odds, segments, toxicity

from .conftest import ROWS, SF_DIR

WORD = re.compile("[^\x20\x09-\x0d]+")


def real(name: str):
    return duckdb.sql(f"select * from '{SF_DIR}/{name}.parquet'").fetchall()


def repeats(texts: list, length: int, first_stays: bool) -> list[list[bool]]:
    """Which symbols repeated windows cover; ``texts`` in the order of their ids."""
    times = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    seen, out = set(), []
    for t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            window = t[p : p + length]
            if (window in seen) if first_stays else times[window] > 1:
                gone[p : p + length] = [True] * length
            seen.add(window)
        out.append(gone)
    return out


@pytest.mark.parametrize("hot", [1000, 1])
def test_suffix_dedup(spark, docs, empty, monkeypatch, hot):
    monkeypatch.setattr(anchors, "HOT", hot)
    rows = [(i, (t or "").encode()) for i, t, *_ in real("documents")[:250]]
    frame = spark.createDataFrame([(i, t.decode(), "x") for i, t in rows], "doc_id long, text string, extra string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in remove_repeats(frame).collect()}
    want = {}
    for (i, t), gone in zip(rows, repeats([t for _, t in rows], 200, False), strict=True):
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        want[i] = (len(t), sum(gone), hashlib.sha256(kept).hexdigest())
    assert got == want
    if hot > 1:
        odd = [(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in remove_repeats(docs).collect()]
        assert len(odd) == len(ROWS) and {x[0]: x[2] for x in odd}[5] == len(ROWS[5][1])
        assert remove_repeats(empty).count() == 0


@pytest.mark.parametrize("hot", [1000, 1])
def test_substring_dedup(spark, docs, empty, monkeypatch, hot):
    monkeypatch.setattr(anchors, "HOT", hot)
    rows = sorted((i, tuple(WORD.findall(t or ""))) for i, t, *_ in real("documents")[:300])
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in remove_repeated_words(frame).collect()}
    want = {}
    for (i, t), gone in zip(rows, repeats([t for _, t in rows], 20, True), strict=True):
        want[i] = (len(t), sum(gone), " ".join(w for w, g in zip(t, gone, strict=True) if not g))
    assert got == want
    if hot > 1:
        odd = {r["doc_id"]: r["n_removed"] for r in remove_repeated_words(docs).collect()}
        assert (odd[1], odd[2], odd[5], odd[6]) == (0, 60, 0, 30_000)
        assert remove_repeated_words(empty).count() == 0


def shingles(text: str | None, n: int) -> set:
    w = WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def plain_classes(sets: dict, similarity: float) -> dict:
    """The least id that links of similar sets reach from each id."""
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and both >= similarity * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize(("similarity", "n"), [("0.9", 3), ("0.8", 5), ("0.6", 3)])
def test_near_duplicates(spark, docs, empty, similarity, n):
    rows = [(i, t) for i, t, *_ in real("documents")[:400]]
    sets = {i: shingles(t, n) for i, t in rows}
    classes = plain_classes(sets, float(similarity))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), similarity, n).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == {i: (len(sets[i]), classes[i]) for i in sets}
    if n == 5:
        odd = near_duplicates(docs).collect()
        assert {r["doc_id"]: r["component_id"] for r in odd if r["doc_id"] in (3, 4, 5, 6, 8)} == {3: 3, 4: 4, 5: 5, 6: 5, 8: 8}
        kept = one_of_each(docs)
        assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3
        assert near_duplicates(empty).count() == 0


@pytest.mark.parametrize(("rounds", "broadcast"), [(8, 1_000_000), (0, 0)])
def test_chains_within_a_tile(spark, monkeypatch, rounds, broadcast):
    """Edits of one passage that are similar in part only: links lead from class to class, by pivots or without."""
    monkeypatch.setattr("kinfold.llm.jaccard.PIVOT_ROUNDS", rounds)
    monkeypatch.setattr("kinfold.llm.jaccard.BROADCAST_PAIRS", broadcast)
    random = np.random.default_rng(11)
    passage, rows = [f"p{i}" for i in range(80)], []
    for i in range(150):
        words = list(passage)
        for at in random.choice(80, int(random.integers(1, 7)), replace=False):
            words[at] = f"e{at}_{random.integers(3)}"
        rows.append((i, " ".join(words)))
    sets = {i: shingles(t, 5) for i, t in rows}
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), "0.8", 5).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == plain_classes(sets, 0.8)


def test_a_round_tries_the_closest_pivot_of_a_class(spark):
    """One pair for each set and other class, with the pivot that is most like the set."""
    base = np.arange(1, 101, dtype=np.uint64) << np.uint64(6)
    sets = {1: base[:96], 2: base[:99], 3: base}
    rows = [(i, len(s), *parity(s).tolist()) for i, s in sets.items()]
    signed = spark.createDataFrame(rows, "row_id long, size long, " + ", ".join(f"p{i} long" for i in range(8)))
    left, right = (signed.withColumnsRenamed({"row_id": x, "size": f"size_{x}"} | {f"p{i}": f"{x}{i}" for i in range(8)}) for x in "ab")
    tile = spark.createDataFrame([(7, 1, 1), (7, 2, 1), (7, 3, 3)], "key long, node long, class long")
    found = {tuple(r) for r in _pivot_pairs(tile, SimpleNamespace(left=left, right=right), Fraction("0.9"), 0).collect()}
    assert found == {(1, 3), (2, 3)}  # 1 and 2 meet the class of 3, which meets theirs through 2
    alone = {tuple(r) for r in _pivot_pairs(tile.withColumn("class", F.expr("if(node = 3, 3, 1)")), SimpleNamespace(left=left, right=right.filter("b = 3")), Fraction("0.9"), 0).collect()}
    assert alone == {(2, 3)}


def test_sets_of_too_different_sizes_are_not_read(spark):
    """Full bitmaps of large sets say nothing, their sizes do."""
    bits = {f"{x}{i}": F.lit(0) for x in "ab" for i in range(8)}
    pairs = spark.createDataFrame([(9000, 10_000), (10_000, 9000), (8999, 10_000), (10_000, 8999)], "size_a long, size_b long").withColumns(bits)
    assert [tuple(r)[:2] for r in pairs.filter(may_be_similar(Fraction("0.9"))).collect()] == [(9000, 10_000), (10_000, 9000)]


def test_a_set_enters_pivot_rounds_once(spark):
    """Of the tiles a set is in, only the largest one; tiles that are small go to the last step."""
    rows = [(key, node, node, n) for key, n in ((1, 20), (2, 30), (3, 4)) for node in range(n)]
    found = _homes(spark.createDataFrame(rows, "key long, node long, class long, n long")).collect()
    assert sorted((r["node"], r["key"], r["class"]) for r in found) == [(i, 2, i) for i in range(30)]
    assert _homes(spark.createDataFrame([r for r in rows if r[0] == 3], "key long, node long, class long, n long")).count() == 0


def test_wide_bitmaps_are_short_and_tell_sets_apart():
    """At most two bits an element, enough to drop sets that share little."""
    random = np.random.default_rng(5)
    for n in (600, 3000, 20_000):
        a, b = (np.unique(random.integers(0, 2**63, n).astype(np.uint64)) for _ in range(2))
        assert 8 * len(wide_parity(a)) <= 2 * n
        assert differing(wide_parity(a), wide_parity(b)) * 9 > 2 * n  # not 0.8 similar


def test_wide_bitmaps_bound_the_difference():
    random = np.random.default_rng(3)
    for n in (300, 1100, 5000):
        a = np.unique(random.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: -n // 9], random.integers(0, 2**63, n // 3).astype(np.uint64)]))
        apart = len(np.setxor1d(a, b))
        assert 0.6 * apart < differing(wide_parity(a), wide_parity(b)) <= apart
        assert differing(wide_parity(a), wide_parity(a)) == 0
    assert wide_parity(a[:100]) is None


def test_packing(spark, docs, empty):
    reference = Reference.from_file(vocabulary())
    rows = [(i, t) for i, t, *_ in real("documents")[:150]]
    out = pack(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary()).toPandas()
    for i, t in rows:
        ids = [*reference.encode(t, add_special_tokens=False).ids, 0]
        pieces = out[out.doc_id == i].sort_values("piece")
        assert [x for p in pieces["ids"] for x in p] == ids
        assert (pieces["length"].iloc[1:] == 2048).all() and (pieces["start"] == pieces["length"].cumsum() - pieces["length"]).all()
        assert all(zlib.crc32(np.array(p, "<u4").tobytes()) == c for p, c in zip(pieces["ids"], pieces["ids_crc32"], strict=True))
    out = out.sort_values(["sequence_id", "offset"])
    filled = out.groupby("sequence_id")["length"]
    assert (filled.cumsum() - out["length"] == out["offset"]).all() and filled.sum().max() <= 2048
    assert filled.ngroups <= ceil(out["length"].sum() / 2048) + 2
    odd = pack(docs, vocabulary()).toPandas()
    assert set(odd[odd.doc_id.isin([3, 4])]["length"]) == {1} and (odd.doc_id == 8).sum() == 2
    assert pack(empty, vocabulary()).count() == 0


def test_best_fit_takes_the_fullest_bin():
    bins, offsets, fills = best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert sorted(fills.tolist()) == [10, 10] and bins[0] == bins[2] and offsets[2] == 6


@pytest.mark.parametrize("text", ["a  b\n\n c ", "it's 'sx", "\x1c x", "<|endoftext|> x", "日本語 12三", "ǅ ¹²³ ¼", "a" * 3000, public_tokenizers.PATTERN])
def test_ids_equal_the_library(text):
    ours = Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert ours.encode(text) == ours.loaded.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, SF_DIR).toPandas()[list(want.columns)]
    by = list(want.columns)
    assert got.sort_values(by).astype(str).values.tolist() == want.sort_values(by).astype(str).values.tolist()


def test_mixing(docs, empty):
    out = mix(docs, word_count(), max_repeats=3.0)
    assert out.columns[: len(docs.columns)] == docs.columns
    assert out.select("doc_id", "text").distinct().count() == docs.select("doc_id", "text").distinct().count()
    times = out.groupBy("source").agg((F.sum("n_tokens")).alias("n")).collect()
    own = {r["source"]: r["n"] for r in docs.groupBy("source").agg(F.sum(word_count()).alias("n")).collect()}
    repeats = [r["n"] / own[r["source"]] for r in times if own[r["source"]] > 1000]
    assert max(repeats) <= 3.1 and min(repeats) >= 1
    thin = mix(docs, word_count(), target_entropy=0.5, budget=20_000)
    assert thin.count() > 0
    assert mix(empty, word_count(), max_repeats=2.0).count() == 0
    with pytest.raises(ValueError, match="either"):
        mix(docs, word_count())


def _accuracy(scored, label):
    truth = {i: v for i, v in duckdb.sql(f"select doc_id, {label} from '{SF_DIR}/labels.parquet'").fetchall()}
    held = [(r["score"], truth[r["doc_id"]]) for r in scored.filter("held_out").collect() if r["doc_id"] in truth]
    return np.mean([(s >= 0.3) == bool(v) for s, v in held])


def test_learned_scores_hold_out(spark):
    assert _accuracy(QUERIES["op4_quality"](spark, SF_DIR), "quality") > 0.95
    assert _accuracy(QUERIES["op6_toxicity"](spark, SF_DIR), "toxic") > 0.9
    held = QUERIES["op7_language_id"](spark, SF_DIR).filter("held_out").collect()
    truth = {i: lang for i, _, lang, *_ in real("documents")}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_scores_of_odd_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    marks = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (5, 1, 0), (8, None, None), (None, 1, 1)], none.schema)
    for operator in (quality, toxicity):
        for labels in (none, marks):
            out = operator(docs, labels).collect()
            assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 for r in out)
        assert operator(empty, marks).count() == 0
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(docs).collect()}
    assert found[3] == found[4] == found[9] == ("und", 0.0)
    assert identify(empty).count() == 0
    assert {r["lang_pred"] for r in identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def _labelled(spark, rows):
    """Texts with a label each, as the input of ``learn``."""
    frame = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], "doc_id long, text string, toxic int")
    return frame.select("doc_id", "text"), frame.select(F.col("doc_id").alias("labelled_id"), "toxic")


def _place(word: str) -> int:
    return int(_forms(pa.RecordBatch.from_pydict({"text": [word]}))[2][0, 0])


def test_a_toxic_word_scores_no_less_in_a_larger_corpus(spark):
    scores = []
    for n in (200, 4000):
        rows = [(f"{random_words(i, 12)} vile{i % 9} idiot {random_words(-i - 1, 12)}", 1) for i in range(n)]
        rows += [(random_words(10**6 + i, 24), 0) for i in range(n)]
        model = learn(*_labelled(spark, rows), workspace(spark, "toxicity"))
        scores.append(float(model.table[0, _place("idiot")]))
        assert scores[-1] == pytest.approx(float(log_odds(np.array([n]), np.array([0]), n, n)[0]))
    assert scores[1] >= scores[0] > 1


def test_every_different_labelled_text_counts(spark):
    passage = random_words(7, 40)
    rows = [(f"you vile{i}", 1) for i in range(30)] + [(f"fine day{i}", 0) for i in range(50)]  # fewer than five words
    rows += [(f"{random_words(i, 60)} {passage} shared", 0) for i in range(20)]  # not near copies: a passage in common
    rows += [(f"{random_words(3, 400)} edit{i} grim", 1) for i in range(40)] * 2  # near copies: one text in all
    place, weights, texts = form_counts(labelled_texts(*_labelled(spark, rows), workspace(spark, "toxicity")))
    toxic = {w: (weights[1] + weights[3])[place == _place(w)].tolist() for w in ("you", "grim")}
    assert toxic["you"] == [30] and toxic["grim"] == pytest.approx([1], abs=0.01)
    assert [texts[0] + texts[2], texts[1] + texts[3]] == pytest.approx([70, 31], abs=0.01)


def random_words(seed: int, n: int) -> str:
    return " ".join(f"w{x}" for x in np.random.default_rng(seed % 2**32).integers(0, 400, n))


def test_every_run_of_a_language_is_in_its_model(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").limit(200)
    few, all_held = (identify(docs, entries=n).orderBy("doc_id", "text").collect() for n in (400, 1 << 30))
    assert few == all_held


def test_segments_are_the_maximal_ones():
    at, gain = np.array([0, 1, 10, 30]), np.array([2.0, 1.0, 3.0, 1.0])
    assert [(round(s, 2), a, b) for s, a, b in segments(at, gain, 0.25)] == [(4.0, 0, 10), (1.0, 30, 30)]


def plain_segments(gains: list[float]) -> set[tuple[int, int]]:
    """Runs whose proper heads and tails all have sums above 0 and that lie in no longer such run."""
    total = np.concatenate([[0.0], np.cumsum(gains)])
    n = len(gains)
    good = [(a, b) for a in range(n) for b in range(a, n) if (total[a + 1 : b + 2] > total[a]).all() and (total[a : b + 1] < total[b + 1]).all()]
    return {(a, b) for a, b in good if not any((x, y) != (a, b) and x <= a and b <= y for x, y in good)}


def test_segments_equal_a_plain_search_and_runs_lose_none():
    random = np.random.default_rng(5)
    for _ in range(60):
        sizes = random.integers(1, 40, 6)
        scores = [np.where(random.random(n) < 0.4, random.integers(1, 9, n) / 8, 0.0) for n in sizes]
        every, text = np.concatenate(scores), np.repeat(np.arange(6), sizes)
        at = np.flatnonzero(every > 0)
        if not len(at):
            continue
        start, most = excursions(at, every[at], text[at])
        bounds = np.append(start, len(at))
        found = {i: {} for i in range(6)}
        for low, high, top in zip(bounds[:-1], bounds[1:], most, strict=True):
            i = text[at[low]]
            assert (text[at[low:high]] == i).all()
            for s, a, b in segments(at[low:high] - int(sizes[:i].sum()), every[at[low:high]]):
                assert s <= top + 1e-9
                found[i][a, b] = s
        for i, own in enumerate(scores):
            gains = np.where(own > 0, own, -0.25)
            assert set(found[i]) == plain_segments(gains.tolist())
            assert all(s == pytest.approx(gains[a : b + 1].sum()) for (a, b), s in found[i].items())


def test_rules(spark, docs, empty):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    judged, rules = quality_rules(spark.read.parquet(f"{SF_DIR}/documents.parquet"), labels)
    text = {i: t for i, t, *_ in real("documents")}
    for r in judged.limit(200).collect():
        w, lines = WORD.findall(text[r["doc_id"]]), text[r["doc_id"]].split("\n")
        full = [x for x in lines if WORD.search(x)]
        runs = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {k + j for k in range(len(w) - 2) if runs[tuple(w[k : k + 3])] > 1 for j in range(3)}
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(full) - len(set(full)), len(again))
    kept = judged.join(labels, "doc_id").filter("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()
    assert {r["quality"]: r["k"] > 0.5 for r in kept} == {0: False, 1: True} and rules
    assert quality_rules(docs, labels)[0].count() == len(ROWS) and quality_rules(empty, labels)[0].count() == 0


def test_nearest_on_ties_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(300)] + [(i, [0.5] * 8) for i in range(300, 600)]
    rows += [(600, None), (601, [1.0, None]), (602, [float("nan")] * 8), (None, [1.0] * 8), (605, [])]
    rows += [(604, [0.25]), (604, [0.25]), (604, [0.75] * 8), (640, [0.5] * 8), (640, [0.75, 1.0])]  # rows of one id
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, query_id string")
    good = [(i, np.floor(64 * np.pad(np.array(v, np.float32).astype(float), (0, 8 - len(v))))) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = sorted((q, sorted((-int(x @ y), c) for k, (c, y) in enumerate(good) if k != n)[:20]) for n, (q, x) in enumerate(good) if q % 20 == 0)
    found = nearest(frame, F.col("vec_id") % 20 == 0).collect()
    got: dict = {}
    for r in found:
        got.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    lists: dict = {}
    for q, own in want:
        lists.setdefault(q, []).extend((i + 1, s, c) for i, (s, c) in enumerate(own))
    assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in lists.items()}
    assert nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
