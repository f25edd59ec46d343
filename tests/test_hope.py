from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

import kinfold.operators.agreement as agreement
from conftest import rows
from kinfold.functions.similarity import jaro_winkler_batch
from kinfold.operators.agreement import graded_pairs, hopeful_pairs
from kinfold.operators.blocking import CANDIDATE_RULES, block_sizes, candidate_pairs
from kinfold.operators.comparison import COMPARISONS, EditTiers, ExactOnly, NameTiers, carried_columns, compare_pairs, with_helpers
from kinfold.operators.hope import Hope, Texts, _edits
from kinfold.operators.model import pairs_above_threshold, score_pairs, weight_needed
from kinfold.scratch import Scratch
from test_agreement import MODEL, THRESHOLD, model_of

IDS = ["record_id_l", "record_id_r", "match_key"]


def _similarities(pairs: list[tuple]) -> dict[tuple, float]:
    whole = {p for p in pairs if None not in p}
    known = sorted(whole | {(a.split("@")[0], b.split("@")[0]) for a, b in whole})
    return dict(zip(known, jaro_winkler_batch(*(pa.array([p[k] for p in known], pa.string()) for k in range(2))), strict=True))


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def _level(comparison, a: str | None, b: str | None, similarity: dict[tuple, float]) -> int:
    if a is None or b is None:
        return -1
    if a == b:
        return comparison.top
    if isinstance(comparison, ExactOnly):
        return 0
    if isinstance(comparison, EditTiers):
        return next((comparison.top - 1 - i for i, d in enumerate(comparison.distances) if _distance(a, b) <= d), 0)
    if isinstance(comparison, NameTiers):
        return next((comparison.top - 1 - i for i, t in enumerate(comparison.thresholds) if similarity[a, b] >= t), 0)
    p, q = a.split("@")[0], b.split("@")[0]
    if p and p == q:
        return 3
    return 2 if similarity[a, b] >= 0.88 else 1 if p and q and similarity[p, q] >= 0.88 else 0


def _people(seed: int, n: int) -> dict[str, list]:
    """Damaged names, addresses and postcodes of all kinds of characters; some values are missing, long or odd."""
    rng = np.random.default_rng(seed)
    word = lambda letters, most: "".join(rng.choice(list(letters), rng.integers(1, most)))
    names = [word("abcdeé日", 9) for _ in range(n // 3)] + ["x" * 70 + "y", "y" + "x" * 70]
    codes = [word("01P", 7) for _ in range(n // 4)] + ["9" * 80, "9" * 79 + "8"]

    def some(values: list[str]) -> list:
        out = []
        for _ in range(n):
            v = values[rng.integers(len(values))]
            at = int(rng.integers(len(v)))
            out.append([v, v, v[:at] + "a" + v[at + 1 :], v[:at] + v[at + 1 :] or "b", None][rng.choice(5, p=[0.4, 0.3, 0.1, 0.1, 0.1])])
        return out

    mails = [f"{a}.{b}@{word('xy', 3)}.org" for a, b in zip(names, names[::-1], strict=True)] + ["@x", "aé", "@", "bb@x@y"]
    return {"first_name": some(names), "last_name": some(names), "email": some(mails), "postcode": some(codes), "city": some(["A", "B", "C", "dd"])}


@pytest.mark.parametrize("seed", range(6))
def test_no_pair_that_reaches_the_weight_is_dropped_and_few_others_are_kept(seed):
    model = MODEL if seed == 0 else model_of(np.random.default_rng(seed))
    people, n = _people(seed, 90), 90
    table = pa.table({c: pa.array(v, pa.string()) for c, v in people.items()})
    weights = [(c, model.weights(c.column)) for c in COMPARISONS]
    pairs = list(combinations(range(n), 2))
    total = dict.fromkeys(pairs, 0.0)
    for c, w in weights:
        values = people[c.column]
        similarity = _similarities([(values[i], values[j]) for i, j in pairs])
        for i, j in pairs:
            total[i, j] += w.get(_level(c, values[i], values[j], similarity), 0.0)
    for needed in np.quantile(list(total.values()), [0.05, 0.5, 0.9, 0.99]):
        hope = Hope(weights, needed)
        texts = hope.texts(table)
        every = np.arange(n)
        for left, right in ((every, every), (every[:40], every[40:])):
            same = left is right
            found = [tuple(sorted(p)) for i, j in hope.of_tile(texts, left, right, same) for p in zip(i.tolist(), j.tolist(), strict=True)]
            want = {p for p, w in total.items() if w >= needed and (same or p[0] < 40 <= p[1])}
            assert len(found) == len(set(found)) and want <= set(found)
        i, j = (np.array(x) for x in zip(*total, strict=True))
        a, b, places = hope.of_pairs(texts, i, j)
        kept = set(zip(a.tolist(), b.tolist(), strict=True))
        assert {p for p, w in total.items() if w >= needed} <= kept
        if seed == 0:  # with weights that grow with the levels; long postcodes are left open
            assert all(total[p] >= needed - 2e-3 or any(len(people["postcode"][x] or "") > 64 for x in p) for p in kept)
        assert (i[places] == a).all() and (j[places] == b).all()


@pytest.mark.parametrize("most", [1, 2, 3])
def test_edit_distances(most):
    rng = np.random.default_rng(most)
    words = ["".join(rng.choice(list("abé"), rng.integers(0, 9))) for _ in range(60)]
    texts = Texts(pa.array(words)).prepare()
    i, j = (x.ravel() for x in np.mgrid[:60, :60])
    found = _edits(texts, texts.code[i], texts, texts.code[j], most)
    assert found.tolist() == [min(_distance(words[a], words[b]), most + 1) for a, b in zip(i, j, strict=True)]


def _damaged(spark, n: int):
    """Records in blocks of many sizes; ids repeat and fields are missing."""
    people, rng = _people(7, n), np.random.default_rng(7)
    of = [[people[c.column][i // 3 if rng.random() < 0.8 else i] for c in COMPARISONS] for i in range(n)]
    frame = [(f"r{i % (n - 5):04d}" if i else None, *of[i], 1 + i % 3) for i in range(n)]
    names = ", ".join(f"{c.column} string" for c in COMPARISONS)
    return spark.createDataFrame(frame, f"record_id string, {names}, copies long").repartition(5)


@pytest.mark.parametrize(("tile_rows", "large_rows"), [(4096, 2), (10, 1), (3, 30)])
def test_graded_blocks_give_the_matches_of_the_listing(spark, monkeypatch, tile_rows, large_rows):
    units = with_helpers(_damaged(spark, 400)).cache()
    matches = lambda pairs: rows(pairs_above_threshold(score_pairs(compare_pairs(pairs), MODEL), THRESHOLD).select(*IDS, "copies_l", "copies_r"))
    want = matches(candidate_pairs(units, carry=[*carried_columns(), "copies"]))
    monkeypatch.setattr(agreement, "GRADED_TILE_ROWS", tile_rows)
    found = hopeful_pairs(units, MODEL, THRESHOLD, CANDIDATE_RULES, COMPARISONS, Scratch(spark, "test"), ["copies"], large_rows=large_rows)
    assert matches(found) == want and len(want) > 100


@pytest.mark.parametrize("most", [0, 10**6])
def test_graded_blocks_with_many_and_few_of_them(spark, monkeypatch, most):
    """Blocks that are too many to be broadcast meet their rows by key."""
    monkeypatch.setattr(agreement, "_BROADCAST_BLOCKS", most)
    units = _damaged(spark, 300)
    hope = Hope([(c, MODEL.weights(c.column)) for c in COMPARISONS], weight_needed(THRESHOLD) - MODEL.prior_weight)
    columns = [c.column for c in COMPARISONS]
    sizes = block_sizes(units, CANDIDATE_RULES).filter("n > 1")
    found = graded_pairs(units, sizes, hope, CANDIDATE_RULES, columns, "record_id", 16)
    listed = compare_pairs(candidate_pairs(with_helpers(units), carry=carried_columns()))
    want = pairs_above_threshold(score_pairs(listed, MODEL), THRESHOLD).select(*IDS)
    assert rows(want.exceptAll(found.select(*IDS))) == [] and want.count() > 50
    assert graded_pairs(units, sizes.filter("n < 0"), hope, CANDIDATE_RULES, columns, "record_id", 16) is None


def test_blocks_of_some_thousand_rows_are_not_joined_and_their_rows_go_out_once(spark, monkeypatch):
    """Joins on near values copy each row for every value near its own, which filled the disk."""
    monkeypatch.setattr(agreement, "agreeing_pairs", None)
    n = 1500
    units = spark.range(n).selectExpr(
        "lpad(id, 6, '0') as record_id", "concat('ba', hex(id % 97)) as first_name", "concat('lo', hex(id % 89)) as last_name",
        "concat(hex(id), '@x') as email", "'P1' as postcode", "concat('C', id % 20) as city",
    )
    found = hopeful_pairs(with_helpers(units), MODEL, THRESHOLD, CANDIDATE_RULES, COMPARISONS, Scratch(spark, "test"))
    listed = compare_pairs(candidate_pairs(with_helpers(units), carry=carried_columns()))
    want = pairs_above_threshold(score_pairs(listed, MODEL), THRESHOLD).select(*IDS)
    got = pairs_above_threshold(score_pairs(compare_pairs(found), MODEL), THRESHOLD).select(*IDS)
    assert rows(got) == rows(want) and not got.isEmpty()


def test_blocks_beyond_grading_are_joined(spark):
    units = with_helpers(_damaged(spark, 400)).cache()
    matches = lambda pairs: rows(pairs_above_threshold(score_pairs(compare_pairs(pairs), MODEL), THRESHOLD).select(*IDS))
    want = matches(candidate_pairs(units, carry=carried_columns()))
    found = hopeful_pairs(units, MODEL, THRESHOLD, CANDIDATE_RULES, COMPARISONS, Scratch(spark, "test"), large_rows=4, graded_rows=20)
    assert matches(found) == want
