"""The manifest against a plain tree, on repeated ids, copies, nulls and groups of several arrays."""

from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from kinfold.llm.merkle import manifest

from .conftest import DOC, ROWS


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _leaf(row: tuple) -> str:
    doc_id, text, lang, source, n_chars = row
    values = ("" if v is None else str(v) for v in (doc_id, source, lang, n_chars, text))
    return _h("".join("-" if raw is None else f"{len(v.encode())}:{v}" for raw, v in zip((doc_id, source, lang, n_chars, text), values, strict=True)))


def _tree(nodes: list[str]) -> tuple[str, list[list[str]]]:
    """Root of a list of nodes, and the siblings (before, after) of each of them, level by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, p in enumerate(at):
            run = p - p % 8
            paths[i].append(("".join(level[run:p]), "".join(level[p + 1 : run + 8])))
            at[i] = p // 8
        level = [_h("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
    return level[0], paths


def plain(rows: list[tuple], fresh=lambda r: r) -> list[tuple]:
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    # Rows of one id in order of their leaf, rows without id first.
    members = [sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r))) for x in langs]
    trees = [_tree([_leaf(r) for r in own]) for own in members]
    root, upper = _tree([t[0] for t in trees])
    out = []
    for own, (subroot, paths), above in zip(members, trees, upper, strict=True):
        for r, path in zip(own, paths, strict=True):
            folded = _leaf(fresh(r))
            for before, after in path + above:
                folded = _h(before + folded + after)
            out.append((r[0], _leaf(r), subroot, root, _h("".join(a + b for a, b in path + above)), folded, folded == root))
    return sorted(map(str, out))


def _found(frame, **kwargs) -> list[str]:
    return sorted(str(tuple(r)) for r in manifest(frame, **kwargs).collect())


def test_odd_rows(spark, docs, empty):
    assert _found(docs.withColumns({"grp": F.lit(3), "leaf": F.lit("x"), "total": F.lit(None)})) == plain(ROWS)
    out = manifest(empty)
    assert out.count() == 0 and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_one_row(spark):
    row = (7, "a", None, None, None)
    assert _found(spark.createDataFrame([row], DOC)) == plain([row])
    assert _leaf(row) == _h("1:7---1:a")


@pytest.mark.parametrize("spread", [1, 7919, 2**49 + 12345])
def test_groups_of_several_arrays(spark, spread):
    big = 2**62
    rows = [((i - 2500) * spread % big - big // 2, f"Text {i}", "en" if i % 5 else "fr", "s", i) for i in range(6000)]
    lower = F.when(F.col("n_chars") % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    want = plain(rows, lambda r: (r[0], r[1].lower(), *r[2:]) if r[4] % 3 == 0 else r)
    assert _found(spark.createDataFrame(rows, DOC), fresh={"text": lower}) == want


def test_a_third_of_the_rows_share_an_id(spark):
    rows = [(i, f"own {i}", "en", "a", i) for i in range(3000)]
    rows += [(77, f"same id {i % 600}", "en", "a", 0) for i in range(1500)]  # several leaves, some of them repeated
    rows += [(None, "no id, one text", "en", "a", 0)] * 5000  # copies over more than one array
    rows += [(None, f"no id {i}", None, "b", None) for i in range(40)] + [(5, "x", "", "a", 1)] * 9
    assert _found(spark.createDataFrame(rows, DOC).repartition(7)) == plain(rows)
