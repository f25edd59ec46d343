"""Aligned tokens against a plain version that works byte by byte."""

from __future__ import annotations

import json
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import kinfold.llm.alignment as alignment
from kinfold.llm.alignment import align, coalesce, overlaps
from kinfold.llm.packing import _byte_of
from kinfold.llm.queries import PIECES, vocabulary

from .conftest import ROWS, SF_DIR


def _tokens():
    a = Tokenizer.from_file(vocabulary())
    a.encode_special_tokens = True
    byte_of = _byte_of()
    with open(vocabulary()) as f:
        bytes_a = {i: bytes(byte_of[c] for c in t) for t, i in json.load(f)["model"]["vocab"].items() if not t.startswith("<|")}
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))

    def both(text):
        if not text:
            return [], []
        left = [(i, bytes_a[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        same = b"".join(x for _, x in left) == raw == b"".join(x for _, x in right)
        return (left, right) if same else ([], [])

    return both


def plain(rows: list[tuple]) -> list[tuple]:
    both, links, out = _tokens(), Counter(), []
    for doc_id, text in rows:
        sides = both(text)
        owner, ends = [], []
        for tokens in sides:
            owner.append([k for k, (_, raw) in enumerate(tokens) for _ in raw])
            ends.append(set(np.cumsum([len(raw) for _, raw in tokens]).tolist()))
        pairs = sorted(set(zip(*owner, strict=True)))
        cuts = sorted(ends[0] & ends[1])
        groups, at = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(tokens[k][0]) for k in dict.fromkeys(own[at:cut])) for tokens, own in zip(sides, owner, strict=True)))
            at = cut
        own = [(sides[0][x][0], sides[1][y][0]) for x, y in pairs]
        links.update(own)
        out.append((doc_id, len(sides[0]), len(sides[1]), len(groups), own, sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most: dict = {}
    for (_, y), n in links.items():
        most[y] = max(most.get(y, 0), n)
    return sorted(
        str((i, a, b, g, len(own), sum(links[p] == most[p[1]] for p in own), sum(links[p] for p in own), h)) for i, a, b, g, own, h in out
    )


def _found(frame) -> list[str]:
    return sorted(str(tuple(r)) for r in align(frame, vocabulary(), vocabulary(PIECES)).collect())


def test_documents(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet' order by doc_id limit 120").fetchall()
    assert _found(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == plain(rows)


def test_odd_rows(spark, docs, empty):
    odd = ["<|endoftext|> x</s><s>", "<0x41> <unk>", "a▁b", "日本語 and 𝒳 \U0001f600‍", "a" * 500, "\x00\x01", " ", "\n\n  x \t", "é́ ﬁ ①", "it's 'sx don't", "naïve Straße  "]
    rows = [(i, t) for i, t, *_ in ROWS] + [(100 + i, t) for i, t in enumerate(odd)] + [(2**60, "third"), (2**60, "third")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"chunk": F.lit("x"), "n_a": F.lit(None), "pairs": F.lit(1)})
    found = _found(frame)
    assert found == plain(rows) and sum(", 0, 0, 0, 0, 0, 0, ''" in r for r in found) >= 2
    assert align(empty, vocabulary(), vocabulary(PIECES)).count() == 0


def test_chunks_count_together(spark, monkeypatch):
    rows = [(i, f"the cat number {i % 7} sat on the mat" + " and slept" * (i % 4)) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = plain(rows)
    assert _found(frame) == want
    monkeypatch.setattr(alignment, "OUT_ROWS", 7)
    assert _found(frame.coalesce(1)) == want


@pytest.mark.parametrize("seed", range(5))
def test_groups_and_links_of_random_intervals(seed):
    rng = np.random.default_rng(seed)
    ends = [np.unique(np.append(rng.integers(1, 200, rng.integers(1, 80)), 200)) for _ in range(2)]
    (ea, sa), (eb, sb) = ((e, np.append(0, e[:-1])) for e in ends)
    ga, gb = coalesce(sa, ea, sb, eb)
    common = sorted(set(ea.tolist()) & set(eb.tolist()))
    assert ga.tolist() == np.searchsorted(common, sa, "right").tolist() and gb.tolist() == np.searchsorted(common, sb, "right").tolist()
    left, right = overlaps(sa, ea, sb, eb)
    want = [(i, j) for i in range(len(sa)) for j in range(len(sb)) if sa[i] < eb[j] and sb[j] < ea[i]]
    assert list(zip(left.tolist(), right.tolist(), strict=True)) == want
