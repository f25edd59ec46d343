"""Order of suffixes in bounded parts."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

import kinfold.llm.suffixes as suffixes
from kinfold.llm.anchors import STRETCH_BYTES, Symbols, _hashes
from kinfold.llm.suffixes import sorted_directly


@settings(deadline=None)
@given(st.lists(st.text(st.sampled_from("ab\0\xff"), min_size=1, max_size=40).map(lambda t: t.encode("latin-1")), min_size=1, max_size=12), st.integers(1, 30), st.integers(1, 9))
def test_order_of_positions(contents, depth, share):
    text = np.frombuffer(b"".join(contents), np.uint8)
    ends = np.repeat(np.cumsum([len(c) for c in contents]), [len(c) for c in contents])
    at = np.flatnonzero(np.arange(len(text)) % 3 != 1)
    raw = text.tobytes()
    want = sorted(at.tolist(), key=lambda i: raw[i : min(i + depth, ends[i])])
    before, suffixes.SORTED = suffixes.SORTED, share
    try:
        assert sorted_directly(text, ends, at, depth).tolist() == want
    finally:
        suffixes.SORTED = before


def _peak(call) -> int:
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_a_shard_is_bounded():
    # The strings of all positions at once would take 233 bytes each.
    text = np.random.default_rng(2).integers(97, 123, 600_000).astype(np.uint8)
    ends, every = np.full(len(text), len(text)), np.ones(len(text), bool)
    assert _peak(lambda: suffixes.suffix_order(text, ends, every, 200)) < 150 * len(text)


def test_memory_of_anchors_follows_a_part_of_the_batch():
    texts = np.random.default_rng(3).integers(97, 123, 3_000_000).astype(np.uint8).tobytes().decode()
    rows = [texts[i : i + 6_000] for i in range(0, len(texts), 6_000)]
    batch, run = pa.record_batch({"text": rows}), _hashes(Symbols("bytes", 200, 32))
    assert _peak(lambda: list(run(iter([batch])))) < 150 * STRETCH_BYTES
