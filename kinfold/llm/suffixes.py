"""Removal of repeated byte strings by suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts elsewhere, in any text, goes; all occurrences go, as
strings are judged on the input. Stretches of text that share an anchor (``anchors.py``) meet in a shard, which sorts
their suffixes in two stages. A suffix that is smaller than its successor, or starts with the same byte, is sorted
directly. A larger one starts with a greater byte than its successor, so a scan of the buckets of first bytes in rising
order finds the larger ones in their order. Neighbours in the array with a common prefix of ``length`` bytes repeat.

Defined cases: a null text is empty; a text shorter than ``length`` stays whole; matches never cross texts; a repeated
row is an occurrence of its own, so both lose their text; an empty table gives no rows; columns of ``docs`` other
than ``doc_id`` and ``text`` are not read. A cut inside a character leaves bytes, which
``kept`` holds as they are and ``kept_text`` leaves out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from kinfold.llm.anchors import Symbols, covered, repeated_starts, texts_of, to_ranges
from kinfold.llm.common import flat, map_batches, workspace

LENGTH = 200
GRAM = 32
#: Strings that are sorted at a time.
SORTED = 100_000


def sorted_directly(text: np.ndarray, ends: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``at`` in the order of their strings' first ``depth`` bytes, equal ones as they come.

    Strings exist for a share of ``SORTED`` positions at a time: positions are first ordered by eight bytes, those of a
    larger group of equal ones by the next eight.
    """
    raw, out = text.tobytes(), []
    wide = np.concatenate([text, np.zeros(8, np.uint8)])
    waiting = [(at, 0)]
    while waiting:
        at, done = waiting.pop()
        if len(at) <= SORTED:
            stops = np.minimum(at + depth, ends[at]).tolist()
            keys = [raw[a:b] for a, b in zip(at.tolist(), stops, strict=True)]
            out.append(at[np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)])
            continue
        left = np.minimum(at + depth, ends[at]) - (at + done)
        if (left <= 0).all():
            out.append(at)  # equal to their ends
            continue
        # The next eight bytes as a number, behind the end zeros; an ended string comes first.
        word = np.zeros(len(at), np.uint64)
        for i in range(8):
            word = word << np.uint64(8) | np.where(left > i, wide[np.minimum(at + done + i, len(text))], 0).astype(np.uint64)
        order = np.lexsort((np.clip(left, 0, 8), word))
        at, word, left = at[order], word[order], np.clip(left, 0, 8)[order]
        edges = np.concatenate([[0], np.flatnonzero((word[1:] != word[:-1]) | (left[1:] != left[:-1])) + 1, [len(at)]])
        parts, first = [], 0
        while first < len(edges) - 1:
            last = max(first + 1, int(np.searchsorted(edges, edges[first] + SORTED, "right")) - 1)
            parts.append((at[edges[first] : edges[last]], done + 8))
            first = last
        waiting += reversed(parts)
    return np.concatenate(out) if out else at


def suffix_order(text: np.ndarray, ends: np.ndarray, needed: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``needed`` in the order of their first ``depth`` bytes.

    ``ends`` gives the end of each position's string; a needed position that is larger than its successor needs
    that as well.
    """
    n = len(text)
    after = np.append(text[1:], 0)
    larger = (text > after) & (np.arange(n) + 1 < ends)
    direct = sorted_directly(text, ends, np.flatnonzero(needed & ~larger), depth)
    cut = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for byte in range(256):
        bucket = np.concatenate([*waiting[byte], direct[cut[byte] : cut[byte + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[needed[before] & larger[before]]
        first = text[before]
        order = np.argsort(first, kind="stable")
        before, edges = before[order], np.searchsorted(first[order], np.arange(257))
        for b in np.unique(first):
            waiting[b].append(before[edges[b] : edges[b + 1]])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int, block: int = 20_000) -> np.ndarray:
    """Length of the common prefix, ``depth`` at most, of each position and the next in order."""
    out = np.zeros(max(len(order) - 1, 0), np.int64)
    reach = np.arange(depth)
    for i in range(0, len(out), block):
        a, b = order[i : i + block], order[i + 1 : i + 1 + block]
        a = a[: len(b)]
        differ = text[a[:, None] + reach] != text[b[:, None] + reach]
        out[i : i + len(b)] = np.where(differ.any(1), differ.argmax(1), depth)
    return out


def _shard(length: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "f"])
        content = list(rows["content"])
        sizes = np.array([len(c) for c in content], np.int64)
        text = np.frombuffer(b"".join(content), np.uint8)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        span = sizes - length
        ends = np.repeat(begin + sizes, sizes)
        of = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(text)) - begin[of]
        asked = place <= span[of]
        # A start may need the positions after it up to the next one that is sorted directly.
        larger = (text > np.append(text[1:], 0)) & (np.arange(len(text)) + 1 < ends)
        direct = np.flatnonzero(~larger)
        until = direct[np.searchsorted(direct, begin + span)]
        needed = np.arange(len(text)) <= until[of]
        order = suffix_order(text, ends, needed, length)
        order = order[asked[order]]
        again = common_prefixes(text, order, length) >= length
        repeated = np.zeros(len(text), bool)
        repeated[order[:-1][again]] = True
        repeated[order[1:][again]] = True
        hits = np.flatnonzero(repeated)
        cut = np.searchsorted(hits, np.append(begin, len(text)))
        ranges = [to_ranges(hits[cut[i] : cut[i + 1]] - begin[i]) for i in range(len(sizes))]
        out = pd.DataFrame({"h": rows["h"].to_numpy(), "f": rows["f"].to_numpy(), "ranges": ranges})
        return out[out["ranges"].str.len() > 0]

    return run


def _remove(length: int):
    def make(batch: pa.RecordBatch) -> dict:
        data, offsets = flat(batch.column("text"))
        out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text", "removed")}
        for i, ranges in enumerate(batch.column("ranges").to_pylist()):
            own = data[offsets[i] : offsets[i + 1]]
            gone = covered(ranges or [], length, len(own))
            kept = own[~gone].tobytes() if ranges else own.tobytes()
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            out["n_bytes"].append(len(own))
            out["n_removed"].append(len(own) - len(kept))
            out["n_spans"].append(len(edges) // 2)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept)
            out["kept_text"].append(kept.decode("utf-8", "ignore"))
            out["removed"].append([{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)])
        return {c: batch.column(c) for c in ("doc_id", "copy", "carried")} | out

    return make


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: ``doc_id``, ``copy``, sizes, ``kept_sha256``, the ``kept`` bytes and the ``removed`` byte ranges.

    Columns of ``docs`` in ``carry`` come along in the struct ``carried``.
    """
    if not gram <= length <= gram + 255:
        raise ValueError("length must be from gram to gram + 255")
    scratch = workspace(docs.sparkSession, "suffixes")
    texts = texts_of(scratch, docs, carry)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = repeated_starts(scratch, texts, Symbols("bytes", length, gram), _shard(length), keep_first=False)
    carried = texts.schema["carried"].dataType.simpleString()
    ddl = f"doc_id {kind}, copy int, carried {carried}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, kept_text string, removed array<struct<first:int,last:int>>"
    return map_batches(found, _remove(length), ddl)
