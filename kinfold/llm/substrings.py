"""Removal of repeated word sequences by compressed full-text indexes.

A word goes if a window of ``length`` words that covers it starts earlier as well: in a document of smaller id, or
earlier in the same one. The first occurrence stays. Stretches of text that share an anchor (``anchors.py``) meet
in a shard. Its index is the Burrows-Wheeler transform of the stretches in a wavelet matrix: one bit vector for each bit
of a word's number, packed into 64-bit words with counts before them. Stretches stream against it: backward search
narrows the range of suffixes word by word, for all stretches at once, and stops where only the window itself is
left, from where the next window that can repeat follows. The least place in the range of a whole window tells
whether it starts earlier.

Words are compared by 64-bit hashes. Defined cases: a null text has no words; a text with fewer words than a window stays
whole; windows never cross texts; rows of one id are ordered by the hash of their text, so of repeated rows the first
stays; an empty table gives no rows; columns of ``docs`` other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from kinfold.llm.anchors import Symbols, covered, repeated_starts, texts_of, to_ranges
from kinfold.llm.common import Words, flat, map_batches, workspace

LENGTH = 20
GRAM = 8


class BitVector:
    """Bits in 64-bit words, with the number of set bits before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))[:-1]])
        self.ones = int(bits.sum())
        self.zeros = len(bits) - self.ones

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low).astype(np.int64)


class FmIndex:
    """Backward search over a text of numbers below ``sigma``; suffixes are ordered by their first ``depth`` numbers."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int):
        n = len(text)
        rank, step = text.astype(np.int64), 1
        while True:
            later = np.zeros(n, np.int64)
            later[: max(n - step, 0)] = rank[step:] + 1
            pair = rank * (max(n, sigma) + 2) + later
            self.suffixes = np.argsort(pair, kind="stable")
            step *= 2
            if step >= depth:
                break
            ordered = pair[self.suffixes]
            rank = np.empty(n, np.int64)
            rank[self.suffixes] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        column = text[self.suffixes - 1]  # the transform: what stands before each suffix
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.levels = []
        for bit in reversed(range(max(1, int(sigma - 1).bit_length()))):
            bits = (column >> bit & 1).astype(np.uint8)
            self.levels.append((bit, BitVector(bits)))
            column = np.concatenate([column[bits == 0], column[bits == 1]])
        # The last column is sorted by bit-reversed number; a number's run starts where rank 0 leads.
        self.start = self._descend(np.arange(sigma), np.zeros(sigma, np.int64))

    def _descend(self, number: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, vector in self.levels:
            ones = vector.rank(at)
            at = np.where(number >> bit & 1, vector.zeros + ones, at - ones)
        return at

    def extend(self, number: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that start with ``number`` and then what the given ranges start with."""
        both = self._descend(np.concatenate([number, number]), np.concatenate([low, high])) - np.tile(self.start[number], 2)
        return self.first[number] + both[: len(number)], self.first[number] + both[len(number) :]


def earlier_windows(text: np.ndarray, sigma: int, begin: np.ndarray, span: np.ndarray, where: np.ndarray, length: int) -> np.ndarray:
    """Starts in ``text`` whose window also starts at a place of smaller ``where``.

    Stretch ``i`` may start windows from ``begin[i]`` to ``begin[i] + span[i]``.
    """
    index = FmIndex(text, sigma, length)
    place = np.append(where[index.suffixes], np.iinfo(np.int64).max)
    now, last = begin.copy(), begin + span
    found = []
    while True:
        live = np.flatnonzero(now <= last)
        if not len(live):
            return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        at = now[live]
        low, high = np.zeros(len(live), np.int64), np.full(len(live), len(text))
        for back in range(length - 1, -1, -1):
            low, high = index.extend(text[at + back], low, high)
            alone = high - low <= 1
            # Every window over this part is alone as well: go on behind its first word.
            now[live[alone]] = at[alone] + back + 1
            live, at, low, high = live[~alone], at[~alone], low[~alone], high[~alone]
            if not len(live):
                break
        if len(live):
            least = np.minimum.reduceat(place, np.stack([low, high], 1).reshape(-1))[::2]
            found.append(at[least < where[at]])
            now[live] = at + 1


def _shard(length: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "copy", "place"])
        symbols = [np.frombuffer(c, np.uint64) for c in rows["content"]]
        sizes = np.array([len(s) for s in symbols], np.int64)
        known, number = np.unique(np.concatenate(symbols), return_inverse=True)
        # A 0 ends each stretch.
        begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        text = np.zeros(int((sizes + 1).sum()), np.int64)
        of = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.arange(len(number)) + of
        text[inside] = number + 1
        # Where a word stands in the corpus: its document's turn, then its place.
        turn = (rows[["key", "copy"]] != rows[["key", "copy"]].shift()).any(axis=1).cumsum().to_numpy()
        at = (rows["place"].to_numpy() >> 16) + (turn.astype(np.int64) << 36)
        where = np.zeros(len(text), np.int64)
        where[inside] = at[of] + inside - begin[of]
        hits = earlier_windows(text, len(known) + 1, begin, sizes - length, where, length)
        cut = np.searchsorted(hits, np.append(begin, len(text)))
        ranges = [to_ranges(hits[cut[i] : cut[i + 1]] - begin[i]) for i in range(len(sizes))]
        out = pd.DataFrame({"h": rows["h"].to_numpy(), "f": rows["f"].to_numpy(), "ranges": ranges})
        return out[out["ranges"].str.len() > 0]

    return run


def _remove(length: int):
    def make(batch: pa.RecordBatch) -> dict:
        data, offsets = flat(batch.column("text"))
        words = Words(data, offsets)
        raw = data.tobytes()
        out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept", "removed")}
        for i, ranges in enumerate(batch.column("ranges").to_pylist()):
            a, b = int(words.bounds[i]), int(words.bounds[i + 1])
            gone = covered(ranges or [], length, b - a)
            stay = np.flatnonzero(~gone) + a
            kept = b" ".join([raw[x:y] for x, y in zip(words.starts[stay].tolist(), words.ends[stay].tolist(), strict=True)])
            out["n_words"].append(b - a)
            out["n_removed"].append(int(gone.sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept.decode())
            out["removed"].append(to_ranges(np.flatnonzero(gone)))
        return {"doc_id": batch.column("doc_id"), "copy": batch.column("copy")} | out

    return make


def remove_repeated_words(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row: ``doc_id``, ``copy``, word counts, ``kept_sha256``, the ``kept`` text and the ``removed`` word ranges."""
    if not gram <= length <= gram + 255:
        raise ValueError("length must be from gram to gram + 255")
    scratch = workspace(docs.sparkSession, "substrings")
    texts = texts_of(scratch, docs)
    found = repeated_starts(scratch, texts, Symbols("words", length, gram), _shard(length), keep_first=True)
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, copy int, n_words long, n_removed long, kept_sha256 string, kept string, removed array<struct<first:int,last:int>>"
    return map_batches(found, _remove(length), ddl)
