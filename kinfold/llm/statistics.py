"""Counts that describe a text, for a batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from kinfold.llm.common import Words, flat, grams, hash_spans, mix, total_in

#: Bytes of the characters that count as symbols.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_CONTINUES = np.zeros(256, bool)
_CONTINUES[0x80:0xC0] = True

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct_words", "n_stops",
)
DDL = ", ".join(f"{c} long" for c in COUNTS)


def _with_text(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix(keys + (doc.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def repeated_words(hashes: np.ndarray, words: Words, n: int = 3) -> np.ndarray:
    """Whether each word is in a run of ``n`` words that its text holds twice or more."""
    found, at = grams(hashes, words.bounds, n)
    _, place, times = np.unique(_with_text(found, words.doc[at]), return_inverse=True, return_counts=True)
    again = at[times[place] > 1]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + n, -1)
    return np.cumsum(cover)[:-1] > 0


def _lines(data: np.ndarray, offsets: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and lines equal to an earlier one among them, of each text."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1][offsets[1:] > offsets[:-1]], breaks + 1]))
    starts = np.unique(starts[starts < len(data)])
    if not len(starts) or not len(words.starts):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    ends = np.append(starts[1:], len(data))
    ends = ends - (data[ends - 1] == 0x0A)
    has = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has], ends[has]
    doc = np.searchsorted(offsets, starts, "right") - 1
    total = np.bincount(doc, minlength=n)
    _, first = np.unique(_with_text(hash_spans(data, starts, ends - starts), doc), return_index=True)
    return total, total - np.bincount(doc[first], minlength=n)


def counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for each text of an Arrow column."""
    data, offsets = flat(column)
    words = Words(data, offsets)
    hashes = words.hashes()
    lines, copies = _lines(data, offsets, words)
    _, first = np.unique(_with_text(hashes, words.doc), return_index=True)
    letters_only = words.inside & ~_CONTINUES[data]
    stop = _LETTER[data[words.ends - 1]] if len(words.ends) else np.zeros(0, bool)
    return {
        "n_words": words.count,
        "word_chars": total_in(letters_only, offsets),
        "n_symbols": total_in(_SYMBOL[data], offsets),
        "n_dup_lines": copies,
        "n_repeat_words": total_in(repeated_words(hashes, words), words.bounds),
        "n_lines": lines,
        "n_upper": total_in(_UPPER[data], offsets),
        "n_digits": total_in(_DIGIT[data], offsets),
        "n_marks": total_in(words.inside & ~_LETTER[data] & ~_DIGIT[data], offsets),
        "n_distinct_words": np.bincount(words.doc[first], minlength=len(offsets) - 1),
        "n_stops": total_in(~stop, words.bounds),
    }
