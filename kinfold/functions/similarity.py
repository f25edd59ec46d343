"""Jaro-Winkler similarity for columns of string pairs.

Spark has no such function. An Arrow UDF computes it for a whole batch with numpy, by character. It is
only asked about pairs that can reach the wanted value: `may_reach` bounds the result on the JVM side
from lengths and sets of characters, so most unrelated pairs never need it.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX_WEIGHT = 0.1
PREFIX_LENGTH = 4
BOOST_ABOVE = 0.7
_WORD = 64  # matched positions of one string fit into one 64-bit mask
_CELLS = 2_000_000  # size of the largest temporary array
_PAD_LEFT, _PAD_RIGHT = 0xFFFFFFFF, 0xFFFFFFFE  # no code points, and not equal to each other
_SLACK = 1e-9  # keeps a bound safe against rounding
_DIGITS = 12  # equal ratios stay equal however their sums were rounded


def _codepoints(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of null-free texts, one text after the other, and the offset of each text."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = data.to_pybytes()[ends[0] : ends[-1]] if data else b""
    if raw.isascii():
        codes = np.frombuffer(raw, dtype=np.uint8)
    else:
        codes = np.frombuffer(raw.decode().encode("utf-32-le"), dtype=np.uint32)
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    return codes, np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


def _grid(data: np.ndarray, offsets: np.ndarray, rows: np.ndarray, width: int, fill: int) -> np.ndarray:
    start, length = offsets[rows], offsets[rows + 1] - offsets[rows]
    place = np.arange(width)
    at = np.minimum(start[:, None] + place, len(data) - 1)
    return np.where(place < length[:, None], data[at], data.dtype.type(fill & np.iinfo(data.dtype).max))


def _in_order(chars: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Taken characters of every row moved to its front, zero behind them."""
    out = np.zeros_like(chars)
    row, col = np.nonzero(taken)
    out[row, (np.cumsum(taken, axis=1) - 1)[row, col]] = chars[row, col]
    return out


def _coded(data_a: np.ndarray, data_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Characters as numbers from 0 on, and how many different ones there are."""
    used = np.zeros(max(data.max(initial=0) for data in (data_a, data_b)) + 1, dtype=bool)
    used[data_a] = used[data_b] = True
    code = np.cumsum(used, dtype=np.int32) - 1
    return code.take(data_a), code.take(data_b), int(code[-1]) + 1


def _jaro_short(
    a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray, codes: int, least: float
) -> np.ndarray:
    """Jaro similarity of pairs of texts at most 64 characters long and not empty.

    ``a`` and ``b`` hold texts as `_coded`, with padding of their own; ``of_a`` and ``of_b`` are the texts of each pair.
    Pairs that cannot reach a Jaro-Winkler similarity of ``least`` with their matches have 0.
    """
    rows, width = len(of_a), a.shape[1]
    # Positions of each character in each left text, as bits.
    places = np.zeros(len(a) * (codes + 2), dtype=np.uint64)
    for k, at in enumerate(np.ascontiguousarray(a.T) + np.arange(len(a)) * (codes + 2)):
        places[at] = places.take(at) | np.uint64(1 << k)
    start, right = of_a * (codes + 2), np.ascontiguousarray(b.T).astype(np.int64)
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
    # below[k] has the k lowest bits set
    below = np.array([(1 << k) - 1 for k in range(_WORD + 1)], dtype=np.uint64)
    reaches = np.arange(_WORD // 2)
    zero = np.uint64(0)
    free = np.full(rows, ~zero)
    taken_b = np.zeros((width, rows), dtype=bool)
    for j in range(width):
        window = below[np.minimum(j + reaches + 1, _WORD)] & ~below[np.maximum(j - reaches, 0)]
        at = right[j].take(of_b)
        at += start
        hits = places.take(at)
        hits &= free
        hits &= window.take(reach)
        hits &= np.negative(hits)  # the lowest bit
        free ^= hits
        np.not_equal(hits, zero, out=taken_b[j])
    matches = taken_b.sum(axis=0, dtype=np.uint8)
    best = (matches / len_a + matches / len_b + 1.0) / 3.0
    head_a, head_b = a[:, :PREFIX_LENGTH].T, b[:, :PREFIX_LENGTH].T
    equal, boost = np.ones(rows, dtype=bool), np.zeros(rows)
    for x, y in zip(head_a, head_b, strict=True):
        equal &= x.take(of_a) == y.take(of_b)
        boost += PREFIX_WEIGHT * equal
    best = np.where(best > BOOST_ABOVE, best + boost * (1.0 - best), best)
    wanted = np.flatnonzero(best >= least - _SLACK)
    used = np.ascontiguousarray(~free[wanted], dtype="<u8").view(np.uint8).reshape(len(wanted), 8)
    taken_a = np.unpackbits(used, axis=1, bitorder="little")[:, :width].astype(bool)
    out = np.zeros(rows)
    out[wanted] = _score(a[of_a[wanted]], b[of_b[wanted]], taken_a, np.ascontiguousarray(taken_b[:, wanted].T), len_a[wanted], len_b[wanted])
    return out


def _score(
    a: np.ndarray, b: np.ndarray, taken_a: np.ndarray, taken_b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray
) -> np.ndarray:
    """Jaro similarity from the matched characters of both sides."""
    matches = taken_b.sum(axis=1)
    swapped = (_in_order(a, taken_a) != _in_order(b, taken_b)).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (matches / len_a + matches / len_b + (matches - swapped) / matches) / 3.0
    return np.where(matches > 0, score, 0.0)


def _jaro_long(a: np.ndarray, b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray) -> np.ndarray:
    """Jaro similarity of row pairs of any length: the matched positions of a row take several 64-bit words.

    One step handles a character of every row; the lowest free hit of a row lies in its first word that has one.
    """
    rows, width = a.shape
    words = -(-width // _WORD)
    every, first_bit = np.arange(rows), np.arange(words) * _WORD
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)[:, None]
    below = np.array([(1 << k) - 1 for k in range(_WORD + 1)], dtype=np.uint64)
    free = np.full((rows, words), ~np.uint64(0))
    taken_b = np.zeros((rows, width), dtype=bool)
    same = np.zeros((rows, words * _WORD), dtype=bool)
    for j in range(width):
        np.equal(a, b[:, j : j + 1], out=same[:, :width])
        where = np.packbits(same, axis=1, bitorder="little").view("<u8")
        window = below[np.clip(j + reach + 1 - first_bit, 0, _WORD)] & ~below[np.clip(j - reach - first_bit, 0, _WORD)]
        hits = where & free & window
        word = (hits != 0).argmax(axis=1)
        own = hits[every, word]
        first = own & (~own + np.uint64(1))
        free[every, word] &= ~first
        taken_b[:, j] = first != 0
    used = np.ascontiguousarray(~free, dtype="<u8").view(np.uint8).reshape(rows, -1)
    taken_a = np.unpackbits(used, axis=1, bitorder="little")[:, :width].astype(bool)
    return _score(a, b, taken_a, taken_b, len_a, len_b)


def jaro_winkler_batch(left: pa.Array, right: pa.Array, least: float = 0.0) -> np.ndarray:
    """Similarity of null-free text pairs; 0 where a side is empty, and maybe where it is below ``least``."""
    # Texts of a block come up in many pairs: each is prepared once, and equal pairs are compared once.
    left, right = left.dictionary_encode(), right.dictionary_encode()
    pair = left.indices.to_numpy().astype(np.int64) * len(right.dictionary) + right.indices.to_numpy()
    pairs, own = np.unique(pair, return_inverse=True)
    of_a, of_b = np.divmod(pairs, max(len(right.dictionary), 1))
    data_a, off_a = _codepoints(left.dictionary)
    data_b, off_b = _codepoints(right.dictionary)
    if data_a.dtype != data_b.dtype:
        data_a, data_b = data_a.astype(np.uint32), data_b.astype(np.uint32)
    len_a, len_b = np.diff(off_a)[of_a], np.diff(off_b)[of_b]
    longest = np.maximum(len_a, len_b)
    score = np.zeros(len(len_a))
    filled = (len_a > 0) & (len_b > 0)
    short = np.flatnonzero(filled & (longest <= _WORD))
    code_a, code_b, codes = _coded(data_a, data_b)
    # Pairs of similar length share a grid as wide as its longest text.
    for band in range(0, _WORD, 8):
        in_band = short[(longest[short] > band) & (longest[short] <= band + 8)]
        step = max(1, _CELLS // (codes + 2 + 2 * (band + 8)))
        for at in range(0, len(in_band), step):
            rows = in_band[at : at + step]
            texts_a, at_a = np.unique(of_a[rows], return_inverse=True)
            texts_b, at_b = np.unique(of_b[rows], return_inverse=True)
            a = _grid(code_a, off_a, texts_a, band + 8, codes)
            b = _grid(code_b, off_b, texts_b, band + 8, codes + 1)
            score[rows] = _jaro_short(a, b, at_a, at_b, len_a[rows], len_b[rows], codes, least)
    long, width = np.flatnonzero(filled & (longest > _WORD)), 2 * _WORD
    while len(long):
        in_band = long[longest[long] <= width]
        step = max(1, _CELLS // width)
        for at in range(0, len(in_band), step):
            rows = in_band[at : at + step]
            own_width = int(longest[rows].max())
            a = _grid(data_a, off_a, of_a[rows], own_width, _PAD_LEFT)
            b = _grid(data_b, off_b, of_b[rows], own_width, _PAD_RIGHT)
            score[rows] = _jaro_long(a, b, len_a[rows], len_b[rows])
        long, width = long[longest[long] > width], 2 * width
    rows = np.flatnonzero(score > BOOST_ABOVE)
    heads_a = _grid(data_a, off_a, of_a[rows], PREFIX_LENGTH, _PAD_LEFT)
    heads_b = _grid(data_b, off_b, of_b[rows], PREFIX_LENGTH, _PAD_RIGHT)
    prefix = np.cumprod(heads_a == heads_b, axis=1).sum(axis=1)
    score[rows] += prefix * PREFIX_WEIGHT * (1.0 - score[rows])
    return np.round(score, _DIGITS)[own]


def jaro_winkler_arrow(left: pa.Array, right: pa.Array, least: float = 0.0) -> pa.Array:
    """Similarity of text pairs; null where a side is null, and maybe 0 where it is below ``least``."""
    both = pc.and_(left.is_valid(), right.is_valid())
    out = np.full(len(left), np.nan)
    asked = np.flatnonzero(both.to_numpy(zero_copy_only=False))
    if len(asked):
        out[asked] = jaro_winkler_batch(left.filter(both), right.filter(both), least)
    return pa.array(out, type=pa.float64(), mask=np.isnan(out))


def jaro_winkler_from(least: float):
    """Similarity of two text columns that may be 0 where it is below ``least``, which saves work."""

    def similarity(left: pa.Array, right: pa.Array) -> pa.Array:
        return jaro_winkler_arrow(left, right, least)

    # Declared non-deterministic so that a filter on a level does not make Spark compute it twice.
    return F.arrow_udf(similarity, DoubleType()).asNondeterministic()


def bound_helpers(name: str, text: str) -> dict[str, str]:
    """SQL of the columns that `may_reach` needs for a text: its length and its characters.

    The characters are a 64-bit set of first and second occurrences. They fall into 32 classes; bit p says
    that class p occurs, bit p + 32 that it occurs twice.
    """
    place = "pmod(ascii(c), 32)"
    again = f"if(bits & shiftleft(1L, {place}) != 0, 32, 0)"
    # split() ends in an empty string, which is no character
    chars = f"filter(split({text}, ''), c -> c != '')"
    return {
        f"_size_{name}": f"cast(length({text}) as double)",
        f"_chars_{name}": f"aggregate({chars}, 0L, (bits, c) -> bits | shiftleft(1L, {place} + {again}))",
    }


def open_bounds(name: str) -> dict[str, str]:
    """The columns of `bound_helpers` with values that rule no similarity out."""
    return {f"_size_{name}": "1D", f"_chars_{name}": "0L"}


def may_reach(name: str, jaro_winkler_at_least: float) -> str:
    """SQL that is false only if ``<name>_l`` and ``<name>_r`` are less similar than wanted.

    A character without a counterpart stays unmatched, so the number of matches m is at most either length
    less the occurrences in its set that the other set lacks, and the Jaro similarity is at most
    (m / a + m / b + 1) / 3 for lengths a and b. Different first characters rule the prefix boost out;
    otherwise the full one is assumed.
    """
    boost = PREFIX_LENGTH * PREFIX_WEIGHT
    boosted = max(BOOST_ABOVE, (jaro_winkler_at_least - boost) / (1.0 - boost))
    boosted = min(boosted, jaro_winkler_at_least)
    a, b, in_a, in_b = (f"_{part}_{name}_{side}" for part in ("size", "chars") for side in "lr")
    matches = f"least({a} - bit_count({in_a} & ~{in_b}), {b} - bit_count({in_b} & ~{in_a}))"
    factor = [f"{3 * (needed - _SLACK) - 1}D" for needed in (boosted, jaro_winkler_at_least)]
    needed = f"if(ascii({name}_l) = ascii({name}_r), {factor[0]}, {factor[1]})"
    return f"{matches} * ({a} + {b}) >= {needed} * {a} * {b}"
