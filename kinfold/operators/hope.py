"""Which pairs of a block can match, found over whole blocks in numpy instead of by listing their pairs in a join.

Every comparison has a bound on the weight that a pair can get from it:

* over all pairs of a tile, from numbers of its distinct values: equal or not, and for names how many characters two
  texts can have in common at most;
* for the pairs that these leave, one comparison after the other, from the levels themselves.

A pair is dropped as soon as its bounds cannot reach the weight that the threshold needs, so no match is lost. The pairs
of a tile exist only as a few thousand rows of a grid at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from kinfold.functions.similarity import BOOST_ABOVE, PREFIX_LENGTH, PREFIX_WEIGHT, _codepoints, jaro_winkler_batch
from kinfold.operators import comparison as _comparison
from kinfold.operators.comparison import Comparison, EditTiers, EmailTiers, NameTiers, Tier

# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(_comparison)

_SLACK = 1e-9
_SUM_SLACK = 1e-3  # weights are added in single precision
_CELLS = 200_000  # pairs of a tile that are bounded at a time
_HELD_PAIRS = 200_000  # pairs that are graded at a time
_HELD_ROWS = 16_384  # rows of whole tiles that are prepared at a time
_BINS = 128  # of the common characters' share
_EDIT_LENGTH = 64
#: A similarity takes as long as the bounds of so many pairs.
_SIMILARITY_COST = 200


class Texts:
    """Distinct texts with what their bounds need; ``code`` numbers the text of each row, -1 for a missing one."""

    def __init__(self, values: pa.Array):
        encoded = values.dictionary_encode()
        self.code = encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
        self.values = encoded.dictionary
        self.ready = False

    def prepare(self) -> Texts:
        """Characters of each text, their number, a set of first and second occurrences as in `bound_helpers`, and the first one."""
        if not self.ready:
            self.data, self.at = _codepoints(self.values)
            self.size = np.diff(self.at)
            n = len(self.size)
            places = np.repeat(np.arange(n), self.size) * 32 + self.data % 32
            seen = np.bincount(places, minlength=n * 32).reshape(n, 32)
            bit = np.uint64(1) << np.arange(32, dtype=np.uint64)
            self.chars = ((seen > 0) * bit).sum(axis=1, dtype=np.uint64) | (((seen > 1) * bit).sum(axis=1, dtype=np.uint64) << np.uint64(32))
            # Characters beyond the second occurrence of their class, which the set does not tell.
            self.more = (self.size - np.bitwise_count(self.chars)).astype(np.int32)
            self.first = np.where(self.size > 0, self.data[np.minimum(self.at[:-1], max(len(self.data) - 1, 0))] if len(self.data) else 0, 0)
            self.share = (1.0 / np.maximum(self.size, 1)).astype(np.float32)
            self.ready = True
        return self


def _best_by_share(tiers: Sequence[tuple[float, float]], least: float) -> np.ndarray:
    """Greatest weight of a pair by its share of common characters, m / a + m / b, first without and then with equal first characters.

    ``tiers`` are similarities with the weight of their level. A share of bin k is below (k + 1) / _BINS * 2.
    """
    share = (np.arange(_BINS) + 1) / _BINS * 2 + 1e-5
    jaro = np.minimum((share + 1) / 3, 1.0)
    out = []
    for boost in (0.0, PREFIX_WEIGHT * PREFIX_LENGTH):
        similarity = np.where(jaro > BOOST_ABOVE - _SLACK, jaro + boost * (1 - jaro), jaro)
        best = np.full(_BINS, least)
        for reached, weight in tiers:
            best = np.where(similarity >= reached - _SLACK, np.maximum(best, weight), best)
        out.append(best)
    return np.concatenate(out).astype(np.float32)


def _edits(a: Texts, of_a: np.ndarray, b: Texts, of_b: np.ndarray, most: int) -> np.ndarray:
    """Edit distance of pairs of texts up to `_EDIT_LENGTH` characters, above ``most`` where it is."""
    size_a, size_b = a.size[of_a], b.size[of_b]
    far = most + 1
    out = np.full(len(of_a), far, dtype=np.int16)
    near = np.flatnonzero(np.abs(size_a - size_b) <= most)
    if not len(near):
        return out
    size_a, size_b = size_a[near], size_b[near]
    width = int(max(size_a.max(), size_b.max(), 1))

    def grid(texts: Texts, of: np.ndarray, pad: int) -> np.ndarray:
        place = np.arange(width)[:, None]
        at = np.minimum(texts.at[of][None, :] + place, max(len(texts.data) - 1, 0))
        chars = texts.data[at].astype(np.int64) if len(texts.data) else np.zeros(at.shape, dtype=np.int64)
        return np.where(place < texts.size[of][None, :], chars, pad)

    left, right = grid(a, of_a[near], -1), grid(b, of_b[near], -2)
    band = 2 * most + 1
    # row[k] is the distance of the first i characters of the left text and the first i + k - most of the right one
    row = [np.full(len(near), k - most if k >= most else far, dtype=np.int16) for k in range(band)]
    found = np.full(len(near), far, dtype=np.int16)

    def settle(i: int) -> None:
        for k in range(band):
            done = (size_a == i) & (size_b == i + k - most)
            found[done] = row[k][done]

    settle(0)
    for i in range(1, width + 1):
        following = []
        for k in range(band):
            j = i + k - most
            if j < 0 or j > width:
                following.append(np.full(len(near), far, dtype=np.int16))
                continue
            if j == 0:
                best = np.full(len(near), i, dtype=np.int16)
            else:
                best = row[k] + (left[i - 1] != right[j - 1])
                if k + 1 < band:
                    best = np.minimum(best, row[k + 1] + 1)
                if k:
                    best = np.minimum(best, following[k - 1] + 1)
            following.append(np.minimum(best, far).astype(np.int16))
        row = following
        settle(i)
    out[near] = found
    return out


@dataclass
class Bound:
    """Weights that pairs can get from one comparison."""

    comparison: Comparison
    weights: dict[int, float]
    top: float = field(init=False)
    below: float = field(init=False)

    def __post_init__(self):
        self.top = self.weights[self.comparison.top]
        self.below = max(self.weights[level] for level in range(self.comparison.top))
        self.by_share = _best_by_share([(least, self.weights[level]) for _, least, level in self.comparison.tiers()], self.weights[0])
        if isinstance(self.comparison, EditTiers):
            # Weights of a distance from 0 up to one more than the largest that counts, and of unequal texts at least so far apart.
            top, distances = self.comparison.top, self.comparison.distances
            levels = [next((top - 1 - i for i, d in enumerate(distances) if e <= d), 0) for e in range(max(distances) + 2)]
            self.by_edits = np.array([self.weights[level] for level in levels], dtype=np.float32)
            self.from_edits = np.maximum.accumulate(self.by_edits[::-1])[::-1]

    def texts(self, values: pa.Array) -> list[Texts]:
        if not isinstance(self.comparison, EmailTiers):
            return [Texts(values)]
        whole = Texts(values)
        local = [v.split("@", 1)[0] or None for v in whole.values.to_pylist()]
        of = pa.array(local, type=pa.string()).take(pa.array(np.where(whole.code < 0, 0, whole.code), mask=whole.code < 0))
        return [whole, Texts(of)]

    # --- over all pairs of a tile

    def _similar(self, texts: Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Greatest weights of the texts ``a`` with each of ``b``, unless they are equal."""
        common = np.bitwise_count(texts.chars[a][:, None] & texts.chars[b])
        if texts.more[a].any() and texts.more[b].any():
            common = common + np.minimum(texts.more[a][:, None], texts.more[b])
        share = (texts.share[a] * np.float32(_BINS / 2))[:, None] + texts.share[b] * np.float32(_BINS / 2)
        share *= common
        at = np.minimum(share, _BINS - 1).astype(np.uint16)
        at += (texts.first[a][:, None] == texts.first[b]) * np.uint16(_BINS)
        return self.by_share.take(at)

    def table(self, texts: list[Texts], a: np.ndarray, b: np.ndarray, pairs: int) -> Callable[[int, int, int], np.ndarray] | float:
        """Bounds of the rows ``a`` with each of ``b`` (codes), for a stretch of ``a`` and the end of ``b``, or one number for all.

        Distinct values are compared once where they are few, by their similarity if that pays for ``pairs`` pairs.
        """
        own = texts[0]
        known_a, at_a = np.unique(a, return_inverse=True)
        known_b, at_b = np.unique(b, return_inverse=True)
        if len(known_a) == len(known_b) == 1:
            return 0.0 if min(known_a[0], known_b[0]) < 0 else self.top if known_a[0] == known_b[0] else self.below
        named = isinstance(self.comparison, NameTiers)
        missing_a, missing_b = known_a[0] < 0, known_b[0] < 0

        def bounds(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            equal = x[:, None] == y
            if named:
                out = self._similar(own, x, y)
                out[equal] = self.top
            else:
                out = np.where(equal, np.float32(self.top), np.float32(self.below))
            if missing_a:
                out[x < 0] = 0
            if missing_b:
                out[:, y < 0] = 0
            return out

        if named:
            own.prepare()
        if len(known_a) * len(known_b) > pairs / 4:
            return lambda start, end, since: bounds(a[start:end], b[since:])
        table = bounds(known_a, known_b)
        if named:
            i, j = np.nonzero(table > np.float32(self.weights[0]))
            differ = (known_a[i] != known_b[j]) & (known_a[i] >= 0) & (known_b[j] >= 0)
            i, j = i[differ], j[differ]
            if 0 < len(i) <= pairs / _SIMILARITY_COST:
                table[i, j] = self._graded(own, known_a[i], known_b[j], self.comparison.tiers())
        return lambda start, end, since: table.take(at_a[start:end], axis=0).take(at_b[since:], axis=1)

    # --- over listed pairs

    def _graded(self, texts: Texts, a: np.ndarray, b: np.ndarray, tiers: Sequence[Tier], otherwise: float | None = None) -> np.ndarray:
        """Weights by similarity of pairs of texts that are there and differ; ``otherwise``, or that of level 0, if they are not similar."""
        left, right = texts.values.take(pa.array(a)), texts.values.take(pa.array(b))
        similarity = jaro_winkler_batch(left, right, min(least for _, least, _ in tiers))
        out = np.full(len(a), self.weights[0] if otherwise is None else otherwise, dtype=np.float32)
        for _, least, level in tiers[::-1]:  # the first that is reached counts
            out = np.where(similarity >= least, np.float32(self.weights[level]), out)
        return out

    def listed(self, texts: list[Texts], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Bounds of the pairs of rows ``i`` and ``j``."""
        own = texts[0]
        if not len(own.values):
            return np.zeros(len(i), dtype=np.float32)
        a, b = own.code.take(i), own.code.take(j)
        equal = a == b
        if isinstance(self.comparison, NameTiers):
            out = self._near(own, a, b)
        elif isinstance(self.comparison, EditTiers):
            own.prepare()
            x, y = own.chars.take(a), own.chars.take(b)
            common = np.bitwise_count(x & y)
            lost = np.maximum(np.maximum(np.bitwise_count(x), np.bitwise_count(y)) - common, 1)
            out = self.from_edits.take(np.minimum(lost, len(self.from_edits) - 1))
        elif isinstance(self.comparison, EmailTiers):
            p, q = texts[1].code.take(i), texts[1].code.take(j)
            out = np.maximum(self._near(own, a, b), self._near(texts[1], p, q))
            out = np.where((p == q) & (p >= 0), np.float32(self.weights[3]), out)
        else:
            out = np.full(len(i), self.below, dtype=np.float32)
        out = np.where(equal, np.float32(self.top), out)
        out[(a < 0) | (b < 0)] = 0
        return out

    def _near(self, texts: Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        texts.prepare()
        if not len(texts.values):
            return np.full(len(a), self.weights[0], dtype=np.float32)
        common = np.bitwise_count(texts.chars.take(a) & texts.chars.take(b)) + np.minimum(texts.more.take(a), texts.more.take(b))
        share = (texts.share.take(a) + texts.share.take(b)) * np.float32(_BINS / 2) * common
        at = np.minimum(share, _BINS - 1).astype(np.uint16)
        at += (texts.first.take(a) == texts.first.take(b)) * np.uint16(_BINS)
        out = self.by_share.take(at)
        out[(a < 0) | (b < 0)] = self.weights[0]
        return out

    def settled(self, texts: list[Texts], i: np.ndarray, j: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Weights of the pairs, or their ``bounds`` where a text is too long to be settled here."""
        own, out = texts[0], bounds.copy()
        a, b = own.code.take(i), own.code.take(j)
        open_ = (a != b) & (a >= 0) & (b >= 0)
        if isinstance(self.comparison, NameTiers):
            at = np.flatnonzero(open_ & (bounds > self.weights[0]))
            if len(at):
                out[at] = self._graded(own, a[at], b[at], self.comparison.tiers())
        elif isinstance(self.comparison, EditTiers):
            most = max(self.comparison.distances)
            at = np.flatnonzero(open_ & (own.size.take(a) <= _EDIT_LENGTH) & (own.size.take(b) <= _EDIT_LENGTH))
            if len(at):
                out[at] = self.by_edits.take(_edits(own, a[at], own, b[at], most))
        elif isinstance(self.comparison, EmailTiers):
            p, q = texts[1].code.take(i), texts[1].code.take(j)
            at = np.flatnonzero(open_ & ((p != q) | (p < 0)))
            if len(at):
                whole, local = ([t] for t in self.comparison.tiers())
                graded = self._graded(own, a[at], b[at], whole, otherwise=np.nan)
                left = np.flatnonzero(np.isnan(graded))
                graded[left] = self.weights[0]
                left = left[(p[at[left]] >= 0) & (q[at[left]] >= 0)]
                if len(left):
                    graded[left] = self._graded(texts[1], p[at[left]], q[at[left]], local)
                out[at] = graded
        return out


class Hope:
    """The pairs whose weights can add up to ``needed``, by the weight of each level of each comparison."""

    def __init__(self, weights: Sequence[tuple[Comparison, dict[int, float]]], needed: float):
        self.bounds = [Bound(c, w) for c, w in weights]
        self.needed = needed - _SUM_SLACK
        # Few operations for many pairs come first, similarities of long texts last.
        cost = {EditTiers: 1, NameTiers: 2, EmailTiers: 3}
        self.order = sorted(range(len(weights)), key=lambda k: cost.get(type(weights[k][0]), 0))

    def texts(self, table: pa.Table) -> list[list[Texts]]:
        return [b.texts(_array(table, b.comparison.column)) for b in self.bounds]

    def of_tile(self, texts: list[list[Texts]], left: np.ndarray, right: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of the rows ``left`` and ``right`` that the bounds over all pairs leave; each pair once where both are the ``same`` rows."""
        pairs = len(left) * len(right) // (2 if same else 1)
        found = [b.table(t, t[0].code[left], t[0].code[right], pairs) for b, t in zip(self.bounds, texts, strict=True)]
        tables, needed = [t for t in found if callable(t)], np.float32(self.needed - sum(t for t in found if not callable(t)))
        start = 0
        while start < len(left):
            since = start if same else 0  # the rows before have met this stretch
            wide = len(right) - since
            end = min(start + max(1, _CELLS // wide), len(left))
            total = np.zeros((end - start, wide), dtype=np.float32)
            for table in tables:
                total += table(start, end, since)
            i, j = np.divmod(np.flatnonzero(total >= needed), wide)
            i, j, start = i + start, j + since, end
            if same:
                once = j > i
                i, j = i[once], j[once]
            if len(i):
                yield left[i], right[j]

    def of_pairs(self, texts: list[list[Texts]], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of the pairs of rows ``i`` and ``j`` that can reach the threshold, and their places."""
        places = np.arange(len(i))
        bounds = [b.listed(t, i, j) for b, t in zip(self.bounds, texts, strict=True)]
        for k in (None, *self.order):
            if k is not None and len(i):
                bounds[k] = self.bounds[k].settled(texts[k], i, j, bounds[k])
            kept = np.flatnonzero(sum(x.astype(np.float64) for x in bounds) >= self.needed)
            i, j, places, bounds = i[kept], j[kept], places[kept], [x[kept] for x in bounds]
        return i, j, places


def _array(table: pa.Table, column: str) -> pa.Array:
    values = table.column(column).cast(pa.string())
    return values.combine_chunks() if values.num_chunks != 1 else values.chunk(0)


def _pairs_of(table: pa.Table, columns: Sequence[str], i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    sides = {"l": pa.array(i), "r": pa.array(j)}
    found = {f"{c}_{s}": table.column(c).take(at).combine_chunks() for c in columns for s, at in sides.items()}
    return pa.RecordBatch.from_pydict({**found, "rule": table.column("rule").take(sides["l"]).combine_chunks()})


def _tiles(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole tiles (``rule``, ``block``, ``tile``) of sorted rows, some thousand rows at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in tables:
        held.append(batch)
        rows += batch.num_rows
        if rows < _HELD_ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        starts = _starts(table)
        if len(starts) > 1:
            yield table.slice(0, starts[-1])
            table = table.slice(starts[-1])
        held, rows = table.to_batches(), table.num_rows if len(starts) > 1 else 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _starts(table: pa.Table) -> np.ndarray:
    keys = [table.column(c).to_numpy() for c in ("rule", "block", "tile")]
    other = np.zeros(table.num_rows, dtype=bool)
    other[:1] = True
    for k in keys:
        other[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(other)


def hopeful_of_tiles(hope: Hope, columns: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows sorted by tile, the pairs of each one that can match, in either order.

    A tile holds the rows of one ``chunk`` of its block, or of two, whose rows then meet those of the other one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tiles(batches):
            texts = hope.texts(table)
            starts = _starts(table)
            chunk = table.column("chunk").to_numpy()
            across = table.column("across").to_numpy(zero_copy_only=False)
            held: list[tuple[np.ndarray, np.ndarray]] = []
            for start, end in zip(starts, [*starts[1:], table.num_rows], strict=True):
                rows = np.arange(start, end)
                if across[start]:
                    first = chunk[start:end] == chunk[start:end].min()
                    left, right = rows[first], rows[~first]
                else:
                    left = right = rows
                if not len(right):
                    continue
                for found in hope.of_tile(texts, left, right, same=not across[start]):
                    held.append(found)
                    if sum(len(i) for i, _ in held) >= _HELD_PAIRS:
                        i, j, _ = hope.of_pairs(texts, *(np.concatenate(x) for x in zip(*held, strict=True)))
                        held = []
                        yield _pairs_of(table, columns, i, j)
            if held:
                i, j, _ = hope.of_pairs(texts, *(np.concatenate(x) for x in zip(*held, strict=True)))
                yield _pairs_of(table, columns, i, j)

    return run


def hopeful_of_list(hope: Hope) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of listed pairs those that can match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, names = batch.num_rows, [b.comparison.column for b in hope.bounds]
            both = pa.table({c: pa.concat_arrays([batch.column(f"{c}_{s}") for s in "lr"]) for c in names})
            _, _, kept = hope.of_pairs(hope.texts(both), np.arange(n), np.arange(n, 2 * n))
            yield batch.take(pa.array(kept))

    return run
