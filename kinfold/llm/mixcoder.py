"""Context-mixing range coder for token ids, in blocks that are coded side by side.

A block starts from a fresh model, so blocks can be read alone. Numpy handles one id of every block at a time: all blocks of
a pass advance together, and a step costs the same few dozen array operations for a thousand blocks as for one.

The model of a block predicts the next id from the two ids before it (order 2), from the one before it (order 1), and from
all ids so far (order 0). Order 2 and 1 keep an id for each context, with a confidence that has an adaptive chance to be
right. The chance that an order leaves open goes to order 0, which knows how often ids of each of 60 classes (number of
bits, and the two bits after the first) occurred. The chance of an id is the weighted mean of both; the weight follows the
order that was right. An interval of that size codes the id; bits below its class are coded as they are.

Intervals are coded in 48 bits with carries, 16 bits leave at a time. All sums are whole numbers or single IEEE operations on
32-bit floats, so an encoder and a decoder on different machines agree. Every block has a CRC-32 of its ids.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 2048
#: Blocks of one pass.
LANES = 4096
_MAGIC = b"KFT2"
#: Both orders keep their entries in ``2 ** _LINES`` lines of 16 for each last id, so that a step reads one line of a CPU's
#: cache: four for order 1, the others for order 2.
_LINES, _FOR_1 = 8, 4
#: Highest confidence of a remembered id.
_SURE = 7
#: Chances are numbers of ``2 ** 12``, intervals of ``2 ** 24``.
_UNIT = 4096
_CLASSES = 64
#: Order 0 counts anew after so many ids, more often at first.
_REFRESH = 64
#: Steps whose ids are turned between rows of blocks and rows of steps at a time.
_STRIP = 64
_RATE, _WEIGHT_RATE = np.float32(1 / 24), np.float32(1 / 48)
_HALF, _ONE = np.float32(0.5), np.float32(1)
#: Chances stay within 0.02 and 0.96.
_TO, _KEEP, _UP = np.float32(0.02 / 24), np.float32(1) - _RATE, np.float32(0.94 / 24)
_LOW, _WIDE = np.uint64((1 << 32) - 1), np.uint64((1 << 48) - 1)
_NARROW, _W16, _W24, _W32 = (np.uint64(x) for x in (1 << 32, 16, 24, 32))
_W12 = np.uint32(12)
#: Confidence lies in bits 24 and up of an entry.
_GUESS, _SURER = np.uint32((1 << 24) - 1), np.uint32(1 << 24)


class _Classes:
    """Class of each id of up to ``bits`` bits, the number of raw bits below it, and its first id."""

    def __init__(self, bits: int):
        bits = max(bits, 16)
        low = bits - 13  # ids of fewer bits share the last four classes
        ids = np.arange(1 << bits)
        length = np.zeros(len(ids), np.int64)
        for b in range(bits):
            length[1 << b :] = b + 1
        raw = np.maximum(length - 3, low - 3)
        self.of = np.where(length < low, 56 + (ids >> (low - 3)), 4 * (length - low) + (ids >> raw) % 4).astype(np.uint8)
        self.raw, self.first = np.zeros(_CLASSES, np.uint64), np.zeros(_CLASSES, np.uint32)
        head = np.unique(self.of, return_index=True)
        self.raw[head[0]], self.first[head[0]] = raw[head[1]], head[1]


class _Model:
    """Tables of the blocks of a pass; those of order 0 have a row for each class, so that all blocks' are added up at once."""

    def __init__(self, lanes: int):
        self.lanes, lane = lanes, np.arange(lanes, dtype=np.uint32)
        room = np.zeros((lanes << _LINES + 4) + 16, np.uint32)
        self.slots = room[-(room.ctypes.data // 4) % 16 :]
        self.heads = lane << np.uint32(_LINES + 4)
        # Chance of a remembered id, by its confidence and by whether both orders agree.
        start = (np.arange(2 * (_SURE + 1)) // 2 * 0.11 + 0.02).astype(np.float32)
        self.chance = [np.repeat(start, lanes) for _ in range(2)]
        self.weight = np.full(lanes, 0.5, np.float32)
        self.one, self.two = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)
        self.counts = np.ones((_CLASSES, lanes), np.int32)
        self.seen = np.zeros((_REFRESH, lanes), np.uint8)  # classes since the last refresh
        self.new = 0
        self.ends = np.zeros((_CLASSES + 1, lanes), np.uint16)
        self.flat_ends = self.ends.reshape(-1)
        self.place = lane.astype(np.intp)
        self.step = 0

    def _refresh(self) -> None:
        # A quotient of doubles is as good as one of whole numbers this small.
        seen, counts = self.seen[: self.new], self.counts
        for kind in np.flatnonzero(np.bincount(seen.reshape(-1))).tolist():
            counts[kind] += np.add.reduce((seen == kind).view(np.uint8), axis=0, dtype=np.uint8).astype(np.int32) << 3
        self.new = 0
        size = (counts * np.int32(_UNIT - _CLASSES) / counts.sum(axis=0, dtype=np.int32)).astype(np.uint16)
        size += np.uint16(1)
        size[0] += np.uint16(_UNIT) - size.sum(axis=0, dtype=np.uint16)  # what rounding leaves goes to the first class
        for i in range(_CLASSES):
            np.add(self.ends[i], size[i], out=self.ends[i + 1])
        self.counts -= self.counts >> 3

    def predict(self, m: int) -> None:
        """Ids of order 2 and 1 (``guess``) and their shares (``q``, the second 0 where both agree) for ``m`` blocks."""
        if self.step % _REFRESH == 0 or self.step in (4, 8, 16, 32):
            self._refresh()
        self.step += 1
        h1 = self.one[:m] * np.uint32(0x9E3779B1)
        h2 = self.two[:m] * np.uint32(0x85EBCA6B)
        h2 += np.uint32(0x165667B1)
        h2 ^= h1
        h2 *= np.uint32(0xC2B2AE35)
        line = h1 >> np.uint32(32 - _LINES)
        line <<= np.uint32(4)
        line += self.heads[:m]
        h1 >>= np.uint32(30 - _LINES)
        h1 &= np.uint32(_FOR_1 - 1)
        h1 += line
        h2 >>= np.uint32(16)
        h2 *= np.uint32(16 - _FOR_1)
        h2 >>= np.uint32(16)
        h2 += line
        h2 += np.uint32(_FOR_1)
        self.at = [h2.astype(np.intp), h1.astype(np.intp)]
        self.entry = [self.slots.take(a) for a in self.at]
        self.guess = [e & _GUESS for e in self.entry]
        agree = self.guess[0] == self.guess[1]
        same = agree.astype(np.uint32)
        self.of = []
        for e in self.entry:
            of = e >> np.uint32(23)
            of &= np.uint32(2 * _SURE)
            of += same
            self.of.append(self.cells(m, of))
        self.p = [t.take(a) for t, a in zip(self.chance, self.of, strict=True)]
        w = self.weight[:m]
        a = self.p[0] * w
        b = self.p[1] * (_ONE - w)
        both = b * agree.astype(np.float32)
        a += both
        b -= both
        self.q = [(x * np.float32(3968)).astype(np.int32).view(np.uint32) + np.uint32(1) for x in (a, b)]
        self.q[1] -= same
        self.known = self.q[0] + self.q[1]
        self.rest = np.uint32(_UNIT) - self.known

    def cells(self, m: int, kind: np.ndarray) -> np.ndarray:
        """Where each block's value is in tables with a row for each class or state."""
        at = kind.astype(np.intp)
        at *= self.lanes
        at += self.place[:m]
        return at

    def share(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the classes in order 0."""
        start = self.flat_ends.take(at)
        size = self.flat_ends.take(at + self.lanes)
        size -= start
        return start.astype(np.uint32), size.astype(np.uint32)

    def remembered(self, old: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the blocks ``old``, whose id is that of order 2 (``first``) or 1."""
        edge = self.q[0][old] << _W12
        return np.where(first, np.uint32(0), edge), np.where(first, edge, self.q[1][old] << _W12)

    def update(self, m: int, ids: np.ndarray, hit: list[np.ndarray], kind: np.ndarray) -> None:
        # The weight moves to the order that alone was right.
        w = self.weight[:m]
        right = [h.astype(np.float32) for h in hit]
        lead = right[0] - right[1]
        pull = np.abs(lead)
        pull *= _WEIGHT_RATE
        lead += _ONE
        lead *= _HALF
        lead -= w
        lead *= pull
        w += lead
        fresh, surest = ids | _SURER, ids | np.uint32(_SURE << 24)
        for t, of, p, r, h, slot, entry in zip(self.chance, self.of, self.p, right, hit, self.at, self.entry, strict=True):
            p *= _KEEP
            r *= _UP
            p += r
            p += _TO
            t[of] = p
            # Right: surer; wrong: less sure, and replaced where little was left.
            less = np.where(entry < np.uint32(2 << 24), fresh, entry - np.uint32(2 << 24))
            entry += _SURER
            np.minimum(entry, surest, out=entry)
            self.slots[slot] = np.where(h, entry, less)
        self.seen[self.new, :m] = kind
        self.new += 1
        self.two[:m] = self.one[:m]
        self.one[:m] = ids


class _Writer:
    def __init__(self, lanes: int, steps: int):
        self.room = 3 * steps + 8
        self.words = np.zeros(lanes * self.room, np.uint16)
        self.first = np.arange(lanes, dtype=np.int64) * self.room
        self.at = self.first.copy()
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, 1 << 48, np.uint64)

    def put(self, m: int, start: np.ndarray, size: np.ndarray, raw: np.ndarray, rest: np.ndarray) -> None:
        """Narrow the ranges to ``start`` and ``size`` of 2 ** 24 parts, and that to part ``rest`` of 2 ** ``raw``."""
        low, span, at = self.low[:m], self.range[:m], self.at[:m]
        span >>= _W24
        part = start.astype(np.uint64)
        part *= span
        low += part
        span *= size.astype(np.uint64)
        span >>= raw
        part = rest.astype(np.uint64)
        part *= span
        low += part
        over = (low > _WIDE).nonzero()[0]
        if len(over):
            low[over] &= _WIDE
            back = at[over] - 1
            while len(back):
                self.words[back] += np.uint16(1)
                back = back[self.words[back] == 0] - 1
        # Each block writes a word; where it does not leave yet, the next one takes its place.
        narrow = span < _NARROW
        self.words[at] = (low >> _W32).astype(np.uint16)
        at += narrow
        shift = narrow.astype(np.uint64)
        shift <<= np.uint64(4)
        low &= _WIDE >> shift
        low <<= shift
        span <<= shift
        again = (span < _NARROW).nonzero()[0]
        while len(again):
            own = low[again]
            self.words[at[again]] = own >> _W32
            at[again] += 1
            low[again] = (own & _LOW) << _W16
            span[again] <<= _W16
            again = again[span[again] < _NARROW]

    def close(self) -> list[bytes]:
        for _ in range(3):
            self.words[self.at] = self.low >> _W32
            self.at += 1
            self.low = (self.low & _LOW) << _W16
        return [self.words[a:b].astype("<u2").tobytes() for a, b in zip(self.first.tolist(), self.at.tolist(), strict=True)]


class _Reader:
    def __init__(self, blocks: list[bytes]):
        sizes = np.array([len(b) // 2 for b in blocks], np.int64)
        self.words = np.frombuffer(b"".join(blocks) + bytes(8), "<u2")
        self.at = np.cumsum(sizes) - sizes
        self.value = np.zeros(len(blocks), np.uint64)
        self.range = np.full(len(blocks), 1 << 48, np.uint64)
        for _ in range(3):
            self.value = (self.value << _W16) | self.words[self.at]
            self.at += 1

    def place(self, m: int) -> np.ndarray:
        """Number of the part, of 2 ** 24, that the value is in."""
        self.range[:m] >>= _W24
        return np.minimum(self.value[:m] // self.range[:m], np.uint64((1 << 24) - 1)).astype(np.uint32)

    def take(self, m: int, start: np.ndarray, size: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Undo `_Writer.put`; the raw part."""
        value, span, at = self.value[:m], self.range[:m], self.at[:m]
        part = start.astype(np.uint64)
        part *= span
        value -= part
        span *= size.astype(np.uint64)
        span >>= raw
        rest = np.minimum(value // span, (np.uint64(1) << raw) - np.uint64(1))
        value -= span * rest
        # A damaged block may ask for words behind the end; its checksum tells.
        narrow = span < _NARROW
        shift = narrow.astype(np.uint64)
        word = self.words.take(at, mode="clip").astype(np.uint64)
        word *= shift
        shift <<= np.uint64(4)
        value <<= shift
        value |= word
        span <<= shift
        at += narrow
        again = (span < _NARROW).nonzero()[0]
        while len(again):
            own = at[again]
            value[again] = (value[again] << _W16) | self.words.take(own, mode="clip")
            at[again] = own + 1
            span[again] <<= _W16
            again = again[span[again] < _NARROW]
        return rest.astype(np.uint32)


def _active(sizes: np.ndarray, steps: int) -> list[int]:
    """Blocks, longest first, that still have an id at each step."""
    return np.searchsorted(-sizes, -np.arange(steps), "left").tolist()


def _turned(rows: np.ndarray) -> np.ndarray:
    """The transpose in an array of its own; parts of it at a time stay in a CPU's cache."""
    out = np.empty(rows.shape[::-1], rows.dtype)
    for i in range(0, max(rows.shape), 128):
        if len(rows) > rows.shape[1]:
            out[:, i : i + 128] = rows[i : i + 128].T
        else:
            out[i : i + 128] = rows[:, i : i + 128].T
    return out


def _encode_pass(ids: np.ndarray, sizes: np.ndarray, classes: _Classes) -> list[bytes]:
    """Blocks of one pass, longest first; ``ids`` has one row for each."""
    model, out = _Model(len(sizes)), _Writer(len(sizes), int(sizes[0]))
    for step, m in enumerate(_active(sizes, int(sizes[0]))):
        if step % _STRIP == 0:
            strip = _turned(ids[:, step : step + _STRIP])
        own = strip[step % _STRIP, :m]
        model.predict(m)
        kind = classes.of.take(own)
        hit = [own == g for g in model.guess]
        start, size = model.share(model.cells(m, kind))
        start *= model.rest
        start += model.known << _W12
        size *= model.rest
        raw, rest = classes.raw.take(kind), own - classes.first.take(kind)
        # Most ids are new to both orders; the others have an interval of their order.
        old = (hit[0] | hit[1]).nonzero()[0]
        start[old], size[old] = model.remembered(old, hit[0][old])
        raw[old] = rest[old] = 0
        out.put(m, start, size, raw, rest)
        model.update(m, own, hit, kind)
    return out.close()


def _decode_pass(blocks: list[bytes], sizes: np.ndarray, classes: _Classes) -> np.ndarray:
    model, source = _Model(len(sizes)), _Reader(blocks)
    ids, strip = np.zeros((len(sizes), int(sizes[0])), "<u4"), np.zeros((_STRIP, len(sizes)), np.uint32)
    below = np.zeros((_CLASSES - 1, len(sizes)), bool)
    for step, m in enumerate(_active(sizes, int(sizes[0]))):
        model.predict(m)
        place = source.place(m)
        known = model.known << _W12
        # The class of order 0 whose interval holds the place: as many end at or before it.
        inside = (place - known) // model.rest
        np.less_equal(model.ends[1:-1, :m], inside.astype(np.uint16), out=below[:, :m])
        kind = np.add.reduce(below[:, :m].view(np.uint8), axis=0, dtype=np.uint8)
        start, size = model.share(model.cells(m, kind))
        start *= model.rest
        start += known
        size *= model.rest
        raw = classes.raw.take(kind)
        # Places below are those of a remembered id.
        old = (place < known).nonzero()[0]
        first = place[old] < model.q[0][old] << _W12
        start[old], size[old] = model.remembered(old, first)
        raw[old] = 0
        own = source.take(m, start, size, raw)
        own += classes.first.take(kind)
        own[old] = np.where(first, model.guess[0][old], model.guess[1][old])
        strip[step % _STRIP, :m] = own
        if (step + 1) % _STRIP == 0 or step + 1 == sizes[0]:
            done = step % _STRIP + 1
            ids[:, step + 1 - done : step + 1] = _turned(strip[:done])
        model.update(m, own, [own == g for g in model.guess], classes.of.take(own, mode="clip"))
    return ids


def encode(ids: np.ndarray, bits: int, block: int = BLOCK, lanes: int = LANES) -> bytes:
    """Frame of ``ids``, which have at most ``bits`` bits (24 at most)."""
    if not 1 <= bits <= 24:
        raise ValueError("ids of 1 to 24 bits")
    ids, kinds = np.asarray(ids, np.uint32), _Classes(bits)
    count = -(-len(ids) // block)
    coded: list[bytes] = []
    for first in range(0, count, lanes):
        part = ids[first * block : (first + lanes) * block]
        n = -(-len(part) // block)
        sizes = np.full(n, block, np.int64)
        sizes[-1] = len(part) - (n - 1) * block
        if n * block > len(part):
            part = np.concatenate([part, np.zeros(n * block - len(part), np.uint32)])
        coded += _encode_pass(part.reshape(n, block), sizes, kinds)
    plain = np.ascontiguousarray(ids, "<u4")
    checks = [zlib.crc32(plain[i * block : (i + 1) * block]) for i in range(count)]
    head = struct.pack("<4sIIQI", _MAGIC, bits, block, len(ids), count)
    directory = np.array([[len(c) for c in coded], checks], "<u4").tobytes()
    return b"".join([head, struct.pack("<I", zlib.crc32(head + directory)), directory, *coded])


def decode(frame: bytes, first: int = 0, blocks: int | None = None, lanes: int = LANES) -> np.ndarray:
    """Ids of a frame, or of ``blocks`` of its blocks from number ``first`` on."""
    size = struct.calcsize("<4sIIQI")
    magic, bits, block, total, count = struct.unpack_from("<4sIIQI", frame)
    (check,) = struct.unpack_from("<I", frame, size)
    body = size + 4 + 8 * count
    if magic != _MAGIC or zlib.crc32(frame[:size] + frame[size + 4 : body]) != check:
        raise ValueError("no frame of token ids, or a damaged one")
    length, checks = np.frombuffer(frame, "<u4", 2 * count, size + 4).reshape(2, -1).astype(np.int64)
    ends = body + np.cumsum(length)
    last = count if blocks is None else min(count, first + blocks)
    kinds, out = _Classes(bits), []
    for a in range(first, last, lanes):
        b = min(a + lanes, last)
        sizes = np.full(b - a, block, np.int64)
        if b == count:
            sizes[-1] = total - (count - 1) * block
        rows = _decode_pass([frame[ends[i] - length[i] : ends[i]] for i in range(a, b)], sizes, kinds)
        for i in range(b - a):
            if zlib.crc32(rows[i, : sizes[i]]) != checks[a + i]:
                raise ValueError(f"block {a + i} is damaged")
        out.append(rows.reshape(-1)[: sizes.sum()])
    return np.concatenate(out).astype(np.uint32, copy=False) if out else np.zeros(0, np.uint32)
