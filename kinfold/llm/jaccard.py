"""Near-duplicate join by Jaccard similarity of word shingles, and its connected classes.

A document's set holds the 64-bit hashes of its distinct shingles. All sets are put in one order, rare shingles first (by
the size class of a bucket count over all texts, then by hash). Two sets that reach the similarity share one of
their first shingles, of which a set of n has n - ceil(t * n) + 1. A tile is a band of sizes and such a shingle: only sets
in the same tile can be similar, and no pair is lost. A set near the lower edge of its band also enters the bands
below. Passages that many texts share come last in the order, so they make no tiles unless they are most of a text.

Within a tile sets are not paired all with all. Each set is compared with the least of one of its tiles, then with the
least of its other tiles while their classes differ, then with pivots of the largest tile it is in that still holds
several classes: drawn anew, and more of them, while a round links many sets. A round tries the closest pivot of each
class only. Then the sets of different classes that are left in a tile meet each other, which settles every pair. A set's signature is a bitmap of the parity of the shingles on each bit.
Before texts are read again, the bits in which two signatures differ are counted: each is an element that one of them
lacks, which bounds the overlap from above. A short bitmap says nothing of large sets, so these have one that grows with
their size as well; of two lengths the longer folds to the shorter. What passes is decided by intersecting the sorted sets.

Tiles are grouped by packed keys: a batch of texts sends one row for each part of the key space, with one entry for
each key however many of its texts hold it, so neither copies nor a tile that a third of all sets share fill a task.
Equal sets are one class from the start.

Defined cases: a text without words, or null, has the empty set and is linked with nothing; with fewer words than a
shingle the whole sequence is the only shingle; repeated rows are copies; documents with one id are told apart, and a
class is named by its least id; an empty table gives no rows.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import Words, flat, fresh_name, grams, map_batches, mix, partitions_of, passes, save, workspace
from kinfold.operators.components import connected_components
from kinfold.scratch import Scratch

#: Upper size of a size band over its lower size.
BAND = 1.5
#: Buckets in which shingles are counted for the common order.
BUCKETS = 1 << 20
BUCKET_SHIFT = np.uint64(44)
#: Words of a parity bitmap.
PARITY = 8
#: Sets above this size also have a bitmap of ``WIDE`` to twice as many bits an element.
WIDE_FROM = 256
WIDE = 1
#: Bytes of a tile's key; keys that meet by chance only cost a comparison.
KEY_BYTES = 6
#: Keys of one part of the key space, about.
PART_KEYS = 2_000_000
#: Pivots of a tile in the first round, about, and how many times more each later one draws; tiles of no more sets have
#: none. Rounds end when one after the first links less than this share of its sets, or after so many.
PIVOTS = 16
PIVOT_GROWTH = 4
LINKING_SHARE = 0.005
PIVOT_ROUNDS = 4
#: Pairs (two numbers each) that are broadcast to read their texts; more are joined by shuffling texts.
BROADCAST_PAIRS = 1_000_000


class Bands:
    """Size bands for a similarity, given as a fraction."""

    def __init__(self, similarity: Fraction):
        self.similarity = similarity
        self.edges = [1]

    def _reach(self, size: int) -> None:
        while self.edges[-1] <= size:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * BAND)))

    def of(self, size: int) -> list[int]:
        """The band of a size, and the one below if a similar smaller set can be there."""
        self._reach(size)
        band = int(np.searchsorted(self.edges, size, "right")) - 1
        least = math.ceil(size * self.similarity)
        return [band] + [b for b in range(band - 1, -1, -1) if self.edges[b + 1] - 1 >= least]


def in_front(elements: np.ndarray, t: Fraction, rarity: np.ndarray) -> np.ndarray:
    """The first shingles in the common order that a similar set must share one of."""
    n = len(elements) - math.ceil(len(elements) * t) + 1
    return elements[np.lexsort((elements, rarity[elements >> BUCKET_SHIFT]))[:n]]


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(*flat(column), lower=True)
    hashes = words.hashes()
    found, at = grams(hashes, words.bounds, n)
    cut = np.searchsorted(at, words.bounds)
    out = []
    for i, count in enumerate(words.count.tolist()):
        if count >= n:
            out.append(np.unique(found[cut[i] : cut[i + 1]]))
        elif count:
            own, one = hashes[words.bounds[i] : words.bounds[i + 1]], np.zeros(1, np.uint64)
            for h in own:
                one = mix(one * np.uint64(31) + h + np.uint64(count))
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def parity(elements: np.ndarray) -> np.ndarray:
    """``8 * 64`` bits; each tells whether an odd number of elements falls on it."""
    times = np.bincount((elements >> np.uint64(6) & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY)
    return np.packbits((times & 1).astype(np.uint8), bitorder="little").view(np.int64)


def wide_parity(elements: np.ndarray) -> bytes | None:
    """As ``parity``, on a number of bits that grows with the set; none for a small set."""
    if len(elements) <= WIDE_FROM:
        return None
    bits = 1 << (WIDE * len(elements) - 1).bit_length()
    times = np.bincount((elements >> np.uint64(6) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((times & 1).astype(np.uint8), bitorder="little").tobytes()


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two wide bitmaps differ, on the shorter one's length."""
    a, b = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int.from_bytes((a ^ b).tobytes(), "little").bit_count()


def _signatures(n: int):
    def make(batch: pa.RecordBatch) -> dict:
        sets = shingle_sets(batch.column("text"), n)
        bits = np.stack([parity(s) for s in sets])
        return {
            "row_id": batch.column("row_id"), "doc_id": batch.column("doc_id"), "size": np.array([len(s) for s in sets], np.int64),
            "digest": [_digest(s) if len(s) else None for s in sets], "wide": [wide_parity(s) for s in sets],
        } | {f"p{i}": bits[:, i] for i in range(PARITY)}

    return make


def _digest(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


def _key_bytes(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def _keys_of(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // KEY_BYTES, 8), np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, KEY_BYTES)
    return wide.view("<u8").reshape(-1)


def _frequencies(n: int):
    """In how many texts of the task the shingles of each bucket occur."""

    def run(batches):
        counts = np.zeros(BUCKETS, np.int64)
        for batch in passes(batches):
            for s in shingle_sets(batch.column("text"), n):
                np.add.at(counts, (s >> BUCKET_SHIFT).astype(np.int64), 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    return run


def _rarity(texts: DataFrame, n: int) -> np.ndarray:
    """Size class of each bucket's count; any order by it keeps all pairs."""
    counted = texts.select("text").mapInArrow(_frequencies(n), "bucket long, n long")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS rows
    out = np.zeros(BUCKETS, np.uint8)
    out[rows["bucket"].to_numpy()] = np.log2(rows["n"].to_numpy() + 1).astype(np.uint8)
    return out


def _tiles(t: Fraction, n: int, parts: int, rarity: np.ndarray):
    """One row per batch and part of the key space; sets of one batch with equal keys share an entry.

    Rows with a ``part`` below 0 list the sets of a batch that share a tile.
    """

    def make(batch: pa.RecordBatch) -> dict | None:
        bands = Bands(t)
        ids = batch.column("row_id").to_numpy()
        seen, keys, owner = set(), [], []
        for i, s in enumerate(shingle_sets(batch.column("text"), n)):
            digest = _digest(s)
            if len(s) and digest not in seen:
                seen.add(digest)
                front = in_front(s, t, rarity)
                for band in bands.of(len(s)):
                    keys.append(mix(front + mix(np.full(1, band, np.uint64))))
                    owner.append(np.full(len(front), i))
        if not keys:
            return None
        key = np.concatenate(keys) >> np.uint64(64 - 8 * KEY_BYTES)
        of = np.concatenate(owner)
        order = np.lexsort((ids[of], key))
        key, of = key[order], of[order]
        head = np.concatenate([[True], key[1:] != key[:-1]])
        run = np.cumsum(head) - 1
        shared = np.bincount(run)[run] > 1
        part = (key[head] * np.uint64(parts) >> np.uint64(8 * KEY_BYTES)).astype(np.int64) if parts < 1 << 15 else key[head].astype(np.int64) % parts
        turn = np.argsort(part, kind="stable")
        part, sent, by = part[turn], key[head][turn], of[head][turn]
        cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        rows = {k: [] for k in ("part", "keys", "nodes", "of")}
        for x, y in zip(cut[:-1], cut[1:], strict=True):
            nodes, index = np.unique(ids[by[x:y]], return_inverse=True)
            for k, v in zip(rows, (int(part[x]), _key_bytes(sent[x:y]), nodes.astype("<i8").tobytes(), index.astype("<u2").tobytes()), strict=True):
                rows[k].append(v)
        if shared.any():
            for k, v in zip(rows, (-1 - int(ids[0]) % parts, _key_bytes(key[shared]), ids[of[shared]].astype("<i8").tobytes(), b""), strict=True):
                rows[k].append(v)
        return rows

    return make


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """Entries of one part whose key several batches hold; rows below part 0 hold members as they are."""
    key = np.concatenate([_keys_of(x) for x in rows["keys"]])
    if rows["part"].iloc[0] < 0:
        node = np.frombuffer(b"".join(rows["nodes"]), "<i8")
        return pd.DataFrame({"key": key.astype(np.int64), "node": node})
    node = np.concatenate([np.frombuffer(x, "<i8")[np.frombuffer(i, "<u2")] for x, i in zip(rows["nodes"], rows["of"], strict=True)])
    order = np.argsort(key, kind="stable")
    key, node = key[order], node[order]
    run = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
    several = np.bincount(run)[run] > 1
    return pd.DataFrame({"key": key[several].astype(np.int64), "node": node[several]})


def similar(shared: int, size_a: int, size_b: int, t: Fraction) -> bool:
    return shared * t.denominator >= t.numerator * (size_a + size_b - shared)


def differing_bits():
    """Over ``a0.., b0..``: in how many bits the short bitmaps differ."""
    return sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(1, PARITY)), F.bit_count(F.col("a0").bitwiseXOR(F.col("b0"))))


def may_be_similar(t: Fraction):
    """Condition over ``size_a, a0.., size_b, b0..``: sizes and differing parity bits leave room for the similarity."""
    sizes = F.least("size_a", "size_b") * t.denominator >= F.greatest("size_a", "size_b") * t.numerator
    return sizes & (differing_bits() * (t.denominator + t.numerator) <= (F.col("size_a") + F.col("size_b")) * (t.denominator - t.numerator))


def _bounded(t: Fraction):
    """Pairs whose wide bitmaps leave room for the similarity; a pair with a small set stays."""

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("wide_a", "wide_b", "sizes"))
            keep = [x is None or y is None or differing(x, y) * (t.denominator + t.numerator) <= n * (t.denominator - t.numerator) for x, y, n in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(t: Fraction, n: int):
    """Pairs whose sorted sets are similar; a text that comes again in a row is read once."""

    def run(batches):
        last, held = None, None
        for batch in batches:
            a, key = batch.column("text_a"), batch.column("a").to_pylist()
            keep, start = [], 0
            while start < batch.num_rows:
                end = start + 64
                sets = shingle_sets(batch.column("text_b").slice(start, 64), n)
                for i, own in enumerate(sets, start):
                    if key[i] != last:
                        last, held = key[i], shingle_sets(a.slice(i, 1), n)[0]
                    shared = len(np.intersect1d(held, own, assume_unique=True))
                    keep.append(similar(shared, len(held), len(own), t))
                start = end
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class _Join:
    def __init__(self, scratch: Scratch, texts: DataFrame, signed: DataFrame, t: Fraction, n: int):
        self.scratch, self.texts, self.signed, self.t, self.n = scratch, texts, signed, t, n
        self.left, self.right = (
            signed.select(F.col("row_id").alias(x), F.col("size").alias(f"size_{x}"), *[F.col(f"p{i}").alias(f"{x}{i}") for i in range(PARITY)]) for x in "ab"
        )
        self.links: DataFrame | None = None

    def verify(self, pairs: DataFrame, name: str) -> int:
        """Add the similar ones of ``a, b`` (a < b) to the links; how many there are."""
        near = pairs.join(self.left, "a").join(self.right, "b").filter(may_be_similar(self.t))
        near = save(self.scratch, near.select("a", "b", (F.col("size_a") + F.col("size_b")).alias("sizes")), f"{name}-near")
        large = near.filter(F.col("sizes") > 2 * WIDE_FROM)
        bounded = self._with(large, large.count(), self.signed, "wide").select("a", "b", "sizes", "wide_a", "wide_b").mapInArrow(_bounded(self.t), "a long, b long")
        small = near.filter(F.col("sizes") <= 2 * WIDE_FROM).select("a", "b")
        open_pairs = save(self.scratch, bounded.unionByName(small), f"{name}-open")
        read = self._with(open_pairs, open_pairs.count(), self.texts, "text").select("a", "b", "text_a", "text_b")
        found = save(self.scratch, read.mapInArrow(_verified(self.t, self.n), "a long, b long"), f"{name}-links")
        self.links = found if self.links is None else self.links.unionByName(found)
        return found.count()

    def _with(self, pairs: DataFrame, count: int, rows: DataFrame, column: str) -> DataFrame:
        """Pairs with the ``column`` of both rows; few pairs pick their rows before anything is shuffled."""
        first = rows.select(F.col("row_id").alias("a"), F.col(column).alias(f"{column}_a"))
        second = rows.select(F.col("row_id").alias("b"), F.col(column).alias(f"{column}_b"))
        if count > BROADCAST_PAIRS:
            return pairs.join(second, "b").join(first, "a")
        wanted = pairs.select("a").distinct()  # at most BROADCAST_PAIRS numbers
        return second.join(F.broadcast(pairs), "b").join(first.join(F.broadcast(wanted), "a", "left_semi"), "a")

    def classes(self, name: str) -> DataFrame:
        """``node, class`` of every node with a link."""
        inner = Scratch(self.scratch.spark, name)
        found = connected_components(self.links, "a", "b", inner)
        return save(self.scratch, found.select("node", F.col("component").alias("class")), name)


def _mixed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, node, class, n`` of the tiles whose sets are in several classes; ``n`` is the sets of the tile."""
    named = members.join(classes, "node", "left").select("key", "node", F.coalesce("class", "node").alias("class"))
    split = named.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("n")).filter("low < high")
    return named.join(split.select("key", "n"), "key")


def _homes(mixed: DataFrame) -> DataFrame:
    """``key, node, class`` of each set in the largest of its tiles that are large enough for pivots."""
    largest = mixed.filter(F.col("n") > PIVOTS).groupBy("node").agg(F.max(F.struct("n", "key")).alias("at"), F.min("class").alias("class"))
    return largest.select("at.key", "node", "class")


def _pivot_pairs(homes: DataFrame, join: _Join, t: Fraction, turn: int) -> DataFrame:
    """Pairs ``a < b`` of a set and the closest pivot of each other class in its tile.

    Pivots are drawn by a hash of the set.
    """
    sizes = homes.groupBy("key").agg(F.count("*").alias("n"))
    draw = F.xxhash64("node", F.lit(turn)).bitwiseAND(F.lit((1 << 20) - 1)) * F.col("n") < PIVOTS * PIVOT_GROWTH**turn << 20
    pivots = homes.join(sizes, "key").filter(draw).select("key", F.col("node").alias("a"), F.col("class").alias("class_a")).join(join.left, "a")
    others = homes.select("key", F.col("node").alias("b"), F.col("class").alias("class_b")).join(join.right, "b")
    meet = (pivots["key"] == others["key"]) & (F.col("class_a") != F.col("class_b")) & may_be_similar(t)
    distance = differing_bits() / (F.col("size_a") + F.col("size_b"))
    near = pivots.join(others, meet).groupBy("b", "class_a").agg(F.min(F.struct(distance.alias("distance"), "a")).alias("near"))
    return near.select(F.least("near.a", "b").alias("a"), F.greatest("near.a", "b").alias("b")).distinct()


def one_of_each(docs: DataFrame, similarity: str = "0.8", shingle: int = 5) -> DataFrame:
    """``docs`` with the first row of each class of near duplicates."""
    row = fresh_name(docs, "dedup_row")
    rows = save(workspace(docs.sparkSession, "dedup"), docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    named = rows.select(F.col(row).alias("row_id"), "doc_id", "text")
    first = near_duplicates(named, similarity, shingle, numbered=True).filter("is_first").select(F.col("row_id").alias(row))
    return rows.join(first, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(docs: DataFrame, similarity: str = "0.8", shingle: int = 5, numbered: bool = False) -> DataFrame:
    """``row_id, doc_id, n_shingles, component_id, is_first`` of every row; ``numbered`` docs bring a stable ``row_id``.

    ``similarity`` is an exact decimal. ``is_first`` marks the one row that stands for its class: the least id, of equal
    ids the first row.
    """
    t = Fraction(similarity)
    if not 0 < t <= 1:
        raise ValueError("similarity must be above 0 and at most 1")
    scratch = workspace(docs.sparkSession, "jaccard")
    kind = docs.schema["doc_id"].dataType.simpleString()
    if numbered:
        texts = docs.select("row_id", "doc_id", "text")
    else:
        texts = save(scratch, docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text"), "texts")
    ddl = f"row_id long, doc_id {kind}, size long, digest binary, wide binary, " + ", ".join(f"p{i} long" for i in range(PARITY))
    signed = save(scratch, map_batches(texts, _signatures(shingle), ddl), "signatures")
    copies = signed.filter("size > 0").groupBy("digest").agg(F.min("row_id").alias("node"), F.count("*").alias("copies"))
    copies = save(scratch, copies, "copies")
    total = signed.agg(F.sum("size")).first()[0] or 0

    parts = max(partitions_of(docs.sparkSession), math.ceil(2 * total * float(1 - t) / PART_KEYS))
    packed = map_batches(texts.select("row_id", "text"), _tiles(t, shingle, parts, _rarity(texts, shingle)), "part long, keys binary, nodes binary, of binary")
    met = packed.groupBy("part").applyInPandas(_meet, "key long, node long")
    # Of equal sets only the first is a member.
    repeated = copies.filter("copies > 1").select("digest", "node")
    moved = save(scratch, signed.select("row_id", "digest").join(repeated, "digest").filter("row_id <> node").select("row_id", F.col("node").alias("first")), "moved")
    members = met.join(moved, F.col("node") == F.col("row_id"), "left").select("key", F.coalesce("first", "node").alias("node"))
    members = save(scratch, members.distinct(), "members")
    least = members.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1").select("key", "a")

    join = _Join(scratch, texts, signed, t, shingle)
    stars = members.join(least, "key").filter("node > a").select("a", F.col("node").alias("b")).distinct()
    stars = save(scratch, stars, "stars")
    one = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    join.verify(one, "one")
    classes = join.classes("classes-one")

    def other_class(pairs: DataFrame, classes: DataFrame) -> DataFrame:
        a = classes.select(F.col("node").alias("a"), F.col("class").alias("class_a"))
        b = classes.select(F.col("node").alias("b"), F.col("class").alias("class_b"))
        return pairs.join(a, "a", "left").join(b, "b", "left").filter(F.coalesce("class_a", "a") != F.coalesce("class_b", "b")).select("a", "b")

    rest = stars.join(one, ["a", "b"], "left_anti")
    rest = save(scratch, other_class(rest, classes), "rest")
    if not rest.isEmpty():
        join.verify(rest, "rest")
        classes = join.classes("classes-rest")

    mixed = save(scratch, _mixed(members, classes), "mixed")
    for turn in range(PIVOT_ROUNDS):
        homes = save(scratch, _homes(mixed), f"homes-{turn}")
        inside = homes.count()
        if not inside:
            break
        linked = join.verify(_pivot_pairs(homes, join, t, turn), f"pivots-{turn}")
        if linked:
            classes = join.classes(f"classes-pivots-{turn + 1}")
            mixed = save(scratch, _mixed(mixed.select("key", "node"), classes), f"mixed-{turn + 1}")
        if turn and linked <= LINKING_SHARE * inside:
            break

    # What is left of tiles with several classes: sets of different classes meet there directly.
    x = mixed.select("key", F.col("node").alias("a"), F.col("class").alias("class_a")).join(join.left, "a")
    y = mixed.select("key", F.col("node").alias("b"), F.col("class").alias("class_b")).join(join.right, "b")
    meet = (x["key"] == y["key"]) & (F.col("a") < F.col("b")) & (F.col("class_a") != F.col("class_b")) & may_be_similar(t)
    cross = x.join(y, meet).select("a", "b").distinct()
    cross = save(scratch, cross.join(stars, ["a", "b"], "left_anti"), "cross")
    if not cross.isEmpty():
        join.verify(cross, "cross")
        classes = join.classes("classes-cross")

    digests = copies.join(classes, "node", "left").select("digest", F.coalesce("class", "node").alias("class"))
    classed = signed.select("row_id", "doc_id", "size", "digest").join(digests, "digest", "left").withColumn("class", F.coalesce("class", "row_id"))
    named = classed.groupBy("class").agg(F.min(F.struct("doc_id", "row_id")).alias("first"))
    out = classed.join(named, "class")
    return out.select("row_id", "doc_id", F.col("size").alias("n_shingles"), F.col("first.doc_id").alias("component_id"), (F.col("row_id") == F.col("first.row_id")).alias("is_first"))
