"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

A document is its token ids and one end id. One that is longer than a sequence is cut: full pieces, before them a
shorter first piece. Pieces are packed in two parts. Each partition packs its own by best fit, largest first, into
the fullest bin that still takes the piece. Bins filled to ``nearly`` of the capacity are done. The others become items
of a tree: hashed into groups of ``group`` bins, packed again by best fit, until one group is left. A round closes at
least the fuller half of what it leaves open, so every group stays bounded and the rounds end; a bin that is closed
early is a sequence like any other.

Only lengths travel between the rounds; ids are written once with their piece.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; an empty table gives no rows;
columns of ``docs`` other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import map_batches, save, workspace

CAPACITY = 2048
NEARLY = 0.995
GROUP = 20_000
CHUNK = 500_000
#: Parts of byte-level tokenization, fixed by the vocabulary: contractions, words, numbers, signs and spaces.
PARTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same where no two of these meet, without a look ahead, which slows every part.
APART = PARTS.replace(r"\s+(?!\S)|", "")
MEETING = ("  ", " \n", "\n ", "\n\n", "\t", "\r")
#: Characters whose classes are the same in every Unicode version.
_PLAIN = re.compile("[\t\n\r -~¡-©«-±´-ſ]*")


def _byte_of() -> dict[str, int]:
    """Byte behind each character of a byte-level vocabulary: visible ones stand for themselves, others follow U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in visible)
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Tokenizer:
    """Ids of texts by a ``tokenizers`` file.

    Where the file is plain byte-level merging, texts of common characters go through ``tiktoken`` with the file's
    vocabulary as ranks: the same ids at a sixth of the time. All other texts go through ``tokenizers``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Loaded

        with open(path) as f:
            described = json.load(f)
        self.loaded = Loaded.from_file(path)
        self.special = [t["content"] for t in described.get("added_tokens", [])]
        self.fast, self.apart = self._same_ranks(described)

    def _same_ranks(self, described: dict) -> tuple[tiktoken.Encoding, tiktoken.Encoding] | tuple[None, None]:
        kind, model = described.get("pre_tokenizer") or {}, described["model"]
        plain = described.get("normalizer") is None and kind.get("type") == "ByteLevel" and not kind.get("add_prefix_space") and kind.get("use_regex", True)
        if not plain or model.get("type") != "BPE" or model.get("ignore_merges") or model.get("byte_fallback"):
            return None, None
        byte_of = _byte_of()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in self.special}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        if [model["vocab"][m.replace(" ", "")] for m in merges] != list(range(256, 256 + len(merges))):
            return None, None  # ids do not follow the order of the merges
        return tuple(tiktoken.Encoding(name, pat_str=parts, mergeable_ranks=ranks, special_tokens={}) for name, parts in (("plain", PARTS), ("apart", APART)))

    def encode(self, text: str) -> list[int]:
        if self.fast is None or not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return self.loaded.encode(text, add_special_tokens=False).ids
        return (self.fast if any(s in text for s in MEETING) else self.apart).encode_ordinary(text)


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def _cut(path: str, capacity: int, end_id: int):
    def make(batch: pa.RecordBatch) -> dict:
        encode = tokenizer(path).encode
        source, piece, start, ids = [], [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            whole = np.array([*(encode(text) if text else ()), end_id], np.int32)
            edges = [0, *range((len(whole) - 1) % capacity + 1, len(whole) + 1, capacity)]
            for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                source.append(i)
                piece.append(k)
                start.append(a)
                ids.append(whole[a:b])
        lengths = np.array([len(x) for x in ids], np.int64)
        bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return {
            "doc_id": batch.column("doc_id").take(pa.array(source, pa.int64())),
            "piece": np.array(piece, np.int32), "start": np.array(start, np.int64), "length": lengths,
            "ids_crc32": np.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], np.int64),
            "ids": pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids))),
        }

    return make


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, largest first into the fullest bin that takes it, and the fill of each bin."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has r left
    fills: list[int] = []
    order = np.argsort(-sizes, kind="stable")
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            of = by_room[room]
            b = of.pop()
            if not of:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        if room > size:
            by_room[room - size].append(b)
            rooms |= 1 << (room - size)
    return bins, offsets, np.array(fills, np.int64)


def _first(bins: np.ndarray, offsets: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Name of each item's bin: the key of the item at its start."""
    name = np.zeros(bins.max() + 1, np.int64)
    at = offsets == 0
    name[bins[at]] = keys[at]
    return name[bins]


def _local(capacity: int):
    def pack(item: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
        bins, offsets, fills = best_fit(length, capacity)
        name = _first(bins, offsets, item)
        return pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(name), pa.array(offsets), pa.array(np.where(item == name, fills[bins], 0))], names=["item", "bin", "place", "fill"]
        )

    def run(batches):
        items, lengths, held = [], [], 0
        for batch in batches:
            items.append(batch.column("item").to_numpy())
            lengths.append(batch.column("length").to_numpy())
            held += batch.num_rows
            if held >= CHUNK:
                yield pack(np.concatenate(items), np.concatenate(lengths))
                items, lengths, held = [], [], 0
        if held:
            yield pack(np.concatenate(items), np.concatenate(lengths))

    return run


def _merge(capacity: int, done: int, last: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bin")
        key, fill = group["bin"].to_numpy(), group["fill"].to_numpy()
        bins, offsets, fills = best_fit(fill, capacity)
        root = _first(bins, offsets, key)
        at = key == root
        total = fills[bins]
        still = at & (total < done) & (not last)
        # Close at least the fuller half, so that the next round is smaller whatever the sizes are.
        left = np.flatnonzero(still)
        still[left[np.argsort(-total[left], kind="stable")][: (len(left) + 1) // 2]] = False
        return pd.DataFrame({"bin": key, "root": root, "shift": offsets, "fill": np.where(at, total, 0), "open": still})

    return run


def place(pieces: DataFrame, scratch, capacity: int = CAPACITY, nearly: float = NEARLY, group: int = GROUP) -> DataFrame:
    """``item, sequence_id, offset`` for pieces with ``item`` and ``length``."""
    local = save(scratch, pieces.select("item", "length").mapInArrow(_local(capacity), "item long, bin long, place long, fill long"), "local")
    done = math.ceil(nearly * capacity)
    opened = local.filter((F.col("item") == F.col("bin")) & (F.col("fill") < done)).select("bin", "fill")
    moved, count, level = None, opened.count(), 0
    while count:
        groups = math.ceil(count / group)
        keyed = opened.withColumn("group", F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(groups)))
        merged = keyed.groupBy("group").applyInPandas(_merge(capacity, done, groups == 1), "bin long, root long, shift long, fill long, open boolean")
        merged = save(scratch, merged, f"merged-{level}")
        step = merged.select("bin", "root", "shift")
        if moved is None:
            moved = step
        else:
            then = step.select(F.col("bin").alias("root"), F.col("root").alias("next"), F.col("shift").alias("more"))
            moved = moved.join(then, "root", "left").select("bin", F.coalesce("next", "root").alias("root"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
        opened = merged.filter("open").select("bin", "fill")
        count, level = (0 if groups == 1 else opened.count()), level + 1
    if moved is None:
        return local.select("item", F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))
    joined = local.join(moved, "bin", "left")
    return joined.select("item", F.coalesce("root", "bin").alias("sequence_id"), (F.col("place") + F.coalesce("shift", F.lit(0))).alias("offset"))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids``."""
    scratch = workspace(docs.sparkSession, "packing")
    read = docs.select("doc_id", "text")
    kind = read.schema["doc_id"].dataType.simpleString()
    cut = map_batches(read, _cut(path, capacity, end_id), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids array<int>")
    pieces = save(scratch, cut.withColumn("item", F.monotonically_increasing_id()), "pieces")
    placed = place(pieces, scratch, capacity)
    return pieces.join(placed, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")
