"""Alignment of the tokens of two tokenizers over the same texts.

Both tokenizers cut the bytes of a text into intervals. The intervals of all texts of a pass lie behind each other on one
line; they are sorted by their start, and a running maximum of the ends tells where groups break: at a start that
reaches it, tokens of both sides have ended. Inside a group the tokens that overlap are linked.

How often a pair of ids is linked is counted over the whole corpus. A chunk of texts (``CHUNK_BYTES``) sends each of its
distinct pairs once, with a count, and gets one answer for each, so a pair that every text holds costs one row
for each chunk and no key grows with the texts. Per text only places in the chunk's list of pairs are kept.

``a`` is a byte-level file of ``tokenizers`` and reads a space and the text; ``b`` is a ``sentencepiece`` model, which adds
that space itself. Strings of special tokens inside a text are plain text.

Defined cases: a null or empty text, or one whose tokens do not give its bytes back on both sides, has no tokens: zeros
and an empty ``groups_sha256``; repeated rows are counted and returned each; an empty table gives no rows; columns other
than ``doc_id`` and ``text`` are not read. A text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import json
from functools import cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.common import flat, passes, save, workspace
from kinfold.llm.packing import Tokenizer, _byte_of

CHUNK_BYTES = 32_000_000
#: Rows of one Arrow batch that leaves a task.
OUT_ROWS = 2_000
DIGITS = 10
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Side:
    """Ids of texts, and the bytes and size of every id."""

    def __init__(self, table: list[bytes]):
        self.table = table
        self.size = np.array([len(x) for x in table], np.int64)
        self.bits = len(table).bit_length()
        text = [str(i).encode() for i in range(len(table))]
        self.digits = np.zeros((len(table), DIGITS), np.uint8)
        for i, t in enumerate(text):
            self.digits[i, : len(t)] = np.frombuffer(t, np.uint8)
        self.digits_of = np.array([len(t) for t in text], np.int64)

    def gives_back(self, ids: list[int], raw: bytes) -> bool:
        return b"".join(map(self.table.__getitem__, ids)) == raw


class ByteLevel(Side):
    def __init__(self, path: str):
        with open(path) as f:
            described = json.load(f)
        self.own = Tokenizer(path)
        # Strings of special tokens are ordinary text on both ways of the tokenizer.
        self.own.loaded.encode_special_tokens = True
        special, self.own.special = set(self.own.special), []
        byte_of = _byte_of()
        vocabulary = described["model"]["vocab"]
        table = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            table[i] = token.encode() if token in special else bytes(byte_of[c] for c in token)
        super().__init__(table)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.own.encode(" " + t) for t in texts]


class Pieces(Side):
    def __init__(self, path: str):
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [(i, self.own.id_to_piece(i)) for i in range(self.own.get_piece_size())]
        super().__init__([bytes([int(p[3:5], 16)]) if self.own.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.own.encode(texts, num_threads=1)


@cache
def sides(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(path_a), Pieces(path_b)


def coalesce(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every interval of a and of b; intervals of one side are in order and do not overlap."""
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    side = np.repeat(np.array([0, 1], np.int8), [len(start_a), len(start_b)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    opens = np.ones(len(order), bool)
    opens[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    return group[: len(start_a)], group[len(start_a) :]


def overlaps(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the intervals of a and b of every overlapping pair."""
    first = np.searchsorted(end_b, start_a, "right")
    count = np.searchsorted(start_b, end_a, "left") - first
    before = np.cumsum(count) - count
    a = np.repeat(np.arange(len(start_a)), count)
    return a, np.arange(len(a)) - np.repeat(before - first, count)


def _written(a: Side, b: Side, ids: tuple[np.ndarray, np.ndarray], group: tuple[np.ndarray, np.ndarray], last_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All groups as text, and the number of bytes of each token with its separator, in the order of the text.

    ``last_b`` marks the last token of b in each text, which no separator follows.
    """
    groups = int(group[0][-1]) + 1
    first_a, first_b = (np.searchsorted(g, np.arange(groups + 1)) for g in group)
    at = (np.arange(len(ids[0])) + first_b[group[0]], np.arange(len(ids[1])) + first_a[group[1] + 1])
    total = len(ids[0]) + len(ids[1])
    digits, size = np.empty((total, DIGITS), np.uint8), np.empty(total, np.int64)
    mark = np.empty(total, np.uint8)
    for side, i, g, where, end in zip((a, b), ids, group, at, b"|;", strict=True):
        digits[where], size[where] = side.digits[i], side.digits_of[i]
        mark[where] = np.where(np.append(g[1:] == g[:-1], False), ord(","), end)
    digits[np.arange(total), size] = mark
    size += 1
    size[at[1][last_b]] -= 1
    return digits[np.arange(DIGITS) < size[:, None]].tobytes(), size


class _Aligned:
    """The texts of one pass: their counts, hashes, and distinct pairs with the number of their links."""

    def __init__(self, column: pa.Array, a: Side, b: Side):
        data, offsets = flat(column)
        n = len(column)
        self.counts = {c: np.zeros(n, np.int64) for c in COUNTS}
        self.hashes = [""] * n
        texts = column.to_pylist()
        asked = [i for i, t in enumerate(texts) if t]
        found = [a.encode([texts[i] for i in asked]), b.encode([texts[i] for i in asked])]
        raw = [b" " + data[offsets[i] : offsets[i + 1]].tobytes() for i in asked]
        good = [k for k in range(len(asked)) if a.gives_back(found[0][k], raw[k]) and b.gives_back(found[1][k], raw[k])]
        self.text = np.zeros(0, np.int64)
        self.pair = self.links = self.text
        if not good:
            return
        own = np.array([asked[k] for k in good], np.int64)
        ids, text, start, end = [], [], [], []
        for side, of in zip((a, b), found, strict=True):
            ids.append(np.fromiter((x for k in good for x in of[k]), np.int64))
            text.append(np.repeat(np.arange(len(good)), [len(of[k]) for k in good]))
            end.append(np.cumsum(side.size[ids[-1]]))
            start.append(end[-1] - side.size[ids[-1]])
        group = coalesce(start[0], end[0], start[1], end[1])
        left, right = overlaps(start[0], end[0], start[1], end[1])
        per = [np.bincount(t, minlength=len(good)) for t in text]
        opens = np.append(True, group[0][1:] != group[0][:-1])
        values = (*per, np.bincount(text[0][opens], minlength=len(good)), np.bincount(text[0][left], minlength=len(good)))
        for c, v in zip(COUNTS, values, strict=True):
            self.counts[c][own] = v
        whole, size = _written(a, b, tuple(ids), group, np.cumsum(per[1]) - 1)
        cut = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(per[0] + per[1])])]
        for i, x, y in zip(own.tolist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            self.hashes[i] = sha256(memoryview(whole)[x:y]).hexdigest()
        bits = a.bits + b.bits
        key = np.sort(text[0][left] << bits | ids[1][right] << a.bits | ids[0][left])
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        self.text, self.pair = own[key[head] >> bits], key[head] & ((1 << bits) - 1)
        self.links = np.diff(np.append(head, len(key)))


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, which packs small ones well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


def _chunks(path_a: str, path_b: str):
    """Rows of texts with places in their chunk's list of pairs, and one row with that list for each chunk."""
    names = ("chunk", "doc_id", *COUNTS, "groups_sha256", "uses", "pairs")

    def run(batches):
        a, b = sides(path_a, path_b)
        kind, held, size = None, [], 0

        def chunk():
            number = held[0][0].column("row_id")[0].as_py()
            pairs, inverse = np.unique(np.concatenate([x.pair for _, x in held]), return_inverse=True)
            links = np.concatenate([x.links for _, x in held])
            total = np.bincount(inverse, weights=links, minlength=len(pairs)).astype("<i8")
            done = 0
            for batch, x in held:
                place = inverse[done : done + len(x.pair)]
                done += len(x.pair)
                cut = np.searchsorted(x.text, np.arange(batch.num_rows + 1))
                uses = []
                for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    # Pairs of a text ascend, so their places do; steps are smaller numbers.
                    uses.append(_planes(np.concatenate([np.diff(place[i:j], prepend=0), x.links[i:j]])))
                columns = [pa.array([number] * batch.num_rows, pa.int64()), batch.column("doc_id"), *[pa.array(x.counts[c]) for c in COUNTS]]
                columns += [pa.array(x.hashes, pa.string()), pa.array(uses, pa.binary()), pa.nulls(batch.num_rows, pa.binary())]
                whole = pa.RecordBatch.from_arrays(columns, names=names)
                for at in range(0, batch.num_rows, OUT_ROWS):
                    yield whole.slice(at, OUT_ROWS)
            if len(pairs):
                listed = np.concatenate([pairs.astype("<i8"), total]).tobytes()
                empty = [pa.nulls(1, kind), *[pa.nulls(1, pa.int64()) for _ in COUNTS], pa.nulls(1, pa.string()), pa.nulls(1, pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *empty, pa.array([listed], pa.binary())], names=names)

        for batch in passes(batches):
            kind = batch.column("doc_id").type
            held.append((batch.select(["row_id", "doc_id"]), _Aligned(batch.column("text"), a, b)))
            size += int(flat(batch.column("text"))[1][-1])
            if size >= CHUNK_BYTES:
                yield from chunk()
                held, size = [], 0
        if held:
            yield from chunk()

    return run


def _listed(bits: int):
    """The pairs of each chunk as rows: ``chunk``, ``place``, ``a``, ``b`` and ``n``."""

    def run(batches):
        for batch in batches:
            for number, raw in zip(batch.column("chunk").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
                pairs, n = np.frombuffer(raw, "<i8").reshape(2, -1)
                for at in range(0, len(pairs), 50_000):
                    own = pairs[at : at + 50_000]
                    columns = [np.full(len(own), number), np.arange(at, at + len(own), dtype=np.int32), (own & ((1 << bits) - 1)).astype(np.int32), (own >> bits).astype(np.int32), n[at : at + len(own)]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["chunk", "place", "a", "b", "n"])

    return run


def _answered(texts: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """Sums over the links of each text of a chunk."""
    count = np.zeros(len(pairs), np.int64)
    best = np.zeros(len(pairs), np.int64)
    place = pairs["place"].to_numpy()
    count[place], best[place] = pairs["count"].to_numpy(), pairs["best"].to_numpy()
    n_best, count_sum = [], []
    for raw in texts["uses"]:
        steps, links = _from_planes(raw).reshape(2, -1)
        at = np.cumsum(steps)
        n_best.append(int(links @ best[at]))
        count_sum.append(int(links @ count[at]))
    return texts.drop(columns=["chunk", "uses"]).assign(n_best=np.array(n_best, np.int64), count_sum=np.array(count_sum, np.int64))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    ``count_sum`` adds up, over the links of a text, how often the link's pair of ids is linked in the corpus; ``n_best``
    counts the links whose pair is the most frequent one of its id of ``b``, ties included.
    """
    scratch = workspace(docs.sparkSession, "alignment")
    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"{c} long" for c in COUNTS)
    rows = read.mapInArrow(_chunks(path_a, path_b), f"chunk long, doc_id {kind}, {counts}, groups_sha256 string, uses binary, pairs binary")
    rows = save(scratch, rows, "texts")
    bits = sides(path_a, path_b)[0].bits
    listed = rows.filter("pairs is not null").select("chunk", "pairs").mapInArrow(_listed(bits), "chunk long, place int, a int, b int, n long")
    counted = listed.withColumn("count", F.sum("n").over(Window.partitionBy("a", "b"))).select("chunk", "place", "b", "count")
    counted = save(scratch, counted, "pairs")
    most = counted.groupBy("b").agg(F.max("count").alias("most"))  # at most one row for each id of b
    answers = counted.join(F.broadcast(most), "b").select("chunk", "place", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
    texts = rows.filter("pairs is null").drop("pairs")
    # Ids as text: pandas has no whole numbers beside nulls.
    texts = texts.withColumn("doc_id", F.col("doc_id").cast("string"))
    ddl = f"doc_id string, {counts}, groups_sha256 string, n_best long, count_sum long"
    out = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_answered, ddl)
    return out.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
