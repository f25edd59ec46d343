"""Helpers of the text operators: row numbers, Arrow batches as flat byte arrays, words and hashes.

Texts reach Python in Arrow batches. A batch is handled as one flat array of UTF-8 bytes with offsets, so that
words, lines and hashes of a thousand documents come from a few numpy calls.
"""

from __future__ import annotations

import copy
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.scratch import Scratch

#: Rows in one Arrow batch; texts may be long, so the default of 10,000 would not bound memory.
BATCH_ROWS = 500
#: Bytes of text that one numpy pass handles; a longer text is a pass of its own.
PASS_BYTES = 4_000_000

#: Bytes that end a word: space and U+0009 to U+000D. No byte of a longer UTF-8 character is among them.
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Bytes that are not part of a run of ASCII letters, digits and longer UTF-8 characters.
NOT_LETTERS = np.ones(256, bool)
NOT_LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def in_small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, unless the session asks for fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def workspace(spark: SparkSession, label: str) -> Scratch:
    in_small_batches(spark)
    return Scratch(spark, f"{label}-{uuid.uuid4().hex[:8]}")


def partitions_of(spark: SparkSession, least: int = 1) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), least)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def save(scratch: Scratch, df: DataFrame, name: str) -> DataFrame:
    """Write a table of the run compressed and read it back; later plans start from its files."""
    path = f"{scratch.path}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return scratch.spark.read.schema(df.schema).parquet(path)


def numbered(scratch: Scratch, docs: DataFrame, name: str = "rows", **columns) -> DataFrame:
    """``row_id`` and the given columns, written once: repeated rows keep numbers of their own."""
    return save(scratch, docs.select(F.monotonically_increasing_id().alias("row_id"), *[c.alias(k) for k, c in columns.items()]), name)


def fold(column: str, parts: int):
    """``crc32(column as text) mod parts``; a null counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow column, and ``n + 1`` offsets; a null has no bytes."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def passes(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``size`` bytes of text at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], dict | None], schema: str, text: str = "text", size: int = PASS_BYTES) -> DataFrame:
    """``mapInArrow`` of a function from a bounded batch to columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema), prefers_large_types=False)

    def run(batches):
        for batch in passes(batches, text, size):
            columns = make(batch)
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c := columns[f.name], pa.Array) and c.type == f.type else pa.array(c, f.type, from_pandas=False) for f in target],
                    schema=target,
                )

    return df.mapInArrow(run, schema)


class Words:
    """Words of a batch: ``starts`` and ``ends`` in its bytes, and the text ``doc`` each is in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = _SEPARATOR):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        inside = ~separators[data]
        first = inside.copy()
        if len(data):
            edge = offsets[1:-1]
            edge = edge[edge < len(data)]
            first[1:] &= ~inside[:-1]
            last = inside.copy()
            last[:-1] &= ~inside[1:]
            first[edge] = inside[edge]
            edge = edge[edge > 0]
            last[edge - 1] = inside[edge - 1]
        else:
            last = first
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.inside = inside
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        self.count = np.bincount(self.doc, minlength=len(offsets) - 1)
        #: Words of text ``i`` are ``bounds[i]`` to ``bounds[i + 1]``.
        self.bounds = np.concatenate([[0], np.cumsum(self.count)])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes and length."""
        return hash_spans(self.data, self.starts, self.ends - self.starts)

    def distinct(self) -> tuple[Words, np.ndarray]:
        """The different words of the batch, one of each, and which of them every word is."""
        _, first, which = np.unique(self.hashes(), return_index=True, return_inverse=True)
        each = copy.copy(self)
        each.starts, each.ends = self.starts[first], self.ends[first]
        return each, which

    def prefix_hashes(self, lengths: tuple[int, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Hashes of the words, and of their first ``n`` bytes for each of ``lengths``; a shorter word's own hash."""
        size = self.ends - self.starts
        if not len(size):
            return np.zeros(0, np.uint64), [np.zeros(0, np.uint64)] * len(lengths)
        terms, heads = _span_terms(self.data, self.starts, size)
        whole = mix(np.add.reduceat(terms, heads) + size.astype(np.uint64))
        found, total, done = [], np.zeros(len(size), np.uint64), 0
        for n in sorted(lengths):
            for i in range(done, n):
                total = total + terms[np.minimum(heads + i, len(terms) - 1)]
            done = n
            found.append(np.where(size > n, mix(total + np.uint64(n)), whole))
        return whole, found


def _span_terms(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The summands of the spans' hashes, and where each span's begin."""
    heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
    return _BYTE_CODE[data[np.repeat(starts, lengths) + place]] * powers(int(lengths.max()))[place], heads


def hash_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes and length of each span; spans are not empty."""
    if not len(lengths):
        return np.zeros(0, np.uint64)
    terms, heads = _span_terms(data, starts, lengths)
    return mix(np.add.reduceat(terms, heads) + lengths.astype(np.uint64))


def total_in(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between each two ``bounds``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def grams(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``n`` hashes inside one text, and the positions at which the runs start."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rolled = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        rolled = rolled * _BASE + hashes[i : len(hashes) - n + 1 + i]
    whole = np.ones(len(rolled), bool)
    for end in bounds[1:-1]:
        whole[max(0, end - n + 1) : end] = False
    at = np.flatnonzero(whole)
    return mix(rolled[at]), at
