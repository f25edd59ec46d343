"""Token ids of documents in binary files, in order of their ids, and back.

Documents are range-partitioned by id and sorted. A task encodes its documents one after the other and cuts the stream of
ids into frames of whole documents, each of as many coder blocks as one pass of `mixcoder` handles. Files are Parquet, so
that they are written and committed by Spark on any file system and a lost executor's part is written again: a row is a
frame, with its place (``part``, ``segment``) and the ids and lengths of its documents. Blocks inside a frame can be read
alone, by the frame's directory.

Places in the whole stream are not stored: they follow from sums over frames, taken from what was decoded.

Defined cases: a null or empty text is the end id alone; rows without id come first; rows of one id follow each other by a
hash of their text, and each is written; a text longer than a frame is a frame of its own; an empty table gives files
without frames and no rows; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.common import passes, save, workspace
from kinfold.llm.mixcoder import BLOCK, LANES, decode, encode
from kinfold.llm.packing import tokenizer
from kinfold.scratch import Scratch

#: Bytes of text of one range of documents, about.
RANGE_BYTES = 20_000_000
FRAME = "part int, segment int, doc_ids array<bigint>, lengths array<bigint>, frame binary"
#: Digit of a part number; sums are taken digit by digit.
_DIGIT = 1 << 16


def _frames(path: str, end_id: int, frame_ids: int):
    def run(batches):
        own = tokenizer(path)
        bits = max(own.loaded.get_vocab_size(), end_id + 1).bit_length()
        part, segment, held, doc_ids = 0, 0, [], []

        def frame() -> pa.RecordBatch:
            lengths = [len(x) for x in held]
            columns = [[part], [segment], [doc_ids], [lengths], [encode(np.concatenate(held), bits)]]
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["part", "segment", "doc_ids", "lengths", "frame"])

        size = 0
        for batch in passes(batches):
            for number, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("part", "doc_id", "text")], strict=True):
                ids = np.frombuffer(array("I", [*(own.encode(text) if text else ()), end_id]), np.uint32)
                if held and size + len(ids) > frame_ids:
                    yield frame()
                    segment, held, doc_ids, size = segment + 1, [], [], 0
                part = number
                held.append(ids)
                doc_ids.append(doc_id)
                size += len(ids)
        if held:
            yield frame()

    return run


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = 2, frame_ids: int = BLOCK * LANES) -> None:
    """Write the ids of ``docs``, whole-number ``doc_id`` ascending, as files in ``folder``."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranges = max(1, math.ceil((read.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / RANGE_BYTES))
    # The row number spreads rows that are equal in all else; it decides nothing.
    keyed = read.withColumn("row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("row")]
    sorted_docs = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = sorted_docs.select("doc_id", "text", F.spark_partition_id().alias("part"))
    placed.mapInArrow(_frames(path, end_id, frame_ids), FRAME).write.option("compression", "none").parquet(folder)


def frames(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(FRAME).parquet(folder)


def _documents(keep_ids: bool):
    """Decoded documents of each frame, with ``within``, the ids of the frame before them."""
    names = ["part", "segment", "within", "doc_id", "n_tokens", "ids_crc32", *(["ids"] if keep_ids else [])]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                part, segment, doc_ids, lengths, raw = (batch.column(c)[i] for c in ("part", "segment", "doc_ids", "lengths", "frame"))
                ids = decode(raw.as_py())
                size = lengths.values.to_numpy().astype(np.int64)
                ends = np.cumsum(size)
                if ends[-1] != len(ids):
                    raise ValueError("lengths of documents do not match their frame")
                wide = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(wide[4 * (b - n) : 4 * b]) for b, n in zip(ends.tolist(), size.tolist(), strict=True)]
                n = len(size)
                columns = [pa.array([part.as_py()] * n, pa.int32()), pa.array([segment.as_py()] * n, pa.int32()), pa.array(ends - size), doc_ids.values, pa.array(size), pa.array(crc, pa.int64())]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _starts(documents: DataFrame) -> DataFrame:
    """Ids before each frame: sums over the segments of a part, over the parts of a digit, and over digits."""
    segments = documents.groupBy("part", "segment").agg(F.sum("n_tokens").alias("n")).withColumn("digit", F.expr(f"part div {_DIGIT}").cast("int"))
    parts = segments.groupBy("digit", "part").agg(F.sum("n").alias("n"))
    digits = parts.groupBy("digit").agg(F.sum("n").alias("n"))

    def before(rows: DataFrame, within: list[str], by: str, name: str) -> DataFrame:
        order = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(name, F.coalesce(F.sum("n").over(order), F.lit(0))).drop("n")

    at = before(digits, [], "digit", "x").join(before(parts, ["digit"], "part", "y"), "digit")
    at = before(segments, ["part"], "segment", "z").drop("digit").join(at, "part")
    return at.select("part", "segment", (F.col("x") + F.col("y") + F.col("z")).alias("before"))


def read_tokens(spark: SparkSession, folder: str, scratch: Scratch, keep_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document in the files of ``folder``.

    A frame that does not decode to what was written raises an error.
    """
    ddl = "part int, segment int, within long, doc_id long, n_tokens long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    documents = save(scratch, frames(spark, folder).mapInArrow(_documents(keep_ids), ddl), "documents")
    placed = documents.join(_starts(documents), ["part", "segment"])
    return placed.select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))


def token_files(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write the files of ``docs`` in a folder of the run, and read their documents back without the ids."""
    scratch = workspace(docs.sparkSession, "tokens")
    folder = f"{scratch.path}/files"
    write_tokens(docs, path, folder, end_id)
    return read_tokens(docs.sparkSession, folder, scratch, keep_ids=False)
