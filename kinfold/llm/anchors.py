"""Candidates for exact repeats: stretches of text that share an anchor.

A text is a row of symbols (bytes, or words by their hash). Among the runs of ``gram`` symbols inside a window of
``length`` symbols the one of least hash is the window's anchor, the first of equals. Equal windows have equal anchors
at equal places, so a window that occurs twice shows up as an anchor that occurs twice. Neighbouring windows with the
same anchor form a stretch. Most anchors of a corpus occur once and go after a count of hashes; only the stretches
of the others are compared.

Stretches with equal content are one class with a number and a first place. Where an anchor has several classes, the
content of each class's first stretch is read and handed to a shard, which finds windows that classes share. An
anchor with more than ``HOT`` classes would fill a shard, so its stretches are cut into parts that meet by 128-bit
hashes instead; counts combine before they are shuffled.

Texts lie in a bucketed table by document id, so they are shuffled once and every later join finds them in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.common import _BASE, _BYTE_CODE, Words, flat, map_batches, mix, partitions_of, passes, save
from kinfold.scratch import Scratch

HOT = 1_000
SHARD_BYTES = 1_500_000
#: Bytes of text whose anchors are found at a time; a byte takes up to nine arrays of eight bytes each.
STRETCH_BYTES = 500_000
#: Parts into which a stretch of such an anchor is cut at a time.
SPLIT = 5
PLACE_BITS = 16
RANGES = "array<struct<first:int,last:int>>"


class Symbols:
    """How a batch of texts becomes rows of symbols; ``gram`` is a power of two."""

    def __init__(self, kind: str, length: int, gram: int):
        self.kind, self.length, self.gram = kind, length, gram
        self.width = 1 if kind == "bytes" else 8

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = flat(column)
        if self.kind == "bytes":
            return data, offsets
        words = Words(data, offsets)
        return words.hashes(), words.bounds

    def stretches(self, symbols: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        """``doc``, first start ``at`` in the batch, number of further starts ``span``, anchor ``off`` and hash ``h``."""
        size = self.length - self.gram + 1
        code = (_BYTE_CODE[symbols] if self.kind == "bytes" else symbols).copy()
        step, base = 1, int(_BASE)
        while step < self.gram:
            code = code[:-step] * np.uint64(base) + code[step:] if len(code) > step else code[:0]
            base = base * base % 2**64
            step *= 2
        code = mix(code)
        starts = len(symbols) - self.length + 1
        if starts <= 0:
            return {k: np.zeros(0, np.int64) for k in ("doc", "at", "span", "off")} | {"h": np.zeros(0, np.uint64)}
        low = (code & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(code), dtype=np.uint64)
        step = 1
        while step * 2 <= size:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < size:
            low = np.minimum(low[: len(low) - (size - step)], low[size - step :])
        anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        inside = np.zeros(starts + 1, np.int64)
        ends = bounds[1:] - self.length + 1
        has = ends > bounds[:-1]
        np.add.at(inside, bounds[:-1][has], 1)
        np.add.at(inside, ends[has], -1)
        at = np.flatnonzero(np.cumsum(inside)[:-1])
        if not len(at):
            return {k: np.zeros(0, np.int64) for k in ("doc", "at", "span", "off")} | {"h": np.zeros(0, np.uint64)}
        own = anchor[at]
        first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)]))
        doc = np.searchsorted(bounds, at[first], "right") - 1
        last = np.append(first[1:], len(at)) - 1
        return {"doc": doc, "at": at[first], "span": at[last] - at[first], "off": own[first] - at[first], "h": code[own[first]]}

    def content(self, symbols: np.ndarray, at: np.ndarray, span: np.ndarray) -> list[bytes]:
        raw = symbols.tobytes() if self.kind == "words" else memoryview(symbols)
        w = self.width
        return [bytes(raw[a * w : (a + s + self.length) * w]) for a, s in zip(at.tolist(), span.tolist(), strict=True)]


def texts_of(scratch: Scratch, docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``key, copy, doc_id, text, carried`` in a table bucketed by ``key``.

    The key is the id, 0 for a null; ``copy`` numbers the rows of one key, nulls first, then by their text.
    ``carried`` is a struct of the columns in ``carry``.
    """
    n = partitions_of(scratch.spark)
    key = F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType))
    carried = F.struct(F.lit(True).alias("row"), *[F.col(f"`{c}`") for c in carry]).alias("carried")
    rows = docs.select(key.alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text"), carried).repartition(n, "key")
    order = Window.partitionBy("key").orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.length("text"))
    rows = rows.withColumn("copy", F.row_number().over(order) - 1).select("key", "copy", "doc_id", "text", "carried")
    name = f"texts_{uuid.uuid4().hex}"
    rows.write.bucketBy(n, "key").option("path", f"{scratch.path}/texts").option("compression", "zstd").saveAsTable(name)
    return scratch.spark.table(name)


def _hashes(symbols: Symbols):
    def run(batches):
        for batch in passes(batches, size=STRETCH_BYTES):
            found = symbols.stretches(*symbols.read(batch.column("text")))
            h, n = np.unique(found["h"].view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "n"])

    return run


def _stretches(symbols: Symbols):
    def make(batch: pa.RecordBatch) -> dict:
        rows, bounds = symbols.read(batch.column("text"))
        x = symbols.stretches(rows, bounds)
        same = [xxhash.xxh3_64_intdigest(c, seed=o) for c, o in zip(symbols.content(rows, x["at"], x["span"]), x["off"].tolist(), strict=True)]
        doc = pa.array(x["doc"])
        place = (x["at"] - bounds[x["doc"]] << PLACE_BITS) | x["span"] << 8 | x["off"]
        return {
            "key": batch.column("key").take(doc), "copy": batch.column("copy").take(doc), "place": place,
            "h": x["h"].view(np.int64), "f": np.array(same, np.uint64).view(np.int64),
        }

    return make


def _contents(symbols: Symbols):
    """Content of the wanted stretches of each text."""

    def make(batch: pa.RecordBatch) -> dict | None:
        rows, bounds = symbols.read(batch.column("text"))
        out: dict[str, list] = {k: [] for k in ("key", "copy", "place", "h", "f", "several", "content")}
        keys, copies = batch.column("key").to_pylist(), batch.column("copy").to_pylist()
        for i, wanted in enumerate(batch.column("wanted").to_pylist()):
            place = np.array([w["place"] for w in wanted], np.int64)
            for w, c in zip(wanted, symbols.content(rows, bounds[i] + (place >> PLACE_BITS), place >> 8 & 255), strict=True):
                for k, v in (("key", keys[i]), ("copy", copies[i]), ("place", w["place"]), ("h", w["h"]), ("f", w["f"]), ("several", w["several"]), ("content", c)):
                    out[k].append(v)
        return out if out["f"] else None

    return make


def _split(symbols: Symbols, step: int):
    """Each stretch cut at multiples of ``step`` starts from its anchor.

    A part comes with a hash of itself, and of the core that all windows of its cell cover; cells of equal windows
    are the same, as their anchors are.
    """

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                out: dict[str, list] = {k: [] for k in ("row", "start", "starts", "content", "whole", "core")}
                w, size = symbols.width, symbols.length
                columns = (part.column(c).to_pylist() for c in ("place", "start", "starts", "content"))
                for k, (place, first, m, c) in enumerate(zip(*columns, strict=True)):
                    begin = first - (place & 255) + 256 * step  # never negative
                    for cell in range(begin // step, (begin + m - 1) // step + 1):
                        x, y = max(cell * step - begin, 0), min((cell + 1) * step - begin, m)
                        own = c[x * w : (y - 1 + size) * w]
                        core = c[((cell + 1) * step - 1 - begin) * w : (cell * step - begin + size) * w]
                        values = (k, first + x, y - x, own, xxhash.xxh3_128_digest(own, seed=cell), xxhash.xxh3_128_digest(core, seed=cell))
                        for name, v in zip(out, values, strict=True):
                            out[name].append(v)
                kept = part.select(["key", "copy", "place", "h", "f"]).take(pa.array(out.pop("row"), pa.int64()))
                kinds = {"start": pa.int32(), "starts": pa.int32(), "content": pa.binary(), "whole": pa.binary(), "core": pa.binary()}
                yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(out[k], t) for k, t in kinds.items()]], names=[*kept.schema.names, *kinds])

    return run


def _often(scratch: Scratch, rows: DataFrame, symbols: Symbols, keep_first: bool) -> DataFrame | None:
    """``h, f, ranges`` for anchors with many classes.

    Stretches are cut into parts again and again. Equal parts are settled at once; of those the first stays, and it is cut
    further only if another part has the same core. A window that nothing shares falls out after a few rows.
    """
    found, step = None, symbols.length - symbols.gram + 1
    kind = rows.schema["key"].dataType.simpleString()
    rows = rows.select("key", "copy", "place", "h", "f", "content", F.lit(0).alias("start"), (F.shiftright("place", 8).bitwiseAND(F.lit(255)) + 1).cast("int").alias("starts"))
    while step > 1 and not rows.isEmpty():
        step = -(-step // SPLIT)
        ddl = f"key {kind}, copy int, place long, h long, f long, start int, starts int, content binary, whole binary, core binary"
        parts = save(scratch, rows.mapInArrow(_split(symbols, step), ddl).withColumn("at", F.shiftright("place", PLACE_BITS) + F.col("start")), f"parts-{step}")
        spot = F.struct("key", "copy", "at")
        same = save(scratch, parts.groupBy("whole").agg(F.count("*").alias("times"), F.min(spot).alias("least"), F.first("core").alias("core")), f"same-{step}")
        again = parts.join(same.filter("times > 1").select("whole", "least"), "whole")
        if keep_first:
            again = again.filter(spot > F.col("least"))
        again = again.select("h", "f", F.struct(F.col("start").alias("first"), (F.col("start") + F.col("starts") - 1).alias("last")).alias("range"))
        found = again if found is None else found.unionByName(again)
        several = same.groupBy("core").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("core")
        open_parts = same.join(several, "core", "left_semi").select("whole", F.col("least.key").alias("key"), F.col("least.copy").alias("copy"), F.col("least.at").alias("at"))
        rows = parts.join(open_parts, ["whole", "key", "copy", "at"], "left_semi").select("key", "copy", "place", "h", "f", "content", "start", "starts")
    if found is None:
        return None
    return found.groupBy("h", "f").agg(F.array_sort(F.collect_list("range")).alias("ranges"))


def to_ranges(starts: np.ndarray) -> list[dict]:
    """Runs of consecutive numbers."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return [{"first": int(a), "last": int(b)} for a, b in zip(starts[np.concatenate([[0], cut + 1])], starts[np.append(cut, len(starts) - 1)], strict=True)]


def covered(ranges: list[dict], length: int, size: int) -> np.ndarray:
    """Which symbols the windows that start in the ranges cover."""
    cover = np.zeros(size + 1, np.int64)
    for r in ranges:
        cover[r["first"]] += 1
        cover[min(r["last"] + length, size)] -= 1
    return np.cumsum(cover)[:-1] > 0


def repeated_starts(scratch: Scratch, texts: DataFrame, symbols: Symbols, shard: Callable[[pd.DataFrame], pd.DataFrame], keep_first: bool) -> DataFrame:
    """The table of texts with the ``ranges`` of starts of repeated windows.

    With ``keep_first`` the first of equal windows, by key, copy and place, is not among them. ``shard`` gets the classes
    of whole anchors, with ``content``, and returns ``h, f, ranges`` of starts that other classes share (with
    ``keep_first``: that an earlier class has).
    """
    kind = texts.schema["key"].dataType.simpleString()
    counted = texts.select("text").mapInArrow(_hashes(symbols), "h long, n long")
    twice = counted.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")
    all_stretches = map_batches(texts.select("key", "copy", "text"), _stretches(symbols), f"key {kind}, copy int, place long, h long, f long", size=STRETCH_BYTES)
    found = save(scratch, all_stretches.join(twice, "h", "left_semi"), "stretches")

    first = F.min(F.struct("key", "copy", "place")).alias("first")
    classes = save(scratch, found.groupBy("h", "f").agg(F.count("*").alias("n"), first), "classes")
    mixed = save(scratch, classes.groupBy("h").agg(F.count("*").alias("classes")).filter("classes > 1"), "mixed")
    wanted = classes.join(mixed, "h").select("first.key", "first.copy", F.struct(F.col("first.place").alias("place"), "h", "f", (F.col("classes") > HOT).alias("several")).alias("w"))
    wanted = wanted.groupBy("key", "copy").agg(F.collect_list("w").alias("wanted"))
    here = texts.select("key", "copy", "text").join(wanted.hint("shuffle_hash"), ["key", "copy"])
    content = map_batches(here, _contents(symbols), f"key {kind}, copy int, place long, h long, f long, several boolean, content binary")
    content = save(scratch, content, "content")

    small = content.filter("not several")
    size = small.agg(F.sum(F.length("content"))).first()[0] or 0
    shards = max(1, int(size // (SHARD_BYTES * symbols.width)) + 1, partitions_of(scratch.spark) if size > 8 * SHARD_BYTES else 1)
    by_shard = small.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)))
    shared = by_shard.groupBy("shard").applyInPandas(shard, f"h long, f long, ranges {RANGES}")

    often = _often(scratch, content.filter("several"), symbols, keep_first)
    shared = save(scratch, shared if often is None else shared.unionByName(often), "shared")

    # Every start of a class that occurs twice is repeated; with keep_first only its first stretch depends on others.
    marks = classes.join(shared, ["h", "f"], "left").filter("n > 1 or size(ranges) > 0")
    marked = found.join(marks, ["h", "f"])
    start, span = F.shiftright("place", PLACE_BITS).cast("int"), F.shiftright("place", 8).bitwiseAND(F.lit(255)).cast("int")
    whole = F.array(F.struct(start.alias("first"), (start + span).alias("last")))
    part = F.transform(F.coalesce("ranges", F.array().cast(RANGES)), lambda r: F.struct((start + r["first"]).alias("first"), (start + r["last"]).alias("last")))
    if keep_first:
        is_first = F.struct("key", "copy", "place").eqNullSafe(F.col("first"))
        chosen = F.when(is_first, part).otherwise(whole)
    else:
        chosen = F.when(F.col("n") > 1, whole).otherwise(part)
    spans = marked.select("key", "copy", chosen.alias("ranges")).groupBy("key", "copy").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    return texts.join(spans.hint("shuffle_hash"), ["key", "copy"], "left")
