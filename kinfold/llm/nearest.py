"""Exact top-k inner product search by a vector-approximation file.

Every vector component becomes a whole number ``floor(scale * x)``. The approximation file keeps, for each
distinct vector, the cell of each component on a grid of at most ``2 ** bits`` cells per dimension. One scan of
the cells bounds every inner product from both sides; only vectors whose upper bound reaches the k-th lower bound
stay. The exact vectors are then read in the order of their bounds: first the ``reads`` best for each query, whose
k-th exact score is a new limit, then the rest that may still reach that limit. The result is exact.

Scans run in cells of a grid of query blocks by candidate blocks, both of fixed size, so a task holds two blocks.
Equal vectors are one entry with its first ``k + 1`` rows by id, so a vector held by a third of all rows costs one entry.

Defined cases: a row without id or vector, or whose vector holds a null or a value that is not finite, takes no part;
rows that share an id are rows of their own, as candidates and as queries; shorter vectors end in zeros; fewer than k
candidates give fewer rows; an empty table gives no rows. Components beyond 2 ** 27 in size raise an error.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.common import save, workspace

CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 2048
LARGEST = 1 << 27
RESULT = "query_id long, rank int, vec_id long, score long"


def _whole_numbers(scale: float):
    def run(batches):
        for batch in batches:
            vectors = batch.column("vec")
            flat = vectors.flatten().cast(pa.float64())
            good = np.asarray(flat.is_valid()) & np.isfinite(flat.fill_null(0.0).to_numpy(zero_copy_only=False))
            values = np.floor(scale * np.where(good, flat.fill_null(0.0).to_numpy(zero_copy_only=False), 0.0))
            if len(values) and np.abs(values).max() > LARGEST:
                raise ValueError(f"vector components must stay within {LARGEST} after scaling")
            lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            bad = np.concatenate([[0], np.cumsum(~good)])
            keep = np.flatnonzero(bad[ends] == bad[ends - lengths])
            whole = values.astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(keep)), batch.column("id").take(pa.array(keep)), pa.array([whole[ends[i] - lengths[i] : ends[i]].tobytes() for i in keep], pa.binary())],
                names=["row", "id", "vec"],
            )

    return run


def _ranges(batches):
    """Least and greatest value of each dimension."""
    least, most = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for raw in batch.column("vec").to_pylist():
            v = np.frombuffer(raw, "<i4")
            if len(v) > len(least):
                more = len(v) - len(least)
                least, most = (np.pad(x, (0, more)) if len(x) else v.astype(np.int64) for x in (least, most))
            least[: len(v)] = np.minimum(least[: len(v)], v)
            most[: len(v)] = np.maximum(most[: len(v)], v)
            least[len(v) :], most[len(v) :] = np.minimum(least[len(v) :], 0), np.maximum(most[len(v) :], 0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(least), dtype=np.int32)), pa.array(least), pa.array(most)], names=["dim", "least", "most"])


def _matrix(raw, dims: int, kind: str) -> np.ndarray:
    """Rows of packed values, shorter ones padded with zeros."""
    size = np.dtype(kind).itemsize * dims
    return np.frombuffer(b"".join(x.ljust(size, b"\0") for x in raw), kind).reshape(len(raw), dims)


def _scan(dims: int, least: np.ndarray, width: np.ndarray, k: int):
    """Scan one block of cells for one block of queries; keep what may be among the best."""

    def run(queries: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(cells):
            low = least + _matrix(list(cells["code"]), dims, "u1").astype(np.float64) * width
            ids = cells["entry"].to_numpy()
            for at in range(0, len(queries), 256):
                part = queries.iloc[at : at + 256]
                q = _matrix(list(part["vec"]), dims, "<i4").astype(np.float64)
                up, down = np.maximum(q, 0) @ (width - 1), np.minimum(q, 0) @ (width - 1)
                base = q @ low.T
                if len(ids) > k:
                    limit = np.partition(base, len(ids) - k - 1, axis=1)[:, len(ids) - k - 1] + down - up
                else:
                    limit = np.full(len(part), -np.inf)
                row, col = np.nonzero(base >= limit[:, None])
                found.append(pd.DataFrame({"query": part["row"].to_numpy()[row], "entry": ids[col], "bound": (base + up[:, None])[row, col].astype(np.int64)}))
        return pd.concat(found) if found else pd.DataFrame({"query": pd.Series(dtype="int64"), "entry": pd.Series(dtype="int64"), "bound": pd.Series(dtype="int64")})

    return run


def _codes(dims: int, least: np.ndarray, width: np.ndarray):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cell = (_matrix(batch.column("vec").to_pylist(), dims, "<i4") - least) // width
                packed = cell.astype(np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column("entry"), pa.array([x.tobytes() for x in packed], pa.binary())], names=["entry", "code"])

    return run


def _products(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        raw = [batch.column(c).to_pylist() for c in ("vec", "other")]
        dims = max(1, max(len(x) for c in raw for x in c) // 4)
        a, b = (_matrix(x, dims, "<i4").astype(np.int64) for x in raw)
        yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("entry"), pa.array((a * b).sum(axis=1))], names=["query", "entry", "score"])


def nearest(vectors: DataFrame, is_query, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 20, scale: float = 64.0, bits: int = 8, reads: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k greatest inner products of every query row, ties to the smaller id.

    ``is_query`` is a condition on ``vectors``; ``bits`` is the size of a cell number, at most 8.
    """
    spark = vectors.sparkSession
    work = workspace(spark, "nearest")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    rows = rows.filter("id is not null and vec is not null").withColumn("row", F.monotonically_increasing_id())
    marked = rows.select((F.col("row") * 2 + F.col("asked").cast("long")).alias("row"), "id", "vec")
    known = save(work, marked.mapInArrow(_whole_numbers(scale), "row long, id long, vec binary"), "vectors")
    queries = save(work, known.filter("row % 2 = 1"), "queries")

    same = Window.partitionBy("vec").orderBy("id", "row")
    firsts = known.withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k + 1)
    entries = firsts.groupBy("vec").agg(F.sort_array(F.collect_list(F.struct("id", "row"))).alias("members"))
    entries = save(work, entries.select(F.col("members")[0]["row"].alias("entry"), "members", "vec"), "entries")

    ranges = entries.select("vec").mapInArrow(_ranges, "dim int, least long, most long")
    span = ranges.groupBy("dim").agg(F.min("least").alias("least"), F.max("most").alias("most")).orderBy("dim").collect()
    if not span:
        span = [{"least": 0, "most": 0}]
    dims = len(span)
    least = np.array([s["least"] for s in span], np.int64)
    width = np.array([max(1, math.ceil((s["most"] - s["least"] + 1) / 2**bits)) for s in span], np.int64)

    n, asked_n = entries.count(), queries.count()
    blocks, query_blocks = max(1, math.ceil(n / CANDIDATE_BLOCK)), max(1, math.ceil(asked_n / QUERY_BLOCK))
    cells = entries.select("entry", "vec").mapInArrow(_codes(dims, least, width), "entry long, code binary")
    cells = cells.withColumn("block", F.pmod(F.xxhash64("entry"), F.lit(blocks))).withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))))
    sent = queries.withColumn("query_block", F.pmod(F.xxhash64("row"), F.lit(query_blocks))).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    pair = ["query_block", "block"]
    found = sent.groupBy(*pair).cogroup(cells.groupBy(*pair)).applyInPandas(_scan(dims, least, width, k), "query long, entry long, bound long")
    found = save(work, found, "bounds")

    exact_of = queries.select(F.col("row").alias("query"), "vec")
    others = entries.select("entry", F.col("vec").alias("other"))

    def exact(pairs: DataFrame) -> DataFrame:
        both = pairs.select("query", "entry").join(others, "entry").join(exact_of, "query")
        return both.select("query", "entry", "vec", "other").mapInArrow(_products, "query long, entry long, score long")

    def best(scored: DataFrame) -> DataFrame:
        members = scored.join(entries.select("entry", "members"), "entry").select("query", "score", F.inline("members"))
        order = Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")
        ranked = members.filter("row <> query").withColumn("rank", F.row_number().over(order))
        return ranked.filter(F.col("rank") <= k)

    in_order = Window.partitionBy("query").orderBy(F.desc("bound"), "entry")
    first = found.withColumn("n", F.row_number().over(in_order)).filter(F.col("n") <= reads)
    scored = save(work, exact(first), "first")
    limit = best(scored).groupBy("query").agg(F.when(F.count("*") == k, F.min("score")).alias("limit"))
    rest = found.join(scored, ["query", "entry"], "left_anti").join(limit, "query", "left")
    second = exact(rest.filter("limit is null or bound >= limit"))
    named = queries.select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return best(scored.unionByName(second)).join(named, "query").select("query_id", "rank", F.col("id").alias("vec_id"), "score")
