"""Merkle manifest of a dataset: a digest of every document, a tree over each group, and one root.

A leaf's place in its group is the rank of its id among the group's ids. No ids are sorted for it: every batch of rows
packs its ids into small containers, one for each run of 65,536 ids, as a list or a bitmap, whichever is smaller. The
containers of a run are merged, and directories of their counts are summed level by level along the digits of the id.
The rank of an id is then the count of all runs before its own plus the count of ids before it in its own container.

Leaves go by rank into arrays of ``FAN ** LEVELS`` slots. An array reduces ``LEVELS`` levels of the tree in one task, its
result is a slot of an array of the next round, and the rounds end when a group has one node. The tree over the groups
is built in the same way. Proofs then go down again: an array hands the siblings above it to its slots.

Ids that several rows hold are few or many; their rows are ranked once more by the digits of their leaf, equal rows as
one entry with a number of copies, so neither a repeated id nor a row copied a million times fills a task. All groups of
a task are bounded: a run has at most 65,536 different ids, a directory 65,536 children, an array its slots.

Defined cases: null fields enter a leaf as ``-``; rows without id come before all others of their group; rows of one id
are ordered by their leaf; equal rows take consecutive places; a null group comes first, an empty one after it; an empty
table gives no rows; other columns are not read. Sparse ids make more and smaller containers, never larger ones.
"""

from __future__ import annotations

from collections.abc import Mapping
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.common import partitions_of, save, workspace
from kinfold.operators.skew import lookup
from kinfold.scratch import Scratch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
#: Levels of the tree that one array of slots reduces.
LEVELS = 4
SLOTS = FAN**LEVELS
RUN = 1 << 16
#: Rows that are packed into containers at a time.
PACKED_ROWS = 200_000
#: Places of the runs of ids: digits of 16 bits, most significant first.
DIGITS = ("d0", "d1", "d2")
PATH = "array<struct<before:string,after:string>>"


def leaf_digest(columns: Mapping[str, Column]) -> Column:
    """Digest of a row: each value as its size in bytes, a colon and itself, or ``-`` for null."""
    texts = [c.cast("string") for c in columns.values()]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _digest(parts: str) -> str:
    return sha256(parts.encode()).hexdigest()


# --- ranks ------------------------------------------------------------------------------------------


def _places(rows: DataFrame, key: str) -> DataFrame:
    """Digits of a signed 64-bit key in ascending order, and its last one as ``low``; a null comes first."""
    x = F.col(key).bitwiseXOR(F.lit(-(1 << 63)))
    digit = [F.shiftrightunsigned(x, 48), *[F.shiftrightunsigned(x, s).bitwiseAND(F.lit(RUN - 1)) for s in (32, 16, 0)]]
    first = F.coalesce(digit[0], F.lit(-1)).cast("int")
    return rows.withColumns({"d0": first} | {n: F.coalesce(d, F.lit(0)).cast("int") for n, d in zip((*DIGITS[1:], "low"), digit[1:], strict=True)})


def _container(low: np.ndarray) -> bytes:
    """Distinct sorted numbers below 65,536 as a list, or as a bitmap where that is smaller."""
    if 2 * len(low) <= RUN // 8:
        return b"L" + low.astype("<u2").tobytes()
    bits = np.zeros(RUN, np.uint8)
    bits[low] = 1
    return b"B" + np.packbits(bits, bitorder="little").tobytes()


def _numbers(container: bytes) -> np.ndarray:
    if container[:1] == b"L":
        return np.frombuffer(container, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(container, np.uint8, offset=1), bitorder="little"))


def _pack(batches):
    """Containers of the ids of many rows, with the counts of those that stand for more than one row."""

    def packed(rows: pa.Table) -> pa.RecordBatch:
        groups = rows.column("grp").combine_chunks().dictionary_encode()
        code = groups.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        digits = [rows.column(d).to_numpy().astype(np.int64) for d in (*DIGITS, "low")]
        order = np.lexsort((*digits[::-1], code))
        keys = np.stack([x[order] for x in (code, *digits)])
        n = rows.column("n").to_numpy()[order]
        head = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
        keys, n = keys[:, head], np.add.reduceat(n, head)
        cut = np.flatnonzero(np.concatenate([[True], (keys[:4, 1:] != keys[:4, :-1]).any(axis=0)]))
        ends = np.append(cut[1:], keys.shape[1])
        containers, more = [], []
        for a, b in zip(cut.tolist(), ends.tolist(), strict=True):
            low, count = keys[4, a:b], n[a:b]
            several = count > 1
            containers.append(_container(low))
            more.append(np.stack([low[several], count[several]]).astype("<i8").tobytes())
        out = [groups.dictionary.take(pa.array(keys[0, cut])), *[pa.array(keys[i, cut], pa.int32()) for i in (1, 2, 3)]]
        return pa.RecordBatch.from_arrays([*out, pa.array(containers, pa.binary()), pa.array(more, pa.binary())], names=["grp", *DIGITS, "ids", "more"])

    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= PACKED_ROWS:
            yield packed(pa.Table.from_batches(held))
            held, count = [], 0
    if count:
        yield packed(pa.Table.from_batches(held))


def _run_of(parts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers of a run and the rows that each stands for, from one container or several."""
    lows, counts = [], []
    for container, several in parts:
        low = _numbers(container)
        count = np.ones(len(low), np.int64)
        again, n = np.frombuffer(several, "<i8").reshape(2, -1)
        count[np.searchsorted(low, again)] = n
        lows.append(low)
        counts.append(count)
    if len(parts) == 1:
        return lows[0], counts[0]
    low, at = np.unique(np.concatenate(lows), return_inverse=True)
    return low, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)


def _by_run(rows: DataFrame, *then: Column) -> DataFrame:
    """Rows of a run side by side in one partition, so that a task streams through its runs."""
    keys = ["grp", *DIGITS]
    return rows.repartition(partitions_of(rows.sparkSession), *keys).sortWithinPartitions(*keys, *then)


def _merge(batches):
    """One container for each run of sorted parts."""
    held, parts = None, []

    def row() -> tuple:
        low, count = _run_of(parts)
        several = count > 1
        packed = parts[0][0] if len(parts) == 1 else _container(low)
        return *held, packed, np.stack([low[several], count[several]]).astype("<i8").tobytes(), int(count.sum())

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), *[pa.int32()] * 3, pa.binary(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["grp", *DIGITS, "ids", "more", "size"])

    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("grp", *DIGITS, "ids", "more")]
        for *key, ids, more in zip(*columns, strict=True):
            if key != held:
                if parts:
                    out.append(row())
                held, parts = key, []
            parts.append((ids, more))
        if out:
            yield batch_of(out)
    if parts:
        yield batch_of([row()])


def _find(names: list[str]):
    """Rows before each asked key; every run comes right before the rows that ask for it."""

    def run(batches):
        low, rank, before, total = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0
        for batch in batches:
            asked = np.asarray(batch.column("ids").is_null())
            places = batch.column("low").fill_null(0).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(~asked)
            at, of = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for first, end in zip([-1, *starts.tolist()], [*starts.tolist(), batch.num_rows], strict=True):
                if first >= 0:
                    low, count = _run_of([(batch.column("ids")[first].as_py(), batch.column("more")[first].as_py())])
                    rank = np.cumsum(count) - count
                    before, total = batch.column("before")[first].as_py(), batch.column("total")[first].as_py()
                if end > first + 1:
                    at[first + 1 : end] = before + rank[np.searchsorted(low, places[first + 1 : end])]
                    of[first + 1 : end] = total
            kept = batch.select(names).filter(pa.array(asked))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(at[asked]), pa.array(of[asked])], names=[*names, "before", "total"])

    return run


def _directories(runs: DataFrame) -> DataFrame:
    """``before`` (rows of the group in earlier runs) and ``total`` (rows of the group) for every run.

    Counts are summed up along the digits and down again; a window never holds more than the children of one place.
    """
    levels = [["grp", *DIGITS[:i]] for i in range(len(DIGITS) + 1)]
    sizes = [runs.groupBy(*keys).agg(F.sum("size").alias("size")) for keys in levels]
    at = sizes[0].select("grp", F.lit(0).cast("long").alias("before"), F.col("size").alias("total"))
    for above, keys, own in zip(levels[:-1], levels[1:], sizes[1:], strict=True):
        order = Window.partitionBy(*above).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
        inside = own.select(*keys, F.coalesce(F.sum("size").over(order), F.lit(0)).alias("inside"))
        at = inside.join(at, above).select(*keys, (F.col("before") + F.col("inside")).alias("before"), "total")
    return at


def _no_rows(ddl: str) -> pd.DataFrame:
    """An empty frame of text and whole-number columns."""
    kinds = (c.split() for c in ddl.split(", "))
    return pd.DataFrame({name: pd.Series(dtype="object" if kind == "string" else "int64") for name, kind in kinds})


class Ranks:
    """Containers and directories of the keys in ``rows`` (``grp``, ``key``, ``n``: rows that a row stands for)."""

    def __init__(self, scratch: Scratch, rows: DataFrame, name: str):
        parts = _places(rows.select("grp", "key", F.col("n").cast("long").alias("n")), "key").select("grp", *DIGITS, "low", "n")
        ddl = "grp string, d0 int, d1 int, d2 int, ids binary, more binary"
        merged = _by_run(parts.mapInArrow(_pack, ddl)).mapInArrow(_merge, f"{ddl}, size long")
        runs = save(scratch, merged, f"{name}-containers")
        self.runs = save(scratch, runs.join(_directories(runs), ["grp", *DIGITS]), f"{name}-directory")

    def repeated(self) -> DataFrame:
        """``grp``, ``key`` and ``n`` of the keys that stand for several rows."""

        def run(batches):
            for batch in batches:
                for i, (several, *digits) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("more", *DIGITS)], strict=True)):
                    low, n = np.frombuffer(several, "<i8").reshape(2, -1)
                    if len(low):
                        high = (np.uint64(max(digits[0], 0)) << np.uint64(48)) | np.uint64(digits[1] << 32 | digits[2] << 16)
                        key = (low.astype(np.uint64) | high) ^ np.uint64(1 << 63)
                        key = pa.array(key.view(np.int64), mask=np.full(len(low), digits[0] < 0))
                        yield pa.RecordBatch.from_arrays([batch.column("grp").take(pa.array([i] * len(low))), key, pa.array(n)], names=["grp", "key", "n"])

        return self.runs.mapInArrow(run, "grp string, key long, n long")

    def find(self, rows: DataFrame) -> DataFrame:
        """``rows`` (``grp``, ``key``, other columns) with ``before`` and ``total``: rows of the group before the key, and in all."""
        names = rows.columns
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", before long, total long"
        both = _places(rows, "key").unionByName(self.runs.drop("size"), allowMissingColumns=True)
        return _by_run(both, F.col("ids").isNull()).mapInArrow(_find(names), ddl)


def ranked_leaves(scratch: Scratch, leaves: DataFrame) -> DataFrame:
    """``leaves`` (``grp``, ``doc_id``, ``leaf``, ``fresh``) with the place ``at`` of the first of ``copies``, and ``total``."""
    keyed = leaves.select("grp", F.col("doc_id").alias("key"), "leaf", "fresh")
    ranks = Ranks(scratch, keyed.withColumn("n", F.lit(1)), "ids")
    repeated = save(scratch, ranks.repeated(), "repeated")
    # Ids as text from here on: pandas has no whole numbers beside nulls.
    columns = ["grp", F.col("key").cast("string").alias("doc_id"), "leaf", "fresh", "copies"]
    if repeated.isEmpty():
        return ranks.find(keyed.withColumn("copies", F.lit(1).cast("long"))).select(*columns, F.col("before").alias("at"), "total")
    rows = leaves.count()
    marked = save(scratch, lookup(keyed, repeated.withColumn("weight", F.col("n")), ["grp", "key"], "weight", rows, how="left"), "marked")
    single = ranks.find(marked.filter("n is null").drop("n").withColumn("copies", F.lit(1).cast("long")))
    # Rows of one id: equal ones are an entry, entries are ranked by the head of their leaf within the id.
    entries = marked.filter("n is not null").groupBy("grp", "key", "leaf", "fresh").agg(F.count("*").alias("copies"))
    inner = F.concat_ws("|", F.coalesce(F.col("key").cast("string"), F.lit("")), "grp")
    # Flipped, so that signed order is the order of the digest.
    head = F.conv(F.substring("leaf", 1, 16), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    entries = save(scratch, entries.withColumn("inner", inner).withColumn("head", head), "entries")
    as_keys = entries.select(F.col("inner").alias("grp"), F.col("head").alias("key"), F.col("copies").alias("n"))
    of_head = Ranks(scratch, as_keys, "heads")
    asked = entries.select(F.col("inner").alias("grp"), F.col("head").alias("key"), "leaf", "fresh", "copies", F.col("grp").alias("own"), F.col("key").alias("doc_id"))
    same = Window.partitionBy("grp", "key").orderBy("leaf", "fresh").rowsBetween(Window.unboundedPreceding, -1)
    inside = of_head.find(asked).withColumn("inside", F.col("before") + F.coalesce(F.sum("copies").over(same), F.lit(0)))
    inside = inside.select(F.col("own").alias("grp"), F.col("doc_id").alias("key"), "leaf", "fresh", "copies", "inside")
    starts = ranks.find(repeated.select("grp", "key", "n"))
    placed = lookup(inside, starts.select("grp", "key", "before", "total", F.col("n").alias("weight")), ["grp", "key"], "weight", rows)
    several = placed.select(*columns, (F.col("before") + F.col("inside")).alias("at"), "total")
    return several.unionByName(single.select(*columns, F.col("before").alias("at"), "total"))


# --- tree -------------------------------------------------------------------------------------------


def _reduced(total: int) -> int:
    """Nodes of a group after one round."""
    for _ in range(LEVELS):
        total = -(-total // FAN) if total > 1 else total
    return total


def _levels(nodes: list[str], total: int) -> list[list[str]]:
    """Nodes of one array on each of its levels; the last has the array's one result."""
    levels = [nodes]
    for _ in range(LEVELS):
        if total == 1:
            break
        nodes = [_digest("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)]
        levels.append(nodes)
        total = -(-total // FAN)
    return levels


def _slots(rows: pd.DataFrame) -> list[str]:
    """Digests of one array in order of their slots; a row may fill several."""
    out = [""] * int((rows["slot"] + rows["copies"]).max())
    for slot, copies, node in zip(rows["slot"], rows["copies"], rows["node"], strict=True):
        out[slot : slot + copies] = [node] * copies
    return out


def _reduce(rows: pd.DataFrame) -> pd.DataFrame:
    total = int(rows["total"].iloc[0])
    return rows.iloc[:1][["grp"]].assign(total=_reduced(total), at=int(rows["arr"].iloc[0]), node=_levels(_slots(rows), total)[-1][0], copies=1)


def _in_arrays(nodes: DataFrame) -> DataFrame:
    """Nodes with the number ``arr`` of their array and their ``slot``; copies that span arrays are cut."""
    last = F.expr(f"(at + copies - 1) div {SLOTS}")
    cut = nodes.withColumn("arr", F.explode(F.sequence(F.expr(f"at div {SLOTS}"), last)))
    start, end = F.greatest("at", F.col("arr") * SLOTS), F.least(F.col("at") + F.col("copies"), (F.col("arr") + 1) * SLOTS)
    return cut.withColumns({"slot": (start - F.col("arr") * SLOTS).cast("int"), "copies": (end - start).cast("int")}).drop("at")


def _siblings(levels: list[list[str]], slot: int) -> list[tuple[str, str]]:
    """Siblings before and after the node of a slot on each level that the array reduces."""
    out = []
    for nodes in levels[:-1]:
        first = slot - slot % FAN
        out.append(("".join(nodes[first:slot]), "".join(nodes[slot + 1 : first + FAN])))
        slot //= FAN
    return out


def _down(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Paths of the arrays below: the siblings inside this one, then those above it."""
    if not len(rows):
        return _no_rows("grp string, arr long, path string, subroot string, root string")
    levels = _levels(_slots(rows), int(rows["total"].iloc[0]))
    rest = [(x["before"], x["after"]) for x in above["path"].iloc[0]]
    paths = [[{"before": a, "after": b} for a, b in (*_siblings(levels, s), *rest)] for s in rows["slot"]]
    base = int(rows["arr"].iloc[0]) * SLOTS
    return pd.DataFrame({"grp": rows["grp"], "arr": base + rows["slot"].astype("int64"), "path": paths, "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0]})


def _prove(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Proofs of the leaves of one array, and the roots that their fresh digests fold to."""
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    if not len(rows):
        return _no_rows(", ".join(f"{c} string" for c in columns))
    levels = _levels(_slots(rows), int(rows["total"].iloc[0]))
    rest = [(x["before"], x["after"]) for x in above["path"].iloc[0]]
    upper = "".join(a + b for a, b in rest)
    out: dict[str, list] = {c: [] for c in columns}
    subroot, root = above["subroot"].iloc[0], above["root"].iloc[0]
    for doc_id, first, copies, leaf, fresh in zip(rows["doc_id"], rows["slot"], rows["copies"], rows["node"], rows["fresh"], strict=True):
        for slot in range(first, first + copies):
            own = _siblings(levels, slot)
            folded = fresh
            for before, after in (*own, *rest):
                folded = _digest(before + folded + after)
            for c, v in zip(columns, (doc_id, leaf, subroot, root, _digest("".join(a + b for a, b in own) + upper), folded), strict=True):
                out[c].append(v)
    return pd.DataFrame(out)


class _Tree:
    """Rounds of arrays over ``nodes`` (``grp``, ``at``, ``total``, ``node``, ``copies``, other columns)."""

    def __init__(self, scratch: Scratch, nodes: DataFrame, name: str):
        self.rounds = [save(scratch, _in_arrays(nodes), f"{name}-0")]
        most = self.rounds[0].agg(F.max("total")).first()[0]
        while most is not None:
            step = self.rounds[-1].select("grp", "total", "arr", "slot", "node", "copies")
            reduced = step.groupBy("grp", "arr").applyInPandas(_reduce, "grp string, total long, at long, node string, copies long")
            most = _reduced(most)
            if most == 1:
                self.tops = save(scratch, reduced.select("grp", "node"), f"{name}-tops")
                break
            self.rounds.append(save(scratch, _in_arrays(reduced), f"{name}-{len(self.rounds)}"))

    def descend(self, paths: DataFrame) -> DataFrame:
        """Paths of the arrays of round 0, from ``grp``, ``path``, ``subroot`` and ``root`` of the tops."""
        paths = paths.select("grp", F.lit(0).cast("long").alias("arr"), "path", "subroot", "root")
        for nodes in self.rounds[:0:-1]:
            both = nodes.groupBy("grp", "arr").cogroup(paths.groupBy("grp", "arr"))
            paths = both.applyInPandas(_down, f"grp string, arr long, path {PATH}, subroot string, root string")
        return paths


def _numbered_groups(scratch: Scratch, tops: DataFrame) -> DataFrame:
    """Groups in order: ``own``, its place ``at``, the number of groups ``total`` and ``node``."""
    ordered = tops.repartitionByRange(partitions_of(scratch.spark), "grp").sortWithinPartitions("grp")
    ordered = save(scratch, ordered.select("grp", "node", F.monotonically_increasing_id().alias("place")), "groups")
    part = F.shiftright("place", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    order = Window.orderBy("part")  # one row for each partition of the sort
    before = sizes.select("part", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    at = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumn("part", part).join(before, "part").select(F.col("grp").alias("own"), at.alias("at"), "total", "node")


def manifest(docs: DataFrame, fresh: Mapping[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, id_column: str = "doc_id", group_column: str = "lang") -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``fresh`` replaces values of fields by what a reader has now; ``folded_root`` is the root that follows from these and
    the stored proof, and ``verified`` tells whether it is the root of the manifest. The id column must be a whole number.
    """
    scratch = workspace(docs.sparkSession, "manifest")
    stored = {c: F.col(f"`{c}`") for c in fields}
    own = F.coalesce(F.concat(F.lit("s"), F.col(f"`{group_column}`").cast("string")), F.lit("n"))
    leaves = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), own.alias("grp"), leaf_digest(stored).alias("leaf"), leaf_digest(stored | dict(fresh or {})).alias("fresh"))
    leaves = save(scratch, leaves, "leaves")
    tree = _Tree(scratch, ranked_leaves(scratch, leaves).withColumnRenamed("leaf", "node"), "leaves")
    out = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    if leaves.isEmpty():
        return docs.sparkSession.createDataFrame([], f"{out}, verified boolean").withColumn("doc_id", F.col("doc_id").cast("long"))
    groups = _numbered_groups(scratch, tree.tops).select(F.lit("").alias("grp"), "own", "at", "total", "node", F.lit(1).cast("long").alias("copies"))
    over = _Tree(scratch, groups, "groups")
    root = over.tops.select("grp", F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    both = over.rounds[0].groupBy("grp", "arr").cogroup(over.descend(root).groupBy("grp", "arr"))
    paths = both.applyInPandas(_to_groups, f"grp string, path {PATH}, subroot string, root string")
    paths = save(scratch, tree.descend(save(scratch, paths, "group-paths")), "paths")
    proved = tree.rounds[0].groupBy("grp", "arr").cogroup(paths.groupBy("grp", "arr")).applyInPandas(_prove, out)
    return proved.withColumns({"doc_id": F.col("doc_id").cast("long"), "verified": F.col("folded_root") == F.col("root")})


def _to_groups(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Paths above the subroots that an array over the groups holds."""
    found = _down(rows, above)
    return pd.DataFrame({"grp": rows["own"], "path": found["path"], "subroot": rows["node"], "root": found["root"]})
