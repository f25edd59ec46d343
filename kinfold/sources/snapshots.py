"""Golden table: published whole, read whole.

`SnapshotTable` keeps Parquet folders and one manifest per version. Writers add a new folder that no reader
looks at and then create the next manifest, which names the live folders; creating it is atomic and fails
if another writer was first. The high-water mark and the stream batches that were published are part of
the manifest, so a rerun after a crash can neither skip nor repeat a batch.

`CatalogTable` publishes to a table of a configured DSv2 catalog instead.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kinfold.operators.survivorship import golden_order, to_golden_contract
from kinfold.schema import GOLDEN_COLUMNS, GOLDEN_SCHEMA


class Overtaken(RuntimeError):
    """Another writer published after this one had read the table."""


@dataclass(frozen=True)
class Published:
    """Where rows went, how many, and how many writes the table has seen."""

    location: str
    rows: int
    writes: int


@dataclass(frozen=True)
class Mark:
    """Highest record id that has been published, and the size of the run that published it."""

    highest_record_id: str
    records_processed: int


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    snapshot_count: int = 0
    parts: tuple[str, ...] = ()
    mark: Mark | None = None
    stream_batches: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(
            {
                "version": self.version,
                "snapshot_count": self.snapshot_count,
                "parts": list(self.parts),
                "mark": self.mark.__dict__ if self.mark else None,
                "stream_batches": self.stream_batches,
            },
            indent=2,
        )

    @staticmethod
    def from_json(text: str) -> Manifest:
        found = json.loads(text)
        mark = Mark(**found["mark"]) if found["mark"] else None
        return Manifest(
            found["version"], found["snapshot_count"], tuple(found["parts"]), mark, found["stream_batches"]
        )


class SnapshotTable:
    def __init__(self, spark: SparkSession, warehouse: str, namespace: str, table: str):
        self.spark = spark
        self.location = f"{warehouse.rstrip('/')}/{namespace}/{table}"
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.location}/{name}")

    def manifest(self) -> Manifest:
        """The newest manifest, or an empty one before the first write."""
        folder = self._path("manifests")
        fs = folder.getFileSystem(self._conf)
        if not fs.exists(folder):
            return Manifest()
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        numbered = sorted(n for n in names if n.endswith(".json"))
        if not numbered:
            return Manifest()
        stream = fs.open(self._path(f"manifests/{numbered[-1]}"))
        try:
            return Manifest.from_json(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: Manifest) -> Manifest:
        draft = self._path(f"manifests/{uuid.uuid4().hex}.draft")
        fs = draft.getFileSystem(self._conf)
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(manifest.to_json().encode()))
        finally:
            stream.close()
        # Renaming without the overwrite option is atomic and fails if this version exists already.
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        target = self._path(f"manifests/{manifest.version:010d}.json")
        try:
            context.rename(draft, target, options)
        except Exception as exc:
            fs.delete(draft, False)
            if fs.exists(target):
                raise Overtaken(f"version {manifest.version} of {self.location} exists already") from exc
            raise
        return manifest

    def publish(
        self,
        golden: DataFrame,
        append: bool = False,
        mark: Mark | None = None,
        stream_batch: tuple[str, int] | None = None,
        base: Manifest | None = None,
    ) -> Published:
        """Replace all rows, or add rows that were resolved on their own.

        ``mark`` and ``stream_batch`` (stream name and batch number) become visible with the rows. A stream
        batch that was published before is not written again. ``base`` is the manifest that the rows were computed
        from: if the table has moved on since, nothing is published.
        """
        before = base or self.manifest()
        if stream_batch and self.has_batch(*stream_batch):
            return Published(self.location, 0, before.snapshot_count)
        part = f"data/{before.version + 1:010d}-{uuid.uuid4().hex}"
        to_golden_contract(golden).write.parquet(f"{self.location}/{part}")
        rows = self.spark.read.parquet(f"{self.location}/{part}").count()  # from the file footers
        self._commit(
            replace(
                before,
                version=before.version + 1,
                snapshot_count=before.snapshot_count + 1,
                parts=(*before.parts, part) if append else (part,),
                mark=mark or before.mark,
                stream_batches={**before.stream_batches, **dict([stream_batch] if stream_batch else [])},
            )
        )
        return Published(self.location, rows, before.snapshot_count + 1)

    def scan(self) -> DataFrame:
        """The current snapshot; it stays the same however often the result is read."""
        parts = [f"{self.location}/{p}" for p in self.manifest().parts]
        if not parts:
            return self.spark.createDataFrame([], GOLDEN_SCHEMA)
        return self.spark.read.schema(GOLDEN_SCHEMA).parquet(*parts).select(*GOLDEN_COLUMNS)

    def read(self) -> DataFrame:
        return golden_order(self.scan())

    def has_batch(self, stream: str, batch: int) -> bool:
        return self.manifest().stream_batches.get(stream, -1) >= batch

    def load_mark(self) -> Mark | None:
        """The stored mark; none when there is none or the manifest cannot be read."""
        try:
            return self.manifest().mark
        except (ValueError, KeyError, TypeError):
            return None

    def save_mark(self, mark: Mark | None) -> None:
        before = self.manifest()
        self._commit(replace(before, version=before.version + 1, mark=mark))

    def clear_mark(self) -> None:
        """The next incremental run starts from the first record, and every stream batch counts as new."""
        before = self.manifest()
        if before.mark is not None or before.stream_batches:
            self._commit(replace(before, version=before.version + 1, mark=None, stream_batches={}))


class CatalogTable:
    """Golden table in a DSv2 catalog that supports overwrite, such as Iceberg.

    The mark is a table property set after the write, so a crash in between repeats the batch.
    """

    MARK = "kinfold.highest_record_id"
    SIZE = "kinfold.records_processed"

    def __init__(self, spark: SparkSession, catalog: str, namespace: str, table: str, provider: str = "iceberg"):
        self.spark, self.provider = spark, provider
        self.namespace = f"{catalog}.{namespace}"
        self.location = f"{catalog}.{namespace}.{table}"

    def create(self) -> None:
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in GOLDEN_SCHEMA
        )
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {self.namespace}")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.location} ({columns}) USING {self.provider}")

    def publish(self, golden: DataFrame, append: bool = False, mark: Mark | None = None, base: Manifest | None = None) -> Published:
        self.create()
        seen = Observation()
        rows = to_golden_contract(golden).observe(seen, F.count(F.lit(1)).alias("rows"))
        first = self._snapshots() == 0
        writer = rows.writeTo(self.location)
        # Nothing to overwrite before the first write.
        writer.append() if append or first else writer.overwrite(F.lit(True))
        count = seen.get["rows"]
        if mark:
            self.spark.sql(
                f"ALTER TABLE {self.location} SET TBLPROPERTIES"
                f" ('{self.MARK}' = '{mark.highest_record_id}', '{self.SIZE}' = '{mark.records_processed}')"
            )
        return Published(self.location, count, self._snapshots())

    def _snapshots(self) -> int:
        return self.spark.table(f"{self.location}.snapshots").count()

    def scan(self) -> DataFrame:
        return self.spark.table(self.location).select(*GOLDEN_COLUMNS)

    def read(self) -> DataFrame:
        return golden_order(self.scan())

    def load_mark(self) -> Mark | None:
        self.create()
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.location}").collect()}
        return Mark(found[self.MARK], int(found.get(self.SIZE, 0))) if self.MARK in found else None

    def clear_mark(self) -> None:
        self.spark.sql(f"ALTER TABLE {self.location} UNSET TBLPROPERTIES IF EXISTS ('{self.MARK}', '{self.SIZE}')")
