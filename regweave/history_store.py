"""Interval history that is only appended to.

A fold writes one folder: the intervals it closed, in a partition named after their closing day, and the open set.
Closed partitions are never written again; the open set is replaced by naming the new one in a manifest.  A manifest is a
small numbered file that is created in one step, so a fold that died before it left nothing but a folder nobody
names, which the next attempt overwrites; a fold that is repeated after it is recognised and skipped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave import schemas
from regweave.manifests import ManifestLog
from regweave.operators.history import fold_pairs

_OPEN = "open"


@dataclass(frozen=True)
class Manifest:
    """What one version of the history consists of."""

    version: int = 0
    as_of: str | None = None
    batch: str | None = None
    open: str | None = None
    closed: list[str] = field(default_factory=list)
    late: list[str] = field(default_factory=list)


class HistoryStore:
    """Versions of a history below one folder of a file system that all executors reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.log = ManifestLog(spark, f"{self.root}/manifest")

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or one by its number; an empty history has version 0."""
        return Manifest(**self.log.read(version))

    def _commit(self, manifest: Manifest) -> None:
        self.log.commit(manifest.version, asdict(manifest))

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schemas.HISTORY)
        return self.spark.read.schema(schemas.HISTORY).parquet(*[f"{self.root}/{f}" for f in folders])

    def open_rows(self, version: int | None = None) -> DataFrame:
        """Intervals without an end."""
        manifest = self.manifest(version)
        return self._read([manifest.open] if manifest.open else [])

    def closed_rows(self, since: str | None = None, version: int | None = None) -> DataFrame:
        """Ended intervals; with ``since`` only the folders of days from then on are read."""
        folders = self.manifest(version).closed
        return self._read([f for f in folders if since is None or f.rsplit("day=", 1)[1] >= since])

    def rows(self, version: int | None = None) -> DataFrame:
        """The whole history of a version."""
        manifest = self.manifest(version)
        return self._read([*manifest.closed, *([manifest.open] if manifest.open else [])])

    def valid_on(self, day: str, version: int | None = None) -> DataFrame:
        """Intervals that hold on a day: intervals closed by then are not read."""
        rows = self.closed_rows(day, version).filter(F.col("valid_to") > day).unionByName(self.open_rows(version))
        return rows.filter(F.col("valid_from") <= day)

    def fold(self, snapshot: DataFrame, as_of: str, batch: str | None = None, vet: Callable[[DataFrame], DataFrame] | None = None) -> Manifest:
        """Fold one snapshot in and commit; the same ``batch`` again changes nothing.

        Only the open set is read, and joined once with the snapshot; one write holds both results.  ``vet`` is applied to
        the open rows before, ``as_of`` may not lie before the last fold.
        """
        last = self.manifest()
        if batch is not None and batch == last.batch:
            return last
        if last.as_of is not None and as_of < last.as_of:
            raise ValueError(f"snapshot {as_of} is older than {last.as_of}, which is folded")
        held = self._read([last.open] if last.open else [])
        rows = fold_pairs(vet(held) if vet else held, snapshot, as_of).withColumn("day", F.coalesce("valid_to", F.lit(_OPEN)))
        folder = f"fold={last.version + 1:08d}"
        # A folder of this name can only stem from a fold that never committed.
        rows.write.mode("overwrite").partitionBy("day").parquet(f"{self.root}/{folder}")
        days = self.log.names(f"{self.root}/{folder}", only_folders=True)
        closed = [f"{folder}/{d}" for d in days if d != f"day={_OPEN}"]
        opened = f"{folder}/day={_OPEN}" if f"day={_OPEN}" in days else None
        manifest = Manifest(last.version + 1, as_of, batch, opened, [*last.closed, *closed], last.late)
        self._commit(manifest)
        return manifest

    def quarantine(self, snapshot: DataFrame, as_of: str, batch: str) -> Manifest:
        """Put a snapshot aside that came too late to be folded, and name it in the manifest."""
        last = self.manifest()
        name = f"late/as_of={as_of}/batch={batch}"
        if name in last.late:
            return last
        snapshot.write.mode("overwrite").parquet(f"{self.root}/{name}")
        manifest = Manifest(last.version + 1, last.as_of, last.batch, last.open, last.closed, [*last.late, name])
        self._commit(manifest)
        return manifest

    def late_rows(self) -> DataFrame | None:
        """Rows that were put aside, with their day, none if there are none."""
        late = self.manifest().late
        return self.spark.read.option("basePath", f"{self.root}/late").parquet(*[f"{self.root}/{x}" for x in late]) if late else None
