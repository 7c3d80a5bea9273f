"""Numbered manifests below a folder: small JSON files that are created in one step and never changed."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class ManifestLog:
    """Manifests of one folder; version 0 is the empty one."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str, only_folders: bool = False) -> list[str]:
        """Names of the entries of a folder, none if it is missing."""
        path = self._path(folder)
        if not self.fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path) if s.isDirectory() or not only_folders)

    def newest(self) -> int:
        """Number of the newest manifest."""
        found = [n.removesuffix(".json") for n in self.names(self.folder) if n.endswith(".json") and n[0].isdigit()]
        return max(map(int, found), default=0)

    def read(self, version: int | None = None) -> dict:
        """Content of the newest manifest, or of one by its number."""
        version = self.newest() if version is None else version
        if version == 0:
            return {}
        text = self.spark.read.option("wholetext", True).text(f"{self.folder}/{version:08d}.json").first()[0]
        return json.loads(text)

    def commit(self, version: int, content: dict) -> None:
        """Create a manifest; fails if another writer has created the same version."""
        target, draft = self._path(f"{self.folder}/{version:08d}.json"), self._path(f"{self.folder}/_draft-{version:08d}")
        out = self.fs.create(draft, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if self.fs.exists(target) or not self.fs.rename(draft, target):
            raise RuntimeError(f"version {version} was committed by another writer")
