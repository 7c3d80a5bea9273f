"""Sinks.  Tables are range-partitioned and sorted on their key, so part files hold
disjoint key ranges and a point lookup reads one row group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regweave import schemas
from regweave.operators.guards import require_only_source
from regweave.operators.history import history_order


def write_sorted(df: DataFrame, path: str, keys: list, partitions: int | None = None, lookup: str | None = None, block_bytes: int | None = None) -> None:
    """Parquet with globally ordered part files.

    The column to ``lookup`` rows by, the first key or another one, gets Bloom filters: statistics of the row groups leave
    one of them for a value of the first key, the filters for a value of any other column, or for an absent one.
    """
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    writer = ranged.sortWithinPartitions(*keys).write.mode("errorifexists")
    if lookup is not None:
        writer = writer.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
    if block_bytes is not None:
        writer = writer.option("parquet.block.size", block_bytes)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str = "callsign") -> None:
    """Catalog table bucketed and sorted on its key.

    Two tables with the same buckets (the open history and the current records, or the
    id ledger) are joined on the key without shuffling either side.
    """
    df.write.mode("errorifexists").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def write_current(records: DataFrame, path: str, partitions: int | None = None) -> None:
    """Current records in the fixed schema and order."""
    write_sorted(schemas.conform(records, schemas.RECORD), path, ["callsign"], partitions, lookup="callsign")


def write_history(history: DataFrame, path: str, partitions: int | None = None) -> None:
    """Interval history in its own fixed schema."""
    write_sorted(schemas.conform(history, schemas.HISTORY), path, history_order(), partitions, lookup="callsign")


def read_history(spark, path: str) -> DataFrame:
    """Prior history; absent columns read null, unknown ones are ignored."""
    return schemas.conform(spark.read.parquet(path), schemas.HISTORY)


def write_ledger(df: DataFrame, path: str) -> None:
    """Id ledger (current or history rows with their id)."""
    write_sorted(df, path, ["id"], lookup="callsign" if "callsign" in df.columns else None)


def latest_artifact(spark, pattern: str) -> str | None:
    """Path of the newest dated folder or file matching ``pattern``, by name.

    Only the file listing is read.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    names = sorted(s.getPath().toString() for s in found) if found else []
    return names[-1] if names else None


def read_ledger(spark, path: str, schema) -> DataFrame:
    """Prior ledger with schema drift tolerated both ways; ``id`` is always kept."""
    raw = spark.read.parquet(path)
    return schemas.conform(raw, T.StructType([T.StructField("id", T.LongType()), *schema.fields]))


def write_parks(df: DataFrame, path: str) -> None:
    """Parks."""
    write_sorted(schemas.conform(df, schemas.PARK), path, ["reference"])


def write_summits(df: DataFrame, path: str) -> None:
    """Summits."""
    write_sorted(schemas.conform(df, schemas.SUMMIT), path, ["reference"])


def write_park_grids(df: DataFrame, path: str) -> None:
    """Main grid set."""
    write_sorted(schemas.conform(df, schemas.PARK_GRID), path, ["reference", "grid"])


def write_segregated_grids(df: DataFrame, path: str) -> bool:
    """Share-alike grid set: one source only, and no file at all when it is empty."""
    if df.isEmpty():
        return False
    write_park_grids(require_only_source(df, "osm"), path)
    return True


def write_reflectors(df: DataFrame, path: str) -> None:
    """Directory rows."""
    write_sorted(schemas.conform(df, schemas.REFLECTOR), path, ["network", "id"])


def write_talkgroups(df: DataFrame, path: str) -> None:
    """Talkgroup rows."""
    write_sorted(schemas.conform(df, schemas.TALKGROUP), path, ["system", "tg"])


def write_nodes_child(df: DataFrame, path: str) -> None:
    """(id, node) child table."""
    write_sorted(df, path, ["id", "node"])


def write_documents(lines: DataFrame, group: str, path: str, partitions: int | None = None) -> None:
    """Document lines to one folder per document; its part files in name order are the
    JSON text."""
    keys = [F.col(group), F.col("section"), F.col("sort_key")]
    ranged = lines.repartitionByRange(partitions, *keys) if partitions else lines.repartitionByRange(*keys)
    (
        ranged.sortWithinPartitions(*keys).select(group, F.col("line").alias("value"))
        .write.mode("errorifexists").partitionBy(group).text(path)
    )


def flatten_lists(df: DataFrame, columns: list[str]) -> DataFrame:
    """List columns as comma strings for flat consumers."""
    out = df
    for name in columns:
        out = out.withColumn(name, F.array_join(name, ","))
    return out


def write_build_report(spark, outcomes: list[tuple[str, str, str]], path: str) -> None:
    """(source, status, reason) of a build; the skipped-source marker is its filter."""
    spark.createDataFrame(outcomes, "source string, status string, reason string").coalesce(1).write.mode(
        "overwrite"
    ).json(path)
