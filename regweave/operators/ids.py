"""Surrogate ids that stay with a holder and are never issued twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.operators.history import same_identity
from regweave.schemas import IDENTITY_FIELDS
from regweave.session import stored


def high_water(*ledgers: DataFrame) -> int:
    """Largest id in any ledger, 0 for none (one row reaches the driver)."""
    top = 0
    for ledger in ledgers:
        top = max(top, ledger.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0])
    return top


def number_rows(df: DataFrame, key: str, start: int, partitions: int | None = None) -> DataFrame:
    """Gap-free ``id`` in key order, from ``start + 1``.

    A global ``row_number`` would run in one task.  The rows are range-partitioned on
    the key and sorted; each is stored together with its partition number and its
    position there, so the numbering cannot change when an executor is lost and ranges
    are sampled anew.  Ids are the offset of the partition plus the position.  The driver
    holds one number per partition.
    """
    ranged = df.repartitionByRange(partitions, key) if partitions else df.repartitionByRange(key)
    ranged = ranged.sortWithinPartitions(key)
    # The low 33 bits of the monotonic id are the row's position in its partition.
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(ranged.select("*", F.spark_partition_id().alias("_part"), position.alias("_pos")))
    sizes = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], start
    for p in range(max(sizes, default=0) + 1):
        offsets.append(total)
        total += sizes.get(p, 0)
    base = F.element_at(F.lit(offsets).cast("array<bigint>"), F.col("_part") + 1)
    return placed.withColumn("id", base + F.col("_pos") + 1).drop("_part", "_pos")


def assign_ids(current: DataFrame, prior_current: DataFrame, prior_history: DataFrame | None = None) -> DataFrame:
    """``id`` plus the current columns.

    Same callsign and same identity reuse the prior id.  New callsigns and changed
    holders get ids above the high-water mark of both ledgers, in callsign order.
    """
    mark = high_water(prior_current, *([prior_history] if prior_history is not None else []))
    # Only (callsign, old id) is stored and range-partitioned; the records meet their ids
    # in one join at the end.
    pairs = current.select("callsign", *IDENTITY_FIELDS).alias("c").join(
        prior_current.select("id", "callsign", *IDENTITY_FIELDS).alias("p"), F.col("c.callsign") == F.col("p.callsign"), "left"
    )
    matched = stored(
        pairs.select(
            F.col("c.callsign").alias("callsign"),
            F.when(F.col("p.id").isNotNull() & same_identity("p", "c"), F.col("p.id")).cast("bigint").alias("id"),
        )
    )
    kept = matched.filter("id is not null")
    new = number_rows(matched.filter("id is null").select("callsign"), "callsign", mark)
    return current.join(kept.unionByName(new), "callsign").select("id", *current.columns)


def interval_ids(history: DataFrame, current_ids: DataFrame, prior_history: DataFrame) -> DataFrame:
    """Id of each history row.

    A closed interval keeps the id it had under (callsign, valid_from); otherwise, and
    for open intervals, the id the callsign has now; null when neither exists.
    """
    now = current_ids.select(F.col("callsign").alias("_c"), F.col("id").alias("_now"))
    was = prior_history.filter("id is not null").groupBy("callsign", "valid_from").agg(F.max("id").alias("_was"))
    was = was.select(F.col("callsign").alias("_wc"), F.col("valid_from").alias("_wf"), "_was")
    joined = history.join(
        was,
        F.col("valid_to").isNotNull() & (F.col("callsign") == F.col("_wc")) & (F.col("valid_from") == F.col("_wf")),
        "left",
    ).join(now, F.col("callsign") == F.col("_c"), "left")
    return joined.select(F.coalesce("_was", "_now").alias("id"), *history.columns)


def node_child_table(with_ids: DataFrame, list_column: str = "allstar_nodes") -> DataFrame:
    """List column as one (id, node) row per element."""
    return with_ids.select("id", F.explode(list_column).alias("node"))
