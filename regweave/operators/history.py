"""Interval history: snapshot folds, privacy rules on old rows, as-of attribution."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regweave.functions.labels import postal_area
from regweave.schemas import HISTORY, IDENTITY_FIELDS, conform
from regweave.session import stored

# Fixed value: what can identify or locate a holder.
IDENTIFYING_FIELDS = ("first_name", "last_name", "city", "county", "state", "postal_code", "grid")
_PAYLOAD = tuple(n for n in HISTORY.names if n not in ("valid_from", "valid_to"))


def same_identity(left: str, right: str) -> Column:
    """Null-safe equality of the tracked holder and location fields."""
    test = F.lit(True)
    for name in IDENTITY_FIELDS:
        test = test & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return test


def fold_pairs(still_open: DataFrame, current: DataFrame, as_of: str) -> DataFrame:
    """Open intervals and a snapshot to the intervals that stay or begin (open) and those that end on ``as_of``.

    Both meet in one full outer join on unique keys; each pair yields one or two rows from an array, so both
    inputs are read once.
    """
    day = F.lit(as_of)
    old = F.struct(*[F.col(f"o.{n}").alias(n) for n in HISTORY.names])
    ended = F.struct(
        *[(day if n == "valid_to" else F.col(f"o.{n}")).alias(n) for n in HISTORY.names]
    )
    bounds = {"valid_from": day, "valid_to": F.lit(None).cast("string")}
    fresh = F.struct(*[bounds.get(n, F.col(f"c.{n}")).alias(n) for n in HISTORY.names])
    snap = current.select(*[
        F.col(n).cast(HISTORY[n].dataType).alias(n) if n in current.columns
        else F.lit(None).cast(HISTORY[n].dataType).alias(n)
        for n in _PAYLOAD
    ])
    pairs = still_open.alias("o").join(snap.alias("c"), F.col("o.callsign") == F.col("c.callsign"), "full_outer")
    rows = (
        F.when(F.col("o.callsign").isNull(), F.array(fresh))
        .when(F.col("c.callsign").isNull(), F.array(ended))
        .when(same_identity("o", "c"), F.array(old))
        .otherwise(F.array(ended, fresh))
    )
    return pairs.select(F.inline(rows))


def fold_snapshot(prior: DataFrame, current: DataFrame, as_of: str) -> DataFrame:
    """Cumulative history after one snapshot.  Closed intervals pass through without a shuffle."""
    prior = conform(prior, HISTORY)
    closed = prior.filter(F.col("valid_to").isNotNull())
    return fold_pairs(prior.filter(F.col("valid_to").isNull()), current, as_of).unionByName(closed)


def history_order() -> list[Column]:
    """Sort order of the published history: open intervals after closed ones."""
    return [F.col("callsign"), F.col("valid_from"), F.coalesce("valid_to", F.lit("~"))]


def withhold_unvetted(prior: DataFrame, current: DataFrame, source: str = "acma") -> DataFrame:
    """Blank identifying fields of one source's old rows unless the row is open and
    the snapshot publishes the same holder name for that callsign."""
    vetted = current.filter((F.col("source") == source) & F.col("last_name").isNotNull()).select(
        F.col("callsign").alias("_vc"), F.col("last_name").alias("_vn")
    )
    joined = prior.join(
        vetted,
        (F.col("source") == source) & F.col("valid_to").isNull() & (F.col("callsign") == F.col("_vc"))
        & (F.col("last_name") == F.col("_vn")),
        "left",
    )
    keep = ~F.col("source").eqNullSafe(F.lit(source)) | F.col("_vc").isNotNull()
    return joined.select(*[
        F.when(keep, F.col(n)).alias(n) if n in IDENTIFYING_FIELDS else F.col(n) for n in prior.columns
    ])


def generalise_postal(prior: DataFrame, source: str = "ised") -> DataFrame:
    """Cut one source's postal codes to their 3-character area on all old rows."""
    code = F.when(F.col("source") == source, postal_area(F.col("postal_code"))).otherwise(F.col("postal_code"))
    return prior.withColumn("postal_code", code)


def _carry_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order of key and time: each event gets the last start of its key; the last start of all goes at the end."""
    last = None
    for batch in batches:
        if last is not None:
            batch = pa.concat_batches([last, batch])
        start = batch.column("_start").to_numpy(zero_copy_only=False)
        at = np.maximum.accumulate(np.where(start, np.arange(len(start)), -1))
        place, key = pa.array(at, mask=at < 0), batch.column("_k")
        own = key.take(place)
        same = pc.if_else(pc.is_null(key), pc.and_(pc.is_null(own), pa.array(at >= 0)), pc.fill_null(pc.equal(key, own), False))
        found = batch.column("_iv").take(pc.if_else(same, place, pa.scalar(None, place.type)))
        if len(at) and at[-1] >= 0:
            last = batch.slice(int(at[-1]), 1)
        names = batch.schema.names
        yield batch.set_column(names.index("_iv"), "_iv", found).filter(pa.array(~start))
    if last is not None:
        yield last


def attribute_as_of(events: DataFrame, history: DataFrame, key: str, at: str, payload: list[str], partitions: int | None = None) -> DataFrame:
    """Which interval of ``key`` was valid at ``at`` (ISO text), or nulls.

    Events and interval starts lie on one line, range-partitioned by key and time, so a key with a third of all events
    spreads over many ranges at any density of time.  A scan of each range gives every event the last start of its key
    in that range; for events before it, the last start of an earlier range is carried over a table with one row a
    range.  Intervals of a key must not overlap; starts that end at once count for nothing.  A hash
    of the event comes last in the order of ranges, so events of one key and time spread as well.  Bounds are ``valid_from <= at < valid_to``.
    """
    interval = F.struct("valid_from", "valid_to", *payload)
    starts = history.filter("valid_to is null or valid_from < valid_to").select(
        F.col(key).alias("_k"), F.col("valid_from").alias("_t"), interval.alias("_iv"),
        F.lit(None).cast(events.select(F.struct("*").alias("e")).schema["e"].dataType).alias("_e"), F.lit(True).alias("_start"),
    )
    rows = events.select(
        F.col(key).alias("_k"), F.col(at).alias("_t"), F.lit(None).cast(starts.schema["_iv"].dataType).alias("_iv"), F.struct("*").alias("_e"), F.lit(False).alias("_start"),
    )
    line = starts.unionByName(rows)
    # Starts go before events of their time.
    order = [F.col("_k"), F.col("_t"), F.col("_start").desc()]
    spread = [*order, F.xxhash64("_e")]
    ranged = line.repartitionByRange(partitions, *spread) if partitions else line.repartitionByRange(*spread)
    sorted_ = ranged.sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    placed = stored(sorted_.mapInArrow(_carry_starts, sorted_.schema))
    # One row per range: its last start, then carried over later ranges.
    ends = placed.filter("_start").select("_part", F.struct(F.col("_k").alias("k"), F.col("_iv").alias("iv")).alias("_last"))
    ranges = placed.select("_part").distinct().join(ends, "_part", "left")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select("_part", F.last("_last", ignorenulls=True).over(earlier).alias("_carried")).filter("_carried is not null")
    joined = placed.filter("not _start").join(carried, "_part", "left")
    found = F.coalesce("_iv", F.when(F.col("_carried.k").eqNullSafe(F.col("_k")), F.col("_carried.iv")))
    valid = found["valid_to"].isNull() | (F.col("_t") < found["valid_to"])
    hit = F.when(valid, found)
    return joined.select("_e.*", *[hit[c].alias(c) for c in ["valid_from", "valid_to", *payload] if c not in events.columns])


def overlapping_intervals(history: DataFrame) -> DataFrame:
    """Intervals that end after the next one of their callsign starts (should be none)."""
    w = Window.partitionBy("callsign").orderBy("valid_from", F.coalesce("valid_to", F.lit("~")))
    nxt = history.withColumn("next_from", F.lead("valid_from").over(w))
    return nxt.filter(F.coalesce("valid_to", F.lit("~")) > F.col("next_from"))
