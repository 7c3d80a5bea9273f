"""One row per key.

All picks are aggregates or rank limits that reduce each key to one row on the map
side before the shuffle, so a key that holds a third of all rows costs one row per
map task, not one giant reduce task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _rest(df: DataFrame, keys: list[str], drop: tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if c not in keys and c not in drop]


def first_per_key(df: DataFrame, keys: list[str], order: Column, drop: tuple[str, ...] = ()) -> DataFrame:
    """Row with the smallest ``order`` per key (first wins)."""
    row = F.struct(*_rest(df, keys, drop))
    return df.groupBy(*keys).agg(F.min_by(row, F.struct(order)).alias("_row")).select(*keys, "_row.*")


def last_per_key(df: DataFrame, keys: list[str], order: Column, drop: tuple[str, ...] = ()) -> DataFrame:
    """Row with the largest ``order`` per key (last wins)."""
    row = F.struct(*_rest(df, keys, drop))
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(order)).alias("_row")).select(*keys, "_row.*")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key under mixed ascending/descending order.

    ``row_number() == 1`` makes Spark place a group limit on both sides of the
    shuffle, so only one candidate per key and map task moves.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_expiry(df: DataFrame, keys: list[str], expiry: str, order: Column) -> DataFrame:
    """Latest expiry wins, null expiry is lowest, ties keep the first row."""
    return top_per_key(df, keys, [F.coalesce(F.col(expiry), F.lit("")).desc(), order.asc()])


def merge_by_priority(groups: list[DataFrame], key: str) -> DataFrame:
    """Union of groups, the first group that has a key wins; rows are never mixed."""
    tagged = [g.withColumn("_group", F.lit(i)) for i, g in enumerate(groups)]
    has_order = all("_ord" in g.columns for g in groups)
    order = F.struct("_group", "_ord") if has_order else F.struct("_group")
    return first_per_key(union_all(tagged), [key], order, drop=("_group",))


def one_holder(
    df: DataFrame,
    key: str,
    order: Column,
    first_known: list[str],
    earliest: dict[str, str],
    latest: dict[str, str],
    place: tuple[str, str],
    preferred: Column,
    fallback_state: str | None = None,
) -> DataFrame:
    """Many station rows to one holder row.

    First non-null value per field, earliest and latest dates, and the place
    (city, state) of the preferred station, else of the first station that has one.
    ``fallback_state`` replaces the state only when no station names a city.
    """
    city, state = place
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(order))).alias(c) for c in first_known]
    aggs += [F.min(F.col(c)).alias(name) for name, c in earliest.items()]
    aggs += [F.max(F.col(c)).alias(name) for name, c in latest.items()]
    spot = F.min_by(
        F.struct(F.col(city).alias("city"), F.col(state).alias("state")),
        F.when(F.col(city).isNotNull(), F.struct(~F.coalesce(preferred, F.lit(False)), order)),
    ).alias("_spot")
    out = df.groupBy(key).agg(*aggs, spot)
    spot_state = F.col("_spot.state")
    if fallback_state:
        spot_state = F.when(F.col("_spot.city").isNotNull(), spot_state).otherwise(F.col(fallback_state))
    return out.withColumn("city", F.col("_spot.city")).withColumn("state", spot_state).drop("_spot")
