"""Lookups that add columns to current records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.functions.grid import grid4
from regweave.functions.labels import postal_country, postal_key

# A list page covers this many consecutive numbers, so no page can hold more elements.
PAGE = 4096


def number_pages(pairs: DataFrame, key: str, number: str, page: int = PAGE) -> DataFrame:
    """Sorted distinct numbers per key, cut into value-range pages.

    A page holds at most ``page`` distinct numbers by construction, whatever share of the
    rows one key has, and the sets are built on the map side before the shuffle.
    """
    n = F.col(number).cast("bigint")
    start = n - F.pmod(n, F.lit(page).cast("bigint"))  # whole numbers all the way: no rounding
    return pairs.groupBy(F.col(key), F.call_function("div", start, F.lit(page)).alias("page")).agg(
        F.sort_array(F.collect_set(n)).alias("numbers")
    )


def number_lists(pairs: DataFrame, key: str, number: str) -> DataFrame:
    """One sorted list per key, assembled from pages (the published list column).

    The contract wants one array per record; the paged form and the child table are
    the ones to use when a key may hold very many numbers.
    """
    pages = number_pages(pairs, key, number)
    joined = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("page", "numbers"))), lambda p: p["numbers"]))
    return pages.groupBy(key).agg(joined.alias("numbers"))


def _key(records: DataFrame, clean_keys: bool) -> Column:
    return records.callsign if clean_keys else F.upper(records.callsign)


def attach_nodes(records: DataFrame, nodes: DataFrame, clean_keys: bool = False) -> DataFrame:
    """Attach the node list of each callsign; none gives an empty list.

    ``nodes`` has ``callsign`` (upper case) and ``node``.  With ``clean_keys`` the records
    are upper case already and keep their partitioning by callsign.
    """
    lists = number_lists(nodes.select("callsign", "node"), "callsign", "node").select(
        F.col("callsign").alias("_call"), F.col("numbers").alias("_nodes")
    )
    joined = records.join(lists, _key(records, clean_keys) == F.col("_call"), "left")
    return joined.withColumn(
        "allstar_nodes", F.coalesce("_nodes", F.array().cast("array<bigint>"))
    ).select(*records.columns)


def latest_activity(activity: DataFrame) -> DataFrame:
    """Latest date per callsign.  Dates are compared as dates: a fixed-width maximum is
    kept in a hash aggregate, a text one would sort."""
    return activity.groupBy("callsign").agg(F.max(F.try_to_date("day", "yyyy-MM-dd")).cast("string").alias("day"))


def attach_activity(records: DataFrame, activity: DataFrame, clean_keys: bool = False) -> DataFrame:
    """Set the activity flag and the last activity date."""
    latest = latest_activity(activity).select(
        F.col("callsign").alias("_call"), F.col("day").alias("_day")
    )
    joined = records.join(latest, _key(records, clean_keys) == F.col("_call"), "left")
    return (
        joined.withColumn("uses_lotw", F.col("_day").isNotNull())
        .withColumn("lotw_last_activity", F.col("_day"))
        .select(*records.columns)
    )


def _norm(col: Column) -> Column:
    return F.upper(F.trim(F.coalesce(col, F.lit(""))))


def fill_grid(records: DataFrame, postal: DataFrame, city: DataFrame) -> DataFrame:
    """Grid from the postal centroid, else the city centroid, where none is given.

    Runs before entity enrichment: the table is keyed by the postal system of the
    register, not by the entity of the call.  ``postal`` has country, postal_code,
    lat, lon; ``city`` has country, state, city, lat, lon; keys unique.
    """
    home = postal_country(F.col("source"), F.col("country"))
    p = postal.select(
        _norm(F.col("country")).alias("_pc"), _norm(F.col("postal_code")).alias("_pk"),
        grid4(F.col("lat"), F.col("lon")).alias("_pgrid"),
    )
    c = city.select(
        _norm(F.col("country")).alias("_cc"), _norm(F.col("state")).alias("_cs"),
        _norm(F.col("city")).alias("_ck"), grid4(F.col("lat"), F.col("lon")).alias("_cgrid"),
    )
    # Rows with nothing to look up get a key of their own that matches nothing: a null key
    # would send all of them to one shuffle partition.
    needs = F.col("grid").isNull()
    nothing = F.concat(F.lit("\x00"), F.coalesce("callsign", F.lit("")))
    keyed = (
        records.withColumn("_home", home)
        .withColumn("_post", F.when(needs & (F.col("postal_code") != ""), postal_key(F.col("_home"), F.col("postal_code"))).otherwise(nothing))
        .withColumn("_city", F.when(needs & (F.col("city") != ""), _norm(F.col("city"))).otherwise(nothing))
        .withColumn("_state", _norm(F.col("state")))
    )
    joined = keyed.join(
        p, (F.col("_home") == F.col("_pc")) & (F.col("_post") == F.col("_pk")), "left"
    ).join(
        c,
        (F.col("_home") == F.col("_cc")) & (F.col("_state") == F.col("_cs")) & (F.col("_city") == F.col("_ck")),
        "left",
    )
    return joined.withColumn("grid", F.coalesce("grid", "_pgrid", "_cgrid")).select(*records.columns)
