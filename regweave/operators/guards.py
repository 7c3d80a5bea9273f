"""Data assertions and keep-last-good decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------------
SHRINK_GUARD = 0.66
TALKGROUP_SLICE = 40
TALKGROUP_MIN_AGE_DAYS = 2
MIN_REFLECTORS = 2000
MIN_NODES_TO_WRITE = 1000
MIN_NODES_TO_PUBLISH = 30000
COUNT_SLACK = 10
EXPECTED_NETWORKS = ("dstar", "m17", "ysf", "nxdn", "p25", "urf", "dmr")
# ---------------------------------------------------------------------------------


class GateError(ValueError):
    """A data assertion failed."""


def require_columns(df: DataFrame, required: list[str], source: str) -> DataFrame:
    """Fail a source before any plan is run when its header lacks a column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise GateError(f"{source}: missing column(s) {', '.join(missing)}")
    return df


def require_only_source(df: DataFrame, allowed: str) -> DataFrame:
    """Fail when a segregated output holds a row of any other source."""
    bad = df.filter(~F.col("source").eqNullSafe(F.lit(allowed))).select("source").limit(1).collect()
    if bad:
        raise GateError(f"only source={allowed!r} rows may be written; got {bad[0]['source']!r}")
    return df


def source_counts(df: DataFrame) -> DataFrame:
    """Rows per (network, source)."""
    return df.filter("source <> ''").groupBy("network", "source").agg(F.count(F.lit(1)).alias("n"))


def lost_sources(previous: DataFrame, fresh: DataFrame, attempted: DataFrame) -> DataFrame:
    """(network, source) pairs that were tried, had rows before and have none now.

    Only networks that are part of the fresh build are judged.  The three inputs are
    summaries with one row per network and source.
    """
    return (
        previous.filter("n > 0").select("network", "source")
        .join(attempted.select("network", "source"), ["network", "source"], "left_semi")
        .join(fresh.filter("n > 0").select("network", "source"), ["network", "source"], "left_anti")
        .join(fresh.select("network").distinct(), "network", "left_semi")
    )


def decide(previous: DataFrame, fresh: DataFrame, attempted: DataFrame) -> DataFrame:
    """``(network, previous, fresh, decision, reason)`` with decision fresh or keep.

    A lost source keeps the old set, else a shrink below the guard keeps it, and a
    network that was not fetched keeps it too.
    """
    lost = lost_sources(previous, fresh, attempted).groupBy("network").agg(F.min("source").alias("_lost"))
    before = previous.groupBy("network").agg(F.sum("n").alias("previous"))
    now = fresh.groupBy("network").agg(F.sum("n").alias("fresh"))
    both = before.join(now, "network", "full_outer").join(lost, "network", "left")
    shrunk = (F.col("previous") > 0) & (F.col("fresh") < F.col("previous") * SHRINK_GUARD)
    reason = (
        F.when(F.col("fresh").isNull(), "not fetched")
        .when(F.col("_lost").isNotNull(), "lost source")
        .when(F.coalesce(shrunk, F.lit(False)), "shrunk")
    )
    return both.select(
        "network", F.coalesce("previous", F.lit(0)).alias("previous"), F.coalesce("fresh", F.lit(0)).alias("fresh"),
        F.when(reason.isNull(), "fresh").otherwise("keep").alias("decision"), F.coalesce(reason, F.lit("")).alias("reason"),
    )


def keep_last_good(previous: DataFrame, fresh: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of each network from the side its decision names."""
    use_old = decisions.filter("decision = 'keep'").select("network")
    use_new = decisions.filter("decision = 'fresh'").select("network")
    return previous.join(use_old, "network", "left_semi").unionByName(
        fresh.join(use_new, "network", "left_semi"), allowMissingColumns=True
    )


def stalest_slice(systems: DataFrame, fetched: DataFrame, today: str, limit: int = TALKGROUP_SLICE,
                  min_age_days: int = TALKGROUP_MIN_AGE_DAYS) -> DataFrame:
    """Systems to refetch: never fetched first, then oldest, name as tie-break.

    The limit is the feature: a nightly budget.  Unreadable dates count as never.
    """
    state = systems.join(fetched, "system", "left").withColumn("_day", F.try_to_date("fetched", "yyyy-MM-dd"))
    due = state.filter(
        F.col("_day").isNull() | (F.datediff(F.to_date(F.lit(today)), F.col("_day")) >= min_age_days)
    )
    return due.orderBy(F.col("_day").asc_nulls_first(), "system").limit(limit).select(
        "system", F.col("_day").cast("string").alias("fetched")
    )


def changed_groups(previous: DataFrame, fresh: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Groups whose set of rows differs, compared exactly.

    Rows of both sides cancel out as +1 and -1 per distinct row, with map-side combine;
    no group is collected.
    """
    sides = fresh.select(group, *columns, F.lit(1).alias("_side")).unionByName(
        previous.select(group, *columns, F.lit(-1).alias("_side"))
    )
    uneven = sides.groupBy(group, *columns).agg(F.sum("_side").alias("_d")).filter("_d <> 0")
    return uneven.select(group).distinct()


def content_dates(previous: DataFrame, fresh: DataFrame, group: str, columns: list[str], today: str) -> DataFrame:
    """Date on which each group's content last changed.

    Unchanged groups keep the old date; an empty answer for a group that had rows keeps
    it too (state ``empty``).
    """
    old = previous.groupBy(group).agg(F.count(F.lit(1)).alias("n_old"), F.max("synced_at").alias("old_date"))
    new = fresh.groupBy(group).agg(F.count(F.lit(1)).alias("n_new"))
    moved = changed_groups(previous, fresh, group, columns).withColumn("_moved", F.lit(True))
    both = old.join(new, group, "full_outer").join(moved, group, "left")
    state = (
        F.when(F.col("n_new").isNull(), "empty").when(F.col("_moved").isNull(), "unchanged").otherwise("changed")
    )
    return both.select(
        group, F.coalesce("n_old", F.lit(0)).alias("n_old"), F.coalesce("n_new", F.lit(0)).alias("n_new"),
        state.alias("state"),
        F.when(state == "changed", F.lit(today)).otherwise(F.col("old_date")).alias("generated"),
    )


def fold_fetches(results: DataFrame, state: DataFrame, today: str) -> DataFrame:
    """Rotation state after a slice of fetches.

    ``results`` has seq, system, status (ok, failed, empty, throttled).  From the first
    throttled fetch on, nothing counts; failed and empty fetches keep the old date.
    """
    stop = results.filter("status = 'throttled'").agg(F.min("seq")).scalar()
    counted = (
        results.withColumn("_stop", stop)
        .filter("(_stop is null or seq < _stop) and status = 'ok'")
        .select("system").distinct().withColumn("_new", F.lit(today))
    )
    return state.join(counted, "system", "full_outer").select("system", F.coalesce("_new", "fetched").alias("fetched"))


def network_gate(records: DataFrame, expected: DataFrame | None = None, floor: int = MIN_REFLECTORS) -> DataFrame:
    """One row: total, missing networks, and whether the directory may be published."""
    spark = records.sparkSession
    wanted = expected if expected is not None else spark.createDataFrame([(n,) for n in EXPECTED_NETWORKS], "network string")
    absent = wanted.join(records.select("network").distinct(), "network", "left_anti")
    total = records.agg(F.count(F.lit(1)).alias("total"))
    return total.withColumn("missing", absent.agg(F.count(F.lit(1))).scalar()).select(
        "total", "missing", ((F.col("missing") == 0) & (F.col("total") >= floor)).alias("publish")
    )


def node_gate(nodes: DataFrame, declared: int | None = None, floor: int = MIN_NODES_TO_PUBLISH) -> DataFrame:
    """One row: rows, non-numeric ids, and whether the node directory may be published."""
    agg = nodes.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~F.col("node").rlike("^[0-9]+$")).alias("bad_ids")
    )
    same = F.lit(True) if declared is None else F.col("total") == declared
    return agg.withColumn("publish", (F.col("total") >= floor) & (F.col("bad_ids") == 0) & same)


def rejected_gate(rejected: Column, limit: float) -> Column:
    """Aggregate: true when the rejected share is within ``limit``."""
    return F.coalesce(F.avg(rejected.cast("double")) <= limit, F.lit(True))


def count_within_slack(parsed: Column, declared: Column) -> Column:
    """Parsed rows may fall short of the declared count by max(10, 0.5 percent)."""
    return parsed + F.greatest(F.lit(COUNT_SLACK), F.floor(declared / 200)) >= declared


def check(gate: DataFrame, column: str, message: str) -> None:
    """Raise when the one-row gate says no."""
    row = gate.first()
    if not row[column]:
        raise GateError(f"{message}: {row.asDict()}")
