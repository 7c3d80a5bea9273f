"""Longest-prefix join with exact overrides.

A ``startswith`` join plans as a nested loop.  Here every distinct call is expanded to
its own prefixes (a call has at most as many as the table has key lengths) and met
with the table in an equi-join; Spark broadcasts the table only if its measured size
allows, otherwise it shuffles on the prefix and splits hot one-letter prefixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the one key whose match depends on the shape of the call.
SHAPED_PREFIX = "KG4"


def _shape_ok(call: Column, key: Column) -> Column:
    base = F.substring_index(call, "/", 1)
    suffix = F.substring(base, F.lit(len(SHAPED_PREFIX) + 1), F.length(base))
    fits = (suffix == "") | suffix.rlike(r"^\p{L}{2}$")
    return (key != SHAPED_PREFIX) | fits


def resolve_entities(calls: DataFrame, call: str, table: DataFrame, clean_keys: bool = False) -> DataFrame:
    """``(call, entity, number)`` for every distinct call that matches ``table``.

    With ``clean_keys`` the calls are unique, trimmed and upper case, as after a merge.

    ``table`` has ``key, is_exact, entity, number`` with unique ``(key, is_exact)``.
    An exact entry wins over any prefix, then the longest prefix wins.
    """
    # Calls compress well, so by their bytes adaptive execution would merge all of them into one task.
    tasks = int(calls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lengths = [r[0] for r in table.select(F.length("key")).distinct().collect()]  # few values
    if clean_keys:
        one = calls.select(F.col(call).alias("call"))
    else:
        one = calls.select(F.upper(F.trim(F.col(call))).alias("call")).filter("call <> ''").repartition(tasks, "call").distinct()
    wanted = F.array_compact(
        F.array(
            *[
                F.when(F.length("call") >= n, F.struct(F.substring("call", 1, n).alias("key"), F.lit(False).alias("is_exact")))
                for n in sorted(lengths)
            ],
            F.struct(F.col("call").alias("key"), F.lit(True).alias("is_exact")),
        )
    )
    probes = one.select("call", F.inline(wanted))
    hits = probes.join(table, ["key", "is_exact"]).filter(
        F.col("is_exact") | _shape_ok(F.col("call"), F.col("key"))
    )
    best = F.max_by(F.struct("entity", "number"), F.struct(F.col("is_exact"), F.length("key")))
    return hits.repartition(tasks, "call").groupBy("call").agg(best.alias("_hit")).select("call", "_hit.*")


def apply_entities(records: DataFrame, table: DataFrame, clean_keys: bool = False) -> DataFrame:
    """Fill country and entity number.  No hit keeps the old values; a hit overwrites
    both, the number even with null."""
    found = resolve_entities(records, "callsign", table, clean_keys).withColumn("_matched", F.lit(True))
    key = F.col("callsign") if clean_keys else F.upper(F.trim("callsign"))
    if not clean_keys:  # after a merge the records lie by callsign already
        records = records.repartition(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.upper(F.trim("callsign")))
    joined = records.join(found, key == F.col("call"), "left")
    hit = F.col("_matched").isNotNull()
    return (
        joined.withColumn("country", F.when(hit, F.col("entity")).otherwise(F.col("country")))
        .withColumn("dxcc", F.when(hit, F.col("number").cast("bigint")).otherwise(F.col("dxcc")))
        .select(*records.columns)
    )
