"""Record normalisation and the precedence merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regweave.functions.address import looks_like_street_address
from regweave.functions.labels import precedence_rank
from regweave.functions.text import blank_to_null, title_case
from regweave.operators.dedupe import first_per_key, union_all

# Fields that get proper case, and fields checked for street addresses.
NAME_FIELDS = ("first_name", "last_name", "city", "county")
GUARDED_FIELDS = ("first_name", "last_name", "city")


def normalize(df: DataFrame, clean_key: bool = False) -> DataFrame:
    """Trim strings, blank to null, upper-case the key, proper-case names and null
    address-shaped names and towns.  One projection, idempotent.

    ``clean_key`` leaves an already clean key column as it is, which keeps the rows'
    partitioning by it.
    """
    out: list[Column] = []
    for field in df.schema.fields:
        value = F.col(field.name)
        cleaned = clean_key and field.name == "callsign"
        if isinstance(field.dataType, T.StringType) and not field.name.startswith("_") and not cleaned:
            raw, value = value, blank_to_null(value)
            if field.name == "callsign":
                value = F.upper(value)
            elif field.name in NAME_FIELDS:
                value = title_case(value)
            if field.name in GUARDED_FIELDS:
                value = F.when(~looks_like_street_address(raw), value)
        out.append(value.alias(field.name))
    return df.select(*out)


def scrub_counters() -> list[Column]:
    """Aggregates that count address-shaped values per guarded field on raw rows."""
    return [
        F.count_if(looks_like_street_address(F.col(name))).cast("bigint").alias(name)
        for name in GUARDED_FIELDS
    ]


def merge_registers(streams: list[DataFrame], observation=None) -> DataFrame:
    """One row per callsign over all registers.

    Better source rank wins, then the earlier stream, then the earlier ``_ord`` (the
    common row-order struct of all scans).  Rows with a blank key are left out (see
    ``keyless``).  With ``observation`` the scrub counts are collected on all input rows
    without a second pass.
    """
    raw = union_all([s.withColumn("_stream", F.lit(i)) for i, s in enumerate(streams)])
    if observation is not None:
        raw = raw.observe(observation, *scrub_counters())
    # Only the key decides the merge, so the costly clean-up runs on the winners.
    keyed = raw.withColumn("callsign", F.upper(blank_to_null(F.col("callsign")))).filter("callsign is not null")
    order = F.struct(precedence_rank(blank_to_null(F.col("source"))), F.col("_stream"), F.col("_ord"))
    return normalize(first_per_key(keyed, ["callsign"], order, drop=("_ord", "_stream")), clean_key=True)


def keyless(df: DataFrame) -> DataFrame:
    """The rows ``merge_registers`` leaves out because their key is blank."""
    return df.filter(blank_to_null(F.col("callsign")).isNull())
