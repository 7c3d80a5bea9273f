"""Reference inputs: entity prefixes, node and activity lists, centroids, parks, summits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave.functions.address import location_has_street_address
from regweave.functions.dates import iso_date, slash_date_or_same
from regweave.functions.grid import grid6
from regweave.functions.labels import first_subdivision
from regweave.functions.numbers import active_flag, active_until, digits_only, to_double, to_whole
from regweave.functions.text import blank_to_null, redact_emails, strip
from regweave.operators.dedupe import first_per_key, last_per_key
from regweave.schemas import PARK, SUMMIT, conform
from regweave.sources import base, delimited

# --- entity prefixes ---------------------------------------------------------------------


def strip_annotations(token: Column) -> Column:
    """Bare prefix of a token: leading ``=`` and bracketed overrides removed."""
    bare = F.regexp_replace(strip(token), "^=", "")
    return F.upper(strip(F.regexp_replace(bare, r"\([^)]*\)|\[[^\]]*\]|<[^>]*>|\{[^}]*\}", "")))


def entity_keys(chunks: DataFrame, numbers: DataFrame) -> DataFrame:
    """``(key, is_exact, entity, number)`` from ``;``-separated records.

    The first line of a record is its header (name first, primary prefix eighth); the
    first definition of a key wins.
    """
    text = strip(F.col("value"))
    header = F.split(F.substring_index(text, "\n", 1), ":")
    body = F.when(text.contains("\n"), F.regexp_replace(text, r"^[^\n]*\n", "")).otherwise(F.lit(""))
    parsed = chunks.select(
        strip(F.try_element_at(header, F.lit(1))).alias("entity"),
        F.upper(strip(F.try_element_at(header, F.lit(8)))).alias("primary"),
        F.size(header).alias("_n"), body.alias("_body"), "_ord",
    ).filter("_n >= 8")
    tokens = parsed.select(
        "entity", "primary", "_ord", F.posexplode(F.split(F.translate("_body", "\n", ","), ",")).alias("_pos", "_tok")
    ).filter(strip(F.col("_tok")) != "")
    keys = tokens.select(
        strip_annotations(F.col("_tok")).alias("key"), strip(F.col("_tok")).startswith("=").alias("is_exact"), "entity",
        "primary", "_ord", "_pos",
    ).filter("key <> ''")
    first = first_per_key(keys, ["key", "is_exact"], F.struct("_ord", "_pos"), drop=("_ord", "_pos"))
    return first.join(numbers, "primary", "left").select("key", "is_exact", "entity", "number")


def read_entity_numbers(spark: SparkSession, path: str) -> DataFrame:
    """``(primary, number)`` from the quoted CSV; bad rows skipped, last row per key wins."""
    rows = delimited.table(spark, path, {"primary": 0, "number": 2}, header_tokens=set())
    parsed = rows.select(F.upper("primary").alias("primary"), F.col("number").try_cast("bigint").alias("number"), "_ord")
    return last_per_key(parsed.filter("primary is not null and number is not null"), ["primary"], F.col("_ord"), drop=("_ord",))


def read_entities(spark: SparkSession, path: str, numbers_path: str) -> DataFrame:
    """Prefix table with entity numbers."""
    return entity_keys(base.read_lines(spark, path, line_sep=";"), read_entity_numbers(spark, numbers_path))


# --- node directory ----------------------------------------------------------------------


def node_pairs(lines: DataFrame) -> DataFrame:
    """Lenient: ``(callsign, node)`` of lines with two fields or more and a number."""
    cells = F.split(strip(F.col("value")), "[|]")
    return lines.select(
        F.upper(strip(F.try_element_at(cells, F.lit(2)))).alias("callsign"),
        digits_only(F.try_element_at(cells, F.lit(1))).alias("node"),
    ).filter("callsign <> '' and node is not null")


def node_report(lines: DataFrame) -> DataFrame:
    """Strict: every line with a ``reason`` (null when accepted) and the cleaned fields.

    A line needs exactly four fields, a digit node and a callsign; a repeated node keeps
    its first line; an address-like location is blanked and reported.
    """
    cells = F.split(strip(F.col("value")), "[|]", -1)
    at = [F.try_element_at(cells, F.lit(i)) for i in (1, 2, 3, 4)]
    node = digits_only(at[0])
    call = F.upper(strip(at[1]))
    location = redact_emails(blank_to_null(at[3]))
    shaped = lines.filter(strip(F.col("value")) != "").select(
        F.when(F.size(cells) != 4, "field_count").when(node.isNull() | (call == ""), "node_number").alias("reason"),
        node.cast("string").alias("node"), call.alias("callsign"), redact_emails(blank_to_null(at[2])).alias("description"),
        location.alias("location"), "_ord",
    )
    first = shaped.filter("reason is null").groupBy("node").agg(F.min("_ord").alias("_first"))
    joined = shaped.join(first, "node", "left")
    reason = F.coalesce(F.col("reason"), F.when(F.col("_ord") != F.col("_first"), F.lit("duplicate")))
    flagged = location_has_street_address(F.col("location"))
    return joined.select(
        reason.alias("reason"), "node", "callsign", "description", F.when(~flagged, F.col("location")).alias("location"),
        (reason.isNull() & flagged).alias("address"), "_ord",
    )


def node_directory(report: DataFrame) -> DataFrame:
    """Accepted directory rows."""
    return report.filter("reason is null").select("node", "callsign", "description", "location")


def node_drop_counts(report: DataFrame) -> DataFrame:
    """Dropped lines and blanked locations by reason."""
    tagged = report.select(F.coalesce("reason", F.when(F.col("address"), F.lit("address"))).alias("reason"))
    return tagged.filter("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Strict node report of a pipe file."""
    return node_report(base.read_lines(spark, path))


# --- activity list -----------------------------------------------------------------------


def activity_days(lines: DataFrame) -> DataFrame:
    """``(callsign, day)``; extra fields tolerated, bad dates and blank keys skipped."""
    cells = F.split(strip(F.col("value")), ",")
    return lines.select(
        F.upper(strip(F.try_element_at(cells, F.lit(1)))).alias("callsign"),
        iso_date(F.try_element_at(cells, F.lit(2))).alias("day"),
    ).filter("callsign <> '' and day is not null")


def read_activity(spark: SparkSession, path: str) -> DataFrame:
    """Activity list of a CSV file (restricted: read it only when the caller opts in)."""
    return activity_days(base.read_lines(spark, path))


# --- centroids ---------------------------------------------------------------------------


def read_postal_centroids(spark: SparkSession, path: str) -> DataFrame:
    """One centroid per (country, postal code), the last entry wins."""
    rows = base.json_items(spark, path, "country string, postal_code string, lat double, lon double")
    rows = rows.withColumn("country", F.upper(F.trim("country"))).withColumn("postal_code", F.upper(F.trim("postal_code")))
    return last_per_key(rows, ["country", "postal_code"], F.col("_ord"), drop=("_ord", "file"))


def read_city_centroids(spark: SparkSession, path: str) -> DataFrame:
    """One centroid per (country, state, city), the last entry wins."""
    rows = base.json_items(spark, path, "country string, state string, city string, lat double, lon double")
    for name in ("country", "state", "city"):
        rows = rows.withColumn(name, F.upper(F.trim(F.coalesce(name, F.lit("")))))
    return last_per_key(rows, ["country", "state", "city"], F.col("_ord"), drop=("_ord", "file"))


# --- parks and summits -------------------------------------------------------------------

PARK_JSON = (
    "reference string, name string, latitude string, longitude string, grid string, locationDesc string,"
    " active string, isActive string"
)


def park_records(rows: DataFrame, synced_at: str | None = None) -> DataFrame:
    """Park objects (with ``country`` and ``_ord``) to parks, first row per reference."""
    flat = rows.filter("reference <> ''").select(
        F.trim("reference").alias("reference"), F.nullif("name", F.lit("")).alias("name"),
        F.nullif("locationDesc", F.lit("")).alias("location_desc"), first_subdivision(F.col("locationDesc")).alias("region"),
        "country", blank_to_null(F.col("grid")).alias("grid"), to_double(F.col("latitude")).alias("lat"),
        to_double(F.col("longitude")).alias("lon"), active_flag(F.coalesce("active", "isActive")).alias("active"),
        F.lit("pota").alias("source"), F.lit(synced_at).alias("synced_at"), "_ord",
    )
    return conform(first_per_key(flat, ["reference"], F.col("_ord"), drop=("_ord",)), PARK)


def read_parks(spark: SparkSession, path: str, synced_at: str | None = None) -> DataFrame:
    """``parks_<PROGRAM>.json`` arrays, one file per program; the file name gives the country."""
    rows = base.json_items(spark, path, PARK_JSON)
    name = F.regexp_extract(F.col("file"), r"_([^_.]+)\.[^.]*$", 1)
    return park_records(rows.withColumn("country", F.nullif(name, F.lit(""))), synced_at)


SUMMIT_COLUMNS = ["SummitCode", "AssociationName", "RegionName", "SummitName", "AltM", "AltFt", "GridRef1", "GridRef2",
                  "Longitude", "Latitude", "Points", "BonusPoints", "ValidFrom", "ValidTo", "ActivationCount",
                  "ActivationDate", "ActivationCall"]
SUMMIT_TITLE = "SOTA Summits List"


def summit_records(rows: DataFrame, as_of: str, synced_at: str | None = None) -> DataFrame:
    """Named summit columns to summits, first row per code."""
    lat, lon = to_double(F.col("Latitude")), to_double(F.col("Longitude"))
    valid_to = slash_date_or_same(F.col("ValidTo"))
    flat = rows.filter("SummitCode is not null").select(
        F.col("SummitCode").alias("reference"), F.col("SummitName").alias("name"),
        F.col("AssociationName").alias("association"), F.col("RegionName").alias("region"),
        to_whole(F.col("AltM")).alias("alt_m"), to_whole(F.col("AltFt")).alias("alt_ft"),
        F.when(lat.isNotNull() & lon.isNotNull(), grid6(lat, lon)).alias("grid"), lat.alias("lat"), lon.alias("lon"),
        to_whole(F.col("Points")).alias("points"), to_whole(F.col("BonusPoints")).alias("bonus_points"),
        slash_date_or_same(F.col("ValidFrom")).alias("valid_from"), valid_to.alias("valid_to"),
        active_until(valid_to, as_of).alias("active"), F.lit("sota").alias("source"), F.lit(synced_at).alias("synced_at"),
        "_ord",
    )
    return conform(first_per_key(flat, ["reference"], F.col("_ord"), drop=("_ord",)), SUMMIT)


def read_summits(spark: SparkSession, path: str, as_of: str, synced_at: str | None = None) -> DataFrame:
    """CSV files with a title line above their headers."""
    return summit_records(delimited.table(spark, path, dict.fromkeys(SUMMIT_COLUMNS), title=SUMMIT_TITLE), as_of, synced_at)
