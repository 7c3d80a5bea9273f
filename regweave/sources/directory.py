"""Reflector directory inputs: registry XML, host files and nested JSON envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from regweave.functions.labels import bare_host, module_letters, wire_name
from regweave.functions.numbers import digits_only
from regweave.functions.text import blank_to_null, redact_emails, strip
from regweave.operators.dedupe import first_per_key
from regweave.operators.directory import DEXTRA_PORT, HOST_NAME_SHAPE, drop_stale, sanitise
from regweave.schemas import REFLECTOR, conform
from regweave.sources import base

# Fixed value: what an operator must supply for a DMR master.
DMR_REQUIRES = ("dmr_id", "password")

# --- registry XML --------------------------------------------------------------------------


def repair_markup(col: Column) -> Column:
    """Escape ``<`` that opens no tag and ``&`` that opens no reference."""
    return F.regexp_replace(
        F.regexp_replace(col, r"<(?![a-zA-Z/!?])", "&lt;"), r"&(?!#?[a-zA-Z0-9]+;)", "&amp;"
    )


def registry_records(chunks: DataFrame, now_epoch: int, synced_at: str | None = None) -> DataFrame:
    """``<reflector>`` elements (one per row, up to the closing tag) to directory rows."""
    element = F.concat(
        F.lit("<reflector>"), repair_markup(F.regexp_extract("value", r"(?s)<reflector>(.*)$", 1)), F.lit("</reflector>")
    )
    schema = "name string, lastip string, dashboardurl string, lastcontact string, country string, comment string"
    parsed = chunks.filter(F.col("value").contains("<reflector>")).select(F.from_xml(element, F.lit(schema)).alias("x"), "_ord")

    def text(name: str) -> Column:
        return blank_to_null(F.col(f"x.{name}"))

    name = text("name")
    wire = wire_name(name)
    rows = parsed.select(
        name.alias("id"), F.lit("dstar").alias("network"), name.alias("name"),
        F.when(wire.isNotNull() & (wire != name), F.array(wire)).otherwise(F.array().cast("array<string>")).alias("aliases"),
        wire.alias("callsign"), text("lastip").alias("host"), F.lit(DEXTRA_PORT).cast("bigint").alias("port"),
        text("country").alias("country"), text("comment").alias("description"), text("dashboardurl").alias("dashboard"),
        F.lit("xlx").alias("source"), F.lit(synced_at).alias("synced_at"),
        digits_only(text("lastcontact")).alias("_last"), "_ord",
    ).filter("id is not null and host is not null")
    return _directory(drop_stale(rows, "_last", now_epoch).drop("_last"))


def _directory(rows: DataFrame) -> DataFrame:
    """Fixed schema plus ``_ord``, e-mails removed, licence set."""
    ordered = StructType([*REFLECTOR.fields, StructField("_ord", rows.schema["_ord"].dataType)])
    return sanitise(conform(rows, ordered))


def read_registry(spark: SparkSession, path: str, now_epoch: int, synced_at: str | None = None) -> DataFrame:
    """Registry XML, split at element ends so that no task holds the file."""
    return registry_records(base.read_lines(spark, path, line_sep="</reflector>"), now_epoch, synced_at)


# --- host files ----------------------------------------------------------------------------


def host_pairs(lines: DataFrame) -> DataFrame:
    """``(name, host, _ord)`` of ``NAME<ws>ADDRESS`` lines; comments and short lines skipped."""
    text = strip(F.col("value"))
    parts = F.split(text, r"\s+")
    return lines.filter((text != "") & ~text.startswith("#")).select(
        F.upper(F.try_element_at(parts, F.lit(1))).alias("name"), F.try_element_at(parts, F.lit(2)).alias("host"), "_ord"
    ).filter("host <> ''")


def host_records(pairs: DataFrame, synced_at: str | None = None) -> DataFrame:
    """Host pairs of the wire-name shape to directory rows."""
    rows = pairs.filter(F.col("name").rlike(HOST_NAME_SHAPE)).select(
        F.col("name").alias("id"), F.lit("dstar").alias("network"), "name", F.col("name").alias("callsign"), "host",
        F.lit(DEXTRA_PORT).cast("bigint").alias("port"), F.lit("dextra").alias("source"),
        F.lit(synced_at).alias("synced_at"), "_ord",
    )
    return _directory(rows)


def read_hosts(spark: SparkSession, path: str, synced_at: str | None = None) -> DataFrame:
    """Host file as directory rows."""
    return host_records(host_pairs(base.read_lines(spark, path)), synced_at)


def read_alias_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(host, name, _ord)`` of several host files, file order first."""
    from regweave.operators.dedupe import union_all

    parts = []
    for number, path in enumerate(paths):
        order = F.struct(F.lit(f"{number:04d}").alias("path"), F.col("_ord.block").alias("block"), F.col("_ord.row").alias("row"))
        parts.append(host_pairs(base.read_lines(spark, path)).withColumn("_ord", order))
    return union_all(parts).select("host", "name", "_ord")


# --- JSON envelopes ------------------------------------------------------------------------

ROW = (
    "struct<designator:string,name:string,slug:string,url:string,dns:string,ipv4:string,ipv6:string,port:string,"
    "modules:string,sponsor:string,country:string,description:string,extended_description:string>"
)
SERVER = "struct<server:string,slug:string,dns:string,ipv4:string,ipv6:string,port:string,country:string>"
NETWORK = (
    f"struct<network:string,slug:string,tglist:string,url:string,sponsor:string,description:string,servers:array<{SERVER}>>"
)
TALKGROUP = "struct<tg:string,name:string>"


def envelope_rows(payloads: DataFrame, column: str, row_type: str, keys: tuple[str, ...] = ("reflectors", "networks", "servers", "results")) -> DataFrame:
    """Row structs of JSON texts, wherever the row list sits.

    ``data.<key>`` first, then ``data`` as an array, the same keys at top level, a bare
    array.  Other columns are kept; the result adds ``pos`` and ``row``.
    """
    inner = ",".join(f"{k}:array<{row_type}>" for k in keys)
    text = F.col(column)
    keep = [c for c in payloads.columns if c != column]
    is_array = F.substring(F.ltrim(text), 1, 1) == "["
    data_is_array = text.rlike(r'"data"\s*:\s*\[')
    # Each text is parsed once, with the schema its shape asks for; the structs are
    # columns of their own so that the field accesses below do not parse again.
    parsed = payloads.select(
        *keep,
        F.when(is_array, F.from_json(text, f"array<{row_type}>")).alias("_bare"),
        F.when(~is_array & ~data_is_array, F.from_json(text, f"struct<data:struct<{inner}>,{inner}>")).alias("_nested"),
        F.when(~is_array & data_is_array, F.from_json(text, f"struct<data:array<{row_type}>,{inner}>")).alias("_listed"),
    )
    found = F.coalesce(
        "_bare", *[F.col("_nested")["data"][k] for k in keys], F.col("_listed")["data"],
        *[F.col("_nested")[k] for k in keys], *[F.col("_listed")[k] for k in keys],
    )
    return parsed.select(*keep, F.posexplode(found).alias("pos", "row"))


def network_records(payloads: DataFrame, network: str, synced_at: str | None = None) -> DataFrame:
    """Reflector rows of one network (``payload`` JSON text per document)."""
    rows = envelope_rows(payloads, "payload", ROW)
    t = lambda n: blank_to_null(F.col(f"row.{n}"))
    given = F.coalesce(F.when(~t("designator").isin("true", "false"), t("designator")), t("name"))
    ident = given
    callsign = F.lit(None).cast("string")
    if network == "m17":
        ident = F.when(F.upper(given).startswith("M17-"), given).otherwise(F.concat(F.lit("M17-"), given))
        callsign = ident
    flat = rows.select(
        ident.alias("id"), F.lit(network).alias("network"), F.coalesce(t("name"), ident).alias("name"), callsign.alias("callsign"),
        F.coalesce(t("dns"), t("ipv4"), t("ipv6")).alias("host"), digits_only(F.col("row.port")).alias("port"),
        json_modules(F.col("row.modules")).alias("modules"), t("country").alias("country"), t("sponsor").alias("sponsor"),
        F.coalesce(t("description"), t("extended_description")).alias("description"), t("url").alias("dashboard"),
        F.lit("dvref").alias("source"), F.lit(synced_at).alias("synced_at"), _pos_order().alias("_ord"),
    ).filter("id is not null and host is not null")
    return _directory(flat)


def _pos_order() -> Column:
    return F.struct(F.lit("").alias("path"), F.lit(0).cast("bigint").alias("block"), F.col("pos").cast("bigint").alias("row"))


def json_modules(text: Column) -> Column:
    """Module list written as letters or as objects, to sorted distinct letters."""
    as_text = F.from_json(text, "array<string>")
    obj = "struct<module:string,name:string,designator:string>"

    def letter(item: Column) -> Column:
        o = F.from_json(item, obj)
        return F.when(
            F.ltrim(item).startswith("{"),
            F.coalesce(*[F.nullif(F.trim(o[k]), F.lit("")) for k in ("module", "name", "designator")]),
        ).otherwise(item)

    return module_letters(F.transform(as_text, letter))


def server_records(payloads: DataFrame, synced_at: str | None = None) -> DataFrame:
    """One row per DMR server; the network's fields are inherited."""
    nets = envelope_rows(payloads, "payload", NETWORK).filter(F.trim("row.slug") != "")
    t = lambda c: blank_to_null(F.col(c))
    servers = nets.select(
        t("row.slug").alias("system"), F.coalesce(t("row.sponsor"), t("row.network")).alias("sponsor"),
        t("row.description").alias("description"), t("row.url").alias("dashboard"), t("row.tglist").alias("talkgroups_url"),
        "pos", F.posexplode("row.servers").alias("spos", "s"),
    )
    flat = servers.select(
        t("s.slug").alias("id"), F.lit("dmr").alias("network"), F.coalesce(t("s.server"), t("s.slug")).alias("name"),
        F.coalesce(bare_host(F.col("s.dns")), bare_host(F.col("s.ipv4")), bare_host(F.col("s.ipv6"))).alias("host"),
        digits_only(F.col("s.port")).alias("port"), t("s.country").alias("country"), "sponsor", "description", "dashboard",
        F.lit("dvref").alias("source"), F.lit(synced_at).alias("synced_at"), "system",
        F.array(*[F.lit(x) for x in DMR_REQUIRES]).alias("requires"), "talkgroups_url",
        F.struct(F.lit("").alias("path"), F.col("pos").cast("bigint").alias("block"), F.col("spos").cast("bigint").alias("row")).alias("_ord"),
    ).filter("id is not null")
    return _directory(flat)


def talkgroup_rows(payloads: DataFrame, synced_at: str | None = None) -> DataFrame:
    """``(system, tg, name, synced_at)``; payloads carry ``system``; first row per number.

    The list may sit in ``data.network``, ``data`` or at top level.
    """
    lst = f"talkgroups:array<{TALKGROUP}>"
    text = F.col("payload")
    deep = F.from_json(text, f"struct<data:struct<network:struct<{lst}>,{lst}>,{lst}>")
    bare = F.when(F.substring(F.ltrim(text), 1, 1) == "[", F.from_json(text, f"array<{TALKGROUP}>"))
    found = F.coalesce(bare, deep["data"]["network"]["talkgroups"], deep["data"]["talkgroups"], deep["talkgroups"])
    rows = payloads.select("system", F.posexplode(found).alias("pos", "g")).select(
        "system", digits_only(F.col("g.tg")).alias("tg"), redact_emails(blank_to_null(F.col("g.name"))).alias("name"),
        F.lit(synced_at).alias("synced_at"), "pos",
    ).filter("tg is not null")
    return first_per_key(rows, ["system", "tg"], F.col("pos"), drop=("pos",))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON documents, one per row (API answers of bounded size), with file name."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("payload"), F.regexp_extract("_metadata.file_name", r"^(?:talkgroups-)?(.*)\.json$", 1).alias("system")
    )
