"""Nested JSON documents as ordered lines.

A document for a group could be one ``collect_list``, but then one task holds the whole
group.  Here a document is a sorted set of lines: a head with the envelope, one line
per entry, a tail.  Written through a range partitioning on (document, section, key),
the part files of a document read one after the other are the JSON text, and no task
ever holds more than its own range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.functions.labels import CC_BY, row_license
from regweave.operators.directory import drop_shadowing_aliases, entry, is_cc_by

# --- fixed values --------------------------------------------------------------------
SCHEMA_VERSION = 1
API_VERSION = "v1"
CLIENT_REFRESH_DAYS = 7
LICENSE = "CC BY 4.0"
LICENSE_URL = "https://creativecommons.org/licenses/by/4.0/"
MIXED_LICENSE = "mixed — see per-row license and NOTICE"
# -------------------------------------------------------------------------------------

HEAD, BODY, TAIL = 0, 1, 2
_ONE = "document"  # group column of documents that exist once


def _open(head_struct: Column, list_name: str) -> Column:
    body = F.to_json(head_struct)
    return F.concat(F.substring(body, 1, F.length(body) - 1), F.lit(f',"{list_name}":['))


def _lines(heads: DataFrame, entries: DataFrame, group: str) -> DataFrame:
    """Head, entry and tail lines.  The first entry has no leading comma."""
    if group == _ONE:  # a single document: its first key is a scalar subquery, not a join
        keyed = entries.withColumn("_min", entries.agg(F.min("sort_key")).scalar())
    else:
        keyed = entries.join(entries.groupBy(group).agg(F.min("sort_key").alias("_min")), group)
    body = keyed.select(
        group, F.lit(BODY).alias("section"), "sort_key",
        F.concat(F.when(F.col("sort_key") == F.col("_min"), "").otherwise(","), F.col("json")).alias("line"),
    )
    empty = F.lit(None).cast(entries.schema["sort_key"].dataType).alias("sort_key")
    head = heads.select(group, F.lit(HEAD).alias("section"), empty, F.col("head").alias("line"))
    tail = heads.select(group, F.lit(TAIL).alias("section"), empty, F.lit("]}").alias("line"))
    return head.unionByName(body).unionByName(tail)


def license_columns(all_cc_by: Column, rights: str, url: str) -> list[Column]:
    """File-level licence: plain CC BY only when every row is."""
    return [
        F.when(all_cc_by, LICENSE).otherwise(MIXED_LICENSE).alias("license"),
        F.when(all_cc_by, LICENSE_URL).otherwise(url).alias("license_url"),
        F.when(~all_cc_by, rights).alias("rights"),
    ]


def network_summary(records: DataFrame) -> DataFrame:
    """Per network: rows, newest data date, whether all rows are CC BY."""
    return records.groupBy("network").agg(
        F.count(F.lit(1)).alias("count"), F.max("synced_at").alias("generated"), is_cc_by().alias("all_cc_by")
    )


def network_document(records: DataFrame, credits: DataFrame, today: str, rights: str = "", license_url: str = "",
                     modifications: str = "") -> DataFrame:
    """Lines of one document per network.

    ``credits`` has network, attribution, source_name, source_url.  The date is the
    newest date of the data, so an unchanged network gives unchanged text.
    """
    rows = drop_shadowing_aliases(records)
    licensed = rows.withColumn("license", row_license(F.col("source")))
    heads = network_summary(licensed).join(credits, "network", "left")
    cc = F.col("all_cc_by")
    licence, licence_url, rights_note = license_columns(cc, rights, license_url)
    head = F.struct(
        F.lit(API_VERSION).alias("api_version"), "attribution",
        F.lit(CLIENT_REFRESH_DAYS).alias("client_refresh_days"), "count",
        F.coalesce("generated", F.lit(today)).alias("generated"), licence, licence_url,
        F.lit(modifications or None).cast("string").alias("modifications"), "network", rights_note,
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.struct(F.col("source_name").alias("name"), F.col("source_url").alias("url")).alias("source"),
    )
    entries = licensed.select("network", F.col("id").alias("sort_key"), F.to_json(entry()).alias("json"))
    return _lines(heads.select("network", _open(head, "reflectors").alias("head")), entries, "network")


def combined_document(records: DataFrame, credits: DataFrame, today: str, rights: str = "", license_url: str = "") -> DataFrame:
    """Lines of the one document with every network's entries, ordered by (network, id)."""
    licensed = records.withColumn("license", row_license(F.col("source")))
    summary = network_summary(licensed).join(credits, "network", "left")
    # One row per network from here to the head: the networks are a short fixed list.
    per_net = F.array_sort(F.collect_list(F.struct("network", "count", "attribution", "source_name", "source_url")))
    agg = summary.agg(
        per_net.alias("nets"), F.sum("count").alias("count"), F.max("generated").alias("generated"),
        F.bool_and("all_cc_by").alias("all_cc_by"),
    )
    statements = F.flatten(F.transform("nets", lambda n: F.split(F.coalesce(n["attribution"], F.lit("")), "\n")))
    distinct = F.array_distinct(F.filter(F.transform(statements, F.trim), lambda s: s != ""))
    sources = F.array_distinct(
        F.transform("nets", lambda n: F.struct(n["source_name"].alias("name"), n["source_url"].alias("url")))
    )
    counts = F.map_from_entries(F.transform("nets", lambda n: F.struct(n["network"], n["count"])))
    licence, licence_url, rights_note = license_columns(F.col("all_cc_by"), rights, license_url)
    head = F.struct(
        F.lit(API_VERSION).alias("api_version"), F.array_join(distinct, "\n").alias("attribution"),
        F.lit(CLIENT_REFRESH_DAYS).alias("client_refresh_days"), "count",
        F.coalesce("generated", F.lit(today)).alias("generated"), licence, licence_url,
        counts.alias("networks"), rights_note, F.lit(SCHEMA_VERSION).alias("schema_version"), sources.alias("sources"),
    )
    heads = agg.select(F.lit("all").alias("document"), _open(head, "reflectors").alias("head"))
    entries = licensed.select(
        F.lit("all").alias("document"), F.struct("network", "id").alias("sort_key"), F.to_json(entry()).alias("json")
    )
    return _lines(heads, entries, "document")


def talkgroup_document(rows: DataFrame, today: str) -> DataFrame:
    """Lines of one document per system, talkgroups in number order."""
    heads = rows.groupBy("system").agg(
        F.count(F.lit(1)).alias("count"), F.max("synced_at").alias("generated")
    )
    head = F.struct(
        F.lit(API_VERSION).alias("api_version"), F.lit(CLIENT_REFRESH_DAYS).alias("client_refresh_days"), "count",
        F.coalesce("generated", F.lit(today)).alias("generated"), F.lit(LICENSE).alias("license"),
        F.lit(LICENSE_URL).alias("license_url"), F.lit("dmr").alias("network"),
        F.lit(SCHEMA_VERSION).alias("schema_version"), "system",
    )
    entries = rows.select(
        "system", F.col("tg").alias("sort_key"),
        F.to_json(F.struct(F.nullif("name", F.lit("")).alias("name"), "tg")).alias("json"),
    )
    return _lines(heads.select("system", _open(head, "talkgroups").alias("head")), entries, "system")


def node_document(nodes: DataFrame, generated: str, fetched: str) -> DataFrame:
    """Lines of the node directory document, nodes in number order."""
    total = nodes.agg(F.count(F.lit(1)).alias("count"))
    head = F.struct(
        F.lit(API_VERSION).alias("api_version"), F.lit(CLIENT_REFRESH_DAYS).alias("client_refresh_days"), "count",
        F.lit(generated).alias("generated"), F.lit("none-stated").alias("license"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.array(F.struct(F.lit(fetched).alias("fetched"))).alias("sources"),
    )
    heads = total.select(F.lit("nodes").alias("document"), _open(head, "nodes").alias("head"))
    options = {"ignoreNullFields": "false"}
    entries = nodes.select(
        F.lit("nodes").alias("document"), F.col("node").cast("bigint").alias("sort_key"),
        F.to_json(F.struct("callsign", "description", "location", "node"), options).alias("json"),
    )
    return _lines(heads, entries, "document")


def manifest(records: DataFrame, today: str, talkgroups: DataFrame | None = None) -> DataFrame:
    """One row per network: count, date, licence, expiry hint and mirrored systems.

    ``expires_hint`` and ``total`` describe the whole directory and repeat on each row.
    ``talkgroups`` has system, tg, synced_at, fetched.
    """
    per_net = network_summary(records.withColumn("license", row_license(F.col("source"))))
    out = (
        per_net.withColumn("total", per_net.agg(F.sum("count")).scalar())
        .withColumn("newest", per_net.agg(F.max("generated")).scalar())
        .withColumn("license", F.when(F.col("all_cc_by"), LICENSE).otherwise(MIXED_LICENSE))
        .withColumn("newest", F.coalesce("newest", F.lit(today)))
        .withColumn("expires_hint", F.date_add(F.to_date("newest"), CLIENT_REFRESH_DAYS).cast("string"))
        .drop("all_cc_by")
    )
    if talkgroups is not None:
        mirrored = talkgroups.agg(F.count_distinct("system").alias("mirrored_systems")).withColumn("network", F.lit("dmr"))
        out = out.join(mirrored, "network", "left")
    return out


def manifest_talkgroups(talkgroups: DataFrame) -> DataFrame:
    """Mirror map of the manifest as rows: url, count, content date, fetch date."""
    return talkgroups.groupBy("system").agg(
        F.count(F.lit(1)).alias("count"), F.max("synced_at").alias("generated"), F.max("fetched").alias("_fetched")
    ).select(
        "system", F.concat(F.lit("reflectors/dmr/"), "system", F.lit("/talkgroups.json")).alias("url"), "count",
        "generated", F.coalesce("_fetched", "generated").alias("fetched"),
    )


def rows_from_documents(lines: DataFrame) -> DataFrame:
    """Entry lines of network documents back to directory rows (dial fields lifted)."""
    from regweave.schemas import REFLECTOR, conform

    dial_type = (
        "struct<callsign:string,host:string,kind:string,modules:array<string>,port:bigint,requires:array<string>,"
        "system:string,talkgroup:bigint,talkgroups_url:string,timeslot:bigint>"
    )
    schema = (
        "aliases array<string>, alias_source string, country string, dashboard string, description string,"
        f" dial {dial_type}, id string, license string, name string, network string, source string,"
        " sponsor string, system string, talkgroups string"
    )
    body = lines.filter(F.col("section") == BODY).select(
        F.from_json(F.regexp_replace("line", "^,", ""), schema).alias("e"), *[c for c in ("generated",) if c in lines.columns]
    )
    flat = body.filter("e.id is not null").select("e.*", *[c for c in ("generated",) if c in lines.columns])
    lifted = ("callsign", "host", "port", "modules", "requires", "talkgroups_url", "talkgroup", "timeslot")
    out = flat
    for name in lifted:
        out = out.withColumn(name, F.col("dial")[name])
    out = out.withColumn("system", F.coalesce("system", F.col("dial")["system"]))
    for name in ("aliases", "modules", "requires"):
        out = out.withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    if "generated" in out.columns:
        out = out.withColumn("synced_at", F.col("generated"))
    return conform(out, REFLECTOR)


def talkgroups_from_documents(lines: DataFrame) -> DataFrame:
    """Entry lines of talkgroup documents (with ``system`` and ``generated``) to rows."""
    from regweave.schemas import TALKGROUP, conform

    stamp = F.col("generated") if "generated" in lines.columns else F.lit(None).cast("string")
    body = lines.filter(F.col("section") == BODY).select(
        "system", stamp.alias("synced_at"), F.from_json(F.regexp_replace("line", "^,", ""), "tg bigint, name string").alias("e")
    )
    return conform(body.select("system", "e.*", "synced_at").filter("tg is not null and system <> ''"), TALKGROUP)


def node_document_dates(previous: DataFrame, fresh: DataFrame, generated: str, fetched: str, today: str) -> tuple[str, str]:
    """Dates of a new node document: the old ones when no node row differs."""
    from regweave.operators.guards import changed_groups

    columns = ["callsign", "description", "location"]
    same = changed_groups(previous, fresh, "node", columns).isEmpty()
    return (generated, fetched) if same else (today, today)


__all__ = ["CC_BY", "network_document", "combined_document", "talkgroup_document", "node_document", "manifest",
           "manifest_talkgroups", "rows_from_documents", "network_summary"]
