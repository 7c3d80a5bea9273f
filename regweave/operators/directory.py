"""Multi-source directory: address anti-joins, aliases, entries and their licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.functions.dates import literal_map
from regweave.functions.labels import CC_BY, row_license
from regweave.functions.text import redact_emails

# --- fixed values --------------------------------------------------------------------
ALIAS_SHAPE = r"^(?:REF|DCS)[0-9A-Z]{3}$"
ALIAS_SOURCE = "pistar"
HOST_NAME_SHAPE = r"^XRF[0-9A-Z]{3}$"
DIAL_KINDS = {"dstar": "dextra", "m17": "m17", "ysf": "ysf", "nxdn": "nxdn", "p25": "p25",
              "urf": "urf", "dmr": "mmdvm"}
DIAL_FIELDS = {"dextra": ("callsign", "modules"), "m17": ("callsign", "modules"), "ysf": (),
               "nxdn": (), "p25": (), "urf": ("modules",),
               "mmdvm": ("system", "requires", "talkgroups_url", "talkgroup", "timeslot")}
PORT_OPTIONAL_KINDS = ("urf",)
ENVELOPE_FIELDS = ("network", "system", "talkgroups", "id", "name", "aliases", "description",
                   "country", "sponsor", "dashboard", "source", "license", "alias_source")
REDACTED_FIELDS = ("name", "sponsor", "description")
DEXTRA_PORT = 30001
STALE_AFTER_DAYS = 30
# -------------------------------------------------------------------------------------


def sanitise(records: DataFrame) -> DataFrame:
    """E-mail redaction of the free-text fields and the licence derived from the source."""
    out = records
    for name in REDACTED_FIELDS:
        out = out.withColumn(name, redact_emails(F.col(name)))
    return out.withColumn("license", row_license(F.col("source")))


def drop_stale(records: DataFrame, last_contact: str, now_epoch: int | Column) -> DataFrame:
    """Rows not heard of for 30 days leave; an unknown last contact stays."""
    now = F.lit(now_epoch) if isinstance(now_epoch, int) else now_epoch
    cutoff = now - STALE_AFTER_DAYS * 86400
    return records.filter(F.col(last_contact).isNull() | (F.col(last_contact) >= cutoff))


def without_known_hosts(records: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows whose address no listed row has; rows without an address are left out."""
    hosts = listed.filter("host is not null").select("host").distinct()
    return records.filter("host <> ''").join(hosts, "host", "left_anti").select(*records.columns)


def attach_aliases(records: DataFrame, names: DataFrame) -> DataFrame:
    """Append the names known for a row's address to its aliases.

    ``names`` has ``host, name, _ord``.  Refused: a name that is any row's id, a name the
    row already has, rows without an address.  The name shape allows fewer than 94,000
    distinct names, which bounds every list.
    """
    ids = records.select(F.upper("id").alias("name")).distinct()
    usable = names.filter(F.col("name").rlike(ALIAS_SHAPE) & (F.col("host") != ""))
    once = usable.groupBy("host", "name").agg(F.min("_ord").alias("_ord")).join(ids, "name", "left_anti")
    lists = once.groupBy("host").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_ord", "name"))), lambda x: x["name"]).alias("_names")
    ).withColumnRenamed("host", "_host")
    own = F.transform(
        F.concat(F.coalesce("aliases", F.array().cast("array<string>")), F.array_compact(F.array("id", "name", "callsign"))),
        lambda a: F.upper(a),
    )
    added = F.array_except(F.coalesce("_names", F.array().cast("array<string>")), own)
    # Rows without an address get a key of their own, so that they do not pile up in one
    # shuffle partition.
    key = F.coalesce(records["host"], F.concat(F.lit("\x00"), records["id"]))
    joined = records.join(lists, key == F.col("_host"), "left").withColumn("_new", added)
    return (
        joined.withColumn("aliases", F.concat(F.coalesce("aliases", F.array().cast("array<string>")), F.col("_new")))
        .withColumn("alias_source", F.when(F.size("_new") > 0, F.lit(ALIAS_SOURCE)).otherwise(F.col("alias_source")))
        .select(*records.columns)
    )


def shadowed_aliases(records: DataFrame) -> DataFrame:
    """``(network, id, alias)`` for each alias that is another row's id in its network."""
    ids = records.select("network", F.upper("id").alias("_u")).distinct()
    exploded = records.select("network", "id", F.explode("aliases").alias("alias")).filter(
        F.upper("alias") != F.upper("id")
    )
    return exploded.withColumn("_u", F.upper("alias")).join(ids, ["network", "_u"], "left_semi").select(
        "network", "id", "alias"
    )


def drop_shadowing_aliases(records: DataFrame) -> DataFrame:
    """Remove shadowed aliases; only the rows that have one are regrouped."""
    bad = shadowed_aliases(records).groupBy("network", "id").agg(F.collect_set("alias").alias("_bad"))
    joined = records.join(bad, ["network", "id"], "left")
    kept = F.filter("aliases", lambda a: ~F.array_contains(F.coalesce("_bad", F.array().cast("array<string>")), a))
    return joined.withColumn("aliases", kept).select(*records.columns)


def systems_with_servers(records: DataFrame) -> DataFrame:
    """Distinct systems that have a server row."""
    return records.filter("system <> ''").select("system").distinct()


def link_mirrors(servers: DataFrame, mirrored: DataFrame) -> DataFrame:
    """Set the mirror path on server rows whose system has a mirrored list."""
    systems = mirrored.select(F.col("system").alias("_s")).distinct()
    key = F.coalesce(servers["system"], F.concat(F.lit("\x00"), servers["id"]))
    path = F.concat(F.lit("reflectors/dmr/"), F.col("system"), F.lit("/talkgroups.json"))
    return servers.join(systems, key == F.col("_s"), "left").withColumn(
        "talkgroups", F.when(F.col("_s").isNotNull(), path).otherwise(F.col("talkgroups"))
    ).select(*servers.columns)


def _present(name: str, value: Column, is_list: bool) -> Column:
    kept = F.when(F.size(value) > 0, value) if is_list else F.nullif(value.cast("string"), F.lit(""))
    return kept.alias(name)


def dial_kind(network: Column) -> Column:
    """Dial kind of a network; an unmapped network is its own kind."""
    return F.coalesce(F.try_element_at(literal_map(DIAL_KINDS), network), network)


def dial() -> Column:
    """Dial struct of a directory row, null when the row cannot be dialled."""
    kind = dial_kind(F.col("network"))
    ready = (F.col("host") != "") & (F.col("port").isNotNull() | kind.isin(*PORT_OPTIONAL_KINDS))

    def when_used(name: str) -> Column:
        users = [k for k, names in DIAL_FIELDS.items() if name in names]
        value = F.col(name)
        if name in ("modules", "requires"):
            value = F.when(F.size(value) > 0, value)
        elif name in ("talkgroup", "timeslot"):
            pass
        else:
            value = F.nullif(value, F.lit(""))
        return F.when(kind.isin(*users), value).alias(name)

    # Alphabetical fields: the JSON writer keeps this order and leaves nulls out.
    return F.when(
        ready,
        F.struct(
            when_used("callsign"), F.col("host"), kind.alias("kind"), when_used("modules"), F.col("port"),
            when_used("requires"), when_used("system"), when_used("talkgroup"),
            when_used("talkgroups_url"), when_used("timeslot"),
        ),
    )


def entry() -> Column:
    """Published entry: envelope fields that have a value, the name falling back to the
    id, plus ``dial``."""
    fields = {}
    for name in ENVELOPE_FIELDS:
        value = F.col(name)
        if name == "name":
            value = F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("id"))
        fields[name] = _present(name, value, name == "aliases")
    fields["dial"] = dial().alias("dial")
    return F.struct(*[fields[n] for n in sorted(fields)])


def relabel(records: DataFrame) -> DataFrame:
    """Licences and alias provenance of kept rows, as a fresh build would set them."""
    known = F.exists("aliases", lambda a: a.rlike(ALIAS_SHAPE))
    return records.withColumn("license", row_license(F.col("source"))).withColumn(
        "alias_source", F.coalesce("alias_source", F.when(known, F.lit(ALIAS_SOURCE)))
    )


def is_cc_by() -> Column:
    """Aggregate: every row of the group is CC BY."""
    return F.coalesce(F.bool_and(F.col("license") == CC_BY), F.lit(True))


def search(records: DataFrame, term: str) -> DataFrame:
    """Case-insensitive substring search over id, name, aliases, description, country
    and sponsor."""
    fields = F.concat(
        F.array("id", "name", "description", "country", "sponsor"),
        F.coalesce("aliases", F.array().cast("array<string>")),
    )
    return records.filter(F.exists(fields, lambda f: F.coalesce(F.contains(F.lower(f), F.lit(term.lower())), F.lit(False))))
