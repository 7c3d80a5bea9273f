"""Directory queries: rows are built from part, customer and supplier with derived hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.functions.labels import row_license, wire_name
from regweave.operators.dedupe import merge_by_priority
from regweave.operators.directory import (
    attach_aliases, drop_shadowing_aliases, drop_stale, entry, link_mirrors, relabel, sanitise, search,
    shadowed_aliases, systems_with_servers, without_known_hosts,
)
from regweave.operators.documents import (
    combined_document, manifest, manifest_talkgroups, network_document, node_document, rows_from_documents,
    talkgroup_document,
)
from regweave.operators.guards import (
    changed_groups, content_dates, count_within_slack, decide, fold_fetches, keep_last_good, lost_sources, network_gate,
    node_gate, rejected_gate, source_counts, stalest_slice,
)
from regweave.plans.catalog import Tables, query
from regweave.plans.inputs import iso_day
from regweave.schemas import REFLECTOR, conform
from regweave.sources.base import table_order

REGISTRY_SQL = """
reg AS (SELECT p_partkey AS k, 'XLX' || to_base(p_partkey, 36, 3) AS id, 'h' || (p_partkey * 7) AS host, p_name AS name,
   CASE WHEN length(to_base(p_partkey, 36, 3)) = 3 THEN 'XRF' || to_base(p_partkey, 36, 3) END AS wire FROM part)"""
HOSTS_SQL = """
hst AS (SELECT id, host FROM (SELECT 'XRF' || to_base(c_custkey // 2, 36, 3) AS id, 'h' || (c_custkey * 3) AS host,
   row_number() OVER (PARTITION BY c_custkey // 2 ORDER BY c_custkey) AS rn FROM customer
   WHERE 'h' || (c_custkey * 3) NOT IN (SELECT host FROM reg)) WHERE rn = 1)"""


def suffix(key: Column) -> Column:
    """A key in digits and letters, three characters at least: the name space of reflectors."""
    text = F.conv(key.cast("string"), 10, 36)
    return F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(text)


def registry(t: Tables) -> DataFrame:
    """Part as the registry: ids with a derived wire name as alias."""
    k = F.col("p_partkey")
    ident = F.concat(F.lit("XLX"), suffix(k))
    wire = wire_name(ident)
    rows = t.part.select(
        ident.alias("id"), F.lit("dstar").alias("network"), F.col("p_name").alias("name"),
        F.when(wire.isNotNull(), F.array(wire)).otherwise(F.array().cast("array<string>")).alias("aliases"), wire.alias("callsign"),
        F.concat(F.lit("h"), k * 7).alias("host"), F.lit(30001).cast("bigint").alias("port"), F.lit("xlx").alias("source"),
        F.lit("2024-01-05").alias("synced_at"),
    )
    return conform(sanitise(rows.withColumn("sponsor", F.lit(None).cast("string")).withColumn("description", F.lit(None).cast("string"))), REFLECTOR)


def standalone(t: Tables) -> DataFrame:
    """Customers as host-file rows, with their order."""
    k = F.col("c_custkey")
    name = F.concat(F.lit("XRF"), suffix(F.floor(k / 2)))
    rows = t.customer.select(
        name.alias("id"), F.lit("dstar").alias("network"), name.alias("name"), name.alias("callsign"), F.concat(F.lit("h"), k * 3).alias("host"),
        F.lit(30001).cast("bigint").alias("port"), F.lit("dextra").alias("source"), F.lit("2024-01-06").alias("synced_at"), table_order("c_custkey"),
    )
    out = rows.withColumn("license", row_license(F.col("source")))
    order = out.select("id", "host", "_ord")
    return conform(out, REFLECTOR).join(order, ["id", "host"])


def alias_names(t: Tables) -> DataFrame:
    """Suppliers as host-file names of two name spaces and a refused one."""
    k = F.col("s_suppkey")
    number = suffix(k)
    names = F.array(F.concat(F.lit("DCS"), number), F.concat(F.lit("REF"), number), F.concat(F.lit("DB0"), number), F.concat(F.lit("XLX"), number))
    return t.supplier.select(
        F.concat(F.lit("h"), F.floor(k / 3) * 7).alias("host"), F.posexplode(names).alias("pos", "name"), k.alias("k")
    ).select("host", "name", F.struct("k", "pos").alias("_ord"))


@query("anti_address", f"WITH {REGISTRY_SQL} SELECT c_custkey, 'h' || (c_custkey * 3) AS host FROM customer WHERE 'h' || (c_custkey * 3) NOT IN (SELECT host FROM reg)")
def anti_address(t: Tables) -> DataFrame:
    """Rows whose address is already listed are dropped."""
    rows = t.customer.select("c_custkey", F.concat(F.lit("h"), F.col("c_custkey") * 3).alias("host"))
    return without_known_hosts(rows, registry(t))


def _merged(t: Tables) -> DataFrame:
    reg = registry(t).withColumn("_ord", table_order("port"))
    return conform(merge_by_priority([reg, without_known_hosts(standalone(t), reg)], "id"), REFLECTOR)


@query("priority_union", f"""WITH {REGISTRY_SQL}, {HOSTS_SQL}
SELECT id, host, 'xlx' AS source FROM reg UNION ALL SELECT id, host, 'dextra' FROM hst WHERE id NOT IN (SELECT id FROM reg)""")
def priority_union(t: Tables) -> DataFrame:
    """The first group that lists an id wins."""
    return _merged(t).select("id", "host", "source")


ALIAS_SQL = """
nm AS (SELECT 'h' || (s_suppkey // 3 * 7) AS host, s_suppkey AS k, to_base(s_suppkey, 36, 3) AS d FROM supplier
   WHERE length(to_base(s_suppkey, 36, 3)) = 3),
al AS (SELECT host, min(k * 10 + j) AS o, name FROM (
   SELECT host, k, 0 AS j, 'DCS' || d AS name FROM nm UNION ALL SELECT host, k, 1, 'REF' || d FROM nm) GROUP BY host, name),
lists AS (SELECT host, list(name ORDER BY o) AS names FROM al GROUP BY 1)"""


@query("alias_attach", f"""WITH {REGISTRY_SQL}, {ALIAS_SQL}
SELECT id, array_to_string(list_concat(CASE WHEN wire IS NULL THEN [] ELSE [wire] END, coalesce(names, [])), ',') AS aliases,
       CASE WHEN names IS NOT NULL THEN 'pistar' END AS alias_source FROM reg LEFT JOIN lists USING (host)""")
def alias_attach(t: Tables) -> DataFrame:
    """Other names of an address are appended in order, with their provenance."""
    return attach_aliases(registry(t), alias_names(t)).select("id", F.array_join("aliases", ",").alias("aliases"), "alias_source")


@query("alias_shadow", f"""WITH {REGISTRY_SQL}, {HOSTS_SQL}
SELECT id, CASE WHEN wire IS NOT NULL AND wire NOT IN (SELECT id FROM hst) THEN wire ELSE '' END AS aliases,
       CASE WHEN wire IN (SELECT id FROM hst) THEN 1 ELSE 0 END::BIGINT AS dropped FROM reg""")
def alias_shadow(t: Tables) -> DataFrame:
    """An alias that is another row's id goes; the id wins."""
    rows = _merged(t)
    counts = shadowed_aliases(rows).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    kept = drop_shadowing_aliases(rows).filter("source = 'xlx'")
    return kept.join(counts, "id", "left").select("id", F.array_join("aliases", ",").alias("aliases"), F.coalesce("n", F.lit(0)).cast("bigint").alias("dropped"))


@query("mirror_link", """
SELECT 's' || c_custkey AS id, CASE WHEN c_nationkey IN (SELECT s_nationkey FROM supplier) THEN 'reflectors/dmr/net-' || c_nationkey || '/talkgroups.json' END AS talkgroups
FROM customer""")
def mirror_link(t: Tables) -> DataFrame:
    """Server rows link to the mirror of their system where one exists."""
    servers = t.customer.select(F.concat(F.lit("s"), "c_custkey").alias("id"), F.concat(F.lit("net-"), "c_nationkey").alias("system"), F.lit(None).cast("string").alias("talkgroups"))
    mirrored = t.supplier.select(F.concat(F.lit("net-"), "s_nationkey").alias("system"))
    return link_mirrors(servers, mirrored).select("id", "talkgroups")


def directory(t: Tables) -> DataFrame:
    """Part rows spread over networks, with missing hosts, ports and names."""
    k = F.col("p_partkey")
    nets = F.array(*[F.lit(n) for n in ("dstar", "m17", "ysf", "urf", "dmr", "zzz")])
    rows = t.part.select(
        F.format_string("P%08d", k).alias("id"), F.element_at(nets, (k % 6 + 1).cast("int")).alias("network"),
        F.when(k % 4 != 0, F.col("p_name")).alias("name"),
        F.when(k % 5 == 0, F.array(F.lit("REF001"))).otherwise(F.array().cast("array<string>")).alias("aliases"),
        F.concat(F.lit("C"), k).alias("callsign"), F.when(k % 7 != 0, F.concat(F.lit("h"), k)).alias("host"),
        F.when(k % 3 != 0, F.lit(1000) + k).alias("port"), F.array(F.lit("A"), F.lit("B")).alias("modules"),
        F.when(k % 9 == 0, "").otherwise(F.col("p_type")).alias("country"), F.lit(None).cast("string").alias("sponsor"),
        F.when(k % 8 == 0, F.concat(F.lit("mail x"), k, F.lit("@ex.org now"))).alias("description"),
        F.when(k % 2 == 0, "dvref").when(k % 6 == 1, "dvref").otherwise("xlx").alias("source"),
        F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0")).alias("synced_at"),
        F.when(k % 6 == 4, F.concat(F.lit("net-"), k % 10)).alias("system"),
        F.when(k % 6 == 4, F.array(F.lit("dmr_id"), F.lit("password"))).otherwise(F.array().cast("array<string>")).alias("requires"),
    )
    return conform(sanitise(rows), REFLECTOR)


DIR_SQL = """
d AS (SELECT p_partkey AS k, 'P' || lpad(p_partkey::VARCHAR, 8, '0') AS id, ['dstar', 'm17', 'ysf', 'urf', 'dmr', 'zzz'][(p_partkey % 6 + 1)::INT] AS network,
  CASE WHEN p_partkey % 4 <> 0 THEN p_name END AS name, CASE WHEN p_partkey % 7 <> 0 THEN 'h' || p_partkey END AS host,
  CASE WHEN p_partkey % 3 <> 0 THEN 1000 + p_partkey END AS port, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE p_type END AS country,
  CASE WHEN p_partkey % 8 = 0 THEN 'mail [email removed] now' END AS description,
  CASE WHEN p_partkey % 2 = 0 OR p_partkey % 6 = 1 THEN 'dvref' ELSE 'xlx' END AS source,
  '2024-01-' || lpad((p_partkey % 28 + 1)::VARCHAR, 2, '0') AS synced_at, CASE WHEN p_partkey % 6 = 4 THEN 'net-' || (p_partkey % 10) END AS system FROM part),
e AS (SELECT *, CASE network WHEN 'dstar' THEN 'dextra' WHEN 'dmr' THEN 'mmdvm' ELSE network END AS kind,
  CASE source WHEN 'dvref' THEN 'CC-BY-4.0' ELSE 'none-stated' END AS license FROM d),
j AS (SELECT *, host IS NOT NULL AND (port IS NOT NULL OR kind = 'urf') AS dialable FROM e),
js AS (SELECT *, '{' || concat_ws(',', CASE WHEN k % 5 = 0 THEN '"aliases":["REF001"]' END, '"country":"' || nullif(country, '') || '"',
  '"description":"' || description || '"', CASE WHEN dialable THEN '"dial":{' || concat_ws(',',
     CASE WHEN kind IN ('dextra', 'm17') THEN '"callsign":"C' || k || '"' END, '"host":"' || host || '"', '"kind":"' || kind || '"',
     CASE WHEN kind IN ('dextra', 'm17', 'urf') THEN '"modules":["A","B"]' END, '"port":' || port,
     CASE WHEN kind = 'mmdvm' THEN '"requires":["dmr_id","password"]' END, CASE WHEN kind = 'mmdvm' THEN '"system":"' || system || '"' END) || '}' END,
  '"id":"' || id || '"', '"license":"' || license || '"', '"name":"' || coalesce(name, id) || '"', '"network":"' || network || '"',
  '"source":"' || source || '"', '"system":"' || system || '"') || '}' AS json FROM j)"""


@query("entry_json", f"WITH {DIR_SQL} SELECT id, json FROM js")
def entry_json(t: Tables) -> DataFrame:
    """Published entry as JSON: envelope plus discriminated dial, empty values left out."""
    return directory(t).select("id", F.to_json(entry()).alias("json"))


def _credits(t: Tables) -> DataFrame:
    return directory(t).select("network").distinct().select(
        "network", F.when(F.col("network") == "dstar", F.lit("XLX registry\nShared")).otherwise(F.lit("Shared")).alias("attribution"),
        F.lit("DIR").alias("source_name"), F.lit("https://example.org/").alias("source_url"),
    )


_CREDIT_SQL = "CASE network WHEN 'dstar' THEN 'XLX registry\\nShared' ELSE 'Shared' END"
_MIXED = "mixed — see per-row license and NOTICE"
_HEAD_SQL = f"""'{{"api_version":"v1","attribution":"' || {_CREDIT_SQL} || '","client_refresh_days":7,"count":' || n || ',"generated":"' || g
  || '","license":"' || CASE WHEN cc THEN 'CC BY 4.0","license_url":"https://creativecommons.org/licenses/by/4.0/' ELSE '{_MIXED}","license_url":"u' END
  || '","network":"' || network || CASE WHEN cc THEN '"' ELSE '","rights":"r"' END
  || ',"schema_version":1,"source":{{"name":"DIR","url":"https://example.org/"}},"reflectors":['"""


@query("network_doc", f"""WITH {DIR_SQL},
g AS (SELECT network, count(*) AS n, max(synced_at) AS g, bool_and(license = 'CC-BY-4.0') AS cc FROM j GROUP BY 1)
SELECT network, 0::BIGINT AS section, '' AS sort_key, {_HEAD_SQL} AS line FROM g
UNION ALL SELECT network, 1, id, CASE WHEN id = min(id) OVER (PARTITION BY network) THEN '' ELSE ',' END || json FROM js
UNION ALL SELECT network, 2, '', ']}}' FROM g""")
def network_doc(t: Tables) -> DataFrame:
    """One nested document per network as ordered lines."""
    lines = network_document(directory(t), _credits(t), "2024-02-01", rights="r", license_url="u")
    return lines.select("network", F.col("section").cast("bigint").alias("section"), F.coalesce("sort_key", F.lit("")).alias("sort_key"), "line")


@query("combined_doc", f"""WITH {DIR_SQL}
SELECT 1::BIGINT AS section, network || '/' || id AS sort_key, CASE WHEN row_number() OVER (ORDER BY network, id) = 1 THEN '' ELSE ',' END || json AS line FROM js
UNION ALL SELECT 2, '', ']}}'
UNION ALL SELECT 0, '', '{{"api_version":"v1","attribution":"' || (SELECT string_agg(s, '\\n' ORDER BY o) FROM (
    SELECT s, min(network || i) AS o FROM (SELECT network, unnest(['XLX registry', 'Shared']) AS s, unnest([0, 1]) AS i FROM (SELECT DISTINCT network FROM d))
    WHERE s = 'Shared' OR network = 'dstar' GROUP BY s)) || '","client_refresh_days":7,"count":' || (SELECT count(*) FROM d)
  || ',"generated":"' || (SELECT max(synced_at) FROM d) || '","license":"{_MIXED}","license_url":"u","networks":{{'
  || (SELECT string_agg('"' || network || '":' || n, ',' ORDER BY network) FROM (SELECT network, count(*) AS n FROM d GROUP BY 1))
  || '}},"rights":"r","schema_version":1,"sources":[{{"name":"DIR","url":"https://example.org/"}}],"reflectors":['""")
def combined_doc(t: Tables) -> DataFrame:
    """All networks in one document, ordered by (network, id)."""
    lines = combined_document(directory(t), _credits(t), "2024-02-01", rights="r", license_url="u")
    key = F.coalesce(F.concat("sort_key.network", F.lit("/"), "sort_key.id"), F.lit(""))
    return lines.select(F.col("section").cast("bigint").alias("section"), key.alias("sort_key"), "line")


@query("document_rows", f"WITH {DIR_SQL} SELECT id, network, coalesce(name, id) AS name, CASE WHEN dialable THEN host END AS host, CASE WHEN dialable THEN port END::BIGINT AS port, source, license, system FROM j")
def document_rows(t: Tables) -> DataFrame:
    """Published lines read back into rows."""
    lines = network_document(directory(t), _credits(t), "2024-02-01")
    return rows_from_documents(lines).select("id", "network", "name", "host", "port", "source", "license", "system")


@query("manifest", f"""WITH {DIR_SQL}, g AS (SELECT network, count(*) AS count, max(synced_at) AS generated, bool_and(license = 'CC-BY-4.0') AS cc FROM j GROUP BY 1)
SELECT network, count, generated, CASE WHEN cc THEN 'CC BY 4.0' ELSE '{_MIXED}' END AS license, (SELECT count(*) FROM d) AS total,
  (SELECT max(generated) FROM g) AS newest, strftime((SELECT max(generated) FROM g)::DATE + 7, '%Y-%m-%d') AS expires_hint FROM g""")
def manifest_query(t: Tables) -> DataFrame:
    """Per-network summary with the whole directory's count and dates."""
    return manifest(directory(t), "2024-02-01")


def _talkgroups(t: Tables) -> DataFrame:
    return t.part.select(
        F.concat(F.lit("net-"), F.col("p_partkey") % 20).alias("system"), F.col("p_partkey").alias("tg"),
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_name")).alias("name"), F.lit("2024-01-09").alias("synced_at"),
        F.when(F.col("p_partkey") % 20 < 10, "2024-01-20").alias("fetched"),
    )


@query("talkgroup_doc", """
WITH g AS (SELECT 'net-' || (p_partkey % 20) AS system, p_partkey AS tg, CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS name FROM part)
SELECT system, 1::BIGINT AS section, tg, CASE WHEN tg = min(tg) OVER (PARTITION BY system) THEN '' ELSE ',' END || '{' || concat_ws(',', '"name":"' || name || '"', '"tg":' || tg) || '}' AS line FROM g
UNION ALL SELECT system, 0, -1, '{"api_version":"v1","client_refresh_days":7,"count":' || count(*) || ',"generated":"2024-01-09","license":"CC BY 4.0","license_url":"https://creativecommons.org/licenses/by/4.0/","network":"dmr","schema_version":1,"system":"' || system || '","talkgroups":[' FROM g GROUP BY system
UNION ALL SELECT DISTINCT system, 2, -1, ']}' FROM g""")
def talkgroup_doc(t: Tables) -> DataFrame:
    """One talkgroup document per system."""
    lines = talkgroup_document(_talkgroups(t), "2024-02-01")
    return lines.select("system", F.col("section").cast("bigint").alias("section"), F.coalesce("sort_key", F.lit(-1)).cast("bigint").alias("tg"), "line")


@query("manifest_talkgroups", """
SELECT 'net-' || s AS system, 'reflectors/dmr/net-' || s || '/talkgroups.json' AS url, count(*) AS count, '2024-01-09' AS generated,
       CASE WHEN s < 10 THEN '2024-01-20' ELSE '2024-01-09' END AS fetched FROM (SELECT p_partkey % 20 AS s FROM part) GROUP BY s""")
def manifest_talkgroups_query(t: Tables) -> DataFrame:
    """Mirror map of the manifest."""
    return manifest_talkgroups(_talkgroups(t))


@query("node_doc", """
SELECT 1::BIGINT AS section, o_orderkey AS node, CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders) THEN '' ELSE ',' END
  || '{"callsign":"K' || o_custkey || '","description":null,"location":"' || o_orderpriority || '","node":"' || o_orderkey || '"}' AS line FROM orders
UNION ALL SELECT 0, -1, '{"api_version":"v1","client_refresh_days":7,"count":' || count(*) || ',"generated":"2024-01-01","license":"none-stated","schema_version":1,"sources":[{"fetched":"2024-01-02"}],"nodes":[' FROM orders
UNION ALL SELECT 2, -1, ']}'""")
def node_doc(t: Tables) -> DataFrame:
    """Node directory document."""
    nodes = t.orders.select(F.col("o_orderkey").cast("string").alias("node"), F.concat(F.lit("K"), "o_custkey").alias("callsign"),
                            F.lit(None).cast("string").alias("description"), F.col("o_orderpriority").alias("location"))
    lines = node_document(nodes, "2024-01-01", "2024-01-02")
    return lines.select(F.col("section").cast("bigint").alias("section"), F.coalesce("sort_key", F.lit(-1)).cast("bigint").alias("node"), "line")


@query("relabel", f"""WITH {DIR_SQL} SELECT id, license, CASE WHEN k % 5 = 0 THEN 'pistar' END AS alias_source FROM j""")
def relabel_query(t: Tables) -> DataFrame:
    """Kept rows labelled as a fresh build would."""
    old = directory(t).withColumn("license", F.lit("CC-BY-4.0"))
    return relabel(old).select("id", "license", "alias_source")


@query("license_filter", f"WITH {DIR_SQL} SELECT id, network FROM j WHERE license = 'CC-BY-4.0'")
def license_filter(t: Tables) -> DataFrame:
    """Rows of one licence."""
    return directory(t).filter("license = 'CC-BY-4.0'").select("id", "network")


@query("systems_with_servers", f"WITH {DIR_SQL} SELECT DISTINCT system FROM j WHERE system IS NOT NULL")
def systems_with_servers_query(t: Tables) -> DataFrame:
    """Systems worth a refetch."""
    return systems_with_servers(directory(t))


@query("text_search", f"""WITH {DIR_SQL} SELECT id FROM j WHERE contains(lower(id), 'ref001') OR contains(lower(coalesce(name, '')), 'bolt')
  OR contains(lower(country), 'bolt') OR contains(lower(coalesce(description, '')), 'bolt')""")
def text_search(t: Tables) -> DataFrame:
    """Case-insensitive substring search."""
    return search(directory(t), "BOLT").select("id")


@query("stale_filter", """
SELECT event_id FROM events WHERE event_type = 'view' OR epoch(date_trunc('second', ts))::BIGINT >= (SELECT max(epoch(date_trunc('second', ts))::BIGINT) FROM events) - 30 * 86400 + 10 * 86400""")
def stale_filter(t: Tables) -> DataFrame:
    """Rows not heard of for 30 days leave; unknown last contact stays."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    rows = t.events.select("event_id", seconds.alias("s"), F.when(F.col("event_type") != "view", seconds).alias("last"))
    return drop_stale(rows, "last", rows.agg(F.max("s")).scalar() + 10 * 86400).select("event_id")


# --- guards: two half-months of events as previous and fresh build ------------------------------

PERIOD_SQL = """
ev AS (SELECT event_id, user_id, event_type AS network, CASE WHEN user_id % 10 = 0 AND event_type = 'error' THEN 'dextra' WHEN user_id % 2 = 0 THEN 'xlx' ELSE 'dvref' END AS source,
   strftime(ts, '%Y-%m-%d') AS day, value FROM events),
prev AS (SELECT * FROM ev WHERE day < '2024-01-15'),
fresh AS (SELECT event_id, user_id, CASE WHEN network = 'view' OR (network = 'click' AND day > '2024-01-19') THEN 'purchase' ELSE network END AS network,
   CASE WHEN source = 'dextra' THEN 'xlx' ELSE source END AS source, day, value FROM ev WHERE day >= '2024-01-15'),
pc AS (SELECT network, source, count(*) AS n FROM prev GROUP BY 1, 2), fc AS (SELECT network, source, count(*) AS n FROM fresh GROUP BY 1, 2),
lost AS (SELECT network, source FROM pc WHERE network IN (SELECT network FROM fc) AND (network, source) NOT IN (SELECT (network, source) FROM fc)),
b AS (SELECT coalesce(p.network, f.network) AS network, coalesce(p.n, 0) AS previous, coalesce(f.n, 0) AS fresh,
   CASE WHEN f.n IS NULL THEN 'not fetched' WHEN coalesce(p.network, f.network) IN (SELECT network FROM lost) THEN 'lost source'
        WHEN p.n > 0 AND f.n < p.n * 0.66 THEN 'shrunk' ELSE '' END AS reason
   FROM (SELECT network, sum(n) AS n FROM pc GROUP BY 1) p FULL JOIN (SELECT network, sum(n) AS n FROM fc GROUP BY 1) f ON p.network = f.network)"""


def _periods(t: Tables) -> tuple[DataFrame, DataFrame]:
    source = F.when((F.col("user_id") % 10 == 0) & (F.col("event_type") == "error"), "dextra").when(F.col("user_id") % 2 == 0, "xlx").otherwise("dvref")
    ev = t.events.select("event_id", "user_id", F.col("event_type").alias("network"), source.alias("source"), iso_day("ts").alias("day"), "value")
    prev = ev.filter("day < '2024-01-15'")
    # Rows that changed their network or source leave some without rows, or with too few.
    moved = (F.col("network") == "view") | ((F.col("network") == "click") & (F.col("day") > "2024-01-19"))
    fresh = ev.filter("day >= '2024-01-15'").withColumn("network", F.when(moved, "purchase").otherwise(F.col("network"))).withColumn(
        "source", F.when(F.col("source") == "dextra", "xlx").otherwise(F.col("source")))
    return prev, fresh


def _decisions(t: Tables) -> DataFrame:
    prev, fresh = _periods(t)
    a, b = source_counts(prev), source_counts(fresh)
    return decide(a, b, a.select("network", "source"))


@query("source_guard", f"WITH {PERIOD_SQL} SELECT network, source FROM lost")
def source_guard(t: Tables) -> DataFrame:
    """Sources that were tried, had rows and have none now."""
    prev, fresh = _periods(t)
    counts = source_counts(prev)
    return lost_sources(counts, source_counts(fresh), counts).select("network", "source")


@query("shrink_guard", f"WITH {PERIOD_SQL} SELECT network, previous::BIGINT AS previous, fresh::BIGINT AS fresh, CASE WHEN reason = '' THEN 'fresh' ELSE 'keep' END AS decision, reason FROM b")
def shrink_guard(t: Tables) -> DataFrame:
    """Keep-or-publish decision per network."""
    return _decisions(t)


@query("keep_last_good", f"""WITH {PERIOD_SQL} SELECT event_id, network FROM prev WHERE network IN (SELECT network FROM b WHERE reason <> '')
UNION ALL SELECT event_id, network FROM fresh WHERE network IN (SELECT network FROM b WHERE reason = '')""")
def keep_last_good_query(t: Tables) -> DataFrame:
    """Rows from the side each decision names."""
    prev, fresh = _periods(t)
    return keep_last_good(prev, fresh, _decisions(t)).select("event_id", "network")


@query("stalest_slice", """
SELECT system, fetched FROM (
  SELECT 'u' || c_custkey AS system, CASE WHEN user_id % 7 = 0 THEN NULL ELSE d END AS fetched FROM customer LEFT JOIN (
    SELECT user_id, strftime(max(ts), '%Y-%m-%d') AS d FROM events GROUP BY 1) ON user_id = c_custkey)
WHERE fetched IS NULL OR date_diff('day', fetched::DATE, DATE '2024-01-31') >= 2 ORDER BY fetched ASC NULLS FIRST, system LIMIT 40""")
def stalest_slice_query(t: Tables) -> DataFrame:
    """Nightly refetch slice (the limit is the feature)."""
    systems = t.customer.select(F.concat(F.lit("u"), "c_custkey").alias("system"))
    state = t.events.groupBy("user_id").agg(F.max(iso_day("ts")).alias("d")).select(
        F.concat(F.lit("u"), "user_id").alias("system"), F.when(F.col("user_id") % 7 == 0, "garbled").otherwise(F.col("d")).alias("fetched")
    )
    return stalest_slice(systems, state, "2024-01-31")


@query("fetch_fold", """
WITH r AS (SELECT p_partkey AS seq, 'p' || p_partkey AS system, CASE WHEN p_partkey % 5 = 0 THEN 'failed' WHEN p_partkey = 150 OR p_partkey = 170 THEN 'throttled' WHEN p_partkey = 151 THEN 'throttled' ELSE 'ok' END AS status FROM part)
SELECT system, CASE WHEN status = 'ok' AND seq < (SELECT min(seq) FROM r WHERE status = 'throttled') THEN '2024-02-01' ELSE '2024-01-01' END AS fetched FROM r""")
def fetch_fold(t: Tables) -> DataFrame:
    """Rotation state after a slice that was throttled half-way."""
    k = F.col("p_partkey")
    status = F.when(k % 5 == 0, "failed").when(k.isin(150, 151, 170), "throttled").otherwise("ok")
    results = t.part.select(k.alias("seq"), F.concat(F.lit("p"), k).alias("system"), status.alias("status"))
    state = t.part.select(F.concat(F.lit("p"), k).alias("system"), F.lit("2024-01-01").alias("fetched"))
    return fold_fetches(results, state, "2024-02-01")


CONTENT_SQL = """
a AS (SELECT 'n' || (o_custkey % 50) AS system, o_orderkey AS tg, o_orderstatus AS name FROM orders),
f AS (SELECT system, tg, CASE WHEN system = 'n3' AND tg % 100 = 7 THEN 'X' ELSE name END AS name FROM a WHERE system <> 'n5' AND NOT (system = 'n9' AND tg % 11 = 1)),
ch AS (SELECT DISTINCT system FROM (SELECT system, tg, name, sum(s) AS d FROM (SELECT *, 1 AS s FROM f UNION ALL SELECT *, -1 FROM a) GROUP BY 1, 2, 3) WHERE d <> 0)"""


def _contents(t: Tables) -> tuple[DataFrame, DataFrame]:
    old = t.orders.select(F.concat(F.lit("n"), F.col("o_custkey") % 50).alias("system"), F.col("o_orderkey").alias("tg"),
                          F.col("o_orderstatus").alias("name"), F.lit("2024-01-01").alias("synced_at"))
    new = old.filter("system <> 'n5' and not (system = 'n9' and tg % 11 = 1)").withColumn(
        "name", F.when((F.col("system") == "n3") & (F.col("tg") % 100 == 7), "X").otherwise(F.col("name")))
    return old, new


@query("changed_groups", f"WITH {CONTENT_SQL} SELECT system FROM ch")
def changed_groups_query(t: Tables) -> DataFrame:
    """Groups whose rows differ between two builds."""
    old, new = _contents(t)
    return changed_groups(old, new, "system", ["tg", "name"])


@query("unchanged_dates", f"""WITH {CONTENT_SQL}
SELECT o.system, o.n AS n_old, coalesce(n.n, 0) AS n_new, CASE WHEN n.n IS NULL THEN 'empty' WHEN o.system IN (SELECT system FROM ch) THEN 'changed' ELSE 'unchanged' END AS state,
  CASE WHEN n.n IS NOT NULL AND o.system IN (SELECT system FROM ch) THEN '2024-02-01' ELSE '2024-01-01' END AS generated
FROM (SELECT system, count(*) AS n FROM a GROUP BY 1) o LEFT JOIN (SELECT system, count(*) AS n FROM f GROUP BY 1) n USING (system)""")
def unchanged_dates(t: Tables) -> DataFrame:
    """Content dates: moved only where the content moved."""
    old, new = _contents(t)
    return content_dates(old, new, "system", ["tg", "name"], "2024-02-01")


@query("publish_gate", """
SELECT (SELECT count(*) FROM part) AS total, (SELECT count(*) FROM region WHERE r_name NOT IN (SELECT p_type FROM part)) AS missing, false AS publish""")
def publish_gate(t: Tables) -> DataFrame:
    """Total, missing networks and the publish decision."""
    expected = t.region.select(F.col("r_name").alias("network"))
    return network_gate(t.part.select(F.col("p_type").alias("network")), expected, floor=100)


@query("node_gate", "SELECT count(*) AS total, count(*) FILTER (o_orderkey % 100 = 99) AS bad_ids, false AS publish FROM orders")
def node_gate_query(t: Tables) -> DataFrame:
    """Row floor, numeric ids and the publish decision."""
    k = F.col("o_orderkey")
    nodes = t.orders.select(F.when(k % 100 == 99, F.concat(F.lit("x"), k)).otherwise(k.cast("string")).alias("node"))
    return node_gate(nodes, floor=1000)


@query("count_gate", """
SELECT part_no, parsed, few_rejects, parsed + greatest(10, declared // 200) >= declared AS complete
FROM (SELECT *, parsed + parsed * part_no // 1000 + part_no AS declared
  FROM (SELECT o_custkey % 20 AS part_no, count(*) AS parsed, count(*) FILTER (o_orderstatus = 'P')::DOUBLE / count(*) <= 0.34 AS few_rejects
        FROM orders GROUP BY o_custkey % 20))""")
def count_gate(t: Tables) -> DataFrame:
    """Rejected share and declared-count checks; the declared counts reach both sides of max(10, 0.5 percent)."""
    g = t.orders.groupBy((F.col("o_custkey") % 20).alias("part_no")).agg(
        F.count(F.lit(1)).alias("parsed"), rejected_gate(F.col("o_orderstatus") == "P", 0.34).alias("few_rejects")
    )
    declared = F.col("parsed") + F.expr("parsed * part_no div 1000") + F.col("part_no")
    return g.withColumn("complete", count_within_slack(F.col("parsed"), declared))
