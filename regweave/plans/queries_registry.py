"""Registry queries: merge, dedupe, joins, prefixes, enrichment, history, ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.functions.grid import grid4, grid6
from regweave.operators.dedupe import first_per_key, last_per_key, latest_expiry, one_holder, top_per_key, union_all
from regweave.operators.enrich import attach_activity, attach_nodes, fill_grid, number_pages
from regweave.operators.history import (
    attribute_as_of, fold_snapshot, generalise_postal, history_order, overlapping_intervals, withhold_unvetted,
)
from regweave.operators.ids import assign_ids, interval_ids, node_child_table
from regweave.operators.normalize import merge_registers, scrub_counters
from regweave.operators.prefix import apply_entities
from regweave.plans.builds import Lookups, build_current
from regweave.plans.catalog import Tables, query
from regweave.plans.inputs import (
    EMPTY_HISTORY_SQL, MERGED_SQL, call_of, customer_state, fold_sql, iso_day, iso_time, registers, state_sql,
)
from regweave.schemas import HISTORY
from regweave.session import stored
from regweave.sources.base import records, table_order
from regweave.sources.registers import au_records, us_records

MERGED = ["callsign", "last_name", "city", "state", "source"]


@query("registry_merge", f"WITH {MERGED_SQL} SELECT * FROM cased")
def registry_merge(t: Tables) -> DataFrame:
    """Three registers normalised, scrubbed and merged by source precedence, in key order."""
    return merge_registers(registers(t)).select(*MERGED).orderBy("callsign")


@query("scrub_counts", """
SELECT 0::BIGINT AS first_name, 0::BIGINT AS last_name, count(*) AS city FROM supplier WHERE s_suppkey % 10 = 0""")
def scrub_counts(t: Tables) -> DataFrame:
    """Address-shaped values per guarded field over all input rows."""
    a, b, c = registers(t)
    return a.unionByName(b).unionByName(c).agg(*scrub_counters())


EVENT_COLS = "user_id, event_id, event_type, ts_text"


def _events(t: Tables) -> DataFrame:
    return t.events.select("user_id", "event_id", "event_type", iso_time("ts").alias("ts_text"))


def _event_pick(order: str) -> str:
    return f"""
SELECT {EVENT_COLS} FROM (
  SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text,
         row_number() OVER (PARTITION BY user_id ORDER BY ts {order}, event_id {order}) AS rn FROM events) WHERE rn = 1"""


@query("first_wins", _event_pick("ASC"))
def first_wins(t: Tables) -> DataFrame:
    """First row per key."""
    return first_per_key(_events(t), ["user_id"], F.struct("ts_text", "event_id"))


@query("last_wins", _event_pick("DESC"))
def last_wins(t: Tables) -> DataFrame:
    """Last row per key."""
    return last_per_key(_events(t), ["user_id"], F.struct("ts_text", "event_id"))


@query("latest_expiry", """
SELECT o_custkey, o_orderkey, expiry FROM (
  SELECT o_custkey, o_orderkey, expiry,
         row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(expiry, '') DESC, o_orderkey) AS rn
  FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS expiry
        FROM orders)) WHERE rn = 1""")
def latest_expiry_query(t: Tables) -> DataFrame:
    """Latest expiry per key, null lowest, ties keep the first."""
    orders = t.orders.select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") != "P", iso_day("o_orderdate")).alias("expiry"))
    return latest_expiry(orders, ["o_custkey"], "expiry", F.col("o_orderkey"))


@query("composite_rank", """
SELECT o_custkey, o_orderkey, o_orderstatus, expiry FROM (
  SELECT o_custkey, o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS expiry,
         row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'P'), o_orderdate DESC, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def composite_rank(t: Tables) -> DataFrame:
    """Ordinary permits before visiting ones, then later expiry, then first row."""
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", iso_day("o_orderdate").alias("expiry"))
    return top_per_key(
        orders, ["o_custkey"], [(F.col("o_orderstatus") == "P").asc(), F.col("expiry").desc(), F.col("o_orderkey").asc()]
    )


@query("station_rollup", """
WITH s AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS holder,
         CASE WHEN l_suppkey % 3 <> 0 THEN 'S' || l_suppkey END AS town, 'P' || l_partkey AS town_state,
         CASE WHEN l_suppkey % 4 <> 0 THEN 'E' || (l_suppkey % 7) END AS entity_state, l_linestatus = 'F' AS fixed,
         strftime(l_shipdate, '%Y-%m-%d') AS d FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS o FROM s),
g AS (SELECT l_orderkey, arg_min(holder, o) FILTER (holder IS NOT NULL) AS holder,
             arg_min(entity_state, o) FILTER (entity_state IS NOT NULL) AS entity_state,
             min(d) AS first_day, max(d) AS last_day FROM r GROUP BY 1),
p AS (SELECT l_orderkey, town, town_state FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY NOT fixed, o) AS k FROM r WHERE town IS NOT NULL) WHERE k = 1)
SELECT g.l_orderkey, holder, first_day, last_day, town AS city,
       CASE WHEN town IS NOT NULL THEN town_state ELSE entity_state END AS state
FROM g LEFT JOIN p USING (l_orderkey)""")
def station_rollup(t: Tables) -> DataFrame:
    """Many station rows per key to one holder row."""
    s = t.lineitem.select(
        "l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("_o"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("holder"),
        F.when(F.col("l_suppkey") % 3 != 0, F.concat(F.lit("S"), F.col("l_suppkey"))).alias("town"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("town_state"),
        F.when(F.col("l_suppkey") % 4 != 0, F.concat(F.lit("E"), F.col("l_suppkey") % 7)).alias("entity_state"),
        (F.col("l_linestatus") == "F").alias("fixed"), iso_day("l_shipdate").alias("d"),
    )
    out = one_holder(s, "l_orderkey", F.col("_o"), ["holder", "entity_state"], {"first_day": "d"}, {"last_day": "d"},
                     ("town", "town_state"), F.col("fixed"), fallback_state="entity_state")
    return out.drop("entity_state")


@query("usi_join", """
WITH hd AS (SELECT o_orderkey AS usi, strftime(o_orderdate, '%Y-%m-%d') AS grant_date FROM orders WHERE o_orderstatus = 'O'),
am AS (SELECT usi, klass FROM (SELECT l_orderkey AS usi, l_linestatus AS klass,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
       FROM lineitem WHERE l_returnflag = 'R') WHERE rn = 1)
SELECT 'K' || l_orderkey || '/' || l_linenumber AS callsign, 'S' || l_suppkey AS last_name, grant_date,
       CASE klass WHEN 'F' THEN 'Fixed' ELSE klass END AS license_class
FROM lineitem JOIN hd ON l_orderkey = usi LEFT JOIN am ON am.usi = l_orderkey WHERE l_returnflag <> 'R'""")
def usi_join(t: Tables) -> DataFrame:
    """Entity rows joined to active headers (inner) and last class rows (left)."""
    key = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    line = t.lineitem
    header = t.orders.select(
        F.col("o_orderkey").cast("string").alias("usi"), F.lit("").alias("callsign"),
        F.when(F.col("o_orderstatus") == "O", "A").otherwise("E").alias("status"), iso_day("o_orderdate").alias("grant"),
        F.lit(None).cast("string").alias("expired"), F.lit(None).cast("string").alias("effective"), F.struct("o_orderkey").alias("_ord"),
    )
    entity = line.filter("l_returnflag <> 'R'").select(
        F.col("l_orderkey").cast("string").alias("usi"), F.concat(call_of("l_orderkey"), F.lit("/"), F.col("l_linenumber")).alias("callsign"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("last"), table_order("l_orderkey"),
        *[F.lit(None).cast("string").alias(c) for c in ("entity_type", "first", "street", "city", "state", "zip", "frn", "applicant")],
    )
    classes = line.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").cast("string").alias("usi"), F.when(F.col("l_linestatus") == "F", "Fixed").otherwise(F.col("l_linestatus")).alias("class"),
        F.lit(None).cast("string").alias("previous"), key.alias("_ord"),
    )
    return us_records(header, entity, classes).select("callsign", "last_name", "grant_date", "license_class")


@query("register_join", """
WITH lic AS (SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND lower(o_orderpriority) LIKE '%i%'),
dev AS (SELECT call_sign, l_orderkey FROM (
  SELECT 'K' || l_partkey AS call_sign, l_orderkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) AS rn
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM lic)) WHERE rn = 1)
SELECT call_sign AS callsign, CASE WHEN c_nationkey BETWEEN 1 AND 5 THEN c_name END AS last_name, o_orderpriority AS license_class,
       n_name AS applicant_type
FROM dev JOIN lic ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def register_join(t: Tables) -> DataFrame:
    """Device to filtered licence to semi-reduced client to type names."""
    s = lambda c: F.col(c).cast("string")
    none = lambda c: F.lit(None).cast("string").alias(c)
    device = t.lineitem.select(
        s("l_orderkey").alias("LICENCE_NO"), F.concat(F.lit("k"), F.col("l_partkey")).alias("CALL_SIGN"),
        F.struct(F.lit("").alias("path"), F.col("l_orderkey").alias("block"), F.col("l_linenumber").cast("bigint").alias("row")).alias("_ord"),
    )
    amateur = F.lower("o_orderpriority").contains("i")
    licence = t.orders.select(
        s("o_orderkey").alias("LICENCE_NO"), s("o_custkey").alias("CLIENT_NO"),
        F.when(amateur, "Amateur").otherwise("Fixed").alias("LICENCE_TYPE_NAME"), F.col("o_orderpriority").alias("LICENCE_CATEGORY_NAME"),
        none("DATE_ISSUED"), none("DATE_OF_EFFECT"), none("DATE_OF_EXPIRY"),
        F.when(F.col("o_orderstatus") == "F", "Granted").otherwise("Cancelled").alias("STATUS_TEXT"), table_order("o_orderkey"),
    )
    client = t.customer.select(
        s("c_custkey").alias("CLIENT_NO"), F.col("c_name").alias("LICENCEE"), none("POSTAL_STREET"), none("POSTAL_SUBURB"),
        none("POSTAL_STATE"), none("POSTAL_POSTCODE"), s("c_nationkey").alias("CLIENT_TYPE_ID"), table_order("c_custkey"),
    )
    types = t.nation.select(s("n_nationkey").alias("TYPE_ID"), F.col("n_name").alias("NAME"), table_order("n_nationkey"))
    return au_records(device, licence, client, types).select("callsign", "last_name", "license_class", "applicant_type")


@query("longest_prefix", """
WITH keys AS (
  SELECT DISTINCT upper(p_brand) AS k, false AS ex, 'Entity ' || p_brand AS entity,
         CASE WHEN replace(p_brand, 'Brand#', '')::BIGINT % 4 <> 0 THEN replace(p_brand, 'Brand#', '')::BIGINT END AS num FROM part
  UNION ALL SELECT DISTINCT p_type, false, 'Type ' || p_type, length(p_type)::BIGINT FROM part
  UNION ALL SELECT 'K', false, 'United States', 291 UNION ALL SELECT 'KG4', false, 'Guantanamo Bay', 105
  UNION ALL SELECT upper(p_brand) || '-' || p_partkey, true, 'Exact', p_partkey FROM part WHERE p_partkey % 50 = 0),
calls AS (
  SELECT p_partkey, p_type, p_size,
    CASE p_partkey % 5 WHEN 0 THEN upper(p_brand) || '-' || p_partkey WHEN 1 THEN p_type || p_partkey
      WHEN 2 THEN 'KG4' || chr((65 + p_partkey % 26)::INT) || chr((65 + p_size % 26)::INT)
      WHEN 3 THEN 'KG4' || chr((65 + p_partkey % 26)::INT) || 'XY/P' ELSE 'Q' || p_partkey END AS callsign FROM part),
hits AS (
  SELECT p_partkey, entity, num, row_number() OVER (PARTITION BY p_partkey ORDER BY ex DESC, length(k) DESC) AS rn
  FROM calls JOIN keys ON CASE WHEN ex THEN callsign = k ELSE starts_with(callsign, k) END
  WHERE ex OR k <> 'KG4' OR regexp_full_match(string_split(callsign, '/')[1][4:], '[A-Z]{2}'))
SELECT callsign, CASE WHEN h.p_partkey IS NULL THEN 'Old ' || p_type ELSE entity END AS country,
       CASE WHEN h.p_partkey IS NULL THEN p_size::BIGINT ELSE num END AS dxcc, c.p_partkey AS postal
FROM calls c LEFT JOIN hits h ON h.p_partkey = c.p_partkey AND rn = 1""")
def longest_prefix(t: Tables) -> DataFrame:
    """Entity by exact call, else longest prefix, with the shape exception."""
    part = t.part
    number = F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("bigint")
    static = part.sparkSession.createDataFrame(
        [("K", False, "United States", 291), ("KG4", False, "Guantanamo Bay", 105)], "key string, is_exact boolean, entity string, number bigint"
    )
    keys = (
        part.select(F.upper("p_brand").alias("key"), F.lit(False).alias("is_exact"), F.concat(F.lit("Entity "), "p_brand").alias("entity"),
                    F.when(number % 4 != 0, number).alias("number")).distinct()
        .unionByName(part.select(F.col("p_type").alias("key"), F.lit(False).alias("is_exact"), F.concat(F.lit("Type "), "p_type").alias("entity"),
                                 F.length("p_type").cast("bigint").alias("number")).distinct())
        .unionByName(static)
        .unionByName(part.filter("p_partkey % 50 = 0").select(
            F.concat(F.upper("p_brand"), F.lit("-"), "p_partkey").alias("key"), F.lit(True).alias("is_exact"), F.lit("Exact").alias("entity"),
            F.col("p_partkey").alias("number")))
    )
    letter = lambda c: F.char(F.lit(65) + F.col(c) % 26)
    kind = F.col("p_partkey") % 5
    call = (
        F.when(kind == 0, F.concat(F.upper("p_brand"), F.lit("-"), "p_partkey")).when(kind == 1, F.concat("p_type", "p_partkey"))
        .when(kind == 2, F.concat(F.lit("KG4"), letter("p_partkey"), letter("p_size")))
        .when(kind == 3, F.concat(F.lit("KG4"), letter("p_partkey"), F.lit("XY/P"))).otherwise(F.concat(F.lit("Q"), "p_partkey"))
    )
    calls = records(part.withColumn("_ord", table_order("p_partkey")), "x", None, callsign=call,
                    country=F.concat(F.lit("Old "), "p_type"), dxcc=F.col("p_size"), postal_code=F.col("p_partkey")).drop("_ord")
    return apply_entities(calls, keys).select("callsign", "country", "dxcc", F.col("postal_code").cast("bigint").alias("postal"))


@query("list_enrich", """
SELECT 'K' || o_orderkey AS callsign, coalesce(nodes, '') AS nodes, coalesce(n, 0)::BIGINT AS n FROM orders LEFT JOIN (
  SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS nodes, count(DISTINCT l_suppkey) AS n
  FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def list_enrich(t: Tables) -> DataFrame:
    """Sorted distinct list per key, empty where there is none."""
    return _with_nodes(t).select(
        "callsign", F.array_join("allstar_nodes", ",").alias("nodes"), F.size("allstar_nodes").cast("bigint").alias("n")
    )


def _with_nodes(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey").withColumn("_ord", table_order("o_orderkey"))
    base = records(orders, "x", None, callsign=call_of("o_orderkey")).drop("_ord")
    nodes = t.lineitem.select(call_of("l_orderkey").alias("callsign"), F.col("l_suppkey").alias("node"))
    return attach_nodes(base, nodes)


@query("list_pages", """
SELECT l_returnflag, l_partkey // 256 AS page, count(DISTINCT l_partkey) AS n,
       array_to_string(list_sort(list(DISTINCT l_partkey)), ',') AS numbers
FROM lineitem GROUP BY 1, 2""")
def list_pages(t: Tables) -> DataFrame:
    """Lists of three keys that hold a third of all rows each, in bounded pages."""
    pages = number_pages(t.lineitem, "l_returnflag", "l_partkey", page=256)
    return pages.select("l_returnflag", "page", F.size("numbers").cast("bigint").alias("n"), F.array_join("numbers", ",").alias("numbers"))


@query("activity_flag", """
SELECT 'K' || c_custkey AS callsign, d IS NOT NULL AS uses_lotw, d AS lotw_last_activity FROM customer LEFT JOIN (
  SELECT user_id, max(strftime(ts, '%Y-%m-%d')) AS d FROM events GROUP BY 1) ON user_id = c_custkey""")
def activity_flag(t: Tables) -> DataFrame:
    """Activity flag and latest date."""
    base = records(t.customer.withColumn("_ord", table_order("c_custkey")), "x", None, callsign=call_of("c_custkey")).drop("_ord")
    activity = t.events.select(call_of("user_id").alias("callsign"), iso_day("ts").alias("day"))
    return attach_activity(base, activity).select("callsign", "uses_lotw", "lotw_last_activity")


POINT_SQL = """
pts AS (SELECT o_orderkey, ((o_orderkey * 37) % 18001)::DOUBLE / 100.0::DOUBLE - 90.0::DOUBLE AS lat,
               ((o_custkey * 91 + o_orderkey) % 36001)::DOUBLE / 100.0::DOUBLE - 180.0::DOUBLE AS lon FROM orders),
adj AS (SELECT o_orderkey, least(greatest(lon + 180.0::DOUBLE, 0.0::DOUBLE), 359.999999::DOUBLE) AS e,
               least(greatest(lat + 90.0::DOUBLE, 0.0::DOUBLE), 179.999999::DOUBLE) AS n FROM pts)"""
GRID4_SQL = """chr((65 + floor(e / 20))::INT) || chr((65 + floor(n / 10))::INT)
       || floor((e % 20) / 2)::INT || floor(n % 10)::INT"""


def _points(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", (((F.col("o_orderkey") * 37) % 18001).cast("double") / 100.0 - 90.0).alias("lat"),
        (((F.col("o_custkey") * 91 + F.col("o_orderkey")) % 36001).cast("double") / 100.0 - 180.0).alias("lon"),
    )


@query("grid4", f"WITH {POINT_SQL} SELECT o_orderkey, {GRID4_SQL} AS grid FROM adj")
def grid4_query(t: Tables) -> DataFrame:
    """4-character locator, clamped at the edges."""
    return _points(t).select("o_orderkey", grid4(F.col("lat"), F.col("lon")).alias("grid"))


@query("grid6", f"""WITH {POINT_SQL} SELECT o_orderkey, {GRID4_SQL}
  || chr((97 + floor((e % 2) / 2 * 24))::INT) || chr((97 + floor((n % 1) * 24))::INT) AS grid FROM adj""")
def grid6_query(t: Tables) -> DataFrame:
    """6-character locator."""
    return _points(t).select("o_orderkey", grid6(F.col("lat"), F.col("lon")).alias("grid"))


@query("geo_fallback", """
WITH postal AS (SELECT CASE WHEN p_size % 2 = 0 THEN 'UNITED STATES' ELSE 'CANADA' END AS country,
    CASE WHEN p_size % 2 = 0 THEN lpad((p_partkey % 300)::VARCHAR, 5, '0') ELSE 'K' || (p_partkey % 10) || 'A' END AS code,
    min(p_partkey) AS k FROM part GROUP BY 1, 2),
rec AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'UNITED STATES' WHEN 1 THEN 'CANADA' ELSE 'NORWAY' END AS home,
    CASE c_custkey % 3 WHEN 0 THEN lpad((c_custkey % 1000)::VARCHAR, 5, '0') WHEN 1 THEN 'K' || (c_custkey % 13 % 12) || 'A'
         ELSE '0123' END AS code,
    c_nationkey, c_mktsegment FROM customer),
res AS (SELECT c_custkey, CASE WHEN p.k IS NOT NULL THEN ((p.k * 7) % 1700)::DOUBLE / 10.0::DOUBLE - 85.0::DOUBLE
             WHEN home <> 'CANADA' AND c_nationkey % 2 = 0 THEN c_nationkey::DOUBLE END AS lat,
    CASE WHEN p.k IS NOT NULL THEN ((p.k * 13) % 3500)::DOUBLE / 10.0::DOUBLE - 175.0::DOUBLE
             WHEN home <> 'CANADA' AND c_nationkey % 2 = 0 THEN -c_nationkey::DOUBLE END AS lon
  FROM rec LEFT JOIN postal p ON p.country = home AND p.code = rec.code),
adj AS (SELECT *, lon + 180.0::DOUBLE AS e, lat + 90.0::DOUBLE AS n FROM res)
SELECT 'K' || c_custkey AS callsign, CASE WHEN c_custkey % 17 = 0 THEN 'ZZ99' WHEN lat IS NOT NULL THEN """ + GRID4_SQL + """ END AS grid
FROM adj""")
def geo_fallback(t: Tables) -> DataFrame:
    """Postal centroid, else city centroid, else null; an existing grid stays."""
    even = F.col("p_size") % 2 == 0
    postal = t.part.groupBy(
        F.when(even, "United States").otherwise("Canada").alias("country"),
        F.when(even, F.lpad((F.col("p_partkey") % 300).cast("string"), 5, "0"))
        .otherwise(F.concat(F.lit("k"), F.col("p_partkey") % 10, F.lit("a"))).alias("postal_code"),
    ).agg(F.min("p_partkey").alias("k")).select(
        "country", "postal_code", (((F.col("k") * 7) % 1700).cast("double") / 10.0 - 85.0).alias("lat"),
        (((F.col("k") * 13) % 3500).cast("double") / 10.0 - 175.0).alias("lon"),
    )
    town = t.nation.filter("n_nationkey % 2 = 0").select(
        F.explode(F.array(F.lit("United States"), F.lit("Norway"))).alias("country"), F.lit(None).cast("string").alias("state"),
        F.lower("n_name").alias("city"), F.col("n_nationkey").cast("double").alias("lat"), (-F.col("n_nationkey")).cast("double").alias("lon"),
    )
    kind = F.col("c_custkey") % 3
    who = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumn("_ord", table_order("c_custkey"))
    base = records(
        who, "", None, callsign=call_of("c_custkey"), source=F.when(kind == 0, "fcc").when(kind == 1, "ised").otherwise("nkom"),
        country=F.when(kind == 2, " Norway ").otherwise("Elsewhere"), city=F.concat(F.lit(" "), "n_name"),
        postal_code=F.when(kind == 0, F.concat(F.lpad((F.col("c_custkey") % 1000).cast("string"), 5, "0"), F.lit("-1234")))
        .when(kind == 1, F.concat(F.lit("K"), F.col("c_custkey") % 13 % 12, F.lit("A 0B1"))).otherwise("0123"),
        grid=F.when(F.col("c_custkey") % 17 == 0, "ZZ99"),
    ).drop("_ord")
    return fill_grid(base, postal, town).select("callsign", "grid")


# --- history --------------------------------------------------------------------------------

CUT1, CUT2, CUT3 = "1998-01-01", "2000-01-01", "2001-06-01"
HCOLS = ["callsign", "valid_from", "valid_to", "last_name", "city", "postal_code", "license_class", "dxcc", "source"]
HSQL = ", ".join(f"{c}::BIGINT AS dxcc" if c == "dxcc" else c for c in HCOLS)
TWO_SQL = ",".join([EMPTY_HISTORY_SQL, state_sql("s1", CUT1), state_sql("s2", CUT2), fold_sql("h1", "h0", "s1", CUT1),
                    fold_sql("h2", "h1", "s2", CUT2)])
THREE_SQL = ",".join([TWO_SQL, state_sql("s3", CUT3), fold_sql("h3", "h2", "s3", CUT3)])


def _history(t: Tables, *cuts: str) -> DataFrame:
    """Folded snapshots; like in a real build, each fold but the last is a stored table."""
    history = t.spark.createDataFrame([], HISTORY)
    for cut in cuts[:-1]:
        history = stored(fold_snapshot(history, customer_state(t, cut), cut))
    return fold_snapshot(history, customer_state(t, cuts[-1]), cuts[-1])


@query("scd2_fold", f"WITH {TWO_SQL} SELECT {HSQL} FROM h2")
def scd2_fold(t: Tables) -> DataFrame:
    """Two snapshots folded into interval history."""
    return _history(t, CUT1, CUT2).select(*HCOLS).orderBy(*history_order())


@query("scd2_three", f"WITH {THREE_SQL} SELECT {HSQL} FROM h3")
def scd2_three(t: Tables) -> DataFrame:
    """Three snapshots folded."""
    return _history(t, CUT1, CUT2, CUT3).select(*HCOLS)


@query("history_vet", f"""WITH {TWO_SQL}, {state_sql("s3", CUT3)}
SELECT h.callsign, h.valid_from, h.valid_to, CASE WHEN ok THEN h.last_name END AS last_name, CASE WHEN ok THEN h.city END AS city,
       CASE WHEN ok THEN h.postal_code END AS postal_code, h.license_class, h.dxcc::BIGINT AS dxcc, h.source
FROM (SELECT h2.*, h2.source <> 'acma' OR (h2.valid_to IS NULL AND v.callsign IS NOT NULL AND v.last_name = h2.last_name) AS ok
      FROM h2 LEFT JOIN (SELECT callsign, last_name FROM s3 WHERE source = 'acma' AND last_name IS NOT NULL) v USING (callsign)) h""")
def history_vet(t: Tables) -> DataFrame:
    """Old rows of one source keep identifying fields only when vetted by the new snapshot."""
    return withhold_unvetted(_history(t, CUT1, CUT2), customer_state(t, CUT3)).select(*HCOLS)


@query("history_generalise", f"""WITH {TWO_SQL}
SELECT callsign, valid_from, valid_to, CASE WHEN source = 'ised' THEN upper(postal_code[1:3]) ELSE postal_code END AS postal_code, source
FROM h2""")
def history_generalise(t: Tables) -> DataFrame:
    """Postal codes of one source cut to their area on all old rows."""
    return generalise_postal(_history(t, CUT1, CUT2)).select("callsign", "valid_from", "valid_to", "postal_code", "source")


def _signups(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    starts = t.events.filter("event_type = 'signup'").groupBy(call_of("user_id").alias("callsign"), iso_time("ts").alias("valid_from")).agg(
        F.min("event_id").alias("holder")
    )
    w = Window.partitionBy("callsign").orderBy("valid_from")
    nxt = F.lead("valid_from").over(w)
    # A closing event of type error ends the interval early for odd holders.
    return starts.withColumn("valid_to", nxt).withColumn(
        "valid_to", F.when(F.col("holder") % 5 == 0, F.concat(F.substring("valid_from", 1, 10), F.lit(" 23:00:00.000000"))).otherwise(F.col("valid_to"))
    ).filter("valid_to is null or valid_from < valid_to").withColumn(
        "valid_to", F.when(nxt.isNotNull() & (F.col("valid_to") > nxt), nxt).otherwise(F.col("valid_to"))
    )


@query("asof_attribution", """
WITH st AS (SELECT 'K' || user_id AS callsign, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS valid_from, min(event_id) AS holder
            FROM events WHERE event_type = 'signup' GROUP BY 1, 2),
iv0 AS (SELECT *, CASE WHEN holder % 5 = 0 THEN valid_from[1:10] || ' 23:00:00.000000'
               ELSE lead(valid_from) OVER (PARTITION BY callsign ORDER BY valid_from) END AS vt FROM st),
iv1 AS (SELECT *, lead(valid_from) OVER (PARTITION BY callsign ORDER BY valid_from) AS nx FROM iv0 WHERE vt IS NULL OR valid_from < vt),
iv AS (SELECT callsign, holder, valid_from, CASE WHEN nx IS NOT NULL AND vt > nx THEN nx ELSE vt END AS valid_to FROM iv1)
SELECT e.event_id, iv.valid_from, iv.valid_to, iv.holder
FROM events e LEFT JOIN iv ON iv.callsign = 'K' || e.user_id AND strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f') >= iv.valid_from
  AND (iv.valid_to IS NULL OR strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f') < iv.valid_to)""")
def asof_attribution(t: Tables) -> DataFrame:
    """Which interval of its key each event falls into."""
    events = t.events.select("event_id", call_of("user_id").alias("callsign"), iso_time("ts").alias("at"))
    found = attribute_as_of(events, _signups(t), "callsign", "at", ["holder"])
    return found.select("event_id", "valid_from", "valid_to", "holder")


@query("interval_check", f"""WITH {THREE_SQL}
SELECT count(*) AS overlaps FROM (SELECT coalesce(valid_to, '~') AS e,
  lead(valid_from) OVER (PARTITION BY callsign ORDER BY valid_from, coalesce(valid_to, '~')) AS n FROM h3) WHERE e > n""")
def interval_check(t: Tables) -> DataFrame:
    """Intervals of one key must not overlap."""
    return overlapping_intervals(_history(t, CUT1, CUT2, CUT3)).agg(F.count(F.lit(1)).alias("overlaps"))


IDENTITY_SQL = " AND ".join(f"p.{c} IS NOT DISTINCT FROM c.{c}" for c in ("last_name", "city", "postal_code", "license_class", "dxcc"))
IDS_SQL = f"""
{state_sql("s1", CUT1)}, {state_sql("s2", CUT2)},
i1 AS (SELECT row_number() OVER (ORDER BY callsign) AS id, * FROM s1),
m AS (SELECT CASE WHEN p.callsign IS NOT NULL AND ({IDENTITY_SQL}) THEN p.id END AS old_id, c.* FROM s2 c LEFT JOIN i1 p USING (callsign)),
i2 AS (SELECT old_id AS id, callsign, license_class FROM m WHERE old_id IS NOT NULL
       UNION ALL
       SELECT (SELECT max(id) FROM i1) + row_number() OVER (ORDER BY callsign), callsign, license_class FROM m WHERE old_id IS NULL)"""


def _two_ids(t: Tables) -> tuple[DataFrame, DataFrame]:
    none = t.spark.createDataFrame([], "id bigint, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in customer_state(t, CUT1).schema))
    first = stored(assign_ids(customer_state(t, CUT1), none))
    return first, assign_ids(customer_state(t, CUT2), first)


@query("stable_ids", f"WITH {IDS_SQL} SELECT id, callsign, license_class FROM i2")
def stable_ids(t: Tables) -> DataFrame:
    """Ids over two builds: same holder keeps the id, others get new ones in key order."""
    return _two_ids(t)[1].select("id", "callsign", "license_class")


@query("interval_ids", f"""WITH {IDS_SQL}, {EMPTY_HISTORY_SQL}, {fold_sql("h1", "h0", "s1", CUT1)}, {fold_sql("h2", "h1", "s2", CUT2)},
ph AS (SELECT i1.id, h1.callsign, h1.valid_from FROM h1 JOIN i1 USING (callsign))
SELECT h.callsign, h.valid_from, h.valid_to, CASE WHEN h.valid_to IS NOT NULL THEN coalesce(ph.id, i2.id) ELSE i2.id END AS id
FROM h2 h LEFT JOIN ph ON ph.callsign = h.callsign AND ph.valid_from = h.valid_from LEFT JOIN i2 ON i2.callsign = h.callsign""")
def interval_ids_query(t: Tables) -> DataFrame:
    """Id of every history row."""
    first, second = _two_ids(t)
    h1 = stored(_history(t, CUT1))
    prior = h1.join(first.select("id", "callsign"), "callsign")
    h2 = fold_snapshot(h1, customer_state(t, CUT2), CUT2)
    return interval_ids(h2, second, prior).select("callsign", "valid_from", "valid_to", "id")


@query("history_to_current", f"""WITH {IDS_SQL}, {EMPTY_HISTORY_SQL}, {fold_sql("h1", "h0", "s1", CUT1)}, {fold_sql("h2", "h1", "s2", CUT2)},
ph AS (SELECT i1.id, h1.callsign, h1.valid_from FROM h1 JOIN i1 USING (callsign)),
hi AS (SELECT h.callsign, h.valid_from, h.valid_to, CASE WHEN h.valid_to IS NOT NULL THEN coalesce(ph.id, i2.id) ELSE i2.id END AS id
FROM h2 h LEFT JOIN ph ON ph.callsign = h.callsign AND ph.valid_from = h.valid_from LEFT JOIN i2 ON i2.callsign = h.callsign)
SELECT hi.callsign, valid_from, valid_to, i2.license_class FROM hi JOIN i2 ON hi.id = i2.id""")
def history_to_current(t: Tables) -> DataFrame:
    """Intervals of the holders of today, joined to the current records on the id."""
    first, second = _two_ids(t)
    h1 = stored(_history(t, CUT1))
    prior = h1.join(first.select("id", "callsign"), "callsign")
    rows = interval_ids(fold_snapshot(h1, customer_state(t, CUT2), CUT2), second, prior).select("id", "callsign", "valid_from", "valid_to")
    return rows.join(second.select("id", "license_class"), "id").drop("id")


@query("explode_nodes", """
SELECT 'K' || o_orderkey AS callsign, o_orderkey AS id, l_suppkey AS node FROM orders JOIN (
  SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) ON l_orderkey = o_orderkey""")
def explode_nodes(t: Tables) -> DataFrame:
    """List column as child rows, joined back on the id."""
    with_ids = _with_nodes(t).withColumn("id", F.substring("callsign", 2, 20).cast("bigint"))
    child = node_child_table(with_ids)
    return with_ids.select("callsign", "id").join(child, "id").select("callsign", "id", "node")


@query("source_counts", f"WITH {MERGED_SQL} SELECT source, count(*) AS n FROM cased GROUP BY 1")
def source_counts_query(t: Tables) -> DataFrame:
    """Rows per source, largest first."""
    return merge_registers(registers(t)).groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


@query("point_lookup", f"WITH {MERGED_SQL} SELECT callsign, last_name, source FROM cased WHERE callsign = 'K42'")
def point_lookup(t: Tables) -> DataFrame:
    """One key; the filter reaches every register scan below the merge."""
    return merge_registers(registers(t)).filter("callsign = 'K42'").select("callsign", "last_name", "source")


@query("restricted_gate", f"""WITH {MERGED_SQL},
act AS (SELECT 'K' || user_id AS c, max(strftime(ts, '%Y-%m-%d')) AS d FROM events GROUP BY 1),
whole AS (SELECT callsign, source FROM cased UNION ALL
  SELECT 'K' || o_orderkey, 'nmhh' FROM orders WHERE 'K' || o_orderkey NOT IN (SELECT callsign FROM cased))
SELECT false AS opened, source, false AS uses_lotw, count(*) AS n, NULL::VARCHAR AS latest FROM cased GROUP BY source
UNION ALL SELECT true, source, d IS NOT NULL, count(*), max(d) FROM whole LEFT JOIN act ON callsign = c GROUP BY ALL""")
def restricted_gate(t: Tables) -> DataFrame:
    """A build without and with the opt-in, orders being a register that needs it and events the activity list."""
    orders = t.orders.withColumn("_ord", table_order("o_orderkey"))
    streams = [*registers(t), records(orders, "nmhh", None, callsign=call_of("o_orderkey"))]
    activity = t.events.select(call_of("user_id").alias("callsign"), iso_day("ts").alias("day"))
    parts = [build_current(streams, Lookups(activity=activity), include_restricted=o).withColumn("opened", F.lit(o)) for o in (False, True)]
    return union_all(parts).groupBy("opened", "source", "uses_lotw").agg(F.count(F.lit(1)).alias("n"), F.max("lotw_last_activity").alias("latest"))
