"""Domain inputs derived from the synthetic tables, shared by the queries."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave.plans.catalog import Tables
from regweave.session import shared_folder
from regweave.sources.base import records, table_order


def scratch(spark: SparkSession) -> str:
    """A new folder for derived files, below the shared one."""
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def iso_time(col: str) -> Column:
    """Timestamp as ISO text with microseconds."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def iso_day(col: str) -> Column:
    """Timestamp as ISO day."""
    return F.date_format(col, "yyyy-MM-dd")


def call_of(col: str) -> Column:
    """Callsign of an integer key."""
    return F.concat(F.lit("K"), F.col(col).cast("string"))


def registers(t: Tables) -> list[DataFrame]:
    """Customer, supplier and part as three registers whose keys overlap."""
    nation = t.nation
    customer = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumn("_ord", table_order("c_custkey"))
    supplier = t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).withColumn("_ord", table_order("s_suppkey"))
    part = t.part.withColumn("_ord", table_order("p_partkey"))
    town = F.when(F.col("s_suppkey") % 10 == 0, F.concat(F.col("s_suppkey").cast("string"), F.lit(" Main St"))).otherwise(
        F.concat(F.lit("  "), F.col("n_name"), F.lit(" "))
    )
    return [
        records(customer, "fcc", None, callsign=F.lower(call_of("c_custkey")), last_name=F.upper("c_name"), city=F.col("n_name"),
                state=F.col("c_mktsegment")),
        records(supplier, "ised", None, callsign=call_of("s_suppkey"), last_name=F.upper("s_name"), city=town, state=F.lit("  ")),
        records(part, "acma", None, callsign=call_of("p_partkey"), last_name=F.upper("p_name"), city=F.col("p_type"),
                state=F.col("p_brand")),
    ]


# The same three registers after normalisation, one row per key, as SQL.
MERGED_SQL = """
merged AS (
  SELECT callsign, last_name, city, state, source FROM (
    SELECT *, row_number() OVER (PARTITION BY callsign ORDER BY rank, ord) AS rn FROM (
      SELECT 'K' || c_custkey AS callsign, upper(c_name) AS last_name, n_name AS city, c_mktsegment AS state,
             'fcc' AS source, 0 AS rank, c_custkey AS ord
      FROM customer JOIN nation ON c_nationkey = n_nationkey
      UNION ALL
      SELECT 'K' || s_suppkey, upper(s_name), CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE n_name END, NULL, 'ised', 1, s_suppkey
      FROM supplier JOIN nation ON s_nationkey = n_nationkey
      UNION ALL
      SELECT 'K' || p_partkey, upper(p_name), p_type, p_brand, 'acma', 2, p_partkey FROM part)
  ) WHERE rn = 1),
cased AS (
  SELECT callsign,
    array_to_string(list_transform(string_split(last_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS last_name,
    upper(city[1]) || lower(city[2:]) AS city, state, source
  FROM merged)
"""


def customer_state(t: Tables, cut: str) -> DataFrame:
    """Snapshot of customers at a cut date, from their latest order before it.

    Customers whose latest order is pending are absent, so holders vanish and come back.
    """
    orders = t.orders.select("o_custkey", "o_orderkey", iso_day("o_orderdate").alias("day"), "o_orderstatus", "o_orderpriority").filter(F.col("day") < cut)
    last = orders.groupBy("o_custkey").agg(
        F.max_by(F.struct("o_orderstatus", "o_orderpriority"), F.struct("day", "o_orderkey")).alias("s")
    )
    who = last.filter("s.o_orderstatus <> 'P'").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn("_ord", table_order("c_custkey"))
    state = records(
        who, "", cut, callsign=call_of("c_custkey"), last_name=F.col("c_name"), city=F.col("s.o_orderpriority"),
        postal_code=F.concat(F.lit("k1a "), F.col("c_custkey").cast("string")), license_class=F.col("s.o_orderstatus"),
        dxcc=F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey")),
        source=F.when(F.col("c_custkey") % 3 == 0, "acma").when(F.col("c_custkey") % 3 == 1, "ised").otherwise("fcc"),
    )
    return state.drop("_ord")


def state_sql(name: str, cut: str) -> str:
    """The snapshot as a CTE."""
    return f"""
{name} AS (
  SELECT 'K' || c_custkey AS callsign, c_name AS last_name, o_orderpriority AS city, 'k1a ' || c_custkey AS postal_code,
         o_orderstatus AS license_class, CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey END AS dxcc,
         CASE c_custkey % 3 WHEN 0 THEN 'acma' WHEN 1 THEN 'ised' ELSE 'fcc' END AS source
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE strftime(o_orderdate, '%Y-%m-%d') < '{cut}')
  JOIN customer ON o_custkey = c_custkey WHERE rn = 1 AND o_orderstatus <> 'P')"""


def fold_sql(out: str, prior: str, snap: str, as_of: str) -> str:
    """One fold of a snapshot into a history as a CTE."""
    cols = "last_name, city, postal_code, license_class, dxcc, source"
    o = ", ".join(f"o.{c}" for c in cols.split(", "))
    c = ", ".join(f"c.{c}" for c in cols.split(", "))
    same = " AND ".join(f"o.{x} IS NOT DISTINCT FROM c.{x}" for x in ("last_name", "city", "postal_code", "license_class", "dxcc"))
    return f"""
{out} AS (
  SELECT callsign, valid_from, valid_to, {cols} FROM {prior} WHERE valid_to IS NOT NULL
  UNION ALL
  SELECT o.callsign, o.valid_from, CASE WHEN c.callsign IS NULL OR NOT ({same}) THEN '{as_of}' END, {o}
  FROM (SELECT * FROM {prior} WHERE valid_to IS NULL) o LEFT JOIN {snap} c ON o.callsign = c.callsign
  UNION ALL
  SELECT c.callsign, '{as_of}', NULL, {c}
  FROM {snap} c LEFT JOIN (SELECT * FROM {prior} WHERE valid_to IS NULL) o ON o.callsign = c.callsign
  WHERE o.callsign IS NULL OR NOT ({same}))"""


EMPTY_HISTORY_SQL = """
h0 AS (SELECT NULL::VARCHAR AS callsign, NULL::VARCHAR AS valid_from, NULL::VARCHAR AS valid_to, NULL::VARCHAR AS last_name,
              NULL::VARCHAR AS city, NULL::VARCHAR AS postal_code, NULL::VARCHAR AS license_class, NULL::BIGINT AS dxcc,
              NULL::VARCHAR AS source WHERE false)"""
