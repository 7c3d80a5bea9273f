"""Publishing behind gates that the write measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.plans.catalog import Tables, query
from regweave.plans.inputs import scratch
from regweave.publish import Dataset, Publication, all_present, floor, not_shrunk, only_source, rejected_share, shaped


def _published(t: Tables) -> Publication:
    """Two builds: the second loses a network, has a foreign row, odd nodes, and fewer events than before."""
    out = Publication(t.spark, scratch(t.spark))
    k = F.col("p_partkey")
    network = F.element_at(F.array(F.lit("dstar"), F.lit("m17"), F.lit("ysf")), (k % 3 + 1).cast("int"))
    for build in (1, 2):
        second = F.lit(build == 2)
        reflectors = t.part.select(k.alias("id"), F.when(second & (network == "m17"), "ysf").otherwise(network).alias("network"))
        grids = t.supplier.select(F.col("s_suppkey").alias("reference"), F.when(second & (F.col("s_suppkey") % 50 == 7), "pota").otherwise("osm").alias("source"))
        nodes = t.lineitem.select(F.when(second & (F.col("l_partkey") % 10 == 0), F.concat("l_orderkey", F.lit("a"))).otherwise(F.col("l_orderkey").cast("string")).alias("node"))
        events = t.events.filter(~second | (F.col("event_type") != "view") & (F.col("event_type") != "click"))
        calls = t.orders.select(F.col("o_orderkey").alias("key"), (F.col("o_custkey") % 1000 == 0).alias("rejected"))
        out.publish([
            Dataset("reflectors", lambda r=reflectors: r, [all_present("network", ["dstar", "m17", "ysf"]), floor(10)], ("id", "network")),
            Dataset("grids", lambda r=grids: r, [only_source("osm")]), Dataset("nodes", lambda r=nodes: r, [shaped("node", "^[0-9]+$")]),
            Dataset("events", lambda r=events: r, [not_shrunk()]), Dataset("calls", lambda r=calls: r, [rejected_share("rejected", 0.5), not_shrunk()]),
            Dataset("parks", lambda r=grids: r, [], ("reference", "grid")),
        ])
    return out


@query("publish_report", """
SELECT 'reflectors' AS dataset, 'kept' AS status, 'all_present: missing m17' AS reason, (SELECT count(*) FROM part) AS in_use
UNION ALL SELECT 'grids', 'kept', 'only_source: ' || (SELECT count(*) FROM supplier WHERE s_suppkey % 50 = 7) || ' rows of pota', (SELECT count(*) FROM supplier)
UNION ALL SELECT 'nodes', 'kept', 'shaped: ' || (SELECT count(*) FROM lineitem WHERE l_partkey % 10 = 0) || ' values of node', (SELECT count(*) FROM lineitem)
UNION ALL SELECT 'events', 'kept', 'not_shrunk: ' || (SELECT count(*) FROM events WHERE event_type NOT IN ('view', 'click')) || ' rows, ' || (SELECT count(*) FROM events) || ' before', (SELECT count(*) FROM events)
UNION ALL SELECT 'calls', 'published', '', (SELECT count(*) FROM orders)
UNION ALL SELECT 'parks', 'missing', 'parks: missing column(s) grid', NULL""")
def publish_report(t: Tables) -> DataFrame:
    """What became of each dataset, and the rows that are in use after it."""
    out = _published(t)
    held = [out.read(n).agg(F.lit(n).alias("dataset"), F.count(F.lit(1)).alias("in_use")) for n in out.log.read()["datasets"]]
    counts = held[0]
    for more in held[1:]:
        counts = counts.unionByName(more)
    return out.report().join(counts, "dataset", "left")


@query("published_rows", "SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'dstar' WHEN 1 THEN 'm17' ELSE 'ysf' END AS network FROM part")
def published_rows(t: Tables) -> DataFrame:
    """The rows in use of a dataset whose second build was refused."""
    return _published(t).read("reflectors")
