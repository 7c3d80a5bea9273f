"""Gates measured by the write, kept datasets, partial builds."""

import pytest
from pyspark.sql import functions as F

from regweave import publish
from regweave.operators.guards import GateError
from regweave.publish import Dataset, Publication


def grids(spark, *rows):
    return spark.createDataFrame(list(rows), "reference string, grid string, source string")


def test_gates_pass_fail_and_keep_the_last_good(spark, tmp_path):
    out = Publication(spark, str(tmp_path / "p"))
    good = grids(spark, ("A", "FN54", "osm"), ("B", "FN55", "osm"))
    nodes = spark.range(100).select(F.col("id").cast("string").alias("node"), F.lit(False).alias("bad"))
    node_gates = [publish.floor(50), publish.shaped("node", "^[0-9]+$"), publish.not_shrunk(), publish.rejected_share("bad", 0.005)]
    sets = lambda g, n: [Dataset("grids", lambda: g, [publish.only_source("osm")], ("reference", "grid")), Dataset("nodes", lambda: n, node_gates)]
    assert [r[:2] for r in out.publish(sets(good, nodes))] == [("grids", "published"), ("nodes", "published")]
    # A foreign source, and rows below the share of the last publication.
    report = out.publish(sets(grids(spark, ("A", "FN54", "osm"), ("C", "FN56", "pota"), ("D", "FN56", None)), spark.range(101).select(F.col("id").cast("string").alias("node"), F.lit(False).alias("bad"))))
    assert report == [("grids", "kept", "only_source: 2 rows of none"), ("nodes", "published", "")]
    assert out.read("grids").count() == 2 and out.read("nodes").count() == 101
    with pytest.raises(GateError, match="nothing to publish"):
        out.publish(sets(grids(spark, ("A", "FN54", "x")), nodes.limit(60)))
    assert out.read("nodes").count() == 101 and out.log.newest() == 2
    assert sorted(map(tuple, out.report().collect())) == sorted(report)
    # Missing column, flagged rows, odd ids: all seen before or by the one write.
    report = out.publish([*sets(good.drop("grid"), nodes.withColumn("bad", F.col("node") == "7")), Dataset("more", lambda: good, [publish.declared(2)])])
    assert [r[1] for r in report] == ["kept", "kept", "published"] and "grid" in report[0][2] and "1 of 100 rows rejected" in report[1][2]
    report = out.publish([Dataset("nodes", lambda: nodes.union(spark.createDataFrame([("x", False), (None, False)], "node string, bad boolean")), node_gates),
                          Dataset("new", lambda: good, [publish.declared(20), publish.all_present("source", ["osm", "pad"])]), Dataset("ok", lambda: good, [publish.declared(11, 0.01)])])
    assert report == [("nodes", "kept", "shaped: 2 values of node"), ("new", "missing", "declared: 2 rows, 20 declared; all_present: missing pad"), ("ok", "published", "")]


def test_an_empty_dataset_is_measured(spark, tmp_path):
    out = Publication(spark, str(tmp_path / "p"))
    none = grids(spark).filter("false")
    assert out.publish([Dataset("grids", lambda: none, [publish.only_source("osm")]), Dataset("full", lambda: none, [publish.floor(1)])]) == [
        ("grids", "published", ""), ("full", "missing", "floor: 0 rows, expected 1")]


def test_a_gate_costs_no_job(spark, tmp_path):
    jobs = []
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("gated", "one write")
    out = Publication(spark, str(tmp_path / "p"))
    out.publish([Dataset("g", lambda: spark.range(1000).withColumn("source", F.lit("osm")), [publish.only_source("osm"), publish.floor(5), publish.shaped("id", "^[0-9]+$")])])
    jobs = tracker.getJobIdsForGroup("gated")
    spark.sparkContext._jsc.clearJobGroup()
    assert len(jobs) == 1
