"""The opt-in policy of builds: sources, activity flags and summits."""

import pytest
from pyspark.sql import functions as F

from regweave import schemas
from regweave.operators.guards import GateError
from regweave.plans import builds
from regweave.plans.policy import Policy
from regweave.sources import base


def stream(spark, tag, *calls):
    rows = spark.createDataFrame([(c, i) for i, c in enumerate(calls)], "c string, i bigint").withColumn("_ord", base.table_order("i"))
    return base.records(rows, tag, None, callsign=F.col("c"))


def test_sources_are_chosen_or_refused():
    assert Policy().choose(["fcc", "nmhh", "uke"]) == ["fcc", "uke"]
    assert Policy(True).choose(["fcc", "nmhh", "uke"]) == ["fcc", "nmhh", "uke"]
    assert Policy(True).choose(["fcc", "nmhh"], ["nmhh"]) == ["nmhh"]
    for wanted in (["nmhh"], ["xyz"]):
        with pytest.raises(GateError):
            Policy().choose(["fcc", "nmhh"], wanted)


def test_rows_and_activity_need_the_opt_in(spark):
    streams = [stream(spark, "fcc", "K1", "K2"), stream(spark, "nmhh", "HA1", "K1")]
    look = builds.Lookups(activity=spark.createDataFrame([("K1", "2026-01-01")], "callsign string, day string"))
    closed = builds.build_registry(streams, look, builds.Prior(), "2026-02-01")
    got = {r.callsign: (r.source, r.uses_lotw, r.lotw_last_activity) for r in closed.current.collect()}
    assert got == {"K1": ("fcc", False, None), "K2": ("fcc", False, None)}
    assert closed.report == [("activity", "refused", "restricted")]
    assert {r.source for r in closed.history.collect()} == {"fcc"}
    opened = builds.build_registry(streams, look, builds.Prior(), "2026-02-01", include_restricted=True)
    got = {r.callsign: (r.source, r.uses_lotw, r.lotw_last_activity) for r in opened.current.collect()}
    assert got == {"K1": ("fcc", True, "2026-01-01"), "K2": ("fcc", False, None), "HA1": ("nmhh", False, None)} and opened.report == []


def test_a_row_without_a_source_is_kept(spark):
    rows = spark.createDataFrame([("a", None), ("b", "nmhh"), ("c", "fcc")], "k string, source string")
    assert sorted(r.k for r in Policy().rows(rows).collect()) == ["a", "c"]


@pytest.mark.parametrize("opened", [False, True])
def test_summits_are_written_with_the_opt_in_only(spark, tmp_path, opened):
    parks = spark.createDataFrame([("CA-1", "P", "CA", 44.0, -116.0)], "reference string, name string, country string, lat double, lon double")
    none = spark.createDataFrame([], "feature_id string, unit_name string, local_name string, tags map<string,string>, rings array<struct<part:int,ring:array<struct<lon:double,lat:double>>>>")
    summits = schemas.conform(spark.createDataFrame([("G/LD-001",)], "reference string"), schemas.SUMMIT)
    report = builds.write_parks(parks, none, None, str(tmp_path / "p"), summits=summits, include_restricted=opened)
    assert (tmp_path / "p" / "summits").exists() is opened
    assert report == ([] if opened else [("summits", "refused", "restricted")])


def test_a_failing_cluster_is_no_failing_source(spark):
    def lost():
        raise RuntimeError("java.lang.OutOfMemoryError: Java heap space")

    with pytest.raises(RuntimeError):
        builds.collect_streams({"fcc": lambda: stream(spark, "fcc", "K1"), "ised": lost})
