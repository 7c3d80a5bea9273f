"""Plan properties that matter on a cluster: one shuffle of the records, bucketed folds,
skewed keys split, no group in one task."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from regweave import schemas, sinks
from regweave.operators import enrich, history
from regweave.plans import builds
from regweave.sources import base


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they look when every side is too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k, None) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in zip(keys, old):
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def explain(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored_records(spark, n, path):
    rows = spark.range(n).select(F.concat(F.lit("K"), F.col("id")).alias("callsign"), F.lit("fcc").alias("source"),
                                 F.upper(F.concat(F.lit("name "), F.col("id"))).alias("last_name"), base.table_order("id"))
    base.records(rows, "fcc", None, callsign=F.col("callsign"), last_name=F.col("last_name")).write.parquet(path)
    return spark.read.parquet(path)


def test_records_are_shuffled_once(no_broadcast, tmp_path):
    spark = no_broadcast
    streams = [stored_records(spark, 300, str(tmp_path / "a")), stored_records(spark, 500, str(tmp_path / "b"))]
    nodes = spark.range(100).select(F.concat(F.lit("K"), F.col("id")).alias("callsign"), F.col("id").alias("node"))
    activity = nodes.select("callsign", F.lit("2026-01-01").alias("day"))
    out = builds.build_current(streams, builds.Lookups(nodes=nodes, activity=activity), include_restricted=True)
    plan = explain(out)
    # One exchange for the merge, two for the node lists, one for the activity dates; the
    # two sort-merge joins take the records as the merge left them.
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("Exchange hashpartitioning") == 4, plan
    assert out.count() == 500


def test_bucketed_fold_needs_no_shuffle(no_broadcast, tmp_path):
    spark = no_broadcast
    names = [f"t{uuid.uuid4().hex}" for _ in range(2)]
    current = stored_records(spark, 400, str(tmp_path / "c")).drop("_ord")
    h = history.fold_snapshot(spark.createDataFrame([], schemas.HISTORY), current, "2026-01-01")
    old = spark.conf.get("spark.sql.warehouse.dir")
    assert old
    try:
        sinks.write_bucketed(h, names[0], 8)
        sinks.write_bucketed(current, names[1], 8)
        fold = history.fold_snapshot(spark.table(names[0]), spark.table(names[1]), "2026-01-02")
        assert "Exchange hashpartitioning" not in explain(fold)
        assert fold.filter("valid_to is null").count() == 400
    finally:
        for n in names:
            spark.sql(f"drop table if exists {n}")


def test_skewed_join_is_split(no_broadcast, tmp_path):
    spark = no_broadcast
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(0, 60000, 1, 12).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("host"), F.col("id").cast("string").alias("id"))
        from regweave.operators.directory import link_mirrors

        servers = hot.select("id", F.col("host").alias("system"), F.lit(None).cast("string").alias("talkgroups"))
        mirrored = spark.range(0, 500).select(F.concat(F.lit("k"), F.col("id")).alias("system")).unionByName(spark.createDataFrame([("hot",)], "system string"))
        out = link_mirrors(servers, mirrored)
        assert out.filter("talkgroups is not null").count() >= 20000
        rows = out.collect()
        assert len(rows) == 60000
        assert "skew" in explain(out).lower() or "AQEShuffleRead" in explain(out)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_pages_stay_bounded(spark):
    hot = spark.range(0, 50000).select(F.lit("hot").alias("key"), F.col("id").alias("n"))
    sizes = enrich.number_pages(hot, "key", "n", page=1000).select(F.size("numbers").alias("s")).collect()
    assert len(sizes) == 50 and max(r.s for r in sizes) == 1000


@pytest.mark.parametrize("minutes", [3000, 1])
def test_as_of_splits_a_hot_key(spark, monkeypatch, minutes):
    """One key with all events, spread over time or at one instant, goes to all ranges alike."""
    hist = spark.createDataFrame([("hot", "2026-01-01 00:00", None, "x"), ("a", "2026-01-01 00:00", None, "y")], "callsign string, valid_from string, valid_to string, holder string")
    ev = spark.range(0, 3000).select("id", F.lit("hot").alias("callsign"), F.date_format(F.expr(f"timestamp'2026-01-01' + make_interval(0,0,0,0,0,int(id % {minutes}),0)"), "yyyy-MM-dd HH:mm").alias("at"))
    seen, stored = [], history.stored
    monkeypatch.setattr(history, "stored", lambda df: seen.append(stored(df)) or seen[-1])
    out = history.attribute_as_of(ev, hist, "callsign", "at", ["holder"], partitions=12)
    assert out.filter("holder = 'x'").count() == 3000 == out.count()
    sizes = [r["count"] for r in seen[0].filter("not _start").groupBy("_part").count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 3 * 3000 / 12
    assert not re.search(r"Window \[[^\]]*\], \[_k", explain(out))


def test_state_is_carried_over_blocks_and_long_islands_are_joined_in_pieces(spark):
    from regweave.operators import assemble

    rows = [("d", i, "A" if i == 3 else "B" if i == 50 else None) for i in range(100)] + [("e", i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "doc string, at bigint, v string")
    got = {(r.doc, r.at): r.now for r in assemble.carry_last(df, ["doc"], "at", "v", "now", block_rows=7).collect()}
    assert got == {(d, i): None if d == "e" or i < 3 else "A" if i < 50 else "B" for d, i, _ in rows}
    words = [f"w{i}-" if i % 9 == 4 else f"w{i}" for i in range(1000)]
    lines = spark.createDataFrame([("x", i, w) for i, w in enumerate(words)], "k string, at bigint, w string")
    want = " ".join(words).replace("- ", "-")
    for piece in (1, 16, 5000):
        row = assemble.join_lines(lines, ["k"], "at", "w", piece).first()
        assert row.entry_text == want and row.n_lines == 1000


def scanned(df):
    """Rows that the scans of a query handed on."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_a_look_up_reads_one_row_group(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(0, 200_000).select(F.format_string("K%07d", F.pmod(F.col("id") * 7919, F.lit(200_000))).alias("callsign"), F.col("id"), F.md5(F.col("id").cast("string")).alias("name"))
    sinks.write_sorted(rows, str(tmp_path / "t"), ["callsign"], partitions=4, lookup="name", block_bytes=400_000)
    groups = sum(pq.ParquetFile(f).num_row_groups for f in (tmp_path / "t").glob("*.parquet"))
    assert groups >= 8
    table = spark.read.parquet(str(tmp_path / "t"))
    for column in ("callsign", "name"):
        value = table.filter("id = 777").first()[column]
        found = table.filter(F.col(column) == value)
        assert [r.id for r in found.collect()] == [777] and scanned(found) <= 1.5 * 200_000 / groups
    absent = table.filter(F.col("name") == "0" * 32)
    assert absent.collect() == [] and scanned(absent) <= 1.5 * 200_000 / groups


def test_exploded_rows_and_packed_grids_are_not_broadcast(spark):
    """Probes of points and lists of grids are far larger than Spark sizes them; they must not pass through the driver."""
    from regweave.operators import spatial

    ring = [(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0)]
    shapes = spark.createDataFrame([("f", "Range 1", None, {}, [(0, ring)])], "feature_id string, unit_name string, local_name string, "
                                   "tags map<string,string>, rings array<struct<part:int,ring:array<struct<lon:double,lat:double>>>>")
    points = spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit("Range 1").alias("name"), F.lit(4.0).alias("lat"), (F.col("id") / 5).alias("lon"))
    found = spatial.points_in_features(points, "k", shapes)
    assert "BroadcastHashJoin [level" not in explain(found) and "Generate" in explain(found)
    assert found.count() == 41
    owners, groups = spatial.matched_sets(points, "k", shapes)
    grids = spatial.grids_of(owners, groups, "k", "s")
    assert "BroadcastHashJoin" not in explain(grids)
    assert {tuple(r) for r in grids.groupBy("k").agg(F.count("*")).collect()} == {(str(i), 32) for i in range(41)}
