"""The corpus pipeline stage by stage, and the queries that SQL can check."""

import duckdb
import numpy as np
import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

import corpus_pipeline
from regweave.llm import decontam, load_queries, simhash

SF = "/root/testdata/sf0.01"


def test_stages_take_effect_on_their_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
        if name == "near_duplicates":
            prints = np.array([simhash.fingerprint((r.text or "").encode()) for r in after.select("text").collect()], np.uint64)
            assert all((np.bitwise_count(prints ^ p) <= 2).sum() == 1 for p in prints)
        if name == "benchmark":
            assert decontam.contaminated(after, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0 < docs.count() - after.count()
        docs = after
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))


def test_stages_handle_nulls_ties_and_empty_tables(spark, tmp_path):
    rows = [(1, "same text of a few words here", "en"), (1, "same text of a few words here", "en"), (2, None, None), (None, "", None),
            (3, "other " * 5000 + "x" * 9000, "en"), (4, "12 34", "en"), (5, "same text of a few words here", "fr")]
    for n, data in ((0, rows), (1, [])):
        docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string").withColumns({"_id": F.lit(1), "fp": F.lit("a"), "root": F.lit(2)})
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, "/root/testdata/sf0.001").write.parquet(str(tmp_path / f"{n}{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{n}{name}"))
        assert sorted(r.doc_id for r in docs.collect()) == ([1, 3] if data else [])


def test_the_language_stage_uses_its_verdict(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    blank = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, None).otherwise(F.col("lang")))
    after = corpus_pipeline.language(spark, blank, SF)
    got, given = {r.doc_id: r.lang for r in after.collect()}, {r.doc_id: r.lang for r in docs.collect()}
    filled = [d for d in got if d % 3 == 0]
    assert None not in got.values() and sum(got[d] == given[d] for d in filled) >= 0.98 * len(filled)
    assert all(got[d] == given[d] for d in got if d % 3)
    # Without labels, or without the column, nothing is rejected.
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, none, SF).count() == docs.count() == corpus_pipeline.language(spark, docs.drop("lang"), SF).count()


def test_near_duplicates_are_what_op1_or_the_exact_pass_links(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in rng.integers(0, 5000, 200)]
    often = "alpha beta gamma " * 2000
    rows = [(1, often), (2, often + " ".join(f"x{i}" for i in range(30))),  # equal fingerprints, Jaccard 0.1
            (3, " ".join(words)), (4, " ".join([*words[:190], *"a b c d e f g h i j".split()])),  # Jaccard 0.9, many bits apart
            (5, "another text of its own"), (None, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    ids = lambda pairs: {r.doc_id for r in pairs.collect() if r.component != r.doc_id and r.doc_id is not None}
    assert 2 in ids(simhash.near_duplicates(docs)) and 4 not in ids(simhash.near_duplicates(docs))
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()) == [1, 3, 5, 6]


def test_near_duplicates_give_no_text_back_and_feed_no_worker_from_another(spark, monkeypatch):
    plans = []

    def recorded(frame, run, schema, *rest, call=DataFrame.mapInArrow):
        out = call(frame, run, schema, *rest)
        plans.append((frame._jdf.queryExecution().analyzed().toString().count("MapInArrow"), [c for c in out.columns if "text" in c]))
        return out

    monkeypatch.setattr(DataFrame, "mapInArrow", recorded)
    rows = [(i, f"{'shared words of two texts ' * 9} {i // 2} " + "more of them", "x") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())[0] == 0
    assert plans and all(plan == (0, []) for plan in plans)


@pytest.mark.parametrize("name", sorted(load_queries()[1]))
def test_sql_gives_the_same_rows(spark, name):
    queries, oracles = load_queries()
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = con.execute(oracles[name])
    columns = [d[0] for d in want.description]
    rows = queries[name](spark, SF).select(columns).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want.fetchall()))


def test_near_duplicates_broadcasts_no_exploded_prints(spark, monkeypatch):
    plans, stored = [], simhash.stored

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    monkeypatch.setattr(simhash, "stored", watched)
    docs = spark.createDataFrame([(i, f"one two three four five six {i}") for i in range(30)], "doc_id bigint, text string")
    assert 0 < corpus_pipeline.near_duplicates(spark, docs, SF).count() <= 30
    assert any("Generate" in p for p in plans) and not any("BroadcastHashJoin [v" in p for p in plans)
