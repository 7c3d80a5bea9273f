"""Training-data pipeline: language, recurring lines, near-duplicates, benchmark leaks, token ids.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regweave.llm import bpe, decontam, jaccard, langid, simhash, templates
from regweave.llm.components import components
from regweave.session import shared_folder, stored


def _apart(stage):
    """The stage over documents whose further columns have names that nothing in it uses; they get theirs back."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = [c if c in ("doc_id", "text", "lang", "n_chars") else f"__column{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*own), sf_dir).select(own).toDF(*docs.columns)

    return run


@_apart
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, a null ``lang`` replaced by the predicted one.

    Null texts and texts without a letter go; a given ``lang`` stays.  Without a ``lang`` column or without a
    labelled row there is no model, and all documents stay as they are.  Rows that repeat are kept, null ids too.
    """
    if "lang" not in docs.columns:
        return docs
    model = langid.fit(docs)
    if not model.languages:
        return docs
    judged = langid.predict(docs, model, pred="_lang", score="_score").filter("_lang <> 'und'")
    return judged.withColumn("lang", F.coalesce("lang", F.col("_lang").cast(docs.schema["lang"].dataType))).select(docs.columns)


@_apart
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of recurring templates; ``n_chars`` follows the text.

    Null and empty texts have no lines and stay, as do null ids and rows that repeat; an empty table stays empty.
    """
    out = templates.drop_recurring(docs).select(docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


@_apart
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id; of rows that share it, the first by text.

    Documents are linked by op1 (fingerprints of 3-word shingles at 2 or fewer differing bits) and, since it misses
    some of them, by an exact pass over all pairs with a 5-word Jaccard of 0.8 and more.  A group is what either links.
    """
    # Both passes name a text by a hash that Spark computes: neither is repeated to join them, and no document goes through Python for it.
    texts = docs.select(F.xxhash64("text").alias("own"), "text")
    prints = simhash.near_duplicates(texts, "own").select("own", F.xxhash64(F.lit("print"), "root").alias("a")).distinct()
    sets = jaccard.near_duplicates(texts, "own").select("own", "node", F.xxhash64(F.lit("set"), "root").alias("b")).distinct()
    rows = docs.groupBy(F.xxhash64("text").alias("own")).agg(F.min("doc_id").alias("least"))
    rows = stored(rows.join(prints, "own").join(sets, "own"))
    rows = rows.join(components(rows.select("a", "b").distinct()).withColumnRenamed("node", "a"), "a")
    groups = rows.join(rows.groupBy("root").agg(F.min("least").alias("component")), "root")
    keepers = groups.filter(F.col("least").eqNullSafe(F.col("component"))).groupBy("root", "least").agg(F.min(F.struct("node", "own")).alias("first"))
    # One key for the join and the window, so that whole documents are shuffled once.
    keepers = keepers.select(F.xxhash64("least", "first.own").alias("_key")).distinct()
    rows = docs.withColumn("_key", F.xxhash64("doc_id", F.xxhash64("text"))).join(keepers, "_key", "left_semi")
    first = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64(*docs.columns)))
    return rows.withColumn("_first", first).filter("_first = 1").select(docs.columns)


@_apart
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none; a null id is judged like any other, rows that share an id go or stay together.
    """
    found = decontam.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, as little-endian unsigned 32-bit integers, their count, and a digest of the decoded text.

    Null and empty texts have no ids; rows that repeat are kept; further columns are not read, whatever their names.
    """
    out = bpe.encode(docs)
    return out.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("token_ids", token_ids)]

#: Neither the parses against the automata nor the tokenizer can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{i}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
