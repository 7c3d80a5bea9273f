"""Fold dated snapshots into the history as they arrive.

The history store is the state, so the stream itself needs none.  A micro-batch folds its days in order, each with a
commit of its own named after batch and day: a batch that is replayed after a failure skips the days it had folded and
goes on with the others.  A day older than the last folded one is put aside; the stream goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from regweave import schemas
from regweave.history_store import HistoryStore


def latest_history(spark: SparkSession, root: str) -> DataFrame:
    """Newest committed history."""
    return HistoryStore(spark, root).rows()


def fold_batch(root: str):
    """``foreachBatch`` function that folds every ``as_of`` of the batch in date order."""

    def run(batch: DataFrame, batch_id: int) -> None:
        store = HistoryStore(batch.sparkSession, root)
        # Distinct snapshot dates of one batch: a handful of folder names.
        for day in sorted(r[0] for r in batch.select("as_of").distinct().collect()):
            last, name = store.manifest(), f"{batch_id}:{day}"
            # Days of this very batch that a first attempt has folded.
            if last.batch is not None and last.batch.split(":", 1)[0] == str(batch_id) and day <= last.batch.split(":", 1)[1]:
                continue
            rows = batch.filter(F.col("as_of") == day).drop("as_of")
            if last.as_of is not None and day < last.as_of:
                store.quarantine(rows, day, str(batch_id))
            else:
                store.fold(rows, day, name)

    return run


def stream_history(spark: SparkSession, snapshots: str, root: str, checkpoint: str) -> StreamingQuery:
    """Start the fold over ``snapshots/as_of=YYYY-MM-DD`` folders until caught up."""
    schema = T.StructType([*schemas.RECORD.fields, T.StructField("as_of", T.StringType())])
    source = spark.readStream.schema(schema).parquet(snapshots).withColumn("as_of", F.col("as_of").cast("string"))
    return (
        source.writeStream.foreachBatch(fold_batch(root))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
