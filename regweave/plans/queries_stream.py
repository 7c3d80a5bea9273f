"""Streaming query: dated snapshots folded one micro-batch at a time."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.history_store import HistoryStore
from regweave.plans.catalog import Tables, query
from regweave.plans.inputs import EMPTY_HISTORY_SQL, customer_state, fold_sql, state_sql
from regweave.plans.queries_registry import CUT1, CUT2, CUT3, HCOLS, HSQL
from regweave.session import shared_folder
from regweave.streaming.snapshots import latest_history, stream_history

_SQL = ",".join([
    EMPTY_HISTORY_SQL, state_sql("s1", CUT1), state_sql("s2", CUT2), state_sql("s3", CUT3), fold_sql("h1", "h0", "s1", CUT1),
    fold_sql("h2", "h1", "s2", CUT2), fold_sql("h3", "h2", "s3", CUT3),
])


@query("snapshot_stream", f"WITH {_SQL} SELECT {HSQL} FROM h3")
def snapshot_stream(t: Tables) -> DataFrame:
    """Two snapshots arrive and are folded, then a third in a second run of the stream."""
    root = f"{shared_folder(t.spark)}/regweave-stream-{uuid.uuid4().hex}"
    for cuts in ((CUT1, CUT2), (CUT3,)):
        for cut in cuts:
            state = customer_state(t, cut).withColumn("as_of", F.lit(cut))
            state.write.mode("append").partitionBy("as_of").parquet(f"{root}/in")
        stream_history(t.spark, f"{root}/in", f"{root}/history", f"{root}/state").awaitTermination()
    return latest_history(t.spark, f"{root}/history").select(*HCOLS)


def _stored_history(t: Tables) -> HistoryStore:
    store = HistoryStore(t.spark, f"{shared_folder(t.spark)}/regweave-history-{uuid.uuid4().hex}")
    for cut in (CUT1, CUT2, CUT3):
        store.fold(customer_state(t, cut), cut, batch=cut)
    return store


@query("history_store", f"WITH {_SQL} SELECT {HSQL} FROM h3")
def history_store(t: Tables) -> DataFrame:
    """Three snapshots folded into a history that is only appended to."""
    return _stored_history(t).rows().select(*HCOLS)


@query("history_valid_on", f"WITH {_SQL} SELECT {HSQL} FROM h3 WHERE valid_from <= '{CUT2}' AND (valid_to IS NULL OR valid_to > '{CUT2}')")
def history_valid_on(t: Tables) -> DataFrame:
    """Holders on a day: folders of intervals that had ended by then are not read."""
    return _stored_history(t).valid_on(CUT2).select(*HCOLS)
