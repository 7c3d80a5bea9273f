"""The append-only history: equal to the plain fold, nothing written twice, recovery, late days."""

import os
import random

import pytest
from pyspark.sql import functions as F

from regweave import schemas
from regweave.history_store import HistoryStore
from regweave.operators.history import fold_snapshot
from regweave.streaming.snapshots import fold_batch, latest_history

DAYS = ["2026-01-01", "2026-01-02", "2026-01-05", "2026-01-09"]


def snapshot(spark, seed, n=60):
    rng = random.Random(seed)
    rows = [(f"K{i}", rng.choice(["A", "B", None]), rng.choice(["x", "y"])) for i in range(n) if rng.random() < 0.8]
    return spark.createDataFrame(rows, "callsign string, last_name string, city string")


def rows_of(df):
    return sorted(map(repr, map(tuple, schemas.conform(df, schemas.HISTORY).collect())))


def files(root):
    out = {}
    for folder, _, names in os.walk(root):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                out[os.path.relpath(path, root)] = (os.stat(path).st_mtime_ns, os.stat(path).st_size)
    return out


def test_folds_equal_the_plain_history_and_write_no_closed_file_twice(spark, tmp_path):
    store, plain = HistoryStore(spark, str(tmp_path / "h")), spark.createDataFrame([], schemas.HISTORY)
    seen = {}
    for i, day in enumerate(DAYS):
        snap = snapshot(spark, i)
        store.fold(snap, day)
        plain = spark.createDataFrame(fold_snapshot(plain, snap, day).collect(), schemas.HISTORY)
        assert rows_of(store.rows()) == rows_of(plain)
        now = files(tmp_path / "h")
        assert all(now[f] == v for f, v in seen.items())
        # A fold adds the files of one closing day and of one open set, whatever the length of the history.
        assert all(f"fold={i + 1:08d}" in f and (f"day={day}" in f or "day=open" in f) for f in now.keys() - seen.keys())
        seen = now
    assert store.open_rows().filter("valid_to is not null").count() == 0 == store.closed_rows().filter("valid_to is null").count()
    assert rows_of(store.rows(2)) != rows_of(store.rows()) and store.manifest(2).as_of == DAYS[1]
    day = "2026-01-03"
    assert rows_of(store.valid_on(day)) == rows_of(plain.filter(f"valid_from <= '{day}' and (valid_to is null or valid_to > '{day}')"))
    assert len(store.closed_rows(since="2026-01-09").inputFiles()) < len(store.closed_rows().inputFiles())


def test_a_fold_that_died_is_repeated_and_a_repeated_one_is_skipped(spark, tmp_path, monkeypatch):
    store = HistoryStore(spark, str(tmp_path / "h"))
    store.fold(snapshot(spark, 1), DAYS[0], "a")
    before = rows_of(store.rows())
    with monkeypatch.context() as m:
        m.setattr(HistoryStore, "_commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            store.fold(snapshot(spark, 2), DAYS[1], "b")
    # The data was written, the manifest was not: readers see the old version.
    assert rows_of(HistoryStore(spark, store.root).rows()) == before
    done = store.fold(snapshot(spark, 2), DAYS[1], "b")
    assert done.version == 2 and store.fold(snapshot(spark, 3), DAYS[1], "b") == done
    want = fold_snapshot(fold_snapshot(spark.createDataFrame([], schemas.HISTORY), snapshot(spark, 1), DAYS[0]), snapshot(spark, 2), DAYS[1])
    assert rows_of(store.rows()) == rows_of(want)
    with pytest.raises(ValueError):
        store.fold(snapshot(spark, 3), DAYS[0])
    other = HistoryStore(spark, store.root)
    with pytest.raises(RuntimeError):
        other._commit(done)


def test_batches_are_replayed_and_late_days_put_aside(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "h")
    days = {d: snapshot(spark, i).withColumn("as_of", F.lit(d)) for i, d in enumerate(DAYS)}
    both = days[DAYS[1]].unionByName(days[DAYS[2]])
    run, commit, calls = fold_batch(root), HistoryStore._commit, []
    run(days[DAYS[0]], 0)
    with monkeypatch.context() as m:
        m.setattr(HistoryStore, "_commit", lambda self, x: calls.append(x) or (commit(self, x) if len(calls) == 1 else (_ for _ in ()).throw(OSError("gone"))))
        with pytest.raises(OSError):
            run(both, 1)
    assert HistoryStore(spark, root).manifest().batch == f"1:{DAYS[1]}"
    run(both, 1)
    run(both, 1)
    plain = spark.createDataFrame([], schemas.HISTORY)
    for d in DAYS[:3]:
        plain = fold_snapshot(plain, days[d].drop("as_of"), d)
    assert rows_of(latest_history(spark, root)) == rows_of(plain) and HistoryStore(spark, root).manifest().version == 3
    late = snapshot(spark, 9).withColumn("as_of", F.lit("2026-01-03"))
    run(late.unionByName(days[DAYS[3]]), 2)
    run(late.unionByName(days[DAYS[3]]), 2)
    store = HistoryStore(spark, root)
    assert rows_of(store.rows()) == rows_of(fold_snapshot(plain, days[DAYS[3]].drop("as_of"), DAYS[3]))
    assert store.late_rows().count() == late.count() and len(store.manifest().late) == 1
