"""Streams with bounded state: nothing lost, own files only, state that does
not grow, repeated batches."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from ridelake.session import scratch_path
from ridelake.streaming import state as sst

SCHEMA = "event_id long, ts timestamp_ntz, kind_of string, value double"
DAY0 = dt.datetime(2024, 1, 1)


def _schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def _event(i, day, hour=0, kind="a"):
    return i, None if day is None else DAY0 + dt.timedelta(days=day, hours=hour), kind, 1.5


def _deliver(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _report(spark, paths, rows=None):
    src, out, late, ckpt = paths
    if rows:
        _deliver(spark, rows, src)
    return sst.daily_report_state(spark, src, out, late, ckpt, _schema(spark), "ts", "kind_of", "value", "2 days")


def _plain_report(rows):
    out = {}
    for _, ts, kind, value in rows:
        key = (ts and ts.date(), kind)
        n, s = out.get(key, (0, 0.0))
        out[key] = (n + 1, s + value)
    return sorted(((d, k, n, s) for (d, k), (n, s) in out.items()), key=str)


def _found(spark, paths):
    return sorted(map(tuple, sst.whole_report(spark, paths[1], paths[2], "kind_of").collect()), key=str)


def _undo_last_commit(ckpt):
    """As if the driver had died before the last batch with data was committed."""
    folder = ckpt.removeprefix("file:")
    last = max(int(os.path.basename(p)) for p in glob.glob(f"{folder}/commits/[0-9]*"))
    for p in glob.glob(f"{folder}/commits/{last}") + glob.glob(f"{folder}/commits/.{last}.crc"):
        os.remove(p)


def test_report_counts_every_row_and_reads_only_new_files(spark):
    paths = [scratch_path(spark, n) for n in ("r-src", "r-out", "r-late", "r-ckpt")]
    first = [_event(i, i % 20, i % 24, "ab"[i % 2]) for i in range(400)]
    # the open day again, closed days, no time, no group
    second = ([_event(1000 + i, 19, 3) for i in range(7)] + [_event(1100 + i, i % 5) for i in range(11)]
              + [_event(1200, None), _event(1201, 2, kind=None), _event(1202, 21, kind=None)])
    third = [_event(1300 + i, 3) for i in range(5)] + [_event(1400, 22), _event(1401, None, kind=None)]
    done = []
    for rows in (first, second, third):
        query = _report(spark, paths, rows)
        assert sum(p.numInputRows for p in query.recentProgress) == len(rows)  # own files only
        assert sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators) == 0
        done += rows
        assert _found(spark, paths) == _plain_report(done)
    _report(spark, paths)  # nothing new
    assert _found(spark, paths) == _plain_report(done)
    late = spark.read.parquet(paths[2])
    assert late.agg(F.sum("n_events")).first()[0] == 11 + 2 + 5 + 1  # closed days and rows without a time
    assert late.where("found_on IS NULL").count() == 0


def test_report_state_holds_open_days_only(spark):
    paths = [scratch_path(spark, n) for n in ("s-src", "s-out", "s-late", "s-ckpt")]
    for start in (0, 30, 60):
        query = _report(spark, paths, [_event(start * 10 + i, start + i % 30, kind="ab"[i % 2]) for i in range(300)])
        kept = query.recentProgress[-1].stateOperators[0].numRowsTotal
        assert kept <= 2 * 4  # two groups; the last day and the days of the delay


def test_repeated_report_batch_changes_nothing(spark):
    paths = [scratch_path(spark, n) for n in ("c-src", "c-out", "c-late", "c-ckpt")]
    first = [_event(i, i % 10) for i in range(100)]
    second = [_event(200 + i, i % 12) for i in range(60)]
    _report(spark, paths, first)
    _report(spark, paths, second)
    want = _plain_report(first + second)
    assert _found(spark, paths) == want
    _undo_last_commit(paths[3])
    _report(spark, paths)
    assert _found(spark, paths) == want


def _dedup(spark, paths, rows=None):
    src, out, ckpt = paths
    if rows:
        _deliver(spark, rows, src)
    return sst.dedup_state(spark, src, out, ckpt, _schema(spark), ["event_id"], "ts", "2 days")


def _ids(spark, paths):
    return sorted(sst.read_deduplicated(spark, paths[1], _schema(spark)).toPandas()["event_id"].astype(float).fillna(-1))


def test_dedup_keeps_late_first_copies_and_drops_late_repeats(spark):
    paths = [scratch_path(spark, n) for n in ("d-src", "d-out", "d-ckpt")]
    first = [_event(i, i // 10) for i in range(200)] * 2
    second = ([_event(i, i // 10) for i in range(0, 200, 3)]      # copies, most of them behind the watermark
              + [_event(500 + i, i % 8) for i in range(40)] * 2   # late first copies, twice
              + [_event(600, None), _event(600, None), _event(601, 25), _event(None, 1), _event(None, 24)])
    third = [_event(500 + i, i % 8) for i in range(40)] + [_event(700, 26), _event(None, 1), _event(600, None)]
    _dedup(spark, paths, first)
    assert _ids(spark, paths) == list(range(200))
    _dedup(spark, paths, second)
    want = sorted([*range(200), *range(500, 540), 600, 601, -1])
    assert _ids(spark, paths) == want
    query = _dedup(spark, paths, third)
    assert _ids(spark, paths) == sorted([*want, 700])
    # the state holds the keys of the delay, not all
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 10


def test_repeated_dedup_batch_changes_nothing(spark):
    paths = [scratch_path(spark, n) for n in ("e-src", "e-out", "e-ckpt")]
    _dedup(spark, paths, [_event(i, i) for i in range(20)])
    _dedup(spark, paths, [_event(i, i % 25) for i in range(40)])
    assert _ids(spark, paths) == list(range(40))
    _undo_last_commit(paths[2])
    _dedup(spark, paths)
    assert _ids(spark, paths) == list(range(40))


def test_state_does_not_grow_with_deliveries(spark):
    paths = [scratch_path(spark, n) for n in ("g-src", "g-out", "g-ckpt")]
    kept = []
    for k in range(3):
        _dedup(spark, paths, [_event(1000 * k + i, 30 * k + i // 20) for i in range(600)])
        kept.append(spark.read.format("statestore").load(paths[2]).count())
    # twenty keys a day: the days within twice the delay of the newest event
    assert kept == [20 * 4] * 3 and len(_ids(spark, paths)) == 1800


def test_no_files_yet(spark):
    paths = [scratch_path(spark, n) for n in ("n-src", "n-out", "n-ckpt")]
    spark.createDataFrame([], SCHEMA).write.parquet(paths[0])
    assert sst.watermark(spark, paths[2]) == sst.EPOCH
    _dedup(spark, paths)
    assert _ids(spark, paths) == []
