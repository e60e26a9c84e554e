import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridelake.operators import load
from ridelake.session import scratch_path

SCHEMA = "id int, ts timestamp_ntz, v double, month date"


def _frame(spark, rows):
    return spark.createDataFrame(
        [(i, ts, v, None if ts is None else dt.date(ts.year, ts.month, 1)) for i, ts, v in rows],
        SCHEMA)


def _table(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("id", "ts", "v").collect())


def test_time_interval_replaces_only_the_window(spark):
    target = scratch_path(spark, "t-int")
    start, end = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2)
    base = [(1, start - dt.timedelta(seconds=1), 1.0), (2, start, 1.0),
            (3, end - dt.timedelta(microseconds=1), 1.0), (4, end, 1.0), (5, None, 1.0)]
    load.time_interval(_frame(spark, base), target, "ts", "2024-01-01", "2024-06-01", "month")
    assert len(_table(spark, target)) == 4          # NULL key is never in a window
    load.append(_frame(spark, [(5, None, 1.0)]).drop("month")
                .withColumn("month", F.lit(None).cast("date")), target, ["month"])
    new = [(2, start, 2.0), (6, start + dt.timedelta(hours=1), 2.0), (7, end, 9.0)]
    load.time_interval(_frame(spark, new), target, "ts", start, end, "month")
    got = _table(spark, target)
    assert (2, start, 2.0) in got and (6, start + dt.timedelta(hours=1), 2.0) in got
    assert (3, end - dt.timedelta(microseconds=1), 1.0) not in got   # deleted, not re-sent
    assert (4, end, 1.0) in got and (1, start - dt.timedelta(seconds=1), 1.0) in got
    assert (7, end, 9.0) not in got                  # outside the window: not inserted
    assert any(r[0] == 5 for r in got)               # NULL-key row kept


def test_time_interval_empty_rerun_removes_window_keeps_neighbours(spark):
    target = scratch_path(spark, "t-empty")
    rows = [(1, dt.datetime(2024, 3, 10), 1.0), (2, dt.datetime(2024, 4, 10), 1.0)]
    load.time_interval(_frame(spark, rows), target, "ts", "2024-01-01", "2025-01-01", "month")
    load.time_interval(_frame(spark, []), target, "ts", "2024-03-01", "2024-04-01", "month")
    assert [r[0] for r in _table(spark, target)] == [2]


def test_date_window_must_be_day_aligned(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 1))], "d date, month date")
    with pytest.raises(ValueError):
        load.time_interval(df, scratch_path(spark, "t-date"), "d", "2024-01-01 12:00:00",
                           "2024-01-02 00:00:00", "month", granularity="date")


def _cust(spark, rows):
    return spark.createDataFrame(rows, "k int, name string, bal double, seg string")


def test_delete_insert_and_merge(spark):
    old = [(1, "a", 1.0, "x"), (2, "b", 2.0, "x"), (3, "c", 3.0, "y")]
    new = [(2, "B", 20.0, "x"), (4, "d", 4.0, "x")]
    for strategy in ("delete_insert", "merge_all", "merge_balance"):
        target = scratch_path(spark, strategy)
        _cust(spark, old).write.partitionBy("seg").parquet(target)
        if strategy == "delete_insert":
            load.delete_insert(_cust(spark, new), target, ["k"], "seg")
        elif strategy == "merge_all":
            load.merge(_cust(spark, new), target, ["k"], "seg")
        else:
            load.merge(_cust(spark, new), target, ["k"], "seg", update_columns=["bal"])
        got = sorted(tuple(r) for r in spark.read.parquet(target).select("k", "name", "bal", "seg").collect())
        name2 = "b" if strategy == "merge_balance" else "B"
        assert got == [(1, "a", 1.0, "x"), (2, name2, 20.0, "x"), (3, "c", 3.0, "y"),
                       (4, "d", 4.0, "x")], strategy


def test_merge_rejects_repeated_source_keys(spark):
    target = scratch_path(spark, "merge-dup")
    _cust(spark, [(1, "a", 1.0, "x")]).write.partitionBy("seg").parquet(target)
    with pytest.raises(ValueError):
        load.merge(_cust(spark, [(1, "a", 1.0, "x"), (1, "b", 1.0, "x")]), target, ["k"], "seg")


def test_full_refresh_may_read_its_target(spark):
    target = scratch_path(spark, "refresh")
    _cust(spark, [(1, "a", 1.0, "x")]).write.parquet(target)
    doubled = spark.read.parquet(target).withColumn("bal", F.col("bal") * 2)
    load.full_refresh(doubled, target)
    assert spark.read.parquet(target).first()["bal"] == 2.0


def test_repartition_write_reports_files(spark, sf_dir):
    stats = load.repartition_write(spark.read.parquet(f"{sf_dir}/lineitem.parquet"),
                                   scratch_path(spark, "rp"), 4).first()
    assert stats["num_files"] == 4 and stats["avg_file_mb"] > 0


def _seg(spark, path):
    rows = spark.read.schema("k int, name string, bal double, seg string").parquet(path).collect()
    return sorted(map(tuple, rows), key=str)


def test_row_level_loads_lose_and_double_nothing(spark):
    old = [(1, "a", 1.0, None), (2, "b", 2.0, "007"), (3, "c", 3.0, "010"), (None, "n", 9.0, "007"),
           (5, "e", 5.0, "a/b=c")]
    new = [(2, "B", 20.0, "010"), (4, "d", 4.0, None), (None, "N", 8.0, None), (5, "E", 50.0, None)]
    for strategy in ("delete_insert", "merge"):
        target = scratch_path(spark, strategy)
        _cust(spark, old).write.partitionBy("seg").parquet(target)
        getattr(load, strategy)(_cust(spark, new), target, ["k"], "seg")
        assert _seg(spark, target) == sorted([old[0], old[2], old[3], *new], key=str), strategy
    target = scratch_path(spark, "update")
    _cust(spark, old).write.partitionBy("seg").parquet(target)
    load.merge(_cust(spark, new), target, ["k"], "seg", update_columns=["bal", "seg"])
    assert _seg(spark, target) == sorted(
        [old[0], (2, "b", 20.0, "010"), old[2], old[3], new[1], new[2], (5, "e", 50.0, None)], key=str)


def test_a_failed_write_leaves_the_old_table(spark):
    target = scratch_path(spark, "keeps")
    rows = [(1, "a", 1.0, "x"), (2, "b", 2.0, "y")]
    _cust(spark, rows).write.partitionBy("seg").parquet(target)
    bad = _cust(spark, rows).withColumn("bal", F.when(F.col("k") == 2, F.raise_error(F.lit("no")).cast("double")).otherwise(1.0))
    for strategy in (lambda: load.full_refresh(bad, target, ["seg"]),
                     lambda: load.delete_insert(bad, target, ["k"], "seg"),
                     lambda: load.merge(bad, target, ["k"], "seg")):
        with pytest.raises(Exception, match="no"):
            strategy()
        assert _seg(spark, target) == rows


def test_csv_names_of_any_kind(spark, tmp_path):
    for name in ("yellow/2019-01.csv", "green/2019-01.csv", "a=1#x.csv", "b %+[1].csv"):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("v\n" + name + "\n")
    out = str(tmp_path / "out")
    schema = spark.createDataFrame([], "v string").schema
    first = load.csv_to_parquet(spark, str(tmp_path / "in"), out, schema)
    assert sorted(first) == ["a=1#x", "b %+[1]", "green/2019-01", "yellow/2019-01"]
    assert load.csv_to_parquet(spark, str(tmp_path / "in"), out, schema) == []
    rows = spark.read.schema("v string, source string").parquet(out).collect()
    assert sorted(r.v for r in rows) == sorted(f"{r.source}.csv" for r in rows) and len(rows) == 4
