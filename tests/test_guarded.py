"""Loads under checks, quarantine, and CSV conversion as a stream."""

import os

import pytest
from pyspark.sql import functions as F

from ridelake.operators import checks as ck
from ridelake.operators import guarded
from ridelake.plans import quality
from ridelake.session import scratch_path
from ridelake.sources import fs
from ridelake.streaming import convert

SCHEMA = "k int, part string, v double"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------------- loads under checks

def test_failing_check_leaves_the_table_as_it_was(spark):
    target = scratch_path(spark, "guard-test")
    good = [(1, "a", 1.0), (2, None, 2.0), (3, "b", None)]
    checks = [ck.not_null("k"), ck.positive("v"), ck.unique("k"),
              ck.sql_equals("few", "SELECT COUNT(*) < 10 FROM {src}", True)]
    assert all(r.passed for r in guarded.checked_refresh(_frame(spark, good), target, checks, "t").collect())
    bad = {
        "not_null": [(None, "a", 1.0)], "positive": [(1, "a", 0.0)], "unique": [(1, "a", 1.0), (1, "b", 1.0)],
        "few": [(i, "a", 1.0) for i in range(10)],
    }
    for name, rows in bad.items():
        found = {r.check_name: (r.failures, r.passed) for r in
                 guarded.checked_refresh(_frame(spark, rows), target, checks, "t").collect()}
        assert found.pop(name) == (1, False) and all(ok for _, ok in found.values())
        assert _rows(spark.read.parquet(target)) == sorted(good, key=str)
    parent, _, base = target.rpartition("/")
    assert not [n for n in fs.list_names(spark, parent) if n.startswith(f"_{base}")]  # nothing left beside it


def test_row_checks_share_the_pass_that_writes(spark):
    """The rows are computed once: a counter in the source says so."""
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    df = _frame(spark, [(i, "ab"[i % 2], float(i)) for i in range(100)]).repartition(4).mapInArrow(count, SCHEMA)
    checks = [ck.not_null("k"), ck.non_negative("v"), ck.positive("v"), ck.accepted_values("part", ["a"])]
    target = scratch_path(spark, "once")
    found = {r.check_name: r.failures for r in guarded.checked_refresh(df, target, checks, partition_by=["part"]).collect()}
    assert found == {"not_null": 0, "non_negative": 0, "positive": 1, "accepted_values": 50}
    assert calls.value == 100
    assert not fs.exists(spark, target)  # nothing was there, nothing is


def test_empty_load_under_checks(spark):
    target = scratch_path(spark, "guard-empty")
    assert guarded.checked_refresh(_frame(spark, []), target, [ck.not_null("k"), ck.unique("k")]).where("passed").count() == 2
    assert guarded.checked_refresh(_frame(spark, [(1, "a", 1.0)]), target, []).count() == 0
    assert spark.read.schema(SCHEMA).parquet(target).count() == 1


# ------------------------------------------------------------------- quarantine

def test_quarantine_splits_every_row_once(spark):
    rows = [(1, "a", 1.0), (1, "a", -2.0), (2, None, 3.0), (None, "x", 4.0), (None, "x", None), (3, "b", -1.0),
            (4, "c", 5.0), (5, None, 1.0), (5, "", 1.0)]
    checks = [ck.non_negative("v"), ck.unique("k", "part"), ck.accepted_values("part", ["a", "b", "x", ""])]
    ok, bad = guarded.quarantine(_frame(spark, rows), checks, scratch_path(spark, "split"))
    want = {(1, "a", 1.0): ["unique(k,part)"], (1, "a", -2.0): ["non_negative(v)", "unique(k,part)"],
            (None, "x", 4.0): ["unique(k,part)"], (None, "x", None): ["unique(k,part)"],
            (3, "b", -1.0): ["non_negative(v)"], (4, "c", 5.0): ["accepted_values(part)"]}
    assert {tuple(r)[:3]: r.failed_checks for r in bad.collect()} == want
    assert _rows(ok) == sorted([r for r in rows if r not in want], key=str)
    assert ok.columns == ["k", "part", "v"]
    for name in ("accepted", "failed_checks"):
        with pytest.raises(ValueError):
            guarded.quarantine(_frame(spark, rows).withColumn(name, F.lit(1)), checks, scratch_path(spark, "x"))


def test_quarantine_of_nothing_and_without_checks(spark):
    ok, bad = guarded.quarantine(_frame(spark, []), [ck.unique("k")], scratch_path(spark, "none"))
    assert ok.count() == bad.count() == 0
    ok, bad = guarded.quarantine(_frame(spark, [(1, "a", 1.0)]), [], scratch_path(spark, "free"))
    assert (ok.count(), bad.count()) == (1, 0)


def test_repeated_keys_under_a_hot_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                                    F.col("id").alias("v"))
    assert [r[0] for r in guarded.repeated_keys(df, ["k"]).collect()] == [-1]
    ok, bad = guarded.quarantine(df, [ck.unique("k")], scratch_path(spark, "hot"))
    assert (ok.count(), bad.count()) == (20_000, 10_000)
    # what is exchanged before suspects are known is hashes and counts, not keys
    plan = guarded.repeated_keys(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "_hash" in plan


@pytest.mark.parametrize("limit", [None, "0"])
def test_rows_stay_in_place_for_few_repeated_keys(spark, limit):
    """Files and estimates are above the planner's bound, but the repeated keys
    are few: no row is shuffled to them.  Under a bound of 0 all rows are."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "ridelake.broadcast.maxBytes")
    old = {n: spark.conf.get(n, None) for n in names}
    path = scratch_path(spark, "few")
    rows = [(i, f"p{i}", float(i)) for i in range(2000)] + [(7, "p7", -1.0), (None, "x", 1.0), (None, "x", 2.0),
            (8, None, 1.0), (8, "", 1.0), (None, None, 0.0), (None, None, 0.0)]
    _frame(spark, rows).write.parquet(path)
    checks = [ck.non_negative("v"), ck.unique("k", "part")]
    try:
        spark.conf.set(names[0], "100")
        if limit is not None:
            spark.conf.set(names[1], limit)
        df = spark.read.schema(SCHEMA).parquet(path)
        marked = guarded.mark_failures(df, checks)
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert ("hashpartitioning" in plan) == (limit is not None)
        ok, bad = guarded.quarantine(df, checks, scratch_path(spark, "few-split"))
        again = [r for r in rows if r[:2] in {(7, "p7"), (None, "x"), (None, None)}]
        assert _rows(bad.drop("failed_checks")) == sorted(again, key=str)
        assert _rows(bad.where("size(failed_checks) = 2").select("v")) == [(-1.0,)]
        assert _rows(ok) == sorted([r for r in rows if r not in again], key=str)
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"  # as before the split
    finally:
        for n, v in old.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_equal_hashes_of_different_keys_are_no_repeat(spark):
    """A NULL does not change the hash, so these keys share one."""
    df = spark.createDataFrame([(1, "a", None), (2, None, "a"), (3, "b", None), (4, "b", None)], "n int, x string, y string")
    assert df.select(F.xxhash64("x", "y")).distinct().count() == 2
    ok, bad = guarded.quarantine(df, [ck.unique("x", "y")], scratch_path(spark, "collide"))
    assert (sorted(r.n for r in ok.collect()), sorted(r.n for r in bad.collect())) == ([1, 2], [3, 4])


def _small_trips(spark, folder):
    """Three line items of two orders; the urgent one comes twice."""
    tables = {
        "lineitem": ([(1, 1, 1, "O", "A", 10.0, 5.0, 0.1, 0.2, 3), (1, 1, 2, "O", "N", 20.0, 6.0, 0.1, 0.2, 4),
                      (2, 1, 7, "F", "A", 30.0, 7.0, 0.1, 0.2, 5)],
                     "l_orderkey long, l_suppkey long, l_linenumber int, l_linestatus string, l_returnflag string, "
                     "l_extendedprice double, l_quantity double, l_discount double, l_tax double, d int"),
        "orders": ([(1, 1, "1-URGENT", 1), (2, 1, "5-LOW", 2)], "o_orderkey long, o_custkey long, o_orderpriority string, d int"),
        "supplier": ([(1, 8)], "s_suppkey long, s_nationkey int"),
        "customer": ([(1, 9)], "c_custkey long, c_nationkey int"),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        if "d" in df.columns:
            day = "l_shipdate" if name == "lineitem" else "o_orderdate"
            df = df.withColumn(day, F.expr("date_add(DATE '2000-01-01', d)").cast("timestamp_ntz")).drop("d")
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_quarantined_trips_are_stored_before_they_widen(spark, tmp_path, monkeypatch):
    """What is stored between the join and the split has a row a line item
    and each value once, not the raw trips with second extractions."""
    paths = {}
    monkeypatch.setattr(quality, "scratch_path", lambda s, n: paths.setdefault(n, scratch_path(s, n)))
    data = _small_trips(spark, tmp_path)
    ok = quality.q_quarantine_accepted(spark, data)
    stored = [spark.read.parquet(p) for n, p in paths.items() if n != "quarantine"]
    assert [(t.count(), len(t.columns)) for t in stored] == [(3, 12)]
    paths.clear()
    bad = quality.q_quarantine_rejected(spark, data)
    assert ok.count() == 0 and len(ok.columns) == 21
    repeat = "unique(" + ",".join(quality.REPEAT_KEY) + ")"
    assert sorted((r.ratecode_id, r.tip_amount, r.failed_checks) for r in bad.collect()) == [
        (1, -1.0, f"non_negative(tip_amount);{repeat}"), (1, 0.1, repeat), (2, 0.1, repeat), (2, 1.1, repeat),
        (7, 0.1, "not_null(vendor_id)")]
    files = [f for f in fs.list_names(spark, f"{paths['quarantine']}/accepted=false") if f.endswith(".parquet")]
    assert files and all(".zstd." in f for f in files)


def test_the_codec_of_a_split_is_the_callers(spark):
    target = scratch_path(spark, "codec")
    guarded.quarantine(_frame(spark, [(1, "a", -1.0)]), [ck.non_negative("v")], target)
    files = [f for f in fs.list_names(spark, f"{target}/accepted=false") if f.endswith(".parquet")]
    assert files and all(f".{spark.conf.get('spark.sql.parquet.compression.codec')}." in f for f in files)


# ------------------------------------------------------------------- CSV stream

def _write(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("a,b\n" + "".join(f"{a},{b}\n" for a, b in rows))


def _convert(spark, tmp_path, **options):
    return convert.csv_stream_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt"),
                                         spark.createDataFrame([], "a int, b string").schema, **options)


def _out(spark, tmp_path):
    return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("a", "b", "source").collect())


def test_csv_stream_converts_each_file_once(spark, tmp_path):
    _write(tmp_path / "in/x", "t.csv", [(1, "p"), (2, "q")])
    _write(tmp_path / "in/y", "t.csv", [(3, "r")])  # the same name in another folder
    _write(tmp_path / "in/x", "a+b %20=c.csv", [(4, "s")])
    _write(tmp_path / "in", "notes.txt", [(9, "no")])
    want = [(1, "p", "x/t"), (2, "q", "x/t"), (3, "r", "y/t"), (4, "s", "x/a+b %20=c")]
    _convert(spark, tmp_path)
    assert _out(spark, tmp_path) == want
    assert sum(p.numInputRows for p in _convert(spark, tmp_path).recentProgress) == 0
    _write(tmp_path / "in/x", "u.csv", [(5, "t")])
    os.utime(tmp_path / "in/x/u.csv", (10 ** 9, 10 ** 9))  # an old file that comes late
    query = _convert(spark, tmp_path)
    assert sum(p.numInputRows for p in query.recentProgress) == 1
    assert _out(spark, tmp_path) == [*want, (5, "t", "x/u")]


@pytest.mark.parametrize("how", ["archive", "delete"])
def test_csv_stream_clears_finished_files(spark, tmp_path, how):
    options = {"archive_dir": str(tmp_path / "done")} if how == "archive" else {"delete": True}
    for i in range(3):
        _write(tmp_path / "in", f"f{i}.csv", [(i, "x")])
    _convert(spark, tmp_path, **options, max_files=1)
    _write(tmp_path / "in", "f9.csv", [(9, "x")])
    _convert(spark, tmp_path, **options)
    _convert(spark, tmp_path, **options)
    assert [r[0] for r in _out(spark, tmp_path)] == [0, 1, 2, 9]
    left = {f for _, _, names in os.walk(tmp_path / "in") for f in names if f.endswith(".csv")}
    kept = {f for _, _, names in os.walk(tmp_path / "done") for f in names if f.endswith(".csv")}
    assert len(left) <= 1  # the last batch's files go with the next batch
    assert (kept | left if how == "archive" else {"f0.csv", "f1.csv", "f2.csv"}) >= {"f0.csv", "f1.csv", "f2.csv"}


def test_csv_stream_refuses_an_archive_inside_the_inputs(spark, tmp_path):
    _write(tmp_path / "in", "f.csv", [(1, "x")])
    with pytest.raises(ValueError):
        _convert(spark, tmp_path, archive_dir=str(tmp_path / "in/done"))
    with pytest.raises(ValueError):
        _convert(spark, tmp_path, archive_dir=str(tmp_path / "done"), delete=True)
