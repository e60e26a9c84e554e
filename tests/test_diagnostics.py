from ridelake.operators import diagnostics as dg


def test_hash_collision_report(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("b", "a")], "p string, q string")
    rows = dg.hash_collisions(df, ["p", "q"]).collect()
    assert len(rows) == 1 and rows[0]["distinct_rows"] == 2


def test_duplicate_summary_and_rows(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 1, "y"), (1, 2, "z"), (None, 3, "n"),
                                (None, 3, "m")], "o int, l int, v string")
    s = dg.duplicate_summary(df, ["o", "l"]).first()
    assert (s["total_rows"], s["distinct_keys"], s["duplicate_count"]) == (5, 3, 2)
    rows = dg.duplicate_rows(df, ["o", "l"]).select("v").collect()
    assert sorted(r[0] for r in rows) == ["m", "n", "x", "y"]


def test_null_profile_and_period(spark):
    import datetime as dt
    df = spark.createDataFrame([(None, None), (1, None), (None, 2), (3, 4)], "a int, b int")
    p = dg.null_profile(df, "a", "b").first()
    assert (p["total"], p["null_a"], p["null_b"], p["null_both"]) == (4, 2, 2, 1)
    per = spark.createDataFrame([(dt.date(2019, 1, 1), dt.datetime(2008, 5, 1)),
                                 (dt.date(2019, 1, 1), dt.datetime(2019, 1, 31, 23)),
                                 (dt.date(2019, 1, 1), dt.datetime(2035, 1, 1))],
                                "period date, ts timestamp_ntz")
    got = sorted(tuple(r) for r in dg.out_of_period(per, "ts", "period").collect())
    assert got == [(2008, 1), (2035, 1)]


def test_distinct_count_exact_and_sketch(spark):
    df = spark.range(5000).selectExpr("id % 1000 AS k")
    assert dg.distinct_count(df, "k").first()[0] == 1000
    approx = dg.distinct_count(df, "k", exact=False).first()[0]
    assert abs(approx - 1000) <= 50
