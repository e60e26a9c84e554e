import pytest
from pyspark.sql.types import StructType

from ridelake.operators import checks as ck


def test_duplicate_dimension_key_fails_unique(spark):
    z = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "location_id int, zone string")
    res = ck.run_checks(z, [ck.unique("location_id"), ck.not_null("zone")], "zones").collect()
    by = {r["check_name"]: r for r in res}
    assert by["unique"]["failures"] == 1 and not by["unique"]["passed"]
    assert by["not_null"]["passed"]


def test_row_checks_treat_null_as_passing_except_not_null(spark):
    df = spark.createDataFrame([(-1.0, "x"), (None, "y"), (0.0, None)], "a double, t string")
    res = {(r["check_name"], r["column_name"]): r["failures"] for r in ck.run_checks(
        df, [ck.non_negative("a"), ck.positive("a"), ck.accepted_values("t", ["x"]),
             ck.not_null("t")]).collect()}
    assert res == {("non_negative", "a"): 1, ("positive", "a"): 2,
                   ("accepted_values", "t"): 1, ("not_null", "t"): 1}


def test_fail_on_error_raises(spark):
    df = spark.createDataFrame([(None,)], "a int")
    with pytest.raises(AssertionError):
        ck.run_checks(df, [ck.not_null("a")], "t", fail_on_error=True)


def test_custom_sql_check(spark):
    spark.createDataFrame([(1,), (2,)], "a int").createOrReplaceTempView("t_custom")
    ok = ck.run_checks(spark.table("t_custom"),
                       [ck.sql_equals("none_big", "SELECT COUNT(*) FROM t_custom WHERE a > 5", 0)])
    bad = ck.run_checks(spark.table("t_custom"),
                        [ck.sql_equals("none_small", "SELECT COUNT(*) FROM t_custom WHERE a < 5", 0)])
    assert ok.first()["passed"] and not bad.first()["passed"]


def test_schema_contract(spark):
    from pyspark.sql.types import StringType, StructField
    df = spark.createDataFrame([(1, "a", 2.0), (2, None, 3.0)], "a int, b string, extra double")
    contract = StructType.fromDDL("a bigint, c int").add(StructField("b", StringType(), False))
    rows = {r["column_name"]: r for r in ck.check_schema(df, contract).collect()}
    assert not rows["a"]["matches"] and rows["b"]["matches"]
    assert rows["c"]["actual_type"] is None and not rows["extra"]["matches"]
    assert rows["b"]["null_rows"] == 1 and rows["a"]["null_rows"] is None


def test_custom_query_and_values_may_hold_braces(spark):
    from ridelake.operators import checks

    df = spark.createDataFrame([("{a}",), ("b",)], "x string")
    got = checks.run_checks(df, [checks.sql_equals("braces", "SELECT COUNT(*) FROM {src} WHERE x = '{a}'", 1),
                                 checks.accepted_values("x", ["{a}", "b"])], "t{1}").collect()
    assert all(r.passed for r in got) and {r.table_name for r in got} == {"t{1}"}


def test_schema_contract_is_one_aggregation(spark):
    from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

    from ridelake.operators import checks

    df = spark.createDataFrame([(1, None, 2)], "a int, b string, extra long").repartition(3)
    out = checks.check_schema(df, StructType([
        StructField("a", LongType(), False), StructField("b", StringType(), False),
        StructField("gone", IntegerType(), False)]))
    assert [tuple(r) for r in out.collect()] == [
        ("a", "bigint", "int", False, 0), ("b", "string", "string", True, 1),
        ("gone", "int", None, False, None), ("extra", None, "bigint", False, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and "Union" not in plan
