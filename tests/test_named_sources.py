"""Named raw sources: declared names resolve, others are errors."""

import pytest

from ridelake.session import scratch_path
from ridelake.sources import named

SOURCE = named.RawSource("trips", "named_test", ("yellow", "green", "fhv"))


def _write(spark, rows):
    path = scratch_path(spark, "named")
    spark.createDataFrame(rows, "id long, kind string").write.parquet(path)
    return path


def test_lookup_by_name(spark):
    yellow, green = _write(spark, [(1, "a"), (2, None)]), _write(spark, [(3, "b")])
    named.attach(spark, SOURCE, {"yellow": yellow, "green": green})
    assert sorted(r.id for r in named.lookup(spark, SOURCE, "yellow").collect()) == [1, 2]
    assert named.missing(spark, SOURCE) == ["fhv"]
    # another place under the same name: the files of the first stay
    named.attach(spark, SOURCE, {"yellow": green})
    assert [r.id for r in named.lookup(spark, SOURCE, "yellow").collect()] == [3]
    assert spark.read.parquet(yellow).count() == 2


def test_undeclared_and_missing_names(spark):
    with pytest.raises(LookupError, match="declares no table 'red'"):
        named.lookup(spark, SOURCE, "red")
    with pytest.raises(LookupError, match="declares no table 'red'"):
        named.attach(spark, SOURCE, {"red": "/nowhere"})
    with pytest.raises(LookupError, match="declared but not in the catalog"):
        named.lookup(spark, named.RawSource("trips", "named_absent", ("yellow",)), "yellow")


def test_filters_and_columns_reach_the_scan(spark):
    named.attach(spark, SOURCE, {"fhv": _write(spark, [(i, "k") for i in range(9)])})
    plan = (named.lookup(spark, SOURCE, "fhv").where("id > 4").select("id")
            ._jdf.queryExecution().executedPlan().toString())
    assert "GreaterThan(id,4)" in plan and "ReadSchema: struct<id:bigint>" in plan
