import datetime as dt
import json
import os

from ridelake.sources import files, paged
from ridelake.session import scratch_path


def test_union_by_name_widens_and_fills(spark):
    root = scratch_path(spark, "ubn-test")
    spark.createDataFrame([(1, 2)], "id int, passenger_count bigint").write.parquet(root + "/a")
    spark.createDataFrame([(2, 1.5, "x")], "id int, passenger_count double, extra string") \
        .write.parquet(root + "/b")
    df = files.read_union_by_name(spark, [root])
    assert df.schema["passenger_count"].dataType.simpleString() == "double"
    rows = sorted(tuple(r) for r in df.select("id", "passenger_count", "extra").collect())
    assert rows == [(1, 2.0, None), (2, 1.5, "x")]


def test_month_plan_mid_month_start():
    assert files.month_starts("2022-01-15", "2022-03-01") == [dt.date(2022, 1, 1),
                                                               dt.date(2022, 2, 1)]
    paths = files.month_paths("2022-12-15", "2023-01-02", ["yellow"], "x/{type}_{year}-{month}")
    assert [p for _, _, p in paths] == ["x/yellow_2022-12", "x/yellow_2023-01"]


def test_existing_skips_absent(spark):
    root = scratch_path(spark, "exist")
    spark.range(3).write.parquet(root + "/m=2022-01")
    kept = files.existing(spark, [root + "/m=2022-01", root + "/m=2022-02"])
    assert kept == [root + "/m=2022-01"]


def _write_pages(folder, pages):
    for i, recs in enumerate(pages, start=1):
        d = os.path.join(folder, f"page={i}")
        os.makedirs(d)
        with open(os.path.join(d, "part-0.json"), "w") as fh:
            for r in recs:
                fh.write(json.dumps(r) + "\n")


def test_paged_source_reads_every_page_once(spark, tmp_path):
    pages = [[{"id": p * 10 + i, "name": f"n{p}{i}"} for i in range(3)] for p in range(3)]
    _write_pages(str(tmp_path), pages)
    url = str(tmp_path) + "/page={page}"
    for parts in (1, 2, 5):
        df = paged.read_pages(spark, url, "id bigint, name string", partitions=parts)
        assert sorted(r["id"] for r in df.collect()) == sorted(
            r["id"] for p in pages for r in p)
    beyond = paged.read_pages(spark, url, "id bigint, name string", start_page=7)
    assert beyond.count() == 0
    capped = paged.read_pages(spark, url, "id bigint, name string", end_page=2)
    assert capped.count() == 6


def test_paged_source_stops_at_the_first_gap(spark, tmp_path):
    pages = [[{"id": p * 10 + i, "name": None} for i in range(3)] for p in range(2)] + [[], [{"id": 99}]]
    _write_pages(str(tmp_path), pages)
    for parts in (1, 2, 3, 4):
        df = paged.read_pages(spark, str(tmp_path) + "/page={page}", "id bigint, name string", partitions=parts)
        assert sorted(r["id"] for r in df.collect()) == [0, 1, 2, 10, 11, 12]


def test_seed_and_inventory(spark):
    root = scratch_path(spark, "seed-test")
    spark.createDataFrame([(1, "Credit card"), (2, "Cash")], "id int, name string") \
        .coalesce(1).write.option("header", True).csv(root)
    seed = files.read_seed(spark, root, "payment_type_id int, payment_type_name string")
    assert seed.count() == 2 and seed.columns == ["payment_type_id", "payment_type_name"]
    inv = files.file_inventory(spark, root).first()
    assert inv["rows"] == 2 and inv["lines"] == 3 and inv["text_bytes"] == inv["file_size"]


def test_csv_infer_path_for_exploration(spark):
    root = scratch_path(spark, "csv-infer")
    spark.createDataFrame([(1, 2.5, "x")], "a int, b double, c string") \
        .write.option("header", True).csv(root)
    df = files.read_csv(spark, root, infer=True)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "double", "string"]


def test_package_is_shipped_to_python_workers(spark):
    from ridelake.session import ship_package
    ship_package(spark)
    includes = spark.sparkContext._python_includes
    assert any(name.startswith("ridelake-") and name.endswith(".zip") for name in includes)
