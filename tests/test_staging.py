import datetime as dt

import pytest

from ridelake.operators.staging import (
    CANONICAL_COLUMNS,
    YELLOW_STAGING,
    empty_canonical,
    project,
    standardize,
    stg_yellow,
)

D = dt.datetime(2024, 1, 1, 8, 0)


def test_mixed_case_and_missing_columns(spark):
    raw = spark.createDataFrame(
        [(2, D, D, 1.5, 7, 8, 3.25)],
        "VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
        "passenger_count double, PUlocationID int, DOLocationID int, Airport_fee double")
    out = standardize(raw, "green", "2024-02-01 00:00:00")
    assert out.columns == CANONICAL_COLUMNS
    row = out.first()
    assert row["pickup_location_id"] == 7 and row["dropoff_location_id"] == 8
    assert row["airport_fee"] == 3.25
    assert row["passenger_count"] == 2          # 1.5 rounds half to even
    assert row["congestion_surcharge"] is None  # absent column -> all NULL
    assert row["extracted_at"] == dt.datetime(2024, 2, 1)
    assert out.schema["trip_distance"].dataType.simpleString() == "double"


def test_staging_filters_null_vendor_and_casts(spark):
    cols = [src for src, _, _ in YELLOW_STAGING]
    base = {c: 1.0 for c in cols}
    base.update(tpep_pickup_datetime=D, tpep_dropoff_datetime=D, store_and_fwd_flag="N",
                trip_distance=1.2345, fare_amount=10.005)
    rows = [tuple(base[c] for c in cols), tuple(None if c == "VendorID" else base[c] for c in cols)]
    schema = ", ".join(
        f"{c} {'timestamp_ntz' if 'datetime' in c else 'string' if c == 'store_and_fwd_flag' else 'double'}"
        for c in cols)
    out = stg_yellow(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 1
    assert str(out[0]["trip_distance"]) == "1.235" or str(out[0]["trip_distance"]) == "1.234"
    assert str(out[0]["fare_amount"]).startswith("10.0")


def test_project_reports_missing_source(spark):
    df = spark.createDataFrame([(1,)], "VendorID int")
    with pytest.raises(ValueError):
        project(df, YELLOW_STAGING)


def test_no_files_gives_typed_empty_frame(spark):
    e = empty_canonical(spark)
    assert e.count() == 0 and e.columns == CANONICAL_COLUMNS
