"""Source-to-model projections: rename, cast, pick, standardise.

Every projection is one ``select`` built from a declarative mapping, so it
fuses into the scan's whole-stage-codegen span and costs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from ridelake.functions.sqltext import ident, literal, sql

# ---------------------------------------------------------------------------
# Source column -> model column and kind, per trip source.
# Kinds: int (rounded), money (decimal(18,3)), string, timestamp (zone-less).
# ---------------------------------------------------------------------------
YELLOW_STAGING = [
    ("VendorID", "vendor_id", "int"),
    ("ratecodeid", "rate_code_id", "int"),
    ("PULocationID", "pickup_location_id", "int"),
    ("DOLocationID", "dropoff_location_id", "int"),
    ("tpep_pickup_datetime", "pickup_datetime", "timestamp"),
    ("tpep_dropoff_datetime", "dropoff_datetime", "timestamp"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", "money"),
    ("fare_amount", "fare_amount", "money"),
    ("extra", "extra", "money"),
    ("mta_tax", "mta_tax", "money"),
    ("tip_amount", "tip_amount", "money"),
    ("tolls_amount", "tolls_amount", "money"),
    ("improvement_surcharge", "improvement_surcharge", "money"),
    ("total_amount", "total_amount", "money"),
    ("payment_type", "payment_type", "int"),
]
GREEN_STAGING = [
    ("VendorID", "vendor_id", "int"),
    ("RatecodeID", "rate_code_id", "int"),
    ("PULocationID", "pickup_location_id", "int"),
    ("DOLocationID", "dropoff_location_id", "int"),
    ("lpep_pickup_datetime", "pickup_datetime", "timestamp"),
    ("lpep_dropoff_datetime", "dropoff_datetime", "timestamp"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", "money"),
    ("trip_type", "trip_type", "int"),
    ("fare_amount", "fare_amount", "money"),
    ("extra", "extra", "money"),
    ("mta_tax", "mta_tax", "money"),
    ("tip_amount", "tip_amount", "money"),
    ("tolls_amount", "tolls_amount", "money"),
    ("ehail_fee", "ehail_fee", "money"),
    ("improvement_surcharge", "improvement_surcharge", "money"),
    ("total_amount", "total_amount", "money"),
    ("payment_type", "payment_type", "int"),
]
FHV_STAGING = [
    ("dispatching_base_num", "dispatching_base_num", "string"),
    ("pickup_datetime", "pickup_datetime", "timestamp"),
    ("dropOff_datetime", "dropoff_datetime", "timestamp"),
    ("PUlocationID", "pickup_location_id", "int"),
    ("DOlocationID", "dropoff_location_id", "int"),
    ("SR_Flag", "sr_flag", "int"),
    ("Affiliated_base_number", "affiliated_base_number", "string"),
]

# The canonical ingestion schema (21 columns, in this order)
# and, per column, the lower-cased source names tried in order.
CANONICAL_SCHEMA = StructType([
    StructField("taxi_type", StringType()),
    StructField("pickup_datetime", TimestampNTZType()),
    StructField("dropoff_datetime", TimestampNTZType()),
    StructField("pickup_location_id", IntegerType()),
    StructField("dropoff_location_id", IntegerType()),
    StructField("passenger_count", IntegerType()),
    StructField("trip_distance", DoubleType()),
    StructField("ratecode_id", IntegerType()),
    StructField("store_and_fwd_flag", StringType()),
    StructField("payment_type", IntegerType()),
    StructField("fare_amount", DoubleType()),
    StructField("extra", DoubleType()),
    StructField("mta_tax", DoubleType()),
    StructField("tip_amount", DoubleType()),
    StructField("tolls_amount", DoubleType()),
    StructField("improvement_surcharge", DoubleType()),
    StructField("total_amount", DoubleType()),
    StructField("congestion_surcharge", DoubleType()),
    StructField("airport_fee", DoubleType()),
    StructField("vendor_id", IntegerType()),
    StructField("extracted_at", TimestampNTZType()),
])
CANONICAL_COLUMNS = [f.name for f in CANONICAL_SCHEMA.fields]
CANDIDATES = {
    "pickup_datetime": ["pickup_datetime", "tpep_pickup_datetime", "lpep_pickup_datetime"],
    "dropoff_datetime": ["dropoff_datetime", "tpep_dropoff_datetime", "lpep_dropoff_datetime"],
    "pickup_location_id": ["pulocationid", "pickup_location_id"],
    "dropoff_location_id": ["dolocationid", "dropoff_location_id"],
    "passenger_count": ["passenger_count"],
    "trip_distance": ["trip_distance"],
    "ratecode_id": ["ratecodeid", "ratecode_id"],
    "store_and_fwd_flag": ["store_and_fwd_flag"],
    "payment_type": ["payment_type"],
    "fare_amount": ["fare_amount"],
    "extra": ["extra"],
    "mta_tax": ["mta_tax"],
    "tip_amount": ["tip_amount"],
    "tolls_amount": ["tolls_amount"],
    "improvement_surcharge": ["improvement_surcharge"],
    "total_amount": ["total_amount"],
    "congestion_surcharge": ["congestion_surcharge"],
    "airport_fee": ["airport_fee"],
    "vendor_id": ["vendorid", "vendor_id"],
}


def resolve(df: DataFrame, name: str, columns: list[str] | None = None) -> str | None:
    """Actual column name of ``name`` in ``df``, matched case-insensitively."""
    lower = name.lower()
    for c in columns if columns is not None else df.columns:
        if c.lower() == lower:
            return c
    return None


_KIND_SQL = {
    "int": "CAST(rint(CAST({c} AS DOUBLE)) AS INT)",
    "money": "CAST({c} AS DECIMAL(18,3))",
    "timestamp": "CAST({c} AS TIMESTAMP_NTZ)",
    "string": "CAST({c} AS STRING)",
}


def typed_sql(expr: str, kind: str) -> str:
    """SQL text of ``expr`` cast per the model's typing rules."""
    return _KIND_SQL.get(kind, "CAST({c} AS " + kind + ")").format(c=expr)


def project(df: DataFrame, mapping, required: list[str] | None = None) -> DataFrame:
    """Rename + cast per ``mapping`` and keep rows whose ``required`` source
    columns are not NULL (the filter is pushed to the scan)."""
    columns = df.columns
    exprs = []
    for src, dst, kind in mapping:
        actual = resolve(df, src, columns)
        if actual is None:
            raise ValueError(f"source column {src!r} missing; have {columns}")
        exprs.append(f"{typed_sql(ident(actual), kind)} AS {ident(dst)}")
    conds = [f"{ident(resolve(df, r, columns) or r)} IS NOT NULL" for r in required or []]
    where = f" WHERE {' AND '.join(conds)}" if conds else ""
    return sql(df, f"SELECT {', '.join(exprs)} FROM {{src}}{where}", src=df)


def stg_yellow(raw: DataFrame) -> DataFrame:
    return project(raw, YELLOW_STAGING, required=["VendorID"])


def stg_green(raw: DataFrame) -> DataFrame:
    return project(raw, GREEN_STAGING, required=["VendorID"])


def stg_fhv(raw: DataFrame) -> DataFrame:
    return project(raw, FHV_STAGING, required=["dispatching_base_num"])


def standardize(df: DataFrame, taxi_type: str, extracted_at) -> DataFrame:
    """Any trip source -> the canonical 21 columns in fixed order.

    Each column takes the first candidate source column present in the
    schema (not a per-row coalesce), else NULL.  ``extracted_at`` is a run
    argument rather than ``now()`` so that a re-run produces the same rows.
    """
    columns = df.columns
    exprs = []
    for field in CANONICAL_SCHEMA.fields:
        name, sql_type = field.name, field.dataType.simpleString()
        if name == "taxi_type":
            expr = literal(taxi_type)
        elif name == "extracted_at":
            expr = f"CAST({literal(str(extracted_at))} AS TIMESTAMP_NTZ)"
        else:
            actual = next((a for a in (resolve(df, c, columns) for c in CANDIDATES[name]) if a),
                          None)
            if actual is None:
                expr = f"CAST(NULL AS {sql_type})"
            elif isinstance(field.dataType, IntegerType):
                expr = typed_sql(ident(actual), "int")
            else:
                expr = f"CAST({ident(actual)} AS {sql_type})"
        exprs.append(f"{expr} AS {ident(name)}")
    return sql(df, f"SELECT {', '.join(exprs)} FROM {{src}}", src=df)


def empty_canonical(spark) -> DataFrame:
    return spark.createDataFrame([], CANONICAL_SCHEMA)
