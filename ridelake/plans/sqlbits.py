"""SQL fragments shared by the oracle statements (DuckDB dialect)."""

from __future__ import annotations

from ridelake.operators.marts import (
    FACT_COLUMNS,
    FACT_DEDUP_KEYS,
    MART_SUMS,
    STAGING_COLUMNS,
    STAGING_DEDUP_KEYS,
)
from ridelake.operators.staging import (
    CANONICAL_COLUMNS,
    FHV_STAGING,
    GREEN_STAGING,
    YELLOW_STAGING,
)
from ridelake.plans import tables as tb

_KIND_SQL = {
    "int": "CAST({c} AS INTEGER)",
    "money": "CAST({c} AS DECIMAL(18,3))",
    "timestamp": "CAST({c} AS TIMESTAMP)",
    "string": "CAST({c} AS VARCHAR)",
}

# T column that feeds each raw source column (see ``tables.yellow_raw``).
_RAW_FROM_T = {
    "VendorID": "vendor_id", "ratecodeid": "rate_code_id", "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id", "DOLocationID": "dropoff_location_id",
    "tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime",
    "lpep_pickup_datetime": "pickup_datetime", "lpep_dropoff_datetime": "dropoff_datetime",
    "ehail_fee": "tip_amount",
    "trip_type": "CASE WHEN payment_type = 3 THEN 2 ELSE 1 END",
}


def staged_select(mapping, source: str, where: str, from_t: bool = True) -> str:
    cols = []
    for src, dst, kind in mapping:
        expr = _RAW_FROM_T.get(src, src) if from_t else f'"{src}"'
        cols.append(_KIND_SQL[kind].format(c=expr) + f" AS {dst}")
    return f"SELECT {', '.join(cols)} FROM {source} WHERE {where}"


SQL_STG_YELLOW = staged_select(
    YELLOW_STAGING, "T", "taxi_type = 'yellow' AND vendor_id IS NOT NULL")
SQL_STG_GREEN = staged_select(
    GREEN_STAGING, "T", "taxi_type = 'green' AND vendor_id IS NOT NULL")
SQL_STG_FHV = staged_select(FHV_STAGING, "H", "dispatching_base_num IS NOT NULL", from_t=False)


def order_all(first: list[str], columns: list[str], keys: list[str]) -> str:
    """ORDER BY list: ``first`` then every other column, NULLs last."""
    used = {c.split()[0].lower() for c in first} | {k.lower() for k in keys}
    parts = []
    for item in first:
        name, *direction = item.split()
        parts.append(f"{name} {direction[0] if direction else 'ASC'} NULLS LAST")
    parts += [f"{c} ASC NULLS LAST" for c in columns if c.lower() not in used]
    return ", ".join(parts)


SQL_UNION = f"""
  SELECT {', '.join(FACT_COLUMNS[:-1])}, 'Green' AS service_type FROM SG
  UNION ALL
  SELECT {', '.join(c if c not in ('trip_type', 'ehail_fee') else
                    ('CAST(1 AS INTEGER) AS trip_type' if c == 'trip_type'
                     else 'CAST(0 AS DECIMAL(18,3)) AS ehail_fee')
                    for c in FACT_COLUMNS[:-1])}, 'Yellow' AS service_type FROM SY
"""

SQL_DEDUP_FIRST = f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY {', '.join(FACT_DEDUP_KEYS)}
      ORDER BY {order_all(['dropoff_datetime'], FACT_COLUMNS, FACT_DEDUP_KEYS)}) AS rn
    FROM U) WHERE rn = 1
"""

SQL_FCT = """
  SELECT d.*, pz.borough AS pickup_borough, pz.zone AS pickup_zone,
         dz.borough AS dropoff_borough, dz.zone AS dropoff_zone
  FROM D d
  LEFT JOIN Z pz ON d.pickup_location_id = pz.location_id
  LEFT JOIN Z dz ON d.dropoff_location_id = dz.location_id
"""

SQL_MART = "SELECT COALESCE(pickup_zone, 'Unknown Zone') AS pickup_zone, " \
    "CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS revenue_month, service_type, " \
    + ", ".join(f"CAST(SUM({s}) AS DECIMAL(38,3)) AS {d}" for s, d in MART_SUMS) + \
    ", COUNT(*) AS total_monthly_trips" \
    ", ROUND(AVG(CAST(passenger_count AS DOUBLE)), 6) AS avg_monthly_passenger_count" \
    ", ROUND(AVG(CAST(trip_distance AS DOUBLE)), 6) AS avg_monthly_trip_distance" \
    " FROM FCT GROUP BY 1, 2, 3"


def fct_ctes() -> str:
    """WITH-list defining SY, SG, U, D and FCT (after T and Z)."""
    return (f"SY AS ({SQL_STG_YELLOW}),\nSG AS ({SQL_STG_GREEN}),\n"
            f"U AS ({SQL_UNION}),\nD AS ({SQL_DEDUP_FIRST}),\nFCT AS ({SQL_FCT})")


def with_fct(body: str) -> str:
    base = tb.with_ctes("", "T", "Z").rstrip()
    return f"{base},\n{fct_ctes()}\n{body}"


def sql_staging(raw: str, start: str, end: str) -> str:
    """Staging rows over relation ``raw`` for the window [start, end)."""
    order = order_all(["extracted_at DESC"], CANONICAL_COLUMNS, STAGING_DEDUP_KEYS)
    return f"""
  SELECT {', '.join('d.' + c if c != 'payment_type_name' else 'p.payment_type_name'
                    for c in STAGING_COLUMNS)}
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(STAGING_DEDUP_KEYS)}
                                      ORDER BY {order}) AS rn
        FROM {raw}
        WHERE pickup_datetime >= TIMESTAMP '{start}' AND pickup_datetime < TIMESTAMP '{end}') d
  LEFT JOIN P p ON d.payment_type = p.payment_type_id
  WHERE d.rn = 1 AND d.pickup_datetime IS NOT NULL AND d.dropoff_datetime IS NOT NULL
    AND d.dropoff_datetime >= d.pickup_datetime AND d.fare_amount >= 0
    AND d.total_amount >= 0 AND d.tip_amount >= 0"""


def sql_report(staging: str, start: str, end: str) -> str:
    return f"""
  SELECT taxi_type, payment_type_name, CAST(pickup_datetime AS DATE) AS pickup_date,
         COUNT(*) AS trip_count, ROUND(SUM(total_amount), 2) AS total_amount_sum
  FROM {staging}
  WHERE pickup_datetime >= TIMESTAMP '{start}' AND pickup_datetime < TIMESTAMP '{end}'
  GROUP BY 1, 2, 3"""
