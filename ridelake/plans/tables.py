"""Trip-shaped inputs derived from the driver's test tables.

Each builder reads whole tables and returns a lazy DataFrame; nothing is
collected.  ``SQL_*`` strings define the same inputs for the DuckDB oracle
so that every query can be stated independently in SQL.

Mapping (a stand-in for real trip files; the columns are what the models
read):

* trips ``T``: one row per line item, joined to its order, supplier and
  customer.  taxi type from the line status (O green, F yellow), vendor =
  line number with 7 treated as missing, pickup = order date, dropoff = ship
  date, pickup zone = supplier nation, dropoff zone = customer nation,
  passengers and distance = quantity, payment type from the return flag,
  fare and total = extended price, tax-like fees = tax, tip and tolls =
  discount.
  Sixth lines of an order start in zone 264, which no lookup has.
* zones ``Z``: all nations with their region as borough.
* payment lookup ``P``: two fixed rows; payment type 3 stays unmatched.
* raw ``R``: all trips extracted at T0, plus urgent orders extracted again
  at T1 with changed tips (tip -1 on the first line, else tip + 1).
* fhv ``H``: events as for-hire trips; errors have no base number, views an
  empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridelake.functions.sqltext import broadcast_hint, literal, sql
from ridelake.operators.staging import standardize
from ridelake.sources.files import read_input

# Fixed values of the adapters.
T0 = "2002-01-01 00:00:00"
T1 = "2002-01-02 00:00:00"
REEXTRACTED_PRIORITY = "1-URGENT"
SERVICE_ZONE = "Boro Zone"
PAYMENT_TYPES = [(1, "Credit card"), (2, "Cash")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_input(spark, f"{sf_dir}/{name}.parquet")


# Select list of the trip view over the columns of trip_parts.
_TRIP_COLUMNS = """
    CASE WHEN l_linestatus = 'O' THEN 'green' ELSE 'yellow' END AS taxi_type,
    NULLIF(l_linenumber, 7) AS vendor_id,
    l_linenumber AS rate_code_id,
    CASE WHEN l_linenumber = 6 THEN 264 ELSE s_nationkey END AS pickup_location_id,
    c_nationkey AS dropoff_location_id,
    o_orderdate AS pickup_datetime,
    l_shipdate AS dropoff_datetime,
    l_linestatus AS store_and_fwd_flag,
    l_quantity AS passenger_count,
    l_quantity AS trip_distance,
    CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS payment_type,
    l_extendedprice AS fare_amount,
    l_tax AS extra, l_tax AS mta_tax,
    l_discount AS tip_amount, l_discount AS tolls_amount,
    l_tax AS improvement_surcharge,
    l_extendedprice AS total_amount,
    l_tax AS congestion_surcharge,
    l_discount AS airport_fee,
    o_orderpriority AS order_priority"""


def trip_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What trips are made of: line items with their order, supplier and
    customer, each column once (``trips`` repeats half of them).

    Customers are joined to orders first (orders are a quarter of the line
    items), so when customer is too large to broadcast only orders are
    shuffled by customer key; the line items are then shuffled once, by
    order key, with the supplier's nation in place of its key.  Supplier,
    customer and the orders-with-customer subquery are broadcast only while
    their size estimate stays under the session's bound; past it the planner
    shuffles instead.
    """
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    supplier = table(spark, sf_dir, "supplier")
    customer = table(spark, sf_dir, "customer")
    # customers join orders on the customer key, so the subquery has at most
    # as many rows as orders: the orders estimate bounds its size (Catalyst's
    # own estimate of a join without statistics is the product of its inputs)
    return sql(li, f"""
        SELECT {broadcast_hint({"s": supplier, "o": orders})}
               l.l_linenumber, l.l_linestatus, l.l_returnflag, l.l_shipdate, l.l_quantity,
               l.l_extendedprice, l.l_discount, l.l_tax, s.s_nationkey,
               o.c_nationkey, o.o_orderdate, o.o_orderpriority
        FROM {{li}} l
        JOIN {{s}} s ON l.l_suppkey = s.s_suppkey
        JOIN (SELECT {broadcast_hint({"c": customer})}
                     o.o_orderkey, o.o_orderdate, o.o_orderpriority, c.c_nationkey
              FROM {{o}} o JOIN {{c}} c ON o.o_custkey = c.c_custkey) o
          ON l.l_orderkey = o.o_orderkey""", li=li, o=orders, s=supplier, c=customer)


def as_trips(parts: DataFrame) -> DataFrame:
    return sql(parts, f"SELECT {_TRIP_COLUMNS} FROM {{parts}}", parts=parts)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, supplier and customer, as trips."""
    return as_trips(trip_parts(spark, sf_dir))


def yellow_raw(t: DataFrame) -> DataFrame:
    """Yellow trips under the yellow source's column names."""
    return sql(t, """
        SELECT vendor_id AS VendorID, pickup_datetime AS tpep_pickup_datetime,
               dropoff_datetime AS tpep_dropoff_datetime, passenger_count, trip_distance,
               rate_code_id AS RatecodeID, store_and_fwd_flag,
               pickup_location_id AS PULocationID, dropoff_location_id AS DOLocationID,
               payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
               improvement_surcharge, total_amount, congestion_surcharge,
               airport_fee AS Airport_fee
        FROM {t} WHERE taxi_type = 'yellow'""", t=t)


def green_raw(t: DataFrame) -> DataFrame:
    """Green trips under the green source's names; no airport fee column."""
    return sql(t, """
        SELECT vendor_id AS VendorID, pickup_datetime AS lpep_pickup_datetime,
               dropoff_datetime AS lpep_dropoff_datetime, store_and_fwd_flag,
               rate_code_id AS RatecodeID, pickup_location_id AS PULocationID,
               dropoff_location_id AS DOLocationID, passenger_count, trip_distance,
               fare_amount, extra, mta_tax, tip_amount, tolls_amount,
               tip_amount AS ehail_fee, improvement_surcharge, total_amount, payment_type,
               CASE WHEN payment_type = 3 THEN 2 ELSE 1 END AS trip_type,
               congestion_surcharge
        FROM {t} WHERE taxi_type = 'green'""", t=t)


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup as the source file has it (LocationID, Borough, Zone, service_zone)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return sql(nation, f"""
        SELECT n.n_nationkey AS LocationID, r.r_name AS Borough, n.n_name AS Zone,
               {literal(SERVICE_ZONE)} AS service_zone
        FROM {{n}} n JOIN {{r}} r ON n.n_regionkey = r.r_regionkey""", n=nation, r=region)


def payment_lookup(spark: SparkSession) -> DataFrame:
    """The seed as an inline VALUES relation: it carries exact size
    statistics, so the checked broadcast accepts it."""
    values = ", ".join(f"({i}, {literal(n)})" for i, n in PAYMENT_TYPES)
    return spark.sql(f"SELECT CAST(payment_type_id AS INT) AS payment_type_id, "
                     f"payment_type_name FROM VALUES {values} AS p(payment_type_id, "
                     f"payment_type_name)")


def canonical(t: DataFrame, extracted_at: str) -> DataFrame:
    """Both trip types standardised to the 21 canonical columns, each from
    its own source shape (the ``standardize`` operator)."""
    return (standardize(yellow_raw(t), "yellow", extracted_at)
            .unionByName(standardize(green_raw(t), "green", extracted_at)))


def reextracted(t: DataFrame) -> DataFrame:
    """Urgent orders as a second extraction would see them: tips changed."""
    changed = "CASE WHEN rate_code_id = 1 THEN -1.0D ELSE tip_amount + 1.0D END AS tip_amount"
    cols = ", ".join(changed if c == "tip_amount" else c for c in t.columns)
    return sql(t, f"""
        SELECT {cols} FROM {{t}}
        WHERE order_priority = {literal(REEXTRACTED_PRIORITY)}""", t=t)


def _canonical_select(tip: str, extracted_at: str) -> str:
    ints = "CAST(rint(CAST({} AS DOUBLE)) AS INT)"
    return f"""
        taxi_type,
        CAST(pickup_datetime AS TIMESTAMP_NTZ) AS pickup_datetime,
        CAST(dropoff_datetime AS TIMESTAMP_NTZ) AS dropoff_datetime,
        {ints.format('pickup_location_id')} AS pickup_location_id,
        {ints.format('dropoff_location_id')} AS dropoff_location_id,
        {ints.format('passenger_count')} AS passenger_count,
        CAST(trip_distance AS DOUBLE) AS trip_distance,
        {ints.format('rate_code_id')} AS ratecode_id,
        CAST(store_and_fwd_flag AS STRING) AS store_and_fwd_flag,
        {ints.format('payment_type')} AS payment_type,
        CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(extra AS DOUBLE) AS extra,
        CAST(mta_tax AS DOUBLE) AS mta_tax, CAST({tip} AS DOUBLE) AS tip_amount,
        CAST(tolls_amount AS DOUBLE) AS tolls_amount,
        CAST(improvement_surcharge AS DOUBLE) AS improvement_surcharge,
        CAST(total_amount AS DOUBLE) AS total_amount,
        CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge,
        CASE WHEN taxi_type = 'yellow' THEN CAST(airport_fee AS DOUBLE) END AS airport_fee,
        {ints.format('vendor_id')} AS vendor_id,
        CAST({extracted_at} AS TIMESTAMP_NTZ) AS extracted_at"""


def canonical_rows(t: DataFrame, extracted_at: str) -> DataFrame:
    """Canonical 21 columns for both trip types in one pass over ``t``
    (same rows as ``canonical``, which reads each source separately)."""
    return sql(t, f"SELECT {_canonical_select('tip_amount', literal(extracted_at))} FROM {{t}}",
               t=t)


def raw_two_extractions(spark: SparkSession, sf_dir: str, t: DataFrame | None = None) -> DataFrame:
    """Every trip once at T0, urgent orders a second time at T1 with the
    changed tip, produced by one pass over the trip join (each row explodes
    into one or two versions)."""
    t = trips(spark, sf_dir) if t is None else t
    urgent = f"order_priority = {literal(REEXTRACTED_PRIORITY)}"
    tip = ("CASE WHEN _version = 1 THEN (CASE WHEN rate_code_id = 1 THEN -1.0D "
           "ELSE tip_amount + 1.0D END) ELSE tip_amount END")
    ts = f"CASE WHEN _version = 1 THEN {literal(T1)} ELSE {literal(T0)} END"
    return sql(t, f"""
        SELECT {_canonical_select(tip, ts)}
        FROM {{t}} LATERAL VIEW explode(CASE WHEN {urgent} THEN array(0, 1) ELSE array(0) END)
             v AS _version""", t=t)


def fhv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return sql(ev, """
        SELECT CASE WHEN event_type = 'error' THEN CAST(NULL AS STRING)
                    WHEN event_type = 'view' THEN '' ELSE event_type END AS dispatching_base_num,
               ts AS pickup_datetime, ts AS dropOff_datetime,
               NULLIF(user_id % 25, 0) AS PUlocationID,
               NULLIF(user_id % 7, 0) AS DOlocationID,
               CAST(NULL AS INT) AS SR_Flag,
               event_type AS Affiliated_base_number
        FROM {ev}""", ev=ev)


# ---------------------------------------------------------------------------
# The same inputs in SQL, for the oracle.  Each is a CTE body.
# ---------------------------------------------------------------------------
SQL_T = f"""
  SELECT CASE WHEN l.l_linestatus = 'O' THEN 'green' ELSE 'yellow' END AS taxi_type,
         NULLIF(l.l_linenumber, 7) AS vendor_id,
         l.l_linenumber AS rate_code_id,
         CASE WHEN l.l_linenumber = 6 THEN 264 ELSE s.s_nationkey END AS pickup_location_id,
         c.c_nationkey AS dropoff_location_id,
         o.o_orderdate AS pickup_datetime,
         l.l_shipdate AS dropoff_datetime,
         l.l_linestatus AS store_and_fwd_flag,
         l.l_quantity AS passenger_count,
         l.l_quantity AS trip_distance,
         CASE l.l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS payment_type,
         l.l_extendedprice AS fare_amount,
         l.l_tax AS extra, l.l_tax AS mta_tax,
         l.l_discount AS tip_amount, l.l_discount AS tolls_amount,
         l.l_tax AS improvement_surcharge,
         l.l_extendedprice AS total_amount,
         l.l_tax AS congestion_surcharge,
         l.l_discount AS airport_fee,
         o.o_orderpriority AS order_priority
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN customer c ON o.o_custkey = c.c_custkey
"""

SQL_ZONES = f"""
  SELECT n.n_nationkey AS location_id, r.r_name AS borough, n.n_name AS zone,
         '{SERVICE_ZONE}' AS service_zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""

SQL_PAYMENTS = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{n}')" for i, n in PAYMENT_TYPES) + ") p(payment_type_id, payment_type_name)"


def sql_canonical(src: str, extracted_at: str) -> str:
    """Canonical 21 columns over a T-shaped relation ``src``."""
    return f"""
  SELECT taxi_type, pickup_datetime, dropoff_datetime,
         CAST(pickup_location_id AS INTEGER) AS pickup_location_id,
         CAST(dropoff_location_id AS INTEGER) AS dropoff_location_id,
         CAST(passenger_count AS INTEGER) AS passenger_count,
         CAST(trip_distance AS DOUBLE) AS trip_distance,
         CAST(rate_code_id AS INTEGER) AS ratecode_id,
         store_and_fwd_flag,
         CAST(payment_type AS INTEGER) AS payment_type,
         fare_amount, extra, mta_tax, tip_amount, tolls_amount,
         improvement_surcharge, total_amount, congestion_surcharge,
         CASE WHEN taxi_type = 'yellow' THEN airport_fee END AS airport_fee,
         CAST(vendor_id AS INTEGER) AS vendor_id,
         TIMESTAMP '{extracted_at}' AS extracted_at
  FROM {src}"""


SQL_REEXTRACTED = f"""
  SELECT * REPLACE (CASE WHEN rate_code_id = 1 THEN -1.0 ELSE tip_amount + 1.0 END AS tip_amount)
  FROM T WHERE order_priority = '{REEXTRACTED_PRIORITY}'
"""

SQL_R = f"""
  {sql_canonical('T', T0)}
  UNION ALL
  {sql_canonical('T2', T1)}
"""

SQL_H = """
  SELECT CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN ''
              ELSE event_type END AS dispatching_base_num,
         ts AS pickup_datetime, ts AS dropOff_datetime,
         NULLIF(user_id % 25, 0) AS PUlocationID,
         NULLIF(user_id % 7, 0) AS DOlocationID,
         CAST(NULL AS INTEGER) AS SR_Flag,
         event_type AS Affiliated_base_number
  FROM events
"""


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the named adapter CTEs (T, T2, Z, P, R, H)."""
    defs = {
        "T": SQL_T,
        "T2": SQL_REEXTRACTED,
        "Z": SQL_ZONES,
        "P": SQL_PAYMENTS,
        "R": SQL_R,
        "H": SQL_H,
    }
    need: list[str] = []
    for n in names:
        if n == "R":
            for dep in ("T", "T2"):
                if dep not in need:
                    need.append(dep)
        if n == "T2" and "T" not in need:
            need.append("T")
        if n not in need:
            need.append(n)
    return "WITH " + ",\n".join(f"{n} AS ({defs[n]})" for n in need) + "\n" + body
