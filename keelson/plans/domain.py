"""Trip domain over the driver's tables.

The pipeline is written for a taxi-trip schema. The driver supplies a TPC-H-like star
schema instead, so one line item becomes one trip:

=====================  ==========================================================
raw trip column        built from
=====================  ==========================================================
VendorID               l_linenumber
tpep_pickup_datetime   o_orderdate at a minute of the day drawn from the order and line
tpep_dropoff_datetime  pickup plus -2 to 117 minutes, drawn from the days to l_shipdate
passenger_count        l_quantity
trip_distance          l_quantity
PULocationID           customer nation + 1
DOLocationID           supplier nation + 1
payment_type           l_returnflag A/N/R -> 1 (card) / 2 (cash) / 3
fare_amount            l_extendedprice / 250 (whole cents)
tip_amount             fare * discount   (integer cents, floored)
tolls_amount           fare * tax        (integer cents, floored)
total_amount           fare + tip + tolls
=====================  ==========================================================

Some rows are junk of every kind the cleaning rules know, by divisibility of their keys (see
``JUNK``): stray years, missing pickups, trips of no or too many miles, without passengers,
from no zone, longer than twelve hours, and refunds with negative amounts. The rest, and the
few trips that end before they start, are what a real month holds.

Zones are nations (zone name) with their region (borough), numbered from 1. All money columns are
derived in integer cents first, so every engine produces the same doubles.

Scale notes: orders x customer is joined first, then line items join that on the
order key (a shuffle join at scale) and the supplier on the supplier key, so the
line-item-sized data is shuffled twice, not three times. Customer and supplier grow
with the data too, so no broadcast is forced here - the planner and adaptive
execution broadcast a side only when its size is under the threshold, and AQE splits
skewed join partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators.joins import checked_broadcast
from keelson.sources.readers import read_table


# A row is junk of a kind if its key is divisible by the number.
JUNK = {"stray_year": ("l_orderkey", 401), "no_pickup": ("l_orderkey", 409), "no_miles": ("l_partkey", 61),
        "many_miles": ("l_partkey", 67), "no_passengers": ("l_partkey", 59), "no_zone": ("l_partkey", 71),
        "long_trip": ("l_partkey", 83), "refund": ("l_partkey", 53)}


def _junk(kind: str):
    key, n = JUNK[kind]
    return F.col(key) % n == 0


# The kinds that go by the part: all a line item needs of its part key, a bit each.
_BY_PART = [kind for kind, (key, _) in JUNK.items() if key == "l_partkey"]


def _junk_bits():
    bits = F.lit(0)
    for i, kind in enumerate(_BY_PART):
        bits = bits + F.when(_junk(kind), 1 << i).otherwise(0)
    return bits


def _has(kind: str):
    return F.col("_junk").bitwiseAND(1 << _BY_PART.index(kind)) != 0


_READERS: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Reader of one driver table. The driver tables are read-only inputs, so one
    resolved reader per (session, table) is reused instead of resolving the file
    and its schema again for every query built in the session."""
    key = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode(), sf_dir.rstrip("/"), name)
    df = _READERS.get(key)
    if df is None:
        df = read_table(spark, sf_dir, name)
        _READERS[key] = df
    return df


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip rows with the taxi column names (the ingest input). Each scan selects
    only the columns used (P1), so Parquet reads just those; what is needed of the part key, the flag and
    the ship date goes through the shuffles as small numbers."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
         .when(F.col("l_returnflag") == "R", 3).otherwise(4).alias("payment_type"),
        F.to_date("l_shipdate").alias("l_shipdate"), _junk_bits().alias("_junk"))
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    price_c = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    fare_c = F.floor(price_c / 250).cast("bigint") * F.when(_has("refund"), -1).otherwise(1)
    at = F.timestamp_add("MINUTE", (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 211) % 1440, F.col("o_orderdate"))
    pickup = (F.when(_junk("no_pickup"), F.lit(None).cast("timestamp_ntz"))
              .when(_junk("stray_year"), F.timestamp_add("YEAR", F.lit(100), at)).otherwise(at))
    minutes = (F.pmod(F.datediff("l_shipdate", "o_orderdate") * 7 + F.col("l_linenumber"), F.lit(120)) - 2
               + F.when(_has("long_trip"), 1000).otherwise(0))
    miles = F.col("l_quantity").cast("double")
    disc = F.round(F.col("l_discount") * 100).cast("bigint")
    tax = F.round(F.col("l_tax") * 100).cast("bigint")
    # orders x customer first: at scale that join shuffles orders (4x smaller than
    # lineitem) by customer key, and the line items are shuffled only twice (by order
    # key, then by supplier key) instead of three times.
    # Both lookups are broadcast only when proven small (bounded row probe); at scale
    # they are sort-merge joins.
    oc = od.join(cu, od.o_custkey == cu.c_custkey).select("o_orderkey", "o_orderdate", "c_nationkey")
    oc, su = checked_broadcast(oc), checked_broadcast(su)
    j = (li.join(oc, li.l_orderkey == oc.o_orderkey)
           .join(su, F.col("l_suppkey") == su.s_suppkey)
           .select(
               F.col("l_linenumber").cast("int").alias("VendorID"),
               pickup.alias("tpep_pickup_datetime"),
               F.timestamp_add("MINUTE", minutes, pickup).alias("tpep_dropoff_datetime"),
               F.when(_has("no_passengers"), 0.0).otherwise(miles).alias("passenger_count"),
               F.when(_has("no_miles"), 0.0).when(_has("many_miles"), miles + 500).otherwise(miles).alias("trip_distance"),
               F.when(_has("no_zone"), 0).otherwise(F.col("c_nationkey") + 1).cast("bigint").alias("PULocationID"),
               (F.col("s_nationkey") + 1).cast("bigint").alias("DOLocationID"),
               "payment_type",
               fare_c.alias("_fare_c"), disc.alias("_disc"), tax.alias("_tax")))
    j = (j.withColumn("_tip_c", F.floor(F.col("_fare_c") * F.col("_disc") / 100))
          .withColumn("_tolls_c", F.floor(F.col("_fare_c") * F.col("_tax") / 100)))
    return j.select(
        "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
        "trip_distance", "PULocationID", "DOLocationID", "payment_type",
        (F.col("_fare_c") / 100.0).alias("fare_amount"),
        (F.col("_tip_c") / 100.0).alias("tip_amount"),
        (F.col("_tolls_c") / 100.0).alias("tolls_amount"),
        ((F.col("_fare_c") + F.col("_tip_c") + F.col("_tolls_c")) / 100.0).alias("total_amount"),
    )


def zone_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup in the seed's shape: LocationID, Borough, Zone, service_zone."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select((F.col("n_nationkey") + 1).cast("int").alias("LocationID"),
                     F.col("r_name").alias("Borough"),
                     F.col("n_name").alias("Zone"),
                     F.concat(F.lit("region_"), F.col("r_regionkey").cast("string")).alias("service_zone")))


# The SQL twin of ``raw_trips`` / ``zone_seed`` for the DuckDB oracle.
RAW_TRIPS_SQL = """
raw_j AS (
  SELECT l.*, o.o_orderdate, c.c_nationkey, s.s_nationkey,
         o.o_orderdate + to_minutes((l.l_orderkey * 37 + l.l_linenumber * 211) % 1440) AS started,
         ((date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) * 7 + l.l_linenumber) % 120 + 120) % 120 - 2
           + CASE WHEN l.l_partkey % 83 = 0 THEN 1000 ELSE 0 END AS minutes
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
raw_p AS (
  SELECT *, CASE WHEN l_orderkey % 409 = 0 THEN NULL WHEN l_orderkey % 401 = 0 THEN started + INTERVAL 100 YEAR ELSE started END AS pickup
  FROM raw_j
),
raw_c AS (
  SELECT CAST(l.l_linenumber AS INTEGER) AS VendorID,
         pickup AS tpep_pickup_datetime,
         pickup + to_minutes(CAST(minutes AS BIGINT)) AS tpep_dropoff_datetime,
         CASE WHEN l_partkey % 59 = 0 THEN 0 ELSE CAST(l_quantity AS DOUBLE) END AS passenger_count,
         CASE WHEN l_partkey % 61 = 0 THEN 0 WHEN l_partkey % 67 = 0 THEN CAST(l_quantity AS DOUBLE) + 500
              ELSE CAST(l_quantity AS DOUBLE) END AS trip_distance,
         CAST(CASE WHEN l_partkey % 71 = 0 THEN 0 ELSE c_nationkey + 1 END AS BIGINT) AS PULocationID,
         CAST(s_nationkey + 1 AS BIGINT) AS DOLocationID,
         CASE l.l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 ELSE 4 END AS payment_type,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) // 250 * CASE WHEN l_partkey % 53 = 0 THEN -1 ELSE 1 END AS fare_c,
         CAST(round(l.l_discount * 100) AS BIGINT) AS disc,
         CAST(round(l.l_tax * 100) AS BIGINT) AS tax
  FROM raw_p l
),
raw_t AS (
  SELECT *, CAST(floor(fare_c * disc / 100) AS BIGINT) AS tip_c,
            CAST(floor(fare_c * tax / 100) AS BIGINT) AS tolls_c
  FROM raw_c
),
raw AS (
  SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
         PULocationID, DOLocationID, payment_type,
         fare_c / 100.0::DOUBLE AS fare_amount,
         tip_c / 100.0::DOUBLE AS tip_amount,
         tolls_c / 100.0::DOUBLE AS tolls_amount,
         (fare_c + tip_c + tolls_c) / 100.0::DOUBLE AS total_amount
  FROM raw_t
)"""

ZONES_SQL = """
zones AS (
  SELECT CAST(n.n_nationkey + 1 AS INTEGER) AS zone_id, r.r_name AS borough, n.n_name AS zone_name,
         'region_' || CAST(r.r_regionkey AS VARCHAR) AS service_zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


# ----------------------------------------------------------------------------- versions

COMMIT_SIZE = 1000


def event_changes(spark: SparkSession, sf_dir: str, commit_size: int = COMMIT_SIZE) -> DataFrame:
    """Change table over ``events``: key user_id, payload (event_type, value, ts);
    one commit (version) per ``commit_size`` consecutive event ids, ``seq`` = event_id.
    signup -> insert, error -> delete, anything else -> update."""
    e = table(spark, sf_dir, "events")
    op = (F.when(F.col("event_type") == "signup", "insert")
           .when(F.col("event_type") == "error", "delete").otherwise("update"))
    return e.select("user_id", "event_type", "value", "ts",
                    F.floor(F.col("event_id") / commit_size).cast("bigint").alias("version"),
                    F.col("event_id").alias("seq"), op.alias("op"))


CHANGES_SQL = f"""
changes AS (
  SELECT user_id, event_type, value, ts, CAST(floor(event_id / {COMMIT_SIZE}) AS BIGINT) AS version,
         event_id AS seq,
         CASE WHEN event_type = 'signup' THEN 'insert' WHEN event_type = 'error' THEN 'delete' ELSE 'update' END AS op
  FROM events
)"""
