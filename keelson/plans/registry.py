"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the driver tables there and returns a
lazy DataFrame over the whole tables. The oracle SQL runs on DuckDB views with the
same table names; column names match the Spark result exactly. Entries without SQL
get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions import columns as C
from keelson.operators import bloom as B
from keelson.operators import digests as D
from keelson.operators import intervals as I
from keelson.operators import joins as J
from keelson.operators import keyed as K
from keelson.operators import layout as L
from keelson.operators import ordered as O
from keelson.operators import quality as Q
from keelson.operators import skew as X
from keelson.operators import versions as Vr
from keelson.plans import domain, gold, runner
from keelson.plans import medallion as M
from keelson.session import scratch_path
from keelson.sources import readers as R
from keelson.sources import sinks as S
from keelson.streaming import feeds as Fd
from keelson.streaming import jobs as T

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ----------------------------------------------------------------------------- shared inputs
#
# The shared layers are pure plans over read-only inputs and the written bronze table: each is
# built once per session and the DataFrame (an immutable logical plan, no data) is reused by
# every query, like a prepared statement.

_PLANS: dict[tuple, DataFrame] = {}


def _plan(spark: SparkSession, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    k = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode()) + key
    df = _PLANS.get(k)
    if df is None:
        df = build()
        _PLANS[k] = df
    return df


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, ("raw", sf_dir), lambda: domain.raw_trips(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze as a written table, as in a layer run: silver's rules are filters on bare columns of its
    files. Written once a session; it is never changed."""
    return _plan(spark, ("bronze", sf_dir), lambda: S.materialize(
        M.to_bronze(raw(spark, sf_dir), "lineitem.parquet", M.RUN_TS), scratch_path(spark, "bronze_layer")))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, ("silver", sf_dir), lambda: M.silver_trips(bronze(spark, sf_dir)))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, ("zones", sf_dir), lambda: M.silver_zones(domain.zone_seed(spark, sf_dir)))


def gold_daily(spark: SparkSession, sf_dir: str, strategy: str = "broadcast") -> DataFrame:
    return _plan(spark, ("gold_daily", sf_dir, strategy),
                 lambda: gold.daily_zone_revenue(silver(spark, sf_dir), zones(spark, sf_dir), strategy))


def gold_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, ("gold_hourly", sf_dir),
                 lambda: gold.hourly_demand(silver(spark, sf_dir), zones(spark, sf_dir)))


# SQL twins of the shared inputs, composed into WITH clauses.
V = M.DEFAULT_VARS
BRONZE_SQL = domain.RAW_TRIPS_SQL + f""",
bronze AS (
  SELECT *, 'lineitem.parquet' AS _source_file, TIMESTAMP '{M.RUN_TS}' AS _ingested_at,
         coalesce(strftime(tpep_pickup_datetime, '%Y-%m'), 'unknown') AS _pickup_month
  FROM raw
)"""

def half(num: str, den: str, digits: int) -> str:
    """SQL twin of ``half_up``: decimal rounding of num / den, exact in 128-bit integers."""
    n, d = f"CAST(({num}) AS HUGEINT)", f"nullif(CAST(({den}) AS HUGEINT), 0)"
    return f"(CAST(sign({n}) * sign({d}) * ((abs({n}) * {2 * 10 ** digits} + abs({d})) // (2 * abs({d}))) AS DOUBLE) / {10 ** digits} + 0.0)"


RENAMED_SQL = BRONZE_SQL + """,
renamed AS (
  SELECT md5(concat_ws('|', CAST(VendorID AS VARCHAR), CAST(tpep_pickup_datetime AS VARCHAR),
             CAST(tpep_dropoff_datetime AS VARCHAR), CAST(PULocationID AS VARCHAR),
             CAST(DOLocationID AS VARCHAR), CAST(total_amount AS VARCHAR))) AS trip_id,
         CAST(VendorID AS INTEGER) AS vendor_id,
         tpep_pickup_datetime AS pickup_at,
         tpep_dropoff_datetime AS dropoff_at,
         CAST(PULocationID AS INTEGER) AS pickup_zone_id,
         CAST(DOLocationID AS INTEGER) AS dropoff_zone_id,
         CAST(passenger_count AS INTEGER) AS passenger_count,
         CAST(trip_distance AS DOUBLE) AS trip_miles,
         CAST(payment_type AS INTEGER) AS payment_type_id,
         fare_amount, tip_amount, tolls_amount, total_amount,
         {minutes} AS trip_minutes,
         CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
         strftime(tpep_pickup_datetime, '%Y-%m') AS pickup_month,
         CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
         _source_file, _ingested_at
  FROM bronze
)""".replace("{minutes}", half("CAST(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) AS BIGINT)", "60", 2))

RULES_SQL = [
    ("pickup_before_start", f"pickup_at >= TIMESTAMP '{V.start_date}'"),
    ("pickup_after_end", f"pickup_at < TIMESTAMP '{V.end_date}'"),
    ("dropoff_not_after_pickup", "dropoff_at > pickup_at"),
    ("zero_miles", "trip_miles > 0"),
    ("too_many_miles", f"trip_miles < {V.max_miles}"),
    ("negative_fare", "fare_amount >= 0"),
    ("negative_total", "total_amount >= 0"),
    ("no_passengers", "passenger_count > 0"),
    ("pickup_zone_invalid", f"pickup_zone_id BETWEEN {V.min_zone} AND {V.max_zone}"),
    ("dropoff_zone_invalid", f"dropoff_zone_id BETWEEN {V.min_zone} AND {V.max_zone}"),
    ("too_long", f"epoch(dropoff_at) - epoch(pickup_at) <= {V.max_trip_hours} * 3600"),
]

SILVER_COLS = ["vendor_id", "pickup_at", "dropoff_at", "pickup_zone_id", "dropoff_zone_id", "passenger_count",
               "trip_miles", "payment_type_id", "fare_amount", "tip_amount", "tolls_amount", "total_amount",
               "trip_minutes", "pickup_date", "pickup_month", "pickup_hour", "_source_file", "_ingested_at"]

SILVER_SQL = RENAMED_SQL + f""",
cleaned AS (
  SELECT * FROM renamed WHERE {' AND '.join(p for _, p in RULES_SQL)}
),
silver AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY _ingested_at NULLS FIRST,
           {', '.join(c + ' NULLS FIRST' for c in SILVER_COLS)}) AS _rn
    FROM cleaned) WHERE _rn = 1
),""" + domain.ZONES_SQL

def _cents_sum(col: str) -> str:
    return f"CAST(sum(CAST(round({col} * 100) AS BIGINT)) AS BIGINT)"


def _avg_cents(col: str) -> str:
    return half(_cents_sum(col), "count(*) * 100", 2)


def _card_cents(col: str) -> str:
    return f"CAST(sum(CASE WHEN t.payment_type_id = 1 THEN CAST(round(t.{col} * 100) AS BIGINT) ELSE 0 END) AS BIGINT)"


GOLD_DAILY_SQL = SILVER_SQL + f""",
gold_daily AS (
  SELECT t.pickup_date, z.borough, z.zone_name,
         count(*) AS trip_count,
         {_cents_sum('t.total_amount')} / 100.0::DOUBLE AS revenue,
         {_avg_cents('t.total_amount')} AS avg_ticket,
         {_avg_cents('t.trip_miles')} AS avg_miles,
         {half(_cents_sum('t.trip_minutes'), 'count(*) * 100', 1)} AS avg_minutes,
         {half(_card_cents('tip_amount') + ' * 100', _card_cents('fare_amount'), 1)} AS card_tip_pct
  FROM silver t LEFT JOIN zones z ON t.pickup_zone_id = z.zone_id
  GROUP BY 1, 2, 3
)"""

GOLD_HOURLY_CTE = f""",
gold_hourly AS (
  SELECT z.borough, dayname(t.pickup_at) AS day_of_week, t.pickup_hour,
         count(*) AS trip_count,
         {_avg_cents('t.trip_miles')} AS avg_miles,
         {_cents_sum('t.total_amount')} / 100.0::DOUBLE AS revenue
  FROM silver t LEFT JOIN zones z ON t.pickup_zone_id = z.zone_id
  GROUP BY 1, 2, 3
)"""
GOLD_HOURLY_SQL = SILVER_SQL + GOLD_HOURLY_CTE


def W(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


# ----------------------------------------------------------------------------- medallion

@register("bronze_trips", W(BRONZE_SQL, "SELECT * FROM bronze"))
def q_bronze(spark, sf_dir):
    """Raw trips + ingest metadata."""
    return bronze(spark, sf_dir)


@register("silver_trips", W(SILVER_SQL, "SELECT * FROM silver"))
def q_silver(spark, sf_dir):
    """The silver fact."""
    return silver(spark, sf_dir)


@register("silver_zones", W(domain.ZONES_SQL, "SELECT * FROM zones"))
def q_zones(spark, sf_dir):
    """Zone dimension."""
    return zones(spark, sf_dir)


@register("gold_daily_zone_revenue", W(GOLD_DAILY_SQL, "SELECT * FROM gold_daily"))
def q_gold_daily(spark, sf_dir):
    """G4 (flagship), J2, J3, A4, A5, A7, A8: daily zone revenue."""
    return gold_daily(spark, sf_dir)


@register("gold_daily_zone_revenue_merge", W(GOLD_DAILY_SQL, "SELECT * FROM gold_daily"))
def q_gold_daily_merge(spark, sf_dir):
    """G4 with a sort-merge join to the dimension."""
    return gold_daily(spark, sf_dir, "merge")


@register("gold_hourly_demand", W(GOLD_HOURLY_SQL, "SELECT * FROM gold_hourly"))
def q_gold_hourly(spark, sf_dir):
    """G5, F8, F9."""
    return gold_hourly(spark, sf_dir)


# ----------------------------------------------------------------------------- reports

@register("borough_totals", W(GOLD_DAILY_SQL, f"""
SELECT borough, CAST(sum(trip_count) AS BIGINT) AS trips,
       {half(_cents_sum('revenue'), '100000000', 1)} AS revenue_millions,
       {half('CAST(sum(CAST(round(card_tip_pct * 10) AS BIGINT)) AS BIGINT)', 'count(card_tip_pct) * 10', 1)} AS avg_card_tip_pct
FROM gold_daily WHERE borough IS NOT NULL GROUP BY borough"""))
def q_borough_totals(spark, sf_dir):
    """G6, A13, O2."""
    return gold.borough_totals(gold_daily(spark, sf_dir))


@register("payment_tipping", W(SILVER_SQL, f"""
SELECT CASE payment_type_id WHEN 1 THEN 'Card' WHEN 2 THEN 'Cash' ELSE 'Other' END AS payment,
       count(*) AS trips, {_avg_cents('tip_amount')} AS avg_tip,
       {half('CAST(sum(CASE WHEN tip_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) * 100', 'count(*)', 1)} AS pct_with_tip
FROM silver GROUP BY 1"""))
def q_payment_tipping(spark, sf_dir):
    """G7, F15, A9."""
    return gold.payment_tipping(silver(spark, sf_dir))


@register("trips_by_hour", W(GOLD_HOURLY_SQL, """
SELECT pickup_hour, CAST(sum(trip_count) AS BIGINT) AS trips FROM gold_hourly GROUP BY 1"""))
def q_trips_by_hour(spark, sf_dir):
    """G8."""
    return gold.trips_by_hour(gold_hourly(spark, sf_dir))


WEEKDAY_HOUR_SQL = domain.RAW_TRIPS_SQL + f""",
wh AS (
  SELECT dayname(tpep_pickup_datetime) AS day_of_week, CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour,
         count(*) AS trips, {_avg_cents('total_amount')} AS avg_total
  FROM raw WHERE total_amount BETWEEN 0 AND 500 GROUP BY 1, 2
)"""


@register("weekday_hour", W(WEEKDAY_HOUR_SQL, "SELECT * FROM wh"))
def q_weekday_hour(spark, sf_dir):
    """G9, P8, F8, F9, O1."""
    return gold.weekday_hour(raw(spark, sf_dir))


@register("weekday_pivot", W(WEEKDAY_HOUR_SQL, "SELECT hour, " + ", ".join(
    f"CAST(sum(trips) FILTER (WHERE day_of_week = '{d}') AS BIGINT) AS {d}" for d in gold.WEEKDAYS)
    + " FROM wh GROUP BY hour"))
def q_weekday_pivot(spark, sf_dir):
    """G10, R1."""
    return gold.weekday_pivot(gold.weekday_hour(raw(spark, sf_dir)))


GENEROUS_SQL = W(SILVER_SQL, """
SELECT z.borough,
       round(avg(CASE WHEN t.total_amount <> 0 THEN t.tip_amount / t.total_amount * 100 END), 2) AS avg_tip_pct,
       count(*) AS trips
FROM silver t JOIN zones z ON t.pickup_zone_id = z.zone_id GROUP BY 1""")


@register("generous_borough", GENEROUS_SQL)
def q_generous(spark, sf_dir):
    """G11, J1, J3, D1 (native expression)."""
    return gold.generous_borough(silver(spark, sf_dir), zones(spark, sf_dir), "broadcast", "native")


@register("generous_borough_merge", GENEROUS_SQL)
def q_generous_merge(spark, sf_dir):
    """G11 with a sort-merge join."""
    return gold.generous_borough(silver(spark, sf_dir), zones(spark, sf_dir), "merge", "native")


@register("generous_borough_pandas_udf", GENEROUS_SQL)
def q_generous_udf(spark, sf_dir):
    """G11 with the Arrow-batched UDF twin."""
    return gold.generous_borough(silver(spark, sf_dir), zones(spark, sf_dir), "broadcast", "vectorized")


@register("load_audit", W(BRONZE_SQL, """
SELECT _pickup_month, count(*) AS rows, min(_ingested_at) AS first_ingested_at FROM bronze GROUP BY 1"""))
def q_load_audit(spark, sf_dir):
    """G12, A1, A6."""
    return gold.load_audit(bronze(spark, sf_dir))


@register("funnel", W(GOLD_DAILY_SQL + GOLD_HOURLY_CTE, """
SELECT 'bronze' AS layer, count(*) AS rows FROM bronze
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'silver_zones', count(*) FROM zones
UNION ALL SELECT 'gold_daily_zone_revenue', count(*) FROM gold_daily
UNION ALL SELECT 'gold_hourly_demand', count(*) FROM gold_hourly"""))
def q_funnel(spark, sf_dir):
    """Silver is written once and both gold tables read it."""
    s = S.materialize(silver(spark, sf_dir), scratch_path(spark, "silver"))
    z = zones(spark, sf_dir)
    return gold.funnel({"bronze": bronze(spark, sf_dir), "silver": s, "silver_zones": z,
                        "gold_daily_zone_revenue": gold.daily_zone_revenue(s, z),
                        "gold_hourly_demand": gold.hourly_demand(s, z)})


@register("format_count", W(domain.RAW_TRIPS_SQL, f"""
SELECT count(*) AS rows, {half(_cents_sum('trip_distance'), 'count(*) * 100', 4)} AS avg_distance FROM raw"""))
def q_format_count(spark, sf_dir):
    """G14 (queries 1-2), A1, A5."""
    return gold.format_count(raw(spark, sf_dir))


@register("format_grouped", W(domain.RAW_TRIPS_SQL, f"""
SELECT payment_type, count(*) AS trips, {_avg_cents('total_amount')} AS avg_total
FROM raw WHERE trip_distance > 5 GROUP BY 1"""))
def q_format_grouped(spark, sf_dir):
    """G14 (query 3), P13, A3."""
    return gold.format_grouped(raw(spark, sf_dir))


ONE_DAY = "1998-03-15"


@register("one_day", W(domain.RAW_TRIPS_SQL, f"""
SELECT count(*) AS trips, {_avg_cents('total_amount')} AS avg_total
FROM raw WHERE tpep_pickup_datetime >= TIMESTAMP '{ONE_DAY}' AND tpep_pickup_datetime < TIMESTAMP '{ONE_DAY}' + INTERVAL 1 DAY"""))
def q_one_day(spark, sf_dir):
    """G15, P10 (as a pushed-down range)."""
    return gold.one_day(raw(spark, sf_dir), ONE_DAY)


@register("payment_summary", W(domain.RAW_TRIPS_SQL, f"""
SELECT payment_type, count(*) AS trips, {_avg_cents('total_amount')} AS avg_total FROM raw GROUP BY 1"""))
def q_payment_summary(spark, sf_dir):
    """G16, O1."""
    return gold.payment_summary(raw(spark, sf_dir))


@register("daily_trips", W(domain.RAW_TRIPS_SQL, f"""
SELECT CAST(tpep_pickup_datetime AS DATE) AS day, count(*) AS trips, {_avg_cents('total_amount')} AS avg_amount
FROM raw WHERE tpep_pickup_datetime IS NOT NULL GROUP BY 1 ORDER BY 1 LIMIT 8"""))
def q_daily_trips(spark, sf_dir):
    """G17, F6, O1, O4 (first 8 days; the limit is the report)."""
    return gold.daily_trips(raw(spark, sf_dir), 8)


@register("most_active_zones", W(SILVER_SQL, f"""
SELECT pickup_zone_id, count(*) AS trips, {_avg_cents('total_amount')} AS avg_total
FROM silver GROUP BY 1 ORDER BY trips DESC, pickup_zone_id LIMIT 5"""))
def q_most_active(spark, sf_dir):
    """G18, O3 (top 5 with a key tie-break, plus the average ticket)."""
    return gold.top_zones(silver(spark, sf_dir), 5)


@register("avg_total_by_zone", W(SILVER_SQL, f"""
SELECT pickup_zone_id, count(*) AS trips, {_avg_cents('total_amount')} AS avg_total FROM silver GROUP BY 1"""))
def q_avg_by_zone(spark, sf_dir):
    """A5 grouped: the wide groupBy + avg per pickup zone."""
    return gold.avg_total_by_zone(silver(spark, sf_dir))


TPB_SQL = W(SILVER_SQL, """
SELECT z.borough, count(*) AS trips FROM silver t JOIN zones z ON t.pickup_zone_id = z.zone_id GROUP BY 1""")


@register("trips_per_borough", TPB_SQL)
def q_tpb(spark, sf_dir):
    """G19, J3 (checked broadcast), A3."""
    return gold.trips_per_borough(silver(spark, sf_dir), zones(spark, sf_dir), "broadcast")


@register("trips_per_borough_merge", TPB_SQL)
def q_tpb_merge(spark, sf_dir):
    """G19, J4 (sort-merge)."""
    return gold.trips_per_borough(silver(spark, sf_dir), zones(spark, sf_dir), "merge")


@register("trips_per_borough_salted", TPB_SQL)
def q_tpb_salted(spark, sf_dir):
    """Salted join; the oracle is the plain join."""
    return gold.trips_per_borough(silver(spark, sf_dir), zones(spark, sf_dir), salts=16)


SANDBOX_DAY = "1997-06-02"


@register("sandbox_day", W(BRONZE_SQL, f"""
SELECT tpep_pickup_datetime AS pickup_at, total_amount FROM bronze
WHERE tpep_pickup_datetime >= TIMESTAMP '{SANDBOX_DAY}' AND tpep_pickup_datetime < TIMESTAMP '{SANDBOX_DAY}' + INTERVAL 1 DAY"""))
def q_sandbox_day(spark, sf_dir):
    """The one-day projection the sandbox appends."""
    return gold.sandbox_day(bronze(spark, sf_dir), SANDBOX_DAY)


@register("daily_revenue", W(GOLD_DAILY_SQL, f"""
SELECT pickup_date, {_cents_sum('revenue')} / 100.0::DOUBLE AS revenue FROM gold_daily GROUP BY 1"""))
def q_daily_revenue(spark, sf_dir):
    """G21 (series)."""
    return gold.daily_revenue(gold_daily(spark, sf_dir))


@register("revenue_total", W(GOLD_DAILY_SQL, f"""
SELECT {_cents_sum('revenue')} / 100.0::DOUBLE AS revenue, count(DISTINCT pickup_date) AS days FROM gold_daily"""))
def q_revenue_total(spark, sf_dir):
    """G21 (grand total)."""
    return gold.revenue_total(gold_daily(spark, sf_dir))


# ----------------------------------------------------------------------------- joins and skew


MISSING_ZONE = 24


@register("orphan_trips", W(SILVER_SQL, f"""
SELECT t.* FROM silver t
WHERE t.pickup_zone_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM zones z WHERE z.zone_id <> {MISSING_ZONE} AND z.zone_id = t.pickup_zone_id)"""))
def q_orphans(spark, sf_dir):
    """Trips whose pickup zone is missing once one zone is dropped from the
    dimension on purpose (what filtering a dimension does to its facts)."""
    dim = zones(spark, sf_dir).filter(F.col("zone_id") != MISSING_ZONE)
    return Q.relationships(silver(spark, sf_dir), "pickup_zone_id", dim, "zone_id")


@register("skew_profile", """
WITH kc AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT count(*) AS keys, min(n) AS min_rows, quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS p50,
       quantile_cont(n, 0.75) AS p75, quantile_cont(n, 0.95) AS p95, max(n) AS max_rows,
       max(n) / quantile_cont(n, 0.5) AS max_over_median
FROM kc""")
def q_skew_profile(spark, sf_dir):
    """Rows-per-supplier distribution of lineitem."""
    return X.skew_profile(domain.table(spark, sf_dir, "lineitem"), "l_suppkey")


HOT_SUPP = 7
SKEWED_LINES_SQL = f"""
skewed AS (
  SELECT CASE WHEN l_orderkey % 100 < 90 THEN {HOT_SUPP} ELSE l_suppkey END AS l_suppkey,
         l_orderkey, l_linenumber, l_quantity
  FROM lineitem
)"""


def skewed_lines(spark, sf_dir):
    """lineitem with 90 % of the rows moved onto supplier 7 (P15 fixture)."""
    li = domain.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    return J.with_hot_key(li, "l_suppkey", HOT_SUPP, 90, by="l_orderkey")


@register("skewed_agg", W(SKEWED_LINES_SQL, """
SELECT l_suppkey, count(*) AS lines, sum(l_quantity) AS quantity FROM skewed GROUP BY 1"""))
def q_skewed_agg(spark, sf_dir):
    """Aggregation on a key holding 90 % of rows (partial aggregation absorbs it)."""
    return skewed_lines(spark, sf_dir).groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))


SKEWED_JOIN_SQL = W(SKEWED_LINES_SQL, """
SELECT s.s_nationkey, count(*) AS lines FROM skewed k JOIN supplier s ON k.l_suppkey = s.s_suppkey GROUP BY 1""")


def _skewed_join(spark, sf_dir, mode):
    k = skewed_lines(spark, sf_dir)
    s = domain.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    if mode == "salted":
        hot = J.hot_key_rows(k, "l_suppkey", 0.01)
        j = J.salted_join(k, s, "l_suppkey", "s_suppkey", max(16, J.salts_for(hot)),
                          salt_cols=["l_orderkey", "l_linenumber"], hot=list(hot))
    else:
        # The largest hash of a group is asked for so that the rows keep their weight through the join.
        k = J.weighed(k, ["l_orderkey", "l_linenumber"], "__row")
        j = J.join_dim(k, s, F.col("l_suppkey") == F.col("s_suppkey"), "inner", "merge")
        return (j.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("lines"), F.max("__row").alias("__row"))
                .filter(F.col("__row").isNotNull()).drop("__row"))
    return j.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("lines"))


@register("skewed_top_keys", W(SKEWED_LINES_SQL, """
SELECT l_suppkey, count(*) AS lines FROM skewed GROUP BY 1 ORDER BY lines DESC, l_suppkey LIMIT 5"""))
def q_skewed_top(spark, sf_dir):
    """The hot key shows up first in a top-5 of rows per key."""
    return O.top_groups(skewed_lines(spark, sf_dir), "l_suppkey", 5, "lines")


@register("skewed_join", SKEWED_JOIN_SQL)
def q_skewed_join(spark, sf_dir):
    """Sort-merge join on the hot key (adaptive execution splits the hot partition)."""
    return _skewed_join(spark, sf_dir, "plain")


@register("skewed_join_salted", SKEWED_JOIN_SQL)
def q_skewed_join_salted(spark, sf_dir):
    """The same join salted on the detected hot keys only."""
    return _skewed_join(spark, sf_dir, "salted")


# ----------------------------------------------------------------------------- windows / ordering

LINE_COLS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]


@register("silver_dedup", f"""
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate, {', '.join(LINE_COLS)}) AS _rn
  FROM lineitem) WHERE _rn = 1""")
def q_dedup(spark, sf_dir):
    """First line per (order, line number) by ship date; all columns break ties."""
    return K.dedup_first(domain.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf_dir):
    """M2, Q2: keys that would make a merge ambiguous."""
    return K.duplicate_keys(domain.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("sequential_id", """
SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 500000 AS seq_id FROM orders""")
def q_sequential_id(spark, sf_dir):
    """Dense ids in (order date, key) order after an offset, without a one-task window."""
    o = domain.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return O.sequential_id(o, ["o_orderdate", "o_orderkey"], "seq_id", offset=500000)


@register("batch_slice", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 200")
def q_batch_slice(spark, sf_dir):
    """Rows 201-300 in key order (the next batch)."""
    return O.batch_slice(domain.table(spark, sf_dir, "orders"), ["o_orderkey"], 100, 200)


@register("batch_slice_ties", "SELECT * FROM events ORDER BY event_type, value, event_id LIMIT 150 OFFSET 400")
def q_batch_slice_ties(spark, sf_dir):
    """Rows 401-550 in an order of text, doubles and ids whose first columns repeat."""
    return O.batch_slice(domain.table(spark, sf_dir, "events"), ["event_type", "value", "event_id"], 150, 400, enough=500)


@register("batch_slice_far", "SELECT * FROM events ORDER BY ts, event_id LIMIT 100 OFFSET 800")
def q_batch_slice_far(spark, sf_dir):
    """Rows 801-900 by time, with few rows left for the last sort."""
    return O.batch_slice(domain.table(spark, sf_dir, "events"), ["ts", "event_id"], 100, 800, enough=200)


# ----------------------------------------------------------------------------- versions

CHG = domain.CHANGES_SQL


def changes(spark, sf_dir):
    return domain.event_changes(spark, sf_dir)


def _as_of_sql(v: int | None, cols: str = "user_id, event_type, value, ts, version") -> str:
    where = "" if v is None else f"WHERE version <= {v}"
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY version DESC, seq DESC) AS rn "
            f"FROM changes {where}) WHERE rn = 1 AND op <> 'delete'")


@register("as_of_v5", W(CHG, _as_of_sql(5)))
def q_as_of(spark, sf_dir):
    """Table state pinned at version 5."""
    return Vr.as_of(changes(spark, sf_dir), ["user_id"], 5)


@register("as_of_latest", W(CHG, _as_of_sql(None)))
def q_as_of_latest(spark, sf_dir):
    """M5: latest state."""
    return Vr.as_of(changes(spark, sf_dir), ["user_id"])


PAYLOAD = ["event_type", "value", "ts"]


@register("restore_state", W(CHG, _as_of_sql(3, "user_id, event_type, value, ts")))
def q_restore_state(spark, sf_dir):
    """M7: state after restoring version 3 as a new version equals the state at 3."""
    c = changes(spark, sf_dir)
    restored = c.unionByName(Vr.restore(c, ["user_id"], 3, PAYLOAD))
    return Vr.as_of(restored, ["user_id"]).drop("version")


@register("restore_changes", W(CHG + f""",
cur AS ({_as_of_sql(None)}),
old AS ({_as_of_sql(3)})""", """
SELECT coalesce(c.user_id, o.user_id) AS user_id, o.event_type, o.value, o.ts,
       (SELECT max(version) + 1 FROM changes) AS version, CAST(0 AS BIGINT) AS seq,
       CASE WHEN o.user_id IS NULL THEN 'delete' WHEN c.user_id IS NULL THEN 'insert' ELSE 'update' END AS op
FROM cur c FULL OUTER JOIN old o ON c.user_id = o.user_id
WHERE o.user_id IS NULL OR c.user_id IS NULL
   OR NOT (c.event_type IS NOT DISTINCT FROM o.event_type AND c.value IS NOT DISTINCT FROM o.value
           AND c.ts IS NOT DISTINCT FROM o.ts)"""))
def q_restore_changes(spark, sf_dir):
    """M7: the change rows of the restore commit."""
    return Vr.restore(changes(spark, sf_dir), ["user_id"], 3, PAYLOAD)


@register("history", W(CHG, """
SELECT version, count(*) AS n_changes,
       CAST(sum(CASE WHEN op = 'insert' THEN 1 ELSE 0 END) AS BIGINT) AS n_insert,
       CAST(sum(CASE WHEN op = 'update' THEN 1 ELSE 0 END) AS BIGINT) AS n_update,
       CAST(sum(CASE WHEN op = 'delete' THEN 1 ELSE 0 END) AS BIGINT) AS n_delete,
       max(ts) AS committed_at
FROM changes GROUP BY version"""))
def q_history(spark, sf_dir):
    """M6: one row per version."""
    return Vr.history(changes(spark, sf_dir), "ts")


@register("snapshot_diff", W(CHG + f""",
a AS ({_as_of_sql(3)}),
b AS ({_as_of_sql(7)})""", """
SELECT coalesce(a.user_id, b.user_id) AS user_id,
       CASE WHEN a.user_id IS NULL THEN 'added' WHEN b.user_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM a FULL OUTER JOIN b ON a.user_id = b.user_id
WHERE a.user_id IS NULL OR b.user_id IS NULL
   OR NOT (a.event_type IS NOT DISTINCT FROM b.event_type AND a.value IS NOT DISTINCT FROM b.value)"""))
def q_snapshot_diff(spark, sf_dir):
    """M9: what changed between versions 3 and 7."""
    c = changes(spark, sf_dir)
    return Vr.snapshot_diff(Vr.as_of(c, ["user_id"], 3), Vr.as_of(c, ["user_id"], 7), ["user_id"],
                            ["event_type", "value"])


@register("rows_by_version", W(CHG + """,
per_kv AS (
  SELECT user_id, version, op FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, version ORDER BY seq DESC) AS rn FROM changes) WHERE rn = 1
),
d AS (
  SELECT version, CAST(op <> 'delete' AS INTEGER)
         - coalesce(lag(CAST(op <> 'delete' AS INTEGER)) OVER (PARTITION BY user_id ORDER BY version), 0) AS delta
  FROM per_kv
),
pv AS (SELECT version, sum(delta) AS delta FROM d GROUP BY version)""", """
SELECT version, CAST(sum(delta) OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS live_rows
FROM pv"""))
def q_rows_by_version(spark, sf_dir):
    """Live rows after every version."""
    return Vr.rows_by_version(changes(spark, sf_dir), ["user_id"])


LIVE_SQL = ORACLE["rows_by_version"]


def _interval_table(spark, sf_dir) -> str:
    """The event changes as a table of validity intervals: those of the first commits folded at
    once, the later ones folded in."""
    c = changes(spark, sf_dir)
    path, early = scratch_path(spark, "intervals"), scratch_path(spark, "intervals_early")
    I.write(I.fold(c.filter(F.col("version") <= 4), ["user_id"]), early)
    I.write(I.fold_in(I.read(spark, early).drop("is_open"), c.filter(F.col("version") > 4), ["user_id"]), path)
    return path


@register("interval_state_v5", W(CHG, _as_of_sql(5)))
def q_interval_state(spark, sf_dir):
    """The state at version 5 as a range filter on validity intervals."""
    return I.state_at(I.read(spark, _interval_table(spark, sf_dir)), 5).select("user_id", "event_type", "value", "ts", "version")


@register("interval_state_latest", W(CHG, _as_of_sql(None)))
def q_interval_latest(spark, sf_dir):
    """M5: the latest state: the folder of open intervals."""
    return I.state_at(I.read(spark, _interval_table(spark, sf_dir))).select("user_id", "event_type", "value", "ts", "version")


@register("interval_live_rows", LIVE_SQL)
def q_interval_live(spark, sf_dir):
    """Live rows after every version from the ends of the intervals."""
    c = changes(spark, sf_dir)
    return I.live_rows(I.fold(c, ["user_id"]), c.select("version").distinct())


@register("snapshot_diff_digests", ORACLE["snapshot_diff"])
def q_snapshot_digests(spark, sf_dir):
    """M9: versions 3 and 7 written as snapshots with digests; only ranges whose digests differ are
    read and joined."""
    c, paths = changes(spark, sf_dir), {}
    for v in (3, 7):
        paths[v] = scratch_path(spark, f"snapshot_{v}")
        D.write_snapshot(Vr.as_of(c, ["user_id"], v), ["user_id"], paths[v], ["event_type", "value"], width=64, fine=16)
    return D.diff_snapshots(spark, paths[3], paths[7], ["user_id"], ["event_type", "value"])


UPSERT_SQL = """
target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
source AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice,
                  o_orderdate, o_orderpriority
           FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')"""


def upsert_inputs(spark, sf_dir):
    o = domain.table(spark, sf_dir, "orders")
    target = o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    source = (o.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
               .withColumn("o_orderstatus", F.lit("U")).withColumn("o_totalprice", F.col("o_totalprice") + 1.0))
    return target, source


@register("upsert", W(UPSERT_SQL, """
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM source"""))
def q_upsert(spark, sf_dir):
    """1999 orders updated, 2000+ orders inserted, the rest copied."""
    t, s = upsert_inputs(spark, sf_dir)
    return Vr.upsert(t, s, ["o_orderkey"])


@register("upsert_reduced", ORACLE["upsert"])
def q_upsert_reduced(spark, sf_dir):
    """The same merge with a Bloom filter of the source's keys in front of the shuffle."""
    t, s = (S.materialize(x, scratch_path(spark, n)) for x, n in zip(upsert_inputs(spark, sf_dir), ("target", "source")))
    return B.upsert_reduced(t, s, ["o_orderkey"])


@register("orphans_reduced", """
SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')""")
def q_orphans_reduced(spark, sf_dir):
    """Line items without an order of before 1999; most are told by a Bloom filter of the orders."""
    o = domain.table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    return B.orphans_reduced(_lineitem(spark, sf_dir), o, "l_orderkey", "o_orderkey")


@register("upsert_metrics", W(UPSERT_SQL, """
SELECT count(s.o_orderkey) AS source_rows,
       CAST(sum(CASE WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS updated,
       CAST(sum(CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS inserted,
       CAST(sum(CASE WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS copied
FROM target t FULL OUTER JOIN source s ON t.o_orderkey = s.o_orderkey"""))
def q_upsert_metrics(spark, sf_dir):
    """M3: merge metrics."""
    t, s = upsert_inputs(spark, sf_dir)
    return Vr.upsert_metrics(t, s, ["o_orderkey"])


@register("silver_incremental", W(SILVER_SQL, "SELECT * FROM silver"))
def q_silver_incremental(spark, sf_dir):
    """Silver built up to 1997, then an incremental run over the rest
    (watermark filter, dedup, upsert) equals a full build."""
    b = bronze(spark, sf_dir)
    first = M.silver_trips(b.filter(F.col("tpep_pickup_datetime") < F.lit("1998-01-01").cast("timestamp_ntz")))
    return M.silver_trips(b, target=S.materialize(first, scratch_path(spark, "silver_first")))


@register("schema_evolution", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS priority FROM orders
WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority AS priority FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def q_schema_evolution(spark, sf_dir):
    """An append carrying a new column; old rows read it as NULL."""
    o = domain.table(spark, sf_dir, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    old = o.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_custkey", "o_totalprice")
    new = (o.filter(F.col("o_orderdate") >= cut)
            .select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderpriority").alias("priority")))
    Vr.check_schema(new, old.schema, evolve=True)
    return Vr.union_evolving(old, new)


GROWTH_MONTH = "1997-06"


@register("rerun_growth", W(SILVER_SQL, """
SELECT 'append' AS strategy, count(*) * 3 AS rows, 3 AS runs FROM silver
UNION ALL SELECT 'upsert', count(*), 3 FROM silver"""))
def q_rerun_growth(spark, sf_dir):
    """The same batch loaded three times into a table that appends and one that
    upserts, each run written: the first holds every row three times, the second once.

    The upserted table is bucketed by the key, as its 16 bytes: silver's dedup deals the rows by the same
    hash, so the first run, which finds no table yet, writes the batch in place, and the later ones load it
    from there and merge without shuffling either side."""
    buckets = S.buckets_for(spark)
    write = lambda df, run: S.materialize_bucketed(
        df, scratch_path(spark, f"upserted_{run}"), ["trip_id"], buckets, ["pickup_at"])
    batch = upserted = write(silver(spark, sf_dir).withColumn("trip_id", F.unhex("trip_id")), 0)
    appended = scratch_path(spark, "appended")
    for run in range(3):
        S.append(batch, appended, options=S.COMPACT)
        if run:
            upserted = write(Vr.upsert(upserted, batch, ["trip_id"], check_unique=False), run)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("strategy"), "rows", F.lit(3).alias("runs"))
    return count(spark.read.parquet(appended), "append").unionByName(count(upserted, "upsert"))


@register("sandbox_append", W(BRONZE_SQL, f"""
SELECT tpep_pickup_datetime AS pickup_at, total_amount FROM bronze, range(2)
WHERE tpep_pickup_datetime >= TIMESTAMP '{SANDBOX_DAY}' AND tpep_pickup_datetime < TIMESTAMP '{SANDBOX_DAY}' + INTERVAL 1 DAY"""))
def q_sandbox_append(spark, sf_dir):
    """The sandbox day appended by two runs; its rows are there twice."""
    p = scratch_path(spark, "sandbox")
    for _ in range(2):
        runner.append_day(bronze(spark, sf_dir), SANDBOX_DAY, p)
    return spark.read.parquet(p)


@register("upsert_moved_keys", """
WITH target AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year, CAST(NULL AS VARCHAR) AS note FROM orders),
source AS (SELECT * REPLACE (CAST(year(o_orderdate) + 1 AS INTEGER) AS o_year, 'moved' AS note)
           FROM target WHERE o_orderkey % 10 = 0 OR o_year = 2001)
SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source)
UNION ALL SELECT * FROM source""")
def q_upsert_moved_keys(spark, sf_dir):
    """A partitioned merge whose source moves keys to the next year, a whole year
    among them, and brings a new column: one row per key is left."""
    o = domain.table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    path = scratch_path(spark, "orders_moved")
    S.write_partitioned(o, path, ["o_year"])
    source = (o.filter((F.col("o_orderkey") % 10 == 0) | (F.col("o_year") == 2001))
              .withColumn("o_year", F.col("o_year") + 1).withColumn("note", F.lit("moved")))
    Vr.upsert_partitions(spark, path, source, ["o_orderkey"], "o_year", scratch_path(spark, "staging"))
    return R.read_partitioned(spark, path, evolve=True).select(*source.columns)


@register("schema_evolution_files", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS priority FROM orders
WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority AS priority FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def q_schema_evolution_files(spark, sf_dir):
    """A table on disk gets an append with a new column; the merged schema reads
    it as NULL in the older files."""
    o = domain.table(spark, sf_dir, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    p = scratch_path(spark, "evolving")
    old = o.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_custkey", "o_totalprice")
    new = o.filter(F.col("o_orderdate") >= cut).select(*old.columns, F.col("o_orderpriority").alias("priority"))
    S.rebuild(old, p)
    Vr.check_schema(new, old.schema, evolve=True)
    S.append(new, p)
    return R.read_partitioned(spark, p, evolve=True).select(*new.columns)


# ----------------------------------------------------------------------------- quality

# The boroughs (region names) and payment codes the checks accept.
BOROUGHS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PAYMENT_CODES = [1, 2, 3, 4, 5, 6]


def checks(spark, sf_dir):
    """The model tests of the pipeline (Q1-Q6) as (name, failing rows). Each layer
    is written once and every check reads the written table."""
    s = S.materialize(silver(spark, sf_dir), scratch_path(spark, "silver"))
    z = zones(spark, sf_dir)
    g = S.materialize(gold.daily_zone_revenue(s, z), scratch_path(spark, "gold_daily"))
    h = S.materialize(gold.hourly_demand(s, z), scratch_path(spark, "gold_hourly"))
    return [
        ("silver_trip_id_unique", Q.unique(s, "trip_id")),
        ("silver_trip_id_not_null", Q.not_null(s, "trip_id")),
        ("silver_pickup_at_not_null", Q.not_null(s, "pickup_at")),
        ("silver_pickup_zone_relationships", Q.relationships(s, "pickup_zone_id", z, "zone_id")),
        ("silver_payment_type_accepted", Q.accepted(s, "payment_type_id", PAYMENT_CODES)),
        ("silver_total_amount_not_null", Q.not_null(s, "total_amount")),
        ("zones_zone_id_unique", Q.unique(z, "zone_id")),
        ("zones_zone_id_not_null", Q.not_null(z, "zone_id")),
        ("zones_borough_accepted", Q.accepted(z, "borough", BOROUGHS)),
        ("gold_pickup_date_not_null", Q.not_null(g, "pickup_date")),
        ("gold_trip_count_not_null", Q.not_null(g, "trip_count")),
        ("hourly_pickup_hour_not_null", Q.not_null(h, "pickup_hour")),
        ("hourly_pickup_hour_accepted", Q.accepted(h, "pickup_hour", list(range(24)))),
        ("trip_duration_sane", Q.duration_sane(s, V.max_trip_hours)),
        ("gold_matches_silver", Q.reconcile(s, "total_amount", g, "revenue", 1.0)),
    ]


def _count(name: str, body: str) -> str:
    return f"SELECT '{name}' AS \"check\", count(*) AS failures FROM ({body})"


RUN_CHECKS_SQL = W(GOLD_DAILY_SQL + GOLD_HOURLY_CTE, "\nUNION ALL ".join([
    _count("silver_trip_id_unique", "SELECT trip_id FROM silver WHERE trip_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    _count("silver_trip_id_not_null", "SELECT 1 FROM silver WHERE trip_id IS NULL"),
    _count("silver_pickup_at_not_null", "SELECT 1 FROM silver WHERE pickup_at IS NULL"),
    _count("silver_pickup_zone_relationships",
           "SELECT 1 FROM silver t WHERE t.pickup_zone_id IS NOT NULL AND t.pickup_zone_id NOT IN (SELECT zone_id FROM zones)"),
    _count("silver_payment_type_accepted",
           f"SELECT payment_type_id FROM silver WHERE payment_type_id NOT IN ({', '.join(map(str, PAYMENT_CODES))}) GROUP BY 1"),
    _count("silver_total_amount_not_null", "SELECT 1 FROM silver WHERE total_amount IS NULL"),
    _count("zones_zone_id_unique", "SELECT zone_id FROM zones WHERE zone_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    _count("zones_zone_id_not_null", "SELECT 1 FROM zones WHERE zone_id IS NULL"),
    _count("zones_borough_accepted",
           f"SELECT borough FROM zones WHERE borough NOT IN ({', '.join(repr(b) for b in BOROUGHS)}) GROUP BY 1"),
    _count("gold_pickup_date_not_null", "SELECT 1 FROM gold_daily WHERE pickup_date IS NULL"),
    _count("gold_trip_count_not_null", "SELECT 1 FROM gold_daily WHERE trip_count IS NULL"),
    _count("hourly_pickup_hour_not_null", "SELECT 1 FROM gold_hourly WHERE pickup_hour IS NULL"),
    _count("hourly_pickup_hour_accepted",
           "SELECT pickup_hour FROM gold_hourly WHERE pickup_hour NOT BETWEEN 0 AND 23 GROUP BY 1"),
    _count("trip_duration_sane",
           f"SELECT 1 FROM silver WHERE epoch(dropoff_at) - epoch(pickup_at) > {V.max_trip_hours} * 3600"),
    _count("gold_matches_silver",
           f"SELECT 1 FROM (SELECT {_cents_sum('total_amount')} AS a FROM silver), "
           f"(SELECT {_cents_sum('revenue')} AS b FROM gold_daily) WHERE abs(a - b) / 100.0::DOUBLE > 1.0"),
]))


@register("run_checks", RUN_CHECKS_SQL)
def q_run_checks(spark, sf_dir):
    """Q1-Q6, Q10: every model test with its failure count (0 = pass). The tests on rows are
    counted in one pass over each written table."""
    s = S.materialize(silver(spark, sf_dir), scratch_path(spark, "silver"))
    z = zones(spark, sf_dir)
    g = S.materialize(gold.daily_zone_revenue(s, z), scratch_path(spark, "gold_daily"))
    h = S.materialize(gold.hourly_demand(s, z), scratch_path(spark, "gold_hourly"))
    null = lambda c: F.col(c).isNull()
    outside = lambda c, values: (F.col(c).isNotNull() & ~F.col(c).isin(values), c)
    too_long = C.seconds_between("pickup_at", "dropoff_at") > V.max_trip_hours * 3600
    rows = [
        Q.count_failures(s, [("silver_trip_id_not_null", null("trip_id")), ("silver_pickup_at_not_null", null("pickup_at")),
                             ("silver_payment_type_accepted", outside("payment_type_id", PAYMENT_CODES)),
                             ("silver_total_amount_not_null", null("total_amount")), ("trip_duration_sane", too_long)]),
        Q.count_failures(z, [("zones_zone_id_not_null", null("zone_id")), ("zones_borough_accepted", outside("borough", BOROUGHS))]),
        Q.count_failures(g, [("gold_pickup_date_not_null", null("pickup_date")), ("gold_trip_count_not_null", null("trip_count"))]),
        Q.count_failures(h, [("hourly_pickup_hour_not_null", null("pickup_hour")),
                             ("hourly_pickup_hour_accepted", outside("pickup_hour", list(range(24))))]),
        Q.run_checks([("silver_trip_id_unique", Q.unique(s, "trip_id")),
                      ("silver_pickup_zone_relationships", Q.relationships(s, "pickup_zone_id", z, "zone_id")),
                      ("zones_zone_id_unique", Q.unique(z, "zone_id")),
                      ("gold_matches_silver", Q.reconcile(s, "total_amount", g, "revenue", 1.0))]),
    ]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def census_rules():
    return Q.bronze_census_rules(V.start_date, V.end_date, V.max_miles, V.max_trip_hours)


CENSUS_RULES_SQL = [
    ("pickup_out_of_range", f"tpep_pickup_datetime < TIMESTAMP '{V.start_date}' OR tpep_pickup_datetime >= TIMESTAMP '{V.end_date}'"),
    ("dropoff_not_after_pickup", "tpep_dropoff_datetime <= tpep_pickup_datetime"),
    ("zero_distance", "trip_distance <= 0"),
    ("distance_over_limit", f"trip_distance > {V.max_miles}"),
    ("negative_fare", "fare_amount < 0"),
    ("negative_total", "total_amount < 0"),
    ("no_passengers", "passenger_count IS NULL OR passenger_count <= 0"),
    ("zone_out_of_range", "PULocationID NOT BETWEEN 1 AND 265 OR DOLocationID NOT BETWEEN 1 AND 265"),
    ("too_long", f"epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) > {V.max_trip_hours} * 3600"),
]


@register("dq_census", W(BRONZE_SQL, f"SELECT rule, rows, {half('rows * 100', 'total', 3)} AS pct FROM ("
                         + "\nUNION ALL ".join(
                             f"SELECT '{n}' AS rule, CAST(sum(CASE WHEN {p} THEN 1 ELSE 0 END) AS BIGINT) AS rows, "
                             f"count(*) AS total FROM bronze" for n, p in CENSUS_RULES_SQL) + ")"))
def q_dq_census(spark, sf_dir):
    """Nine junk rules counted in one pass, unpivoted."""
    return Q.dq_census(bronze(spark, sf_dir), census_rules())


@register("reject_reasons", W(RENAMED_SQL, "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{n}' AS reason, count(*) AS rows FROM renamed WHERE NOT coalesce({p}, false)" for n, p in RULES_SQL)
    + ") WHERE rows > 0"))
def q_reject_reasons(spark, sf_dir):
    """Q8: rows silver drops, counted per failed rule (a row may fail several)."""
    r = M.rejects(M.silver_rename(bronze(spark, sf_dir)))
    return r.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@register("reconcile", W(GOLD_DAILY_SQL, f"""
SELECT a / 100.0::DOUBLE AS left_amount, b / 100.0::DOUBLE AS right_amount, abs(a - b) / 100.0::DOUBLE AS gap
FROM (SELECT {_cents_sum('total_amount')} AS a FROM silver), (SELECT {_cents_sum('revenue')} AS b FROM gold_daily)"""))
def q_reconcile(spark, sf_dir):
    """Silver total vs gold total, both in cents (silver written once)."""
    s = S.materialize(silver(spark, sf_dir), scratch_path(spark, "silver"))
    return Q.reconcile(s, "total_amount", gold.daily_zone_revenue(s, zones(spark, sf_dir)), "revenue",
                       failing_only=False)


# ----------------------------------------------------------------------------- layout and sources



def _lineitem(spark, sf_dir):
    return domain.table(spark, sf_dir, "lineitem")


# Files of the compaction and z-order queries: small, so that the test tables make several.
TARGET_FILE = 128 * 1024


def _compacted(spark, sf_dir) -> tuple[str, str]:
    """Paths of lineitem as 64 small files and compacted by ship date."""
    small, comp = scratch_path(spark, "small"), scratch_path(spark, "compacted")
    L.write_small_batches(_lineitem(spark, sf_dir), small, 64)
    L.compact(spark, small, comp, order="l_shipdate", target_bytes=TARGET_FILE)
    return small, comp


def _zordered(spark, sf_dir) -> str:
    path = scratch_path(spark, "zorder")
    S.rebuild(L.zorder(_lineitem(spark, sf_dir), ["l_partkey", "l_suppkey"], target_bytes=TARGET_FILE), path)
    return path


@register("compaction", "SELECT * FROM lineitem")
def q_compaction(spark, sf_dir):
    """Lineitem written as 64 small files, compacted into files of a target size that are
    ranges of the ship date; the compacted table holds exactly the input rows."""
    _, comp = _compacted(spark, sf_dir)
    return spark.read.parquet(comp).select(*_lineitem(spark, sf_dir).columns)


@register("compaction_sizes", """
SELECT 'compacted' AS layout, count(*) AS rows, true AS fits FROM lineitem
UNION ALL SELECT 'zorder', count(*), true FROM lineitem""")
def q_compaction_sizes(spark, sf_dir):
    """Every file of the compacted and of the z-ordered table is within a factor of
    two of the target size, at any table size."""
    one = lambda name, path: L.size_report(spark, path, TARGET_FILE).select(F.lit(name).alias("layout"), "rows", "fits")
    return one("compacted", _compacted(spark, sf_dir)[1]).unionByName(one("zorder", _zordered(spark, sf_dir)))


@register("zorder_layout", "SELECT * FROM lineitem")
def q_zorder(spark, sf_dir):
    """Z-ordered on (part, supplier) into files of a target size; same rows as the input."""
    return spark.read.parquet(_zordered(spark, sf_dir)).select(*_lineitem(spark, sf_dir).columns)


@register("layout_census", """
SELECT 'small_files' AS layout, 64 AS files, true AS adds_up UNION ALL SELECT 'compacted', NULL, true""")
def q_layout_census(spark, sf_dir):
    """The census of the small-file and the compacted layout: as many files as were written, and
    MB a file times files is the total."""
    adds_up = F.abs(F.col("mb_per_file") * F.col("files") - F.col("total_mb")) <= 0.0005 * (F.col("files") + 1)
    small, comp = (L.layout_summary(spark, p).select("files", adds_up.alias("adds_up")) for p in _compacted(spark, sf_dir))
    return (small.select(F.lit("small_files").alias("layout"), F.col("files").cast("int").alias("files"), "adds_up")
            .unionByName(comp.select(F.lit("compacted").alias("layout"), F.lit(None).cast("int").alias("files"), "adds_up")))


@register("layout_summary")
def q_layout_summary(spark, sf_dir):
    """File census of the small-file and the compacted layout (rows-only)."""
    small, comp = _compacted(spark, sf_dir)
    return (L.layout_summary(spark, small).withColumn("layout", F.lit("small_files"))
            .unionByName(L.layout_summary(spark, comp).withColumn("layout", F.lit("compacted"))))


@register("format_footprint")
def q_footprint(spark, sf_dir):
    """Bytes of orders as CSV, NDJSON, Parquet none/snappy/zstd (rows-only)."""
    return L.format_footprint(spark, domain.table(spark, sf_dir, "orders"), scratch_path(spark, "footprint"), keep=False)


@register("csv_roundtrip", "SELECT * FROM orders")
def q_csv(spark, sf_dir):
    """Orders written as CSV with header, read back with declared types."""
    o = domain.table(spark, sf_dir, "orders")
    p = scratch_path(spark, "csv")
    S.write_as(o, p, "csv")
    return R.load_seed(spark, p, o.schema)


@register("json_roundtrip", "SELECT * FROM orders")
def q_json(spark, sf_dir):
    """Orders as NDJSON, read back with the schema (no inference pass)."""
    o = domain.table(spark, sf_dir, "orders")
    p = scratch_path(spark, "json")
    S.write_as(o, p, "json")
    return R.read_json(spark, p, o.schema).select(*o.columns)


@register("partitioned_roundtrip", "SELECT * FROM orders")
def q_partitioned(spark, sf_dir):
    """Orders partitioned by status; the partition column comes back from
    the path with its declared type."""
    o = domain.table(spark, sf_dir, "orders")
    p = scratch_path(spark, "by_status")
    S.write_partitioned(o, p, ["o_orderstatus"])
    return R.read_partitioned(spark, p, schema=o.schema).select(*o.columns)


RELOADED, EMPTIED = "1997-01", "1997-02"


@register("bronze_reload", W(BRONZE_SQL, f"""
SELECT * REPLACE (CASE WHEN _pickup_month = '{RELOADED}' THEN 'again.parquet' ELSE _source_file END AS _source_file)
FROM bronze WHERE _pickup_month <> '{EMPTIED}'"""))
def q_bronze_reload(spark, sf_dir):
    """G1, K3: all months ingested in one write, rows without a pickup and with stray years
    included; then one month's file is loaded again twice, and another month's turns out
    empty. Every other month is as it was."""
    trips = raw(spark, sf_dir)
    p = scratch_path(spark, "bronze")
    runner.ingest(trips, p, None, "lineitem.parquet", M.RUN_TS)
    again = trips.filter(M.month_label() == RELOADED)
    for _ in range(2):
        M.ingest_month(again, p, RELOADED, "again.parquet", M.RUN_TS)
    M.ingest_month(trips.limit(0), p, EMPTIED, "lineitem.parquet", M.RUN_TS)
    return R.read_partitioned(spark, p, schema=bronze(spark, sf_dir).schema)


@register("bronze_file_label", W(BRONZE_SQL, "SELECT * REPLACE ('1998-05' AS _pickup_month) FROM bronze"))
def q_bronze_file_label(spark, sf_dir):
    """The whole input labelled as one month's file keeps every row, whatever its
    pickup; read back by month path (S6)."""
    p = scratch_path(spark, "bronze_file")
    M.ingest_month(raw(spark, sf_dir), p, "1998-05", "lineitem.parquet", M.RUN_TS)
    return R.read_months(spark, p, ["1998-05"]).select(*bronze(spark, sf_dir).columns)


@register("partition_profile")
def q_partition_profile(spark, sf_dir):
    """Rows per input partition of lineitem (rows-only: depends on file splits)."""
    return X.partition_profile(_lineitem(spark, sf_dir))


# ----------------------------------------------------------------------------- streaming



@register("stream_event_windows", """
WITH w AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS events,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents
  FROM events GROUP BY 1, 2
)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, events, value_cents FROM w
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_windows(spark, sf_dir):
    """Events streamed from Parquet files (availableNow), hourly windows per event
    type with a 1-hour watermark, append mode; the result is every window the final
    watermark has closed."""
    ev = domain.table(spark, sf_dir, "events")
    src = scratch_path(spark, "events_src")
    ev.repartitionByRange(4, "ts").write.parquet(src)
    out, ck = scratch_path(spark, "event_windows"), scratch_path(spark, "event_windows_ckpt")
    T.run_windowed_demand(spark, src, ev.schema, out, ck).awaitTermination()
    return spark.read.parquet(out)


@register("null_coverage", """
SELECT count(*) AS rows, count(priority) AS priority_non_null FROM (
  SELECT o_orderkey, CAST(NULL AS VARCHAR) AS priority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
  UNION ALL
  SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')""")
def q_null_coverage(spark, sf_dir):
    """count(*) next to count(new column) after a schema-evolving append."""
    return Q.null_coverage(q_schema_evolution(spark, sf_dir), ["priority"])



@register("borough_card_tip_weighted", W(SILVER_SQL, f"""
SELECT z.borough, {half(_card_cents('tip_amount') + ' * 100', _card_cents('fare_amount'), 1)} AS weighted_card_tip_pct
FROM silver t JOIN zones z ON t.pickup_zone_id = z.zone_id GROUP BY 1"""))
def q_borough_weighted(spark, sf_dir):
    """G6 companion: fare-weighted card tip % per borough."""
    return gold.borough_card_tip_weighted(silver(spark, sf_dir), zones(spark, sf_dir))



@register("upsert_partitions", """
WITH target AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders),
source AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
                  o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS o_year
           FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM source""")
def q_upsert_partitions(spark, sf_dir):
    """M1 at partition scope: orders partitioned by year; changed 2000+ orders are merged
    by rewriting only the touched year partitions (the rest is never read or written)."""
    o = domain.table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    path = scratch_path(spark, "orders_by_year")
    S.write_partitioned(o, path, ["o_year"])
    source = (o.filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
               .withColumn("o_totalprice", F.col("o_totalprice") + 1.0))
    Vr.upsert_partitions(spark, path, source, ["o_orderkey"], "o_year", scratch_path(spark, "staging"))
    return spark.read.parquet(path).select(*o.columns)


GENEROUS_RAW_SQL = W(domain.RAW_TRIPS_SQL + "," + domain.ZONES_SQL, """
SELECT z.borough,
       round(avg(CASE WHEN t.total_amount <> 0 THEN t.tip_amount / t.total_amount * 100 END), 2) AS avg_tip_pct,
       count(*) AS trips
FROM raw t JOIN zones z ON t.PULocationID = z.zone_id
WHERE t.total_amount > 0 AND t.tip_amount >= 0
GROUP BY 1""")


def raw_for_tips(spark, sf_dir):
    """Raw trips as the tip analysis reads them: positive total, non-negative tip."""
    return (raw(spark, sf_dir).filter((F.col("total_amount") > 0) & (F.col("tip_amount") >= 0))
            .select(F.col("PULocationID").alias("pickup_zone_id"), "tip_amount", "total_amount"))


@register("generous_borough_raw", GENEROUS_RAW_SQL)
def q_generous_raw(spark, sf_dir):
    """G11 on raw trips: checked broadcast of the zones, native tip expression."""
    return gold.generous_borough(raw_for_tips(spark, sf_dir), zones(spark, sf_dir), "broadcast", "native")



@register("overwrite_changes", W(CHG + f""",
cur AS ({_as_of_sql(None)}),
new AS (SELECT user_id, event_type, value + 1.0 AS value, ts FROM ({_as_of_sql(7)}))""", """
SELECT coalesce(c.user_id, n.user_id) AS user_id, n.event_type, n.value, n.ts,
       (SELECT max(version) + 1 FROM changes) AS version, CAST(0 AS BIGINT) AS seq,
       CASE WHEN n.user_id IS NULL THEN 'delete' WHEN c.user_id IS NULL THEN 'insert' ELSE 'update' END AS op
FROM cur c FULL OUTER JOIN new n ON c.user_id = n.user_id
WHERE n.user_id IS NULL OR c.user_id IS NULL
   OR NOT (c.event_type IS NOT DISTINCT FROM n.event_type AND c.value IS NOT DISTINCT FROM n.value
           AND c.ts IS NOT DISTINCT FROM n.ts)"""))
def q_overwrite_changes(spark, sf_dir):
    """§2.10 whole overwrite: the table replaced by a new snapshot (state at version 7
    with every value changed) is recorded as deletes, inserts and updates."""
    c = changes(spark, sf_dir)
    new = Vr.as_of(c, ["user_id"], 7).select("user_id", "event_type", (F.col("value") + 1.0).alias("value"), "ts")
    return Vr.overwrite(c, ["user_id"], new, PAYLOAD)


@register("gold_hourly_from_parts", W(GOLD_HOURLY_SQL, "SELECT * FROM gold_hourly"))
def q_gold_hourly_parts(spark, sf_dir):
    """G5 through additive per-month partials rolled up (the incremental form used by
    merge-mode runs); must equal the direct aggregate."""
    return gold.hourly_from_parts(gold.hourly_demand_parts(silver(spark, sf_dir), zones(spark, sf_dir)))


# ----------------------------------------------------------------------------- sources, sinks and formats

@register("csv_inferred", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def q_csv_inferred(spark, sf_dir):
    """S3: orders as CSV, read back with inferred column types."""
    o = domain.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    p = scratch_path(spark, "csv_inferred")
    S.write_as(o, p, "csv")
    got = R.read_csv_inferred(spark, p)
    return got.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey"),
                      "o_orderstatus", "o_totalprice", "o_orderpriority")


@register("path_list", """
SELECT o_orderstatus, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1""")
def q_path_list(spark, sf_dir):
    """One folder per status, read as a list of paths."""
    o = domain.table(spark, sf_dir, "orders")
    root = scratch_path(spark, "orders_of")
    S.write_partitioned(o.withColumn("folder", F.col("o_orderstatus")), root, ["folder"])    # one pass over orders
    paths = [r[0] for r in L.file_sizes(spark, root).select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect()]
    return R.read_paths(spark, paths).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("key_sum"))


@register("two_level_partitions", "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders")
def q_two_levels(spark, sf_dir):
    """K5: orders partitioned by year and status; all rows come back."""
    o = domain.table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    p = scratch_path(spark, "by_year_status")
    S.write_partitioned(o, p, ["o_year", "o_orderstatus"])
    return R.read_partitioned(spark, p, schema=o.schema).select(*o.columns)


CODECS = ["none", "snappy", "gzip", "zstd"]


@register("codec_readback", "SELECT c AS codec, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, "
          f"count(DISTINCT o_custkey) AS customers FROM orders, (SELECT unnest({CODECS!r}) AS c) GROUP BY 1")
def q_codec_readback(spark, sf_dir):
    """K7: orders as Parquet in each codec hold the same rows."""
    o = domain.table(spark, sf_dir, "orders")
    out = None
    for codec in CODECS:
        p = scratch_path(spark, f"codec_{codec}")
        S.write_as(o, p, "parquet", codec)
        one = spark.read.parquet(p).agg(F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("key_sum"),
                                        F.countDistinct("o_custkey").alias("customers")).withColumn("codec", F.lit(codec))
        out = one if out is None else out.unionByName(one)
    return out


@register("named_table", "SELECT * FROM nation")
def q_named_table(spark, sf_dir):
    """Nation saved as a catalog table over an external path and read by name."""
    n = domain.table(spark, sf_dir, "nation")
    p = scratch_path(spark, "named_nation")
    name = "keelson_" + p.rpartition("-")[2]
    S.save_named(n, name, p)
    return R.read_named(spark, name)


@register("named_bucketed", """
SELECT o_orderpriority, count(*) AS lines, CAST(sum(l_linenumber) AS BIGINT) AS numbers
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def q_named_bucketed(spark, sf_dir):
    """Orders and line items saved by name, bucketed and sorted by the order key, and joined by
    name: neither side is shuffled or sorted."""
    names = {}
    for table, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        p = scratch_path(spark, f"bucketed_{table}")
        names[table] = "keelson_" + p.rpartition("-")[2]
        S.write_bucketed(domain.table(spark, sf_dir, table).repartition(8, key), names[table], p, [key], 8)
    li, o = (R.read_named(spark, names[t]) for t in ("lineitem", "orders"))
    return (li.join(o.hint("merge"), li["l_orderkey"] == o["o_orderkey"]).groupBy("o_orderpriority")
            .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_linenumber").alias("numbers")))


FORMAT_SQL = W(domain.RAW_TRIPS_SQL, f"""
SELECT format, payment_type, count(*) AS trips, {_avg_cents('total_amount')} AS avg_total
FROM raw, (SELECT unnest(['csv', 'json', 'parquet']) AS format) WHERE trip_distance > 5 GROUP BY 1, 2""")


@register("format_trio", FORMAT_SQL)
def q_format_trio(spark, sf_dir):
    """G14 on all three formats: the raw trips written once as CSV, NDJSON (both compressed, one file
    a task) and Parquet, the grouped query on each."""
    trips = S.materialize(raw(spark, sf_dir), scratch_path(spark, "trips"))
    out = None
    for fmt in ("csv", "json", "parquet"):
        p = scratch_path(spark, f"trips_{fmt}")
        S.write_as(trips, p, fmt, None if fmt == "parquet" else "gzip")
        reader = spark.read.schema(trips.schema)
        back = (reader.option("header", True).csv(p) if fmt == "csv" else reader.json(p) if fmt == "json" else reader.parquet(p))
        one = gold.format_grouped(back).withColumn("format", F.lit(fmt))
        out = one if out is None else out.unionByName(one)
    return out


@register("one_day_layouts", W(domain.RAW_TRIPS_SQL, f"""
SELECT layout, count(*) AS trips, {_avg_cents('total_amount')} AS avg_total
FROM raw, (SELECT unnest(['partitioned', 'shuffled', 'sorted']) AS layout)
WHERE tpep_pickup_datetime >= TIMESTAMP '{ONE_DAY}' AND tpep_pickup_datetime < TIMESTAMP '{ONE_DAY}' + INTERVAL 1 DAY GROUP BY 1"""))
def q_one_day_layouts(spark, sf_dir):
    """The one-day report on the trips partitioned by day, shuffled and sorted."""
    trips = S.materialize(raw(spark, sf_dir).withColumn("day", F.to_date("tpep_pickup_datetime").cast("string")),
                          scratch_path(spark, "trips"))
    files = L.files_for(trips, 8)
    paths = {x: scratch_path(spark, f"trips_{x}") for x in ("partitioned", "shuffled", "sorted")}
    S.write_partitioned(trips, paths["partitioned"], ["day"])
    L.write_shuffled(trips, paths["shuffled"], files)
    L.write_sorted(trips, paths["sorted"], "tpep_pickup_datetime", files)
    out = None
    for layout, p in paths.items():
        df = R.read_partitioned(spark, p)
        df = df.filter(F.col("day") == ONE_DAY) if layout == "partitioned" else df
        one = gold.one_day(df, ONE_DAY).withColumn("layout", F.lit(layout))
        out = one if out is None else out.unionByName(one)
    return out


@register("row_id_check", "SELECT count(*) AS rows, count(*) AS ids, true AS all_there FROM orders")
def q_row_ids(spark, sf_dir):
    """Every row has an id of its own, and no row is lost."""
    o = domain.table(spark, sf_dir, "orders")
    ids = O.row_ids(o).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("row_id").alias("ids"),
                           F.count("row_id").alias("given"))
    return ids.select("rows", "ids", (F.col("given") == F.col("rows")).alias("all_there"))


@register("partition_totals", "SELECT count(*) AS rows, true AS within FROM lineitem")
def q_partition_totals(spark, sf_dir):
    """The rows of all partitions add up to the table's, and there are as many
    profile rows as non-empty partitions."""
    li = _lineitem(spark, sf_dir)
    p = X.partition_profile(li).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("n"))
    n = X.partition_count(li).select(F.col("partitions"))
    return p.unionByName(n.select(F.lit(None).cast("bigint").alias("rows"), (-F.col("partitions")).alias("n"))).agg(
        F.sum("rows").alias("rows"), (F.sum("n") == 0).alias("within"))


@register("footprint_order", "SELECT 'parquet_zstd' AS smallest, 5 AS formats")
def q_footprint_order(spark, sf_dir):
    """Which of the five formats takes the least room for lineitem."""
    f = L.format_footprint(spark, _lineitem(spark, sf_dir), scratch_path(spark, "footprint"), keep=False)
    return f.agg(F.min_by("format", "bytes").alias("smallest"), F.count(F.lit(1)).cast("int").alias("formats"))


@register("gate_report", RUN_CHECKS_SQL)
def q_gate(spark, sf_dir):
    """Q9: the gate over every model test; it returns its report only if all of them pass."""
    return spark.createDataFrame(Q.gate(checks(spark, sf_dir)), "check string, failures long")


@register("stream_ingest", "SELECT event_type, count(*) AS events, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1")
def q_stream_ingest(spark, sf_dir):
    """Events arriving as files, ingested by a file stream into a Parquet table."""
    ev = domain.table(spark, sf_dir, "events")
    src, out, ck = (scratch_path(spark, x) for x in ("events_in", "events_out", "events_ck"))
    ev.repartition(4).write.parquet(src)
    T.ingest_stream(spark, src, ev.schema, out, ck, pickup_col="ts").awaitTermination()
    return R.read_partitioned(spark, out).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("event_id").alias("id_sum"))


@register("stream_upsert", """
SELECT user_id, count(*) AS rows, max(event_id) AS event_id FROM (
  SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id) GROUP BY user_id""")
def q_stream_upsert(spark, sf_dir):
    """Events streamed in two batches by id, each upserted by user; the last one stays."""
    ev = domain.table(spark, sf_dir, "events").select("event_id", "user_id", (-F.col("event_id")).alias("newest"))
    half = ev.agg(F.max("event_id")).first()[0] // 2
    table_path = scratch_path(spark, "users")
    fn = T.upsert_batches(lambda b: f"{table_path}/batch={b}", ["user_id"], ["newest"])
    for b, part in enumerate((ev.filter(F.col("event_id") <= half), ev.filter(F.col("event_id") > half))):
        src, ck = scratch_path(spark, "users_in"), scratch_path(spark, "users_ck")
        part.write.parquet(src)
        (spark.readStream.schema(ev.schema).parquet(src).writeStream.trigger(availableNow=True)
         .option("checkpointLocation", ck).foreachBatch(lambda df, _, b=b: fn(df, b)).start().awaitTermination())
    return spark.read.parquet(fn.latest(1)).groupBy("user_id").agg(F.count(F.lit(1)).alias("rows"), F.max("event_id").alias("event_id"))


@register("stream_change_feed", ORACLE["as_of_latest"])
def q_change_feed(spark, sf_dir):
    """The change table as files in no order, folded over several micro-batches by sequence
    number, deletes and late changes included: the latest state."""
    c = changes(spark, sf_dir)
    src, table, ck = (scratch_path(spark, x) for x in ("changes_in", "changes_feed", "changes_ck"))
    c.repartition(6, F.xxhash64("seq", "version")).write.parquet(src)
    Fd.run_change_feed(spark, src, c.schema, table, ck, ["user_id"], files_per_trigger=2).awaitTermination()
    return Fd.feed_state(spark, table, ["user_id"]).select("user_id", "event_type", "value", "ts", "version")


@register("stream_windows_corrected", ORACLE["stream_event_windows"])
def q_windows_corrected(spark, sf_dir):
    """Events in files without order, most of them behind the watermark when they arrive: first
    results and corrections together are the batch result."""
    ev = domain.table(spark, sf_dir, "events")
    src, table, ck = (scratch_path(spark, x) for x in ("late_in", "late_windows", "late_ck"))
    ev.repartition(4, "event_id").write.parquet(src)
    Fd.run_corrected_windows(spark, src, ev.schema, table, ck, files_per_trigger=2).awaitTermination()
    return Fd.corrected_windows(spark, table)


# ----------------------------------------------------------------------------- malformed input and sketches


@register("csv_quarantine", """
SELECT 'rows' AS kind, count(*) AS records, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders WHERE o_orderkey % 25 NOT IN (1, 2, 3)
UNION ALL
SELECT 'quarantine', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderkey % 25 IN (1, 2, 3)""")
def q_csv_quarantine(spark, sf_dir):
    """Orders as text, some lines cut off, some with N/A for a price, some with a quote that is
    not closed: every record is a row or in quarantine, word for word."""
    o = domain.table(spark, sf_dir, "orders")
    key, rest = F.col("o_orderkey").cast("string"), [F.col(c).cast("string") for c in ("o_custkey", "o_totalprice", "o_orderpriority")]
    kind = F.pmod("o_orderkey", F.lit(25))
    line = (F.when(kind == 1, F.concat_ws(",", key, rest[0])).when(kind == 2, F.concat_ws(",", key, rest[0], F.lit("N/A"), rest[2]))
            .when(kind == 3, F.concat_ws(",", key, F.concat(F.lit('"'), rest[0]), rest[1], rest[2]))
            .otherwise(F.concat_ws(",", key, *rest)))
    src = scratch_path(spark, "broken_csv")
    o.select(line.alias("value")).write.text(src)
    good, bad = R.read_quarantined(spark, src, "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string",
                                   scratch_path(spark, "parsed_csv"), header=False)
    one = lambda df, name, k: df.agg(F.count(F.lit(1)).alias("records"), F.sum(k).alias("key_sum")).select(F.lit(name).alias("kind"), "records", "key_sum")
    return one(good, "rows", F.col("o_orderkey")).unionByName(one(bad, "quarantine", F.substring_index("record", ",", 1).cast("long")))


@register("sketch_profile", """
SELECT 'hot_key' AS what, count(*) AS rows, true AS within FROM lineitem
UNION ALL SELECT 'quantile ' || p, (SELECT count(*) FROM lineitem), true FROM (SELECT unnest(['0.25', '0.5', '0.75', '0.95']) AS p)""")
def q_sketch_profile(spark, sf_dir):
    """Sketches of the skewed line items, one a line number, merged: the hot key's count is
    within a thousandth of the exact one, and the rank of every quantile within a fiftieth."""
    k = skewed_lines(spark, sf_dir)
    one = X.merged(S.materialize(X.sketches(k, "l_suppkey", "l_orderkey", ["l_linenumber"]), scratch_path(spark, "sketches")))
    hot = X.heavy_keys(one, 1).first()                             # one value and one a quantile reach the driver
    points = [(r["p"], r["value"]) for r in X.sketched_quantiles(one).collect()]
    exact = k.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("l_suppkey") == hot["key"]).alias("hot"),
                  *[F.count_if(F.col("l_orderkey") <= v).alias(f"q{i}") for i, (_, v) in enumerate(points)])
    n = F.col("rows")
    told = [F.struct(F.lit("hot_key").alias("what"), ((F.abs(F.col("hot") - hot["n"]) <= n / 1000) & (F.col("hot") > n / 2)).alias("within"))]
    told += [F.struct(F.lit(f"quantile {p}").alias("what"), (F.abs(F.col(f"q{i}") / n - p) <= 0.02).alias("within")) for i, (p, _) in enumerate(points)]
    return exact.select("rows", F.explode(F.array(*told)).alias("x")).select("x.what", "rows", "x.within")
