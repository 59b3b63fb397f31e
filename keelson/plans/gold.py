"""Gold aggregates and reports.

Money is summed in integer cents (exact, independent of summation order) and turned
into dollars once; averages of doubles are rounded half-up at the end, so the same
input gives the same output on any engine and any partitioning. Every aggregate
here is a hash aggregate with a partial (map-side) step (A14): a hot group key is
reduced inside each input task before the shuffle. Group keys may be derived
expressions (A12: weekday name, date), computed once in the projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions import columns as C
from keelson.functions.udfs import tip_pct_vectorized
from keelson.operators.joins import join_dim, salted_join

# Weekday names in calendar order (pivot column order).
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _zone_join(trips: DataFrame, zones: DataFrame, how: str, strategy: str) -> DataFrame:
    z = zones.select("zone_id", "borough", "zone_name")
    return join_dim(trips, z, F.col("pickup_zone_id") == F.col("zone_id"), how, strategy)


# The additive parts of the trip aggregates, in whole cents and hundredths.
def _card(column: str) -> Column:
    return F.sum(F.when(F.col("payment_type_id") == 1, C.cents(column)).otherwise(0))


PARTS = {
    "_n": lambda: F.count(F.lit(1)), "_rev_c": lambda: F.sum(C.cents("total_amount")),
    "_miles": lambda: F.sum(C.hundredths("trip_miles")), "_minutes": lambda: F.sum(C.hundredths("trip_minutes")),
    "_tip_c": lambda: _card("tip_amount"), "_fare_c": lambda: _card("fare_amount"),
}


def _by_zone(trips: DataFrame, zones: DataFrame, how: str, strategy: str, keys: list, names: list[str],
             parts: list[str]) -> DataFrame:
    """Aggregate in two steps: per zone id and ``keys`` before the zone join, then once more
    on ``names`` (zones may share one). The join sees one row per group, never the fact, so
    a zone that holds most of the trips is one small row whatever the join strategy."""
    g = trips.groupBy("pickup_zone_id", *keys).agg(*[PARTS[p]().alias(p) for p in parts])
    j = _zone_join(g, zones, how, strategy)
    return j.groupBy(*names).agg(*[F.sum(p).alias(p) for p in parts])


def daily_zone_revenue(trips: DataFrame, zones: DataFrame, strategy: str = "broadcast") -> DataFrame:
    """gold_daily_zone_revenue (G4): day x borough x zone name.

    LEFT join to the zone dimension (unmatched zones -> NULL borough/zone group),
    grouped on names, so zones sharing a name merge. ``card_tip_pct`` uses card
    trips only (cash tips are not recorded) and is NULL, not 0, without card fares.
    """
    g = _by_zone(trips, zones, "left", strategy, ["pickup_date"], ["pickup_date", "borough", "zone_name"], list(PARTS))
    return g.select(
        "pickup_date", "borough", "zone_name", F.col("_n").alias("trip_count"),
        (F.col("_rev_c") / 100.0).alias("revenue"),
        C.half_up("_rev_c", F.col("_n") * 100, 2).alias("avg_ticket"),
        C.half_up("_miles", F.col("_n") * 100, 2).alias("avg_miles"),
        C.half_up("_minutes", F.col("_n") * 100, 1).alias("avg_minutes"),
        C.half_up(F.col("_tip_c") * 100, "_fare_c", 1).alias("card_tip_pct"),
    )


HOURLY_PARTS = ["_n", "_rev_c", "_miles"]


def _hourly(g: DataFrame) -> DataFrame:
    return g.select("borough", "day_of_week", "pickup_hour", F.col("_n").alias("trip_count"),
                    C.half_up("_miles", F.col("_n") * 100, 2).alias("avg_miles"),
                    (F.col("_rev_c") / 100.0).alias("revenue"))


def hourly_demand(trips: DataFrame, zones: DataFrame, strategy: str = "broadcast") -> DataFrame:
    """gold_hourly_demand (G5): borough x weekday name x pickup hour."""
    day = C.weekday_name("pickup_at").alias("day_of_week")
    return _hourly(_by_zone(trips, zones, "left", strategy, [day, "pickup_hour"],
                            ["borough", "day_of_week", "pickup_hour"], HOURLY_PARTS))


def hourly_demand_parts(trips: DataFrame, zones: DataFrame, strategy: str = "broadcast") -> DataFrame:
    """Additive per-month partials of ``hourly_demand``: pickup_month, borough,
    day_of_week, pickup_hour and the sums. Months can be recomputed independently and
    rolled up with ``hourly_from_parts``."""
    day = C.weekday_name("pickup_at").alias("day_of_week")
    return _by_zone(trips, zones, "left", strategy, ["pickup_month", day, "pickup_hour"],
                    ["pickup_month", "borough", "day_of_week", "pickup_hour"], HOURLY_PARTS)


def hourly_from_parts(parts: DataFrame) -> DataFrame:
    """Roll the per-month partials up to ``gold_hourly_demand`` (same columns and
    values as ``hourly_demand`` over all months: all sums are whole numbers)."""
    return _hourly(parts.groupBy("borough", "day_of_week", "pickup_hour").agg(*[F.sum(p).alias(p) for p in HOURLY_PARTS]))


def borough_totals(gold: DataFrame) -> DataFrame:
    """Borough totals from gold (G6, A13): trips, revenue in millions, and the
    *unweighted* mean of the zone-day ``card_tip_pct`` (as the dashboard shows it)."""
    g = gold.filter(F.col("borough").isNotNull()).groupBy("borough").agg(
        F.sum("trip_count").alias("trips"),
        F.sum(C.cents("revenue")).alias("_rev_c"),
        F.sum(F.round(F.col("card_tip_pct") * 10).cast("bigint")).alias("_tip_t"),
        F.count("card_tip_pct").alias("_tip_n"))
    return g.select("borough", "trips",
                    C.half_up("_rev_c", F.lit(100_000_000), 1).alias("revenue_millions"),
                    C.half_up("_tip_t", F.col("_tip_n") * 10, 1).alias("avg_card_tip_pct")
                    ).orderBy(F.desc("trips"), "borough")


def borough_card_tip_weighted(trips: DataFrame, zones: DataFrame, strategy: str = "broadcast") -> DataFrame:
    """Card tip % per borough weighted by fare (card tips / card fares over all the
    borough's trips), next to the unweighted mean of zone-day percentages that
    ``borough_totals`` keeps for compatibility."""
    g = _by_zone(trips, zones, "inner", strategy, [], ["borough"], ["_tip_c", "_fare_c"])
    return g.select("borough", C.half_up(F.col("_tip_c") * 100, "_fare_c", 1).alias("weighted_card_tip_pct"))


def payment_tipping(trips: DataFrame) -> DataFrame:
    """Tipping by payment label (G7): trips, average tip, percent of trips with a tip."""
    g = trips.groupBy(C.payment_label("payment_type_id").alias("payment")).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(C.cents("tip_amount")).alias("_tip_c"),
        C.count_if(F.col("tip_amount") > 0).alias("_tipped"))
    return g.select("payment", "trips",
                    C.half_up("_tip_c", F.col("trips") * 100, 2).alias("avg_tip"),
                    C.half_up(F.col("_tipped") * 100, "trips", 1).alias("pct_with_tip")
                    ).orderBy(F.desc("trips"), "payment")


def trips_by_hour(hourly: DataFrame) -> DataFrame:
    """Trips per pickup hour from gold_hourly_demand."""
    return (hourly.groupBy("pickup_hour").agg(F.sum("trip_count").alias("trips"))
                  .orderBy("pickup_hour"))


def weekday_hour(raw: DataFrame, lo: float = 0.0, hi: float = 500.0) -> DataFrame:
    """Weekday x hour trips and average total from raw rows with total in [lo, hi]."""
    ts = "tpep_pickup_datetime"
    g = (raw.filter(F.col("total_amount").between(lo, hi))
            .groupBy(C.weekday_name(ts).alias("day_of_week"), F.hour(ts).alias("hour"))
            .agg(F.count(F.lit(1)).alias("trips"), F.sum(C.cents("total_amount")).alias("_c")))
    return (g.select("day_of_week", "hour", "trips",
                     C.half_up("_c", F.col("trips") * 100, 2).alias("avg_total"))
             .orderBy("hour", "day_of_week"))


def weekday_pivot(wh: DataFrame) -> DataFrame:
    """Rows = hour, columns = Monday..Sunday in calendar order, values = trips.
    The pivot values are given, so no extra job lists the distinct weekdays."""
    return wh.groupBy("hour").pivot("day_of_week", WEEKDAYS).agg(F.sum("trips")).orderBy("hour")


def generous_borough(trips: DataFrame, zones: DataFrame, strategy: str = "broadcast",
                     tip_fn: str = "native", repartition: int | None = None) -> DataFrame:
    """Most generous borough (G11): inner join, mean tip % per borough, trip count.

    ``tip_fn`` picks the native expression (default, stays in codegen) or its Arrow
    ``pandas_udf`` twin; both give the same rows. Trips are summed per zone before the join.
    ``repartition`` reproduces the redundant-shuffle anti-pattern (X6) for the benchmark.
    """
    t = trips.select("pickup_zone_id", "tip_amount", "total_amount")
    if repartition:
        t = t.repartition(repartition)
    fn = {"native": C.tip_pct, "vectorized": tip_pct_vectorized}[tip_fn]
    z = t.withColumn("_tip_pct", fn(F.col("tip_amount"), F.col("total_amount"))).groupBy("pickup_zone_id").agg(
        F.sum("_tip_pct").alias("_sum"), F.count("_tip_pct").alias("_with"), F.count(F.lit(1)).alias("_n"))
    g = _zone_join(z, zones, "inner", strategy).groupBy("borough").agg(
        F.sum("_sum").alias("_sum"), F.sum("_with").alias("_with"), F.sum("_n").alias("trips"))
    return (g.select("borough", C.round_half_up(F.col("_sum") / F.nullif(F.col("_with"), F.lit(0)), 2).alias("avg_tip_pct"), "trips")
             .orderBy(F.desc("avg_tip_pct"), "borough"))


def load_audit(bronze: DataFrame) -> DataFrame:
    """Rows and first ingest time per bronze month."""
    return (bronze.groupBy("_pickup_month").agg(F.count(F.lit(1)).alias("rows"),
                                                 F.min("_ingested_at").alias("first_ingested_at"))
                  .orderBy("_pickup_month"))


def funnel(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer (G13, U1): a UNION ALL of one-row counts."""
    out = None
    for name, df in layers.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def format_count(raw: DataFrame) -> DataFrame:
    """Format benchmark query 1+2 (G14): count(*) and mean distance in one pass."""
    g = raw.agg(F.count(F.lit(1)).alias("rows"), F.sum(C.hundredths("trip_distance")).alias("_d"))
    return g.select("rows", C.half_up("_d", F.col("rows") * 100, 4).alias("avg_distance"))


def format_grouped(raw: DataFrame, min_distance: float = 5.0) -> DataFrame:
    """Format benchmark query 3 (G14): filter + group with count and mean total."""
    g = (raw.filter(F.col("trip_distance") > min_distance).groupBy("payment_type")
            .agg(F.count(F.lit(1)).alias("trips"), F.sum(C.cents("total_amount")).alias("_c")))
    return g.select("payment_type", "trips", C.half_up("_c", F.col("trips") * 100, 2).alias("avg_total"))


def one_day(df: DataFrame, day: str, ts_col: str = "tpep_pickup_datetime") -> DataFrame:
    """Trips and mean total on one day (G15); the day is a half-open range on the
    raw timestamp so it prunes row groups / partitions."""
    g = df.filter(C.day_range(ts_col, day)).agg(F.count(F.lit(1)).alias("trips"),
                                                 F.sum(C.cents("total_amount")).alias("_c"))
    return g.select("trips", C.half_up("_c", F.col("trips") * 100, 2).alias("avg_total"))


def payment_summary(df: DataFrame) -> DataFrame:
    """Trips and mean total per payment type, ordered."""
    g = df.groupBy("payment_type").agg(F.count(F.lit(1)).alias("trips"), F.sum(C.cents("total_amount")).alias("_c"))
    return (g.select("payment_type", "trips", C.half_up("_c", F.col("trips") * 100, 2).alias("avg_total"))
             .orderBy("payment_type"))


def daily_trips(df: DataFrame, n: int = 8, ts_col: str = "tpep_pickup_datetime") -> DataFrame:
    """First ``n`` days: trips and mean total (G17); the limit is the report. Rows without a
    pickup belong to no day."""
    g = df.filter(F.col(ts_col).isNotNull()).groupBy(F.to_date(ts_col).alias("day")).agg(F.count(F.lit(1)).alias("trips"),
                                                        F.sum(C.cents("total_amount")).alias("_c"))
    return (g.select("day", "trips", C.half_up("_c", F.col("trips") * 100, 2).alias("avg_amount"))
             .orderBy("day").limit(n))


def avg_total_by_zone(trips: DataFrame) -> DataFrame:
    """Average total per pickup zone (the wide groupBy + avg of the partitioning demo,
    A5 grouped): partial averages are combined after one shuffle."""
    g = trips.groupBy("pickup_zone_id").agg(F.count(F.lit(1)).alias("trips"),
                                             F.sum(C.cents("total_amount")).alias("_c"))
    return g.select("pickup_zone_id", "trips", C.half_up("_c", F.col("trips") * 100, 2).alias("avg_total"))


def top_zones(trips: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` pickup zones by trips with their average ticket."""
    from keelson.operators.ordered import top_groups
    t = top_groups(trips, "pickup_zone_id", k, "trips", {"_c": F.sum(C.cents("total_amount"))})
    return t.select("pickup_zone_id", "trips", C.half_up("_c", F.col("trips") * 100, 2).alias("avg_total"))


def trips_per_borough(trips: DataFrame, zones: DataFrame, strategy: str = "broadcast",
                      salts: int = 0, hot: list | None = None) -> DataFrame:
    """Trips per borough (G19, X4/X5). ``salts > 0`` uses the salted join; the
    result is the same as the plain join."""
    t = trips.select("pickup_zone_id", "trip_id")
    z = zones.select("zone_id", "borough")
    if salts:
        j = salted_join(t, z, "pickup_zone_id", "zone_id", salts, salt_cols=["trip_id"], hot=hot)
        return j.groupBy("borough").agg(F.count(F.lit(1)).alias("trips"))
    n = t.groupBy("pickup_zone_id").agg(F.count(F.lit(1)).alias("_n"))
    j = join_dim(n, z, F.col("pickup_zone_id") == F.col("zone_id"), "inner", strategy)
    return j.groupBy("borough").agg(F.sum("_n").alias("trips"))


def sandbox_day(bronze: DataFrame, day: str) -> DataFrame:
    """The deliberately non-idempotent sandbox projection (G20): one pickup day."""
    return (bronze.filter(C.day_range("tpep_pickup_datetime", day))
                  .select(F.col("tpep_pickup_datetime").alias("pickup_at"), "total_amount"))


def daily_revenue(gold: DataFrame) -> DataFrame:
    """Dashboard daily revenue series."""
    return (gold.groupBy("pickup_date").agg((F.sum(C.cents("revenue")) / 100.0).alias("revenue"))
                .orderBy("pickup_date"))


def revenue_total(gold: DataFrame) -> DataFrame:
    """Dashboard grand total (G21): revenue and number of days."""
    return gold.agg((F.sum(C.cents("revenue")) / 100.0).alias("revenue"),
                    F.countDistinct("pickup_date").alias("days"))
