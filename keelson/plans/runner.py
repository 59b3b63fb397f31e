"""Layer runs: orchestration of bronze -> silver -> gold.

A plain function sequence: bronze -> zones -> silver -> checks -> gold -> checks.
Each layer run writes a *new* directory and readers are handed the new path, so a
table is never read and overwritten by one job, and a failed run leaves the last
good version in place. A failing gate raises before anything downstream is built.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions import columns as C
from keelson.operators import quality as Q
from keelson.operators.versions import upsert_partitions
from keelson.plans import gold
from keelson.plans import medallion as M
from keelson.sources import readers as R
from keelson.session import path_exists
from keelson.sources import sinks

@dataclass
class RunResult:
    bronze: str
    zones: str
    silver: str
    gold_daily: str
    gold_hourly: str
    checks: list[tuple[str, int]] = field(default_factory=list)


def months_in(raw: DataFrame, ts_col: str = "tpep_pickup_datetime") -> list[str]:
    """Distinct month labels present (one small aggregate; bounded by the number of months,
    not rows)."""
    return sorted(r[0] for r in raw.select(M.month_label(ts_col).alias("m")).distinct().collect())


def ingest(raw: DataFrame, bronze_path: str, months: list[str] | None = None, source_file: str | None = None,
           ingested_at: str | None = None) -> list[str]:
    """Bronze ingest of a table that holds several months, default all (G1, §3.1): one
    clustered write that replaces the partitions of the months named and leaves the others;
    rows without a pickup are under their own label. A named month without rows is emptied.
    One file per month goes through ``medallion.ingest_month`` instead."""
    wanted = raw if months is None else raw.filter(M.month_label().isin(months))
    bronze = M.to_bronze(wanted, source_file, ingested_at)
    (sinks.clustered(bronze, ["_pickup_month"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_pickup_month").parquet(bronze_path))
    present = months_in(wanted)
    for m in set(months or []) - set(present):
        sinks.replace_partition(bronze.limit(0), bronze_path, "_pickup_month", m, check=False)
    return months or present


def run_incremental(bronze: DataFrame, target: DataFrame | None, v: M.SilverVars = M.DEFAULT_VARS,
                    mode: str = "watermark", months: list[str] | None = None) -> DataFrame:
    """Incremental silver (M4).

    ``watermark``: only bronze rows at/after the target's newest pickup are merged
    (the behaviour being rebuilt; an older month re-ingested later is never picked
    up, and a merged row that stops passing the filters stays).
    ``partitions``: the given months are rebuilt from bronze and replace the same
    months in the target, which also repairs back-filled and stale rows there.
    """
    if target is None or mode == "watermark":
        return M.silver_trips(bronze, v, target)
    if mode != "partitions":
        raise ValueError(f"unknown incremental mode {mode!r}")
    if not months:
        raise ValueError("partitions mode needs the months to rebuild")
    fresh = M.silver_trips(bronze.filter(F.col("_pickup_month").isin(months)), v)
    return target.filter(~F.col("pickup_month").isin(months)).unionByName(fresh)


def silver_row_rules(duration_hours: int, v: M.SilverVars = M.DEFAULT_VARS) -> list[tuple[str, Column]]:
    """Those of ``silver_checks`` that look at one silver row at a time, as predicates of failing rows."""
    return [
        ("silver_trip_id_not_null", F.col("trip_id").isNull()),
        ("silver_pickup_at_not_null", F.col("pickup_at").isNull()),
        ("silver_payment_type_accepted", F.col("payment_type_id").isNotNull() & ~F.col("payment_type_id").isin(*v.payments)),
        ("silver_total_amount_not_null", F.col("total_amount").isNull()),
        ("trip_duration_sane", C.seconds_between("pickup_at", "dropoff_at") > duration_hours * 3600),
    ]


DAILY_ROW_RULES = [("gold_pickup_date_not_null", "pickup_date"), ("gold_trip_count_not_null", "trip_count")]


def hourly_row_rules() -> list[tuple[str, Column]]:
    hour = F.col("pickup_hour")
    return [("hourly_pickup_hour_not_null", hour.isNull()), ("hourly_pickup_hour_accepted", hour.isNotNull() & ~hour.between(0, 23))]


def _write_observed(df: DataFrame, path: str, rules: list[tuple[str, Column]], partition_by=()) -> list[tuple[str, int]]:
    """Write ``df`` and return (check, failures) of the rules, counted by the write."""
    df, counted = Q.observed(df, rules)
    sinks.rebuild(df, path, partition_by)
    return counted()


def _scanned(df: DataFrame, rules: list[tuple[str, Column]]) -> list[tuple[str, int]]:
    """The same counts by one scan of a table of which only a part has been written."""
    return [(r["check"], r["failures"]) for r in Q.count_failures(df, rules).collect()]


def silver_checks(silver: DataFrame, zones: DataFrame, duration_hours: int,
                  v: M.SilverVars = M.DEFAULT_VARS) -> list[tuple[str, DataFrame]]:
    """The silver model tests (Q1-Q5)."""
    return [
        ("silver_trip_id_unique", Q.unique(silver, "trip_id")),
        ("silver_trip_id_not_null", Q.not_null(silver, "trip_id")),
        ("silver_pickup_at_not_null", Q.not_null(silver, "pickup_at")),
        ("silver_pickup_zone_relationships", Q.relationships(silver, "pickup_zone_id", zones, "zone_id")),
        ("silver_payment_type_accepted", Q.accepted(silver, "payment_type_id", list(v.payments))),
        ("silver_total_amount_not_null", Q.not_null(silver, "total_amount")),
        ("zones_zone_id_unique", Q.unique(zones, "zone_id")),
        ("zones_zone_id_not_null", Q.not_null(zones, "zone_id")),
        ("zones_borough_accepted", Q.accepted(zones, "borough", list(v.boroughs))),
        ("trip_duration_sane", Q.duration_sane(silver, duration_hours)),
    ]


def gold_checks(silver: DataFrame, daily: DataFrame, hourly: DataFrame) -> list[tuple[str, DataFrame]]:
    """The gold model tests and the reconciliation (Q1, Q3, Q6)."""
    return [
        ("gold_pickup_date_not_null", Q.not_null(daily, "pickup_date")),
        ("gold_trip_count_not_null", Q.not_null(daily, "trip_count")),
        ("hourly_pickup_hour_not_null", Q.not_null(hourly, "pickup_hour")),
        ("hourly_pickup_hour_accepted", Q.accepted(hourly, "pickup_hour", list(range(24)))),
        ("gold_matches_silver", Q.reconcile(silver, "total_amount", daily, "revenue", 1.0)),
    ]


def run_layers(spark: SparkSession, raw: DataFrame, seed: DataFrame, root: str, run_id: str,
               v: M.SilverVars = M.DEFAULT_VARS, previous_silver: str | None = None,
               months: list[str] | None = None, duration_hours: int | None = None,
               source_file: str | None = None, ingested_at: str | None = None,
               silver_mode: str = "snapshot", publish: str | None = None) -> RunResult:
    """One layer run (§3.2): bronze (month replace) -> zones -> silver (full, or
    incremental on ``previous_silver``) -> silver gate -> gold tables -> gold gate.

    Every model lands in ``{root}/{layer}/run={run_id}``; bronze is one partitioned
    table. ``duration_hours`` is the constant of the duration test (defaults to the
    silver cap); raising ``v.max_trip_hours`` above it makes the gate stop the run
    before gold is written. ``source_file`` names the input when ``raw`` is not a
    plain file scan (its hidden file-name column is then not available).

    ``silver_mode="snapshot"`` writes a complete silver table per run (incremental on
    ``previous_silver``). ``silver_mode="merge"`` keeps one month-partitioned silver
    table at ``{root}/silver_trips/table``: the first run builds it, later runs
    transform only bronze rows past the watermark (newest months, partitions pruned)
    and merge them with ``upsert_partitions`` - only the months they touch are read
    and rewritten, which is what keeps a recurring run cheap when silver is huge.
    Daily gold is then month-partitioned and recomputed for the touched months only,
    hourly gold is rolled up from per-month partials. As with an incremental model
    updated in place, merge-mode tables are written before their gate runs; a failing
    gate still stops everything downstream.

    Row checks of a newly written table are counted while it is written. ``publish`` is a prefix: once
    the last gate has passed, the tables of the run are catalog tables ``<publish>_silver_trips`` and
    so on, over the run's files.
    """
    root = root.rstrip("/")
    res = RunResult(bronze=f"{root}/bronze", zones=f"{root}/silver_zones/run={run_id}",
                    silver=f"{root}/silver_trips/run={run_id}", gold_daily=f"{root}/gold_daily/run={run_id}",
                    gold_hourly=f"{root}/gold_hourly/run={run_id}")
    ingest(raw, res.bronze, months, source_file, ingested_at)
    bronze = R.read_partitioned(spark, res.bronze)
    sinks.rebuild(M.silver_zones(seed), res.zones)
    zones = spark.read.parquet(res.zones)
    touched: list[str] | None = None          # None = every month (full build)
    hours = duration_hours if duration_hours is not None else v.max_trip_hours
    rules = silver_row_rules(hours, v)
    if silver_mode == "merge":
        res.silver = f"{root}/silver_trips/table"
        if path_exists(spark, res.silver):
            current = R.read_partitioned(spark, res.silver)
            fresh = M.silver_trips(M.since_watermark(bronze, current), v)
            touched = upsert_partitions(spark, res.silver, fresh, ["trip_id"], "pickup_month",
                                        f"{root}/_staging/silver/run={run_id}")
        else:
            sinks.rebuild(M.silver_trips(bronze, v), res.silver, partition_by=["pickup_month"])
    elif silver_mode == "snapshot":
        target = spark.read.parquet(previous_silver) if previous_silver else None
        row_counts = _write_observed(M.silver_trips(bronze, v, target), res.silver, rules, ["pickup_month"])
    else:
        raise ValueError(f"unknown silver_mode {silver_mode!r}")
    silver = R.read_partitioned(spark, res.silver)
    if silver_mode == "merge":
        row_counts = _scanned(silver, rules)
    done = {name for name, _ in rules}
    res.checks += Q.gate([c for c in silver_checks(silver, zones, hours, v) if c[0] not in done], row_counts)
    daily_rules = [(n, F.col(c).isNull()) for n, c in DAILY_ROW_RULES]
    if silver_mode == "merge":
        # gold daily groups by date, so it is kept month-partitioned and only the months
        # this run touched are recomputed (from pruned silver partitions) and replaced.
        res.gold_daily = f"{root}/gold_daily/table"
        part = silver if touched is None else silver.filter(F.col("pickup_month").isin(touched))
        g = gold.daily_zone_revenue(part, zones).withColumn("pickup_month", C.year_month("pickup_date"))
        if touched is None:
            sinks.rebuild(g, res.gold_daily, partition_by=["pickup_month"])
        elif touched:
            (g.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("pickup_month").parquet(res.gold_daily))
        daily = R.read_partitioned(spark, res.gold_daily).drop("pickup_month")
        # gold hourly spans all dates, so additive per-month partials are kept (only
        # touched months recomputed) and the small partial table is rolled up.
        parts_path = f"{root}/gold_hourly_parts/table"
        p = gold.hourly_demand_parts(part, zones)
        if touched is None:
            sinks.rebuild(p, parts_path, partition_by=["pickup_month"])
        elif touched:
            (p.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("pickup_month").parquet(parts_path))
        row_counts = _scanned(daily, daily_rules)
        row_counts += _write_observed(gold.hourly_from_parts(R.read_partitioned(spark, parts_path)), res.gold_hourly, hourly_row_rules())
    else:
        row_counts = _write_observed(gold.daily_zone_revenue(silver, zones), res.gold_daily, daily_rules)
        daily = spark.read.parquet(res.gold_daily)
        row_counts += _write_observed(gold.hourly_demand(silver, zones), res.gold_hourly, hourly_row_rules())
    hourly = spark.read.parquet(res.gold_hourly)
    done = {name for name, _ in row_counts}
    res.checks += Q.gate([c for c in gold_checks(silver, daily, hourly) if c[0] not in done], row_counts)
    if publish:
        for name, path in (("bronze_trips", res.bronze), ("silver_zones", res.zones), ("silver_trips", res.silver),
                           ("gold_daily_zone_revenue", res.gold_daily), ("gold_hourly_demand", res.gold_hourly)):
            sinks.publish(spark, f"{publish}_{name}", path)
    return res


def append_day(bronze: DataFrame, day: str | _dt.date, path: str) -> None:
    """The sandbox model (G20): append one pickup day's projection on every run -
    deliberately not idempotent (rows grow with each re-run, see M16)."""
    sinks.append(gold.sandbox_day(bronze, str(day)), path)
