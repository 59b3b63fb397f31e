"""Data-quality checks and gates.

A check is a DataFrame of failing rows: empty means pass. ``run_checks`` turns many
checks into one small (check, failures) table; ``gate`` reads that table (one row
per check, never the failing rows) and stops the pipeline on any failure.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from keelson.functions.columns import half_up, seconds_between
from keelson.operators.joins import orphans as _orphans


class GateFailed(RuntimeError):
    """A quality gate found failing rows; downstream steps must not run."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL (Q1)."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values occurring more than once, with their count (Q2)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1))


def accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside ``values`` with their count (Q3); NULL is not a failure."""
    return (df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
              .groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key is missing in the parent."""
    return _orphans(child, parent, column, parent_column)


def duration_sane(df: DataFrame, hours: int = 12, start: str = "pickup_at", end: str = "dropoff_at") -> DataFrame:
    """Trips longer than ``hours`` (Q5) with their duration in hours."""
    secs = seconds_between(start, end)
    return df.filter(secs > hours * 3600).withColumn("hours", secs / 3600.0)


def reconcile(a: DataFrame, a_col: str, b: DataFrame, b_col: str, tolerance: float = 1.0,
              failing_only: bool = True) -> DataFrame:
    """Totals of two layers must agree within ``tolerance``.

    Both totals are summed in integer cents in ONE aggregate over a tagged union of
    the two columns (no join of the two one-row results). ``failing_only`` keeps the
    row only on failure (the test convention: no rows = pass).
    """
    ca = F.round(F.col(a_col) * 100).cast("bigint")
    cb = F.round(F.col(b_col) * 100).cast("bigint")
    u = (a.select(ca.alias("__a"), F.lit(None).cast("bigint").alias("__b"))
          .unionByName(b.select(F.lit(None).cast("bigint").alias("__a"), cb.alias("__b"))))
    t = u.agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    out = t.select((F.col("__a") / 100.0).alias("left_amount"),
                   (F.col("__b") / 100.0).alias("right_amount"),
                   (F.abs(F.col("__a") - F.col("__b")) / 100.0).alias("gap"))
    return out.filter(F.col("gap") > tolerance) if failing_only else out


def run_checks(checks: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """(check, failures) for every named check (Q10): failures = failing rows."""
    out = None
    for name, df in checks:
        one = df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check"), "failures")
        out = one if out is None else out.unionByName(one)
    return out


def count_failures(df: DataFrame, rules: Sequence[tuple[str, Column | tuple[Column, str]]]) -> DataFrame:
    """(check, failures) of many row rules over one table in one pass (Q1, Q3, Q5). A rule is the
    predicate of its failing rows; with a column name beside it, the failing values count."""
    aggs = []
    for i, (_, rule) in enumerate(rules):
        if isinstance(rule, tuple):
            aggs.append(F.countDistinct(F.when(rule[0], F.col(rule[1]))).alias(f"r{i}"))
        else:
            aggs.append(F.coalesce(F.sum(F.when(rule, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(f"r{i}"))
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"r{i}").alias("failures"))
                                  for i, (n, _) in enumerate(rules)]))
    return df.agg(*aggs).select(stacked.alias("s")).select("s.check", "s.failures")


def observed(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, Callable[[], list[tuple[str, int]]]]:
    """``df``, and a function that returns (check, failures) once an action over it has run: the row
    rules are counted by the write itself, so checking a new table costs no scan of it (Q9).

    A rule is the predicate of its failing rows. Counts are exact unless a shuffle stage above the
    observation is run again for a lost executor, which may count its rows twice; none stays none, so
    the gate's verdict holds. The function waits for the action."""
    seen = Observation()
    counts = [F.coalesce(F.sum(F.when(p, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(n) for n, p in rules]
    return df.observe(seen, *counts), lambda: [(n, seen.get[n]) for n, _ in rules]


def gate(checks: Iterable[tuple[str, DataFrame]], counted: Sequence[tuple[str, int]] = ()) -> list[tuple[str, int]]:
    """Run the checks, next to those that are ``counted`` already; raise ``GateFailed`` if any fails
    (Q9). Returns the table of (check, failures) - one row per check."""
    checks = list(checks)
    rows = list(counted) + ([(r["check"], r["failures"]) for r in run_checks(checks).collect()] if checks else [])
    failed = [(c, n) for c, n in rows if n]
    if failed:
        raise GateFailed(f"quality gate failed: {failed}")
    return rows


def dq_census(df: DataFrame, rules: Sequence[tuple[str, Column]], digits: int = 3) -> DataFrame:
    """Junk census (Q7, A11, R2): rows matching each rule, counted in ONE pass, then
    unpivoted to (rule, rows, pct). A NULL rule result counts as no match."""
    aggs = [F.sum(F.when(p, 1).otherwise(0)).cast("bigint").alias(f"r{i}") for i, (_, p) in enumerate(rules)]
    wide = df.agg(F.count(F.lit(1)).alias("__total"), *aggs)
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("rows"))
                                  for i, (n, _) in enumerate(rules)]))
    long = wide.select("__total", stacked.alias("s")).select("s.rule", "s.rows", "__total")
    return long.select("rule", "rows",
                       half_up(F.col("rows") * 100, "__total", digits).alias("pct"))


def bronze_census_rules(year_start: str, year_end: str, max_miles: float = 500.0,
                        max_hours: int = 12) -> list[tuple[str, Column]]:
    """The nine census rules over raw trip columns (Q7). As in the census being
    rebuilt, they are not one-to-one with the silver filter (``> max_miles`` here vs
    ``>= max_miles`` there; NULL fares are not counted here)."""
    pu, do = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    lo, hi = F.lit(year_start).cast("timestamp_ntz"), F.lit(year_end).cast("timestamp_ntz")
    return [
        ("pickup_out_of_range", (pu < lo) | (pu >= hi)),
        ("dropoff_not_after_pickup", do <= pu),
        ("zero_distance", F.col("trip_distance") <= 0),
        ("distance_over_limit", F.col("trip_distance") > max_miles),
        ("negative_fare", F.col("fare_amount") < 0),
        ("negative_total", F.col("total_amount") < 0),
        ("no_passengers", F.col("passenger_count").isNull() | (F.col("passenger_count") <= 0)),
        ("zone_out_of_range", ~F.col("PULocationID").between(1, 265) | ~F.col("DOLocationID").between(1, 265)),
        ("too_long", seconds_between(pu, do) > max_hours * 3600),
    ]


def null_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``count(*)`` next to ``count(col)`` for each column (A2): one row
    ``rows, <col>_non_null...``; shows how an evolved column is back-filled."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"{c}_non_null") for c in columns])
