"""Batches of results: states, work-lists, counters, runs and rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcheck.functions.text import normalize_age, range_start


def classify(items: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """State of each item against its result (key, ok, total_checks, failed): missing, corrupt, perfect or has_failures."""
    joined = items.select(*key).join(found.withColumn("_has", F.lit(True)), key, "left")
    state = (
        F.when(F.col("_has").isNull(), "missing")
        .when(~F.coalesce("ok", F.lit(False)) | (F.coalesce("total_checks", F.lit(0)) == 0), "corrupt")
        .when(F.col("failed") == 0, "perfect")
        .otherwise("has_failures")
    )
    return joined.select(*key, state.alias("state"))


def worklist(states: DataFrame, rerun_failures: bool = False) -> DataFrame:
    """Items to do: missing and corrupt ones, with rerun_failures also those that have failures."""
    todo = ["missing", "corrupt"] + (["has_failures"] if rerun_failures else [])
    return states.where(F.col("state").isin(*todo))


def failure_runs(events: DataFrame, key: list[str], order: list[str], least: int) -> DataFrame:
    """Runs of at least `least` failed events in a row: (key, first, last, n)."""
    by = Window.partitionBy(*key).orderBy(*order)
    within = Window.partitionBy(*key, "failed").orderBy(*order)
    runs = events.withColumn("_run", F.row_number().over(by) - F.row_number().over(within)).where("failed")
    out = runs.groupBy(*key, "_run").agg(F.min(order[-1]).alias("first"), F.max(order[-1]).alias("last"), F.count(F.lit(1)).alias("n"))
    return out.where(F.col("n") >= least).drop("_run")


def progress(events: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Running number, elapsed seconds, rate per minute and seconds that are left at this rate."""
    by = Window.partitionBy(*key).orderBy(*order)
    n = F.row_number().over(by)
    took = F.sum("seconds").over(by)
    total = F.count(F.lit(1)).over(Window.partitionBy(*key))
    out = events.withColumns({"n": n, "elapsed": took, "_total": total})
    return out.withColumn("rate", F.round(F.col("n") * 60 / F.col("elapsed"), 4)).withColumn("left", F.round((F.col("_total") - F.col("n")) * F.col("elapsed") / F.col("n"), 4)).drop("_total")


def age_order(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose age starts below that of the row before, totals and means left out: (key, row_ord, age, before)."""
    n = rows.withColumn("_n", normalize_age(F.col("age")))
    n = n.where(~F.col("_n").isin("total", "grandtotal") & ~F.col("_n").rlike("mean|median|average")).withColumn("_s", range_start(F.col("_n"))).where("_s IS NOT NULL")
    w = Window.partitionBy(*key).orderBy("row_ord")
    n = n.withColumn("before", F.lag("age").over(w)).withColumn("_p", F.lag("_s").over(w))
    return n.where("_s < _p").select(*key, "row_ord", "age", "before")
