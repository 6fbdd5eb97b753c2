"""Scoring of predicted cells against ground truth, under several join
disciplines. Truth and predictions are long: (key columns, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcheck.operators.constraints import first_wins


def accuracy(matched: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Of (want, got): exact, total, rate, and the mean absolute error over wrong cells only; a null got counts its whole truth."""
    miss = F.when(~F.col("want").eqNullSafe(F.col("got")), F.abs(F.col("want") - F.coalesce("got", F.lit(0))))
    return matched.groupBy(*(by or [])).agg(
        F.count_if(F.col("want") == F.col("got")).alias("exact"),
        F.count(F.lit(1)).alias("total"),
        F.round(F.count_if(F.col("want") == F.col("got")) / F.count(F.lit(1)), 6).alias("rate"),
        F.round(F.coalesce(F.avg(miss), F.lit(0.0)), 4).alias("mae"),
    )


def on_predictions(pred: DataFrame, truth: DataFrame, key: list[str], order: str = "row_ord") -> DataFrame:
    """Predictions with a truth: the first prediction of a key counts, truths without one leave the denominator."""
    first = first_wins(pred, key, order).select(*key, F.col("value").alias("got"))
    return first.join(truth.select(*key, F.col("value").alias("want")), key)


def on_truth(pred: DataFrame, truth: DataFrame, key: list[str], order: str = "row_ord") -> DataFrame:
    """Every truth: a missing prediction is an error."""
    first = first_wins(pred, key, order).select(*key, F.col("value").alias("got"))
    return truth.select(*key, F.col("value").alias("want")).join(first, key, "left")


def unmatched(pred: DataFrame, truth: DataFrame, key: list[str]) -> DataFrame:
    return truth.join(pred.select(*key).distinct(), key, "left_anti").select(*key)


def generous(pred: DataFrame, truth: DataFrame, exact_key: list[str], loose_key: list[str]) -> DataFrame:
    """truth with exact (equal value under the full key) and generous (the value stands anywhere under the loose key)."""
    one = pred.select(*exact_key, F.col("value").alias("_got")).groupBy(*exact_key).agg(F.min("_got").alias("_got"))
    anywhere = pred.where("value IS NOT NULL").select(*loose_key, "value").distinct().withColumn("_any", F.lit(True))
    joined = truth.join(one, exact_key, "left").join(anywhere, [*loose_key, "value"], "left")
    exact = F.coalesce(F.col("_got") == F.col("value"), F.lit(False))
    return joined.withColumn("exact", exact).withColumn("generous", exact | F.col("_any").isNotNull()).drop("_got", "_any")


def value_anywhere(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Truths whose value is among the numbers found anywhere: a semi-join on the value alone."""
    return truth.join(found.select("value").distinct(), "value", "left_semi")


def row_context(rows: DataFrame, truth: DataFrame, key: list[str], spellings: list[Column]) -> DataFrame:
    """truth against rows (key, fields map): the first spelling of a column
    that the row has decides; if it has none, the value may stand anywhere
    in the row."""
    joined = truth.join(rows, key, "left")
    named = F.coalesce(*[F.try_element_at("fields", s) for s in spellings])
    anywhere = F.coalesce(F.array_contains(F.map_values("fields"), F.col("value")), F.lit(False))
    return joined.withColumn("hit", F.when(named.isNotNull(), named == F.col("value")).otherwise(anywhere))


def containment(truth: DataFrame, pred: DataFrame, within: list[str], label: str = "label") -> DataFrame:
    """Labels of truth matched to those of pred inside `within`: equal first,
    else the first in order of which one contains the other. The theta join
    stays inside its group, for which `within` must be selective."""
    t, p = truth.withColumnRenamed(label, "_t"), pred.withColumnRenamed(label, "_p")
    both = t.join(p, within).where((F.col("_t") == F.col("_p")) | F.contains("_t", F.col("_p")) | F.contains("_p", F.col("_t")))
    rank = F.struct(F.when(F.col("_t") == F.col("_p"), 0).otherwise(1), "_p")
    return both.groupBy(*within, "_t").agg(F.min(rank)["_p"].alias("matched")).withColumnRenamed("_t", label)


def relative_error(matched: DataFrame, by: list[str]) -> DataFrame:
    """Accuracy with the mean error relative to the truth, over wrong cells."""
    err = F.when(F.col("want") != F.col("got"), F.abs(F.col("want") - F.col("got")) / F.greatest(F.abs("want"), F.lit(1)))
    return matched.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("want") == F.col("got")).alias("exact"), F.round(F.coalesce(F.avg(err), F.lit(0.0)), 6).alias("mean_rel")
    )


def patched(truth: DataFrame, patches: DataFrame, key: list[str]) -> DataFrame:
    """truth with the values of patches (key, patch) put over it."""
    return truth.join(patches, key, "left").withColumn("value", F.coalesce("patch", "value")).drop("patch")
