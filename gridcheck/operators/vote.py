"""Votes over several readings of the same cells. Readings are long:
(cell keys, reading, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcheck.functions.text import let


def histogram(readings: DataFrame, key: list[str]) -> DataFrame:
    """Distinct values of a cell with votes and rank: most votes first, then first seen."""
    counted = readings.where("value IS NOT NULL").groupBy(*key, "value").agg(F.count(F.lit(1)).alias("votes"), F.min("reading").alias("seen"))
    best = Window.partitionBy(*key).orderBy(F.desc("votes"), "seen", "value")
    return counted.withColumn("rank", F.row_number().over(best))


def _winner(counted: DataFrame, key: list[str], *more: str) -> DataFrame:
    """The winner of each cell of (key, value, votes, more): value, votes, confidence, and more of who read it."""
    grouped = counted.groupBy(*key).agg(
        F.max("votes").alias("_top"), F.sum("votes").alias("_all"), F.array_sort(F.collect_list(F.struct("value", "votes", *more))).alias("_h")
    )
    tied = F.transform(F.filter("_h", lambda r: r["votes"] == F.col("_top")), lambda r: r["value"])
    middle = (F.get("_t", F.expr("int((size(_t) - 1) div 2)")) + F.get("_t", F.expr("int(size(_t) div 2)"))) / 2
    won = grouped.withColumn("_t", tied).withColumn("value", middle.cast("bigint"))
    won = won.withColumn("_own", F.get(F.filter("_h", lambda r: r["value"] == F.col("value")), F.lit(0)))
    votes = F.coalesce(F.col("_own.votes"), F.col("_top"))
    return won.select(*key, "value", votes.alias("votes"), F.round(votes / F.col("_all"), 4).alias("confidence"), *[F.col(f"_own.{m}").alias(m) for m in more])


def majority(readings: DataFrame, key: list[str]) -> DataFrame:
    """The value with most votes; a tie gives the truncated median of the
    tied values, which nobody need have read. confidence is the share of the
    winner among the votes that aren't null; a winner that nobody read takes
    the votes of the tied."""
    return _winner(readings.where("value IS NOT NULL").groupBy(*key, "value").agg(F.count(F.lit(1)).alias("votes")), key)


def cross_model(readings: DataFrame, key: list[str]) -> DataFrame:
    """majority() with the sorted names of the models that read the winner."""
    names = F.array_join(F.array_sort(F.collect_set("model")), ",").alias("models")
    return _winner(readings.where("value IS NOT NULL").groupBy(*key, "value").agg(F.count(F.lit(1)).alias("votes"), names), key, "models")


def two_stage(readings: DataFrame, key: list[str]) -> DataFrame:
    """A vote over each model's readings, then one over the models' winners."""
    inner = majority(readings, [*key, "model"]).withColumn("reading", F.col("model"))
    return majority(inner.select(*key, "reading", "value"), key)


def locked(readings: DataFrame, key: list[str], n_readings: int) -> DataFrame:
    """Cells that a vote settles at once: all readings agree, or three quarters of those present."""
    top = histogram(readings, key)
    w = Window.partitionBy(*key)
    top = top.withColumn("_all", F.sum("votes").over(w)).where("rank = 1")
    settled = ((F.col("votes") == n_readings) & (F.col("_all") == n_readings)) | (F.col("votes") * 4 >= F.col("_all") * 3)
    return top.where(settled).select(*key, "value", "votes")


def _digit_vote(values: Column) -> Column:
    """The number that the digits of an array of numbers vote for."""
    ten = F.sequence(F.lit(0), F.lit(9))

    def winner(votes):
        most = let(F.array_max(votes), lambda top: F.filter(ten, lambda d: F.get(votes, d) == top))
        return let(most, lambda tied: F.get(tied, F.floor(F.size(tied) / 2).cast("int")).cast("long"))

    def number(texts):
        place = lambda p: let(
            F.array_join(F.transform(texts, lambda x: F.substr(x, p + 1, F.lit(1))), ""),
            lambda read: let(F.transform(ten, lambda d: F.length(read) - F.length(F.replace(read, d.cast("string"), F.lit("")))), winner),
        )
        chosen = F.transform(F.sequence(F.lit(0), F.array_max(F.transform(texts, lambda x: F.length(x))) - 1), place)
        return F.aggregate(F.reverse(chosen), F.lit(0).cast("long"), lambda n, d: n * 10 + d)

    size = let(F.transform(values, lambda v: F.reverse(F.abs(v).cast("string"))), number)
    negative = F.size(F.filter(values, lambda v: v < 0)) * 2 > F.size(values)
    return F.when(negative, -size).otherwise(size)


def digits(readings: DataFrame, key: list[str]) -> DataFrame:
    """A vote for every decimal place of the right-aligned digits, missing
    ones left out; a tie gives the upper middle of the sorted tied digits.
    The sign has a vote of its own. The readings of a cell, a few, meet once."""
    read = readings.where("value IS NOT NULL").groupBy(*key).agg(F.collect_list("value").alias("_v"))
    return read.select(*key, _digit_vote(F.col("_v")).alias("value"))


def digit_ensemble(readings: DataFrame, key: list[str]) -> DataFrame:
    """digits() with the share of readings that agree, their number and all values in order of reading."""
    read = readings.where("value IS NOT NULL").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("reading", "value"))).alias("_r"))
    values = F.transform("_r", lambda r: r["value"])
    voted = read.select(*key, values.alias("_v"), _digit_vote(values).alias("value"))
    agree = F.size(F.filter("_v", lambda v: v == F.col("value"))) / F.size("_v")
    return voted.select(
        *key,
        "value",
        F.round(agree, 4).alias("agreement"),
        F.size("_v").cast("long").alias("n_readings"),
        F.array_join(F.transform("_v", lambda v: v.cast("string")), ",").alias("all_values"),
    )


def best_pair(a: DataFrame, b: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Of candidates a and b (key, value, votes): the pair with most votes
    whose sum is the target (key, target). An equi-join on target - a."""
    left = target.join(a.withColumnRenamed("value", "a").withColumnRenamed("votes", "_va"), key).withColumn("b", F.col("target") - F.col("a"))
    both = left.join(b.withColumnRenamed("value", "b").withColumnRenamed("votes", "_vb"), [*key, "b"])
    best = Window.partitionBy(*key).orderBy(F.desc("score"), "a", "b")
    return both.withColumn("score", F.col("_va") + F.col("_vb")).withColumn("_n", F.row_number().over(best)).where("_n = 1").select(*key, "a", "b", "score")


def best_triple(p: DataFrame, m: DataFrame, f: DataFrame, key: list[str]) -> DataFrame:
    """The exact triple p = m + f of most votes in all."""
    pm = p.withColumnRenamed("value", "p").withColumnRenamed("votes", "_vp").join(m.withColumnRenamed("value", "m").withColumnRenamed("votes", "_vm"), key)
    pm = pm.withColumn("f", F.col("p") - F.col("m"))
    all3 = pm.join(f.withColumnRenamed("value", "f").withColumnRenamed("votes", "_vf"), [*key, "f"])
    best = Window.partitionBy(*key).orderBy(F.desc("score"), "p", "m")
    scored = all3.withColumn("score", F.col("_vp") + F.col("_vm") + F.col("_vf"))
    return scored.withColumn("_n", F.row_number().over(best)).where("_n = 1").select(*key, "p", "m", "f", "score")
