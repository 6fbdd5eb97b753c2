"""Closed-form corrections and their signatures, set-oriented."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcheck.functions.text import CONFUSED, change_label, digit_fix


def digit_fixes(targets: DataFrame) -> DataFrame:
    """Of (keys, value, target): the rows that one confusable digit mends, with fixed."""
    return targets.withColumn("fixed", digit_fix(F.col("value"), F.col("target"))).where("fixed IS NOT NULL")


def two_digit_fixes(targets: DataFrame, key: list[str]) -> DataFrame:
    """Of (key, value, target): the first change of two confusable digits at
    different places that moves the magnitude by target, most significant
    first. In closed form: the lower of the two places is where the target's
    zeros end, its digit moves by the target's last digit or by that less
    ten, and the rest must be one digit with zeros after it."""
    text, moved = F.abs("value").cast("string"), F.abs("target").cast("string")
    core = F.rtrim(moved, F.lit("0"))
    low = F.length(moved) - F.length(core)
    signed = core.try_cast("bigint") * F.signum("target").cast("bigint")
    digit = lambda place: F.when(F.length(text) > place, F.substr(text, F.length(text) - place, F.lit(1)))
    becomes = lambda place, by: digit(place).cast("int") + by
    fits = lambda place, by: F.concat(digit(place), becomes(place, by).cast("string")).isin(*CONFUSED)

    def candidate(by):
        rest = signed - by
        shown = F.abs(rest).cast("string")
        high, step = low + F.length(shown) - 1, F.substr(shown, F.lit(1), F.lit(1)).cast("int") * F.signum(rest).cast("int")
        place = lambda p: (F.length(text) - 1 - p).alias
        fix = F.struct(place(high)("p1"), becomes(high, step).alias("d1"), place(low)("p2"))
        return F.when(shown.rlike("^[1-9]0+$") & fits(high, step) & fits(low, by), fix)

    last = F.pmod(signed, F.lit(10)).cast("int")
    fixed = F.when(F.col("value") < 0, F.col("value") - F.col("target")).otherwise(F.col("value") + F.col("target"))
    found = targets.withColumn("_fix", F.least(candidate(last), candidate(last - 10))).where("_fix IS NOT NULL")
    return found.select(*key, "value", "target", F.col("_fix.p1").alias("p1"), F.col("_fix.p2").alias("p2"), fixed.alias("fixed"))


def balance_rows(wide: DataFrame) -> DataFrame:
    """The smallest change to a row that doesn't balance is always to persons."""
    sums = F.col("males") + F.col("females")
    off = F.coalesce(F.col("persons") != sums, F.lit(False))
    return wide.withColumns({"old_persons": F.col("persons"), "repaired": off, "persons": F.when(off, sums).otherwise(F.col("persons"))})


def enforce_rows(wide: DataFrame) -> DataFrame:
    """Negatives lose their sign; then a row that doesn't balance changes the
    field of highest confidence (conf_*; persons if there is none, or a tie)
    unless the change would make it negative. Logs field, old, new, label."""
    positive = wide.withColumns({c: F.abs(c) for c in ("persons", "males", "females")})
    p, m, f = F.col("persons"), F.col("males"), F.col("females")
    options = [("persons", m + f, "conf_persons"), ("males", p - f, "conf_males"), ("females", p - m, "conf_females")]
    ranked = F.array_sort(
        F.filter(
            F.array(*[F.struct((-F.col(conf)).alias("c"), F.lit(k).alias("k"), F.lit(name).alias("field"), new.alias("new"), F.col(name).alias("old")) for k, (name, new, conf) in enumerate(options)]),
            lambda o: o["new"] >= 0,
        )
    )
    off = F.coalesce(p != m + f, F.lit(False))
    out = positive.withColumn("_fix", F.when(off, F.get(ranked, F.lit(0))))
    for name, _, _ in options:
        out = out.withColumn(name, F.when(F.col("_fix.field") == name, F.col("_fix.new")).otherwise(F.col(name)))
    label = change_label(F.col("_fix.old"), F.col("_fix.new"))
    return out.select("*", F.col("_fix.field").alias("field"), F.col("_fix.old").alias("old"), F.col("_fix.new").alias("new"), F.when(F.col("_fix").isNotNull(), label).alias("label")).drop("_fix")


def enforce_totals(long: DataFrame, key: list[str]) -> DataFrame:
    """Totals against the sum of all other rows where none is null: below 1 %
    the total takes the sum, else the difference is only logged."""
    sums = long.groupBy(*key).agg(
        F.max(F.when(F.col("age_norm") == "total", F.col("value"))).alias("old"),
        F.sum(F.when(F.col("age_norm") != "total", F.col("value"))).alias("new"),
        F.count_if((F.col("age_norm") != "total") & F.col("value").isNull()).alias("_gaps"),
    )
    share = F.abs(F.col("old") - F.col("new")) / F.greatest(F.abs("new"), F.lit(1))
    off = sums.where("_gaps = 0 AND old <> new").drop("_gaps")
    return off.select("*", F.when(share < 0.001, "high").when(share < 0.01, "medium").otherwise("low").alias("label"), (share < 0.01).alias("corrected"))


def swap_signature(failures: DataFrame, key: list[str]) -> DataFrame:
    """Of failures (key, col, diff): where males and females miss by opposite amounts, the mark of swapped columns."""
    d = failures.groupBy(*key).agg(F.max(F.when(F.col("col") == "males", F.col("diff"))).alias("d_males"), F.max(F.when(F.col("col") == "females", F.col("diff"))).alias("d_females"))
    return d.where("d_males + d_females = 0 AND d_males <> 0")


def confused_groups(long: DataFrame, key: list[str]) -> DataFrame:
    """Groups more than half of whose cells equal those of the group before: (key, grp, left_grp, cells, equal)."""
    w = Window.partitionBy(*key, "age_norm", "col").orderBy("grp")
    pairs = long.withColumn("left_grp", F.lag("grp").over(w)).withColumn("_left", F.lag("value").over(w)).where("_left IS NOT NULL AND value IS NOT NULL")
    rated = pairs.groupBy(*key, "grp", "left_grp").agg(F.count(F.lit(1)).alias("cells"), F.count_if(F.col("value") == F.col("_left")).alias("equal"))
    return rated.where("equal * 2 > cells")


def discrepancies(long: DataFrame, key: list[str], first: str = "ALL") -> DataFrame:
    """Cells of the total group that aren't the sum of the others, all present: (key, total, parts, diff)."""
    sums = long.groupBy(*key).agg(
        F.max(F.when(F.col("grp") == first, F.col("value"))).alias("total"),
        F.sum(F.when(F.col("grp") != first, F.col("value"))).alias("parts"),
        F.count_if(F.col("value").isNull()).alias("_gaps"),
        F.count_if(F.col("grp") == first).alias("_has"),
    )
    out = sums.where("_gaps = 0 AND _has > 0 AND total <> parts").drop("_gaps", "_has")
    return out.withColumn("diff", F.col("total") - F.col("parts"))


def deduced(long: DataFrame, key: list[str], threshold: float = 0.75, first: str = "ALL") -> DataFrame:
    """One pass of confidence deduction: where exactly one cell of an
    equation is below the threshold, the value that the others imply."""
    w = Window.partitionBy(*key)
    weak = F.col("conf") < threshold
    sign = F.when(F.col("grp") == first, 1).otherwise(-1)
    marked = long.withColumn("_weak", F.sum(weak.cast("int")).over(w)).withColumn("_all", F.sum(sign * F.col("value")).over(w))
    marked = marked.withColumn("_gaps", F.sum(F.col("value").isNull().cast("int")).over(w))
    implied = F.col("value") - sign * F.col("_all")
    out = marked.where(weak & (F.col("_weak") == 1) & (F.col("_gaps") == 0) & (F.col("_all") != 0))
    return out.select(*key, "grp", F.col("value").alias("old"), implied.alias("new")).where("new >= 0")


def cascade(wide: DataFrame) -> DataFrame:
    """persons from a changed male or female; a missing one from changed persons, if not negative. changed names the column."""
    p, m, f = F.col("persons"), F.col("males"), F.col("females")
    mf = F.col("changed").isin("males", "females") & m.isNotNull() & f.isNotNull()
    from_p = (F.col("changed") == "persons") & p.isNotNull()
    return wide.withColumns(
        {
            "persons": F.when(mf, m + f).otherwise(p),
            "females": F.when(from_p & m.isNotNull() & f.isNull() & (p >= m), p - m).otherwise(f),
            "males": F.when(from_p & f.isNotNull() & m.isNull() & (p >= f), p - f).otherwise(m),
        }
    )


def truncated(kinds: DataFrame, failures: DataFrame, least: int = 1000) -> DataFrame:
    """Sections with fewer labels than the fullest of their table less one, and a vertical that misses by at least `least`."""
    rows = kinds.where("age_norm <> 'total'").groupBy("table_id", "section").agg(F.countDistinct("age_norm").alias("n"))
    rows = rows.withColumn("most", F.max("n").over(Window.partitionBy("table_id"))).where("n < most - 1")
    worst = failures.groupBy("table_id", "section").agg(F.max(F.abs("diff")).alias("worst"))
    return rows.join(worst, ["table_id", "section"]).where(F.col("worst") >= least)


def structural(failures: DataFrame) -> DataFrame:
    """Sections of ten failures or more, half of them above 50 % of the value: their structure was misread."""
    n = failures.groupBy("table_id", "section").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs("diff") * 2 > F.abs("value")).alias("huge"))
    return n.where("n >= 10 AND huge >= n div 2")
