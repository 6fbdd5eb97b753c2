"""Constraints as data: a sparse incidence relation, and its evaluation.

A row of the incidence relation says that a cell enters a constraint with a
coefficient. Every level (rows, verticals, subtotals, cross-group, cross-
section, known totals, signs) is then the same aggregation. Cells that are
null leave a constraint uncounted: neither passed nor failed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcheck.functions.text import normalize_age, range_end, range_start

VALUES = ("persons", "males", "females")
CELL = ["table_id", "section", "row_ord", "grp", "col"]


def cells(wide: DataFrame, drop_nulls: bool = False) -> DataFrame:
    """Long form of (table_id, section, age, row_ord, grp, persons, males, females): one row per col and value."""
    keys = [c for c in wide.columns if c not in VALUES]
    long = wide.withColumn("age_norm", normalize_age(F.col("age"))).unpivot([*keys, "age_norm"], list(VALUES), "col", "value")
    return long.where("value IS NOT NULL") if drop_nulls else long


def with_persons(wide: DataFrame) -> DataFrame:
    """persons from males and females where it is null."""
    return wide.withColumn("persons", F.coalesce("persons", F.col("males") + F.col("females")))


def last_wins(rows: DataFrame, key: list[str], order: str = "row_ord") -> DataFrame:
    return _nth(rows, key, F.desc(order))


def first_wins(rows: DataFrame, key: list[str], order: str = "row_ord") -> DataFrame:
    return _nth(rows, key, F.asc(order))


def _nth(rows: DataFrame, key: list[str], order: Column) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(order)
    return rows.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def subtotal_tiling(rows: DataFrame, key: list[str]) -> DataFrame:
    """Of rows (key, row_ord, age_norm): those that other rows tile, with the array components."""
    return _tiled(rows, key).where("components IS NOT NULL").select(*key, "row_ord", "age_norm", "components")


def _tiled(rows: DataFrame, key: list[str]) -> DataFrame:
    """rows with components: the two or more ranges right before a range of
    width above 1 that tile it exactly, else null.

    The walk back from a row stops at a label that is no range, at an end
    that doesn't meet, and at an exact fit; it is a fold over the earlier
    labels of the section.
    """
    before = Window.partitionBy(*key).orderBy("row_ord").rowsBetween(Window.unboundedPreceding, -1)
    span = F.struct(range_start(F.col("age_norm")).alias("lo"), range_end(F.col("age_norm")).alias("hi"), F.col("age_norm").alias("name"))
    walked = rows.withColumn("_lo", range_start(F.col("age_norm"))).withColumn("_hi", range_end(F.col("age_norm")))
    walked = walked.withColumn("_before", F.collect_list(span).over(before))

    def step(state, r):
        meets = r["hi"].isNotNull() & (r["hi"] == state["at"])
        go = ~state["stop"] & F.coalesce(meets, F.lit(False))
        n = state["n"] + 1
        hit = go & (r["lo"] == F.col("_lo")) & (n >= 2)
        return F.struct(
            F.when(go, r["lo"]).otherwise(state["at"]).alias("at"),
            F.when(go, n).otherwise(state["n"]).alias("n"),
            (~go | hit).alias("stop"),
            (state["hit"] | hit).alias("hit"),
        )

    start = F.struct(F.col("_hi").alias("at"), F.lit(0).alias("n"), F.lit(False).alias("stop"), F.lit(False).alias("hit"))
    fold = F.aggregate(F.reverse("_before"), start, step)
    walked = walked.withColumn("_fold", F.when((F.col("_hi") - F.col("_lo")) > 1, fold))
    names = F.transform(F.slice("_before", -F.col("_fold.n"), F.col("_fold.n")), lambda r: r["name"])
    return walked.select(*rows.columns, F.when(F.col("_fold.hit"), names).alias("components"))


def row_kinds(wide: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One row per printed row with its kind: total, grandtotal, subtotal or leaf, whether it stands after the Total, components of subtotals, whether its section has a Grand Total, and whether it is the last of its label."""
    key = key or ["table_id", "section"]
    rows = wide.select(*key, "row_ord", "age").distinct().withColumn("age_norm", normalize_age(F.col("age")))
    rows = _tiled(rows, key)
    kind = (
        F.when(F.col("age_norm") == "total", "total")
        .when(F.col("age_norm") == "grandtotal", "grandtotal")
        .when(F.col("components").isNotNull() | F.col("age").rlike(r"(?i)^total\s+\S"), "subtotal")
        .otherwise("leaf")
    )
    before = Window.partitionBy(*key).orderBy("row_ord").rowsBetween(Window.unboundedPreceding, -1)
    after = F.coalesce(F.max(F.col("age_norm") == "total").over(before), F.lit(False))
    within, label = Window.partitionBy(*key), Window.partitionBy(*key, "age_norm")
    rows = rows.withColumn("kind", kind).withColumn("after_total", after)
    return rows.withColumn("has_grand", F.max(F.col("kind") == "grandtotal").over(within)).withColumn("last", F.col("row_ord") == F.max("row_ord").over(label))


def _terms(df: DataFrame, level: str, cid: list, coef: Column, op: str = "=", rhs=0, tol: Column | None = None) -> DataFrame:
    return df.select(
        "table_id",
        F.concat_ws("|", F.lit(level), *[c if isinstance(c, Column) else F.col(c).cast("string") for c in cid]).alias("cid"),
        F.lit(level).alias("level"),
        "section",
        "row_ord",
        "age_norm",
        "grp",
        "col",
        coef.cast("bigint").alias("coef"),
        F.col("value"),
        F.lit(op).alias("op"),
        (rhs if isinstance(rhs, Column) else F.lit(rhs)).cast("bigint").alias("rhs"),
        (tol if tol is not None else F.lit(0)).cast("bigint").alias("tol"),
    )


def row_balance(long: DataFrame) -> DataFrame:
    """L1: persons = males + females, where all three are there."""
    whole = Window.partitionBy("table_id", "section", "row_ord", "grp")
    full = long.withColumn("_n", F.count("value").over(whole)).where("_n = 3")
    return _terms(full, "L1", ["section", "row_ord", "grp"], F.when(F.col("col") == "persons", 1).otherwise(-1))


def non_negative(long: DataFrame) -> DataFrame:
    """L5: a value that is there is not below zero."""
    return _terms(long.where("value IS NOT NULL"), "L5", ["section", "row_ord", "grp", "col"], F.lit(1), op=">=")


def vertical(long: DataFrame, kinds: DataFrame, proportional: bool = False) -> DataFrame:
    """L2: a section's Total is the sum of its leaves before it, of a repeated label the last row."""
    placed = long.join(kinds.select("table_id", "section", "row_ord", "kind", "after_total"), ["table_id", "section", "row_ord"])
    has_grand = F.max(F.col("kind") == "grandtotal").over(Window.partitionBy("table_id", "section"))
    placed = placed.withColumn("_grand", has_grand).where(F.col("kind").isin("total", "leaf"))
    placed = placed.where(~(F.col("_grand") & F.col("after_total") & (F.col("kind") == "leaf")))
    placed = last_wins(placed, ["table_id", "section", "grp", "col", "age_norm"])
    w = Window.partitionBy("table_id", "section", "grp", "col")
    total = F.max(F.when(F.col("kind") == "total", F.col("value"))).over(w)
    leaves = F.sum((F.col("kind") == "leaf").cast("int")).over(w)
    placed = placed.withColumn("_total", total).withColumn("_leaves", leaves).where("_total IS NOT NULL AND _leaves > 0")
    tol = 2 * F.col("_leaves") if proportional else None
    return _terms(placed, "L2", ["section", "grp", "col"], F.when(F.col("kind") == "total", 1).otherwise(-1), tol=tol)


def subtotals(long: DataFrame, kinds: DataFrame, proportional: bool = False) -> DataFrame:
    """L2S: a subtotal is the sum of the rows that tile it; a Grand Total that of Total and the rows after it."""
    member = subtotal_members(kinds).select("table_id", "section", "age_norm", F.explode("subs").alias("_m"))
    placed = last_wins(long, ["table_id", "section", "grp", "col", "age_norm"]).join(member, ["table_id", "section", "age_norm"])
    placed = placed.withColumn("_sub", F.col("_m.sub"))
    n = F.count(F.lit(1)).over(Window.partitionBy("table_id", "section", "grp", "col", "_sub")) - 1
    return _terms(placed, "L2S", ["section", "grp", "col", "_sub"], F.col("_m.coef"), tol=n if proportional else None)


def active(totals: DataFrame, sides: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Whether the first part of a table is the sum of the others on total
    rows, all within max(0.1 %, 10) and three quarters exact: a row per
    table_id with a boolean for each of sides, name to (column that tells the
    parts, its first value, column beside which the test is made)."""
    ways = [F.struct(F.lit(n).alias("side"), F.col(by).alias("by"), (F.col(part) == first).alias("first")) for n, (part, first, by) in sides.items()]
    each = totals.select("table_id", "col", "value", F.explode(F.array(*ways)).alias("_w")).select("table_id", "col", "value", "_w.*")
    sums = each.groupBy("table_id", "side", "by", "col").agg(
        F.max(F.when(F.col("first"), F.col("value"))).alias("_v"),
        F.sum(F.when(~F.col("first"), F.col("value"))).alias("_s"),
        F.count_if(F.col("value").isNull()).alias("_nulls"),
        F.count_if(~F.col("first")).alias("_others"),
    )
    sums = sums.where("_nulls = 0 AND _v IS NOT NULL AND _others > 0").withColumn("_d", F.abs(F.col("_v") - F.col("_s")))
    close = F.col("_d") <= F.greatest(F.col("_v") * 0.001, F.lit(10.0))
    on = lambda n: (
        F.coalesce(F.bool_and(F.when(F.col("side") == n, close)), F.lit(False))
        & (F.count_if((F.col("side") == n) & (F.col("_d") == 0)) * 4 >= F.count_if(F.col("side") == n) * 3)
    )
    return sums.groupBy("table_id").agg(*[on(n).alias(n) for n in sides])


def cross_group(long: DataFrame, first: str = "ALL") -> DataFrame:
    """L3: the first group is the sum of the others, if the total rows say so."""
    on = active(long.where("age_norm = 'total'"), {"on": ("grp", first, "section")}).where("on")
    return _terms(long.join(on, "table_id", "left_semi"), "L3", ["section", "row_ord", "col"], F.when(F.col("grp") == first, 1).otherwise(-1))


def cross_section(long: DataFrame, first: str = "ALL") -> DataFrame:
    """L4: the first section is the sum of the others, label by label, if the total rows say so."""
    on = active(long.where("age_norm = 'total'"), {"on": ("section", first, "grp")}).where("on")
    last = last_wins(long, ["table_id", "section", "grp", "col", "age_norm"]).join(on, "table_id", "left_semi")
    # A label that the first section or all others lack makes no check.
    w = Window.partitionBy("table_id", "age_norm", "grp", "col")
    last = last.withColumn("_first", F.max(F.col("section") == first).over(w)).withColumn("_n", F.count(F.lit(1)).over(w)).where("_first AND _n > 1")
    return _terms(last, "L4", ["age_norm", "grp", "col"], F.when(F.col("section") == first, 1).otherwise(-1))


def known_totals(long: DataFrame, known: DataFrame) -> DataFrame:
    """KT: cells of known (age_norm, col, expected) have that value."""
    return _terms(long.join(known, ["age_norm", "col"]), "KT", ["section", "row_ord", "grp", "col"], F.lit(1), rhs=F.col("expected"))


def subtotal_members(kinds: DataFrame) -> DataFrame:
    """(table_id, section, age_norm, subs): the subtotals that a label enters, each with its coefficient. A Grand Total is that of Total and the rows after it."""
    section = Window.partitionBy("table_id", "section")
    under_grand = (F.col("kind") == "total") | ((F.col("kind") == "leaf") & F.col("after_total"))
    grand = F.collect_list(F.when(under_grand, F.col("age_norm"))).over(section)
    grand = F.when((F.col("kind") == "grandtotal") & (F.size(grand) > 1), grand)
    subs = kinds.select("table_id", "section", F.col("age_norm").alias("_sub"), F.coalesce("components", grand).alias("_parts")).where("_parts IS NOT NULL")
    member = subs.select("table_id", "section", "_sub", F.explode(F.array_distinct(F.concat(F.array("_sub"), "_parts"))).alias("age_norm"))
    coef = F.when(F.col("age_norm") == F.col("_sub"), 1).otherwise(-1)
    return member.groupBy("table_id", "section", "age_norm").agg(F.collect_set(F.struct(F.col("_sub").alias("sub"), coef.alias("coef"))).alias("subs"))


def incidence(
    wide: DataFrame, first_group: str = "ALL", first_section: str = "ALL", persons_independent: bool = False, known: DataFrame | None = None
) -> DataFrame:
    """All constraints of the tables of wide, in one pass over their cells,
    and those of known totals (age_norm, col, expected), if there are any.

    Each cell is joined to its row's kind and its table's active cross
    checks, both small, and unfolds into its memberships. Constraints that
    lack a side (no Total, no parts) are left to evaluate(), which doesn't
    count them.
    """
    kinds = row_kinds(wide)
    kinds = kinds.join(subtotal_members(kinds), ["table_id", "section", "age_norm"], "left")
    long = cells(wide).join(kinds.select("table_id", "section", "row_ord", "kind", "after_total", "has_grand", "last", "subs"), ["table_id", "section", "row_ord"])
    member = []

    def enter(level: str, when: Column, cid: list, coef: Column, op: str = "=") -> None:
        name = F.concat_ws("|", F.lit(level), *[F.col(c).cast("string") for c in cid])
        member.append(F.when(when, F.struct(name.alias("cid"), F.lit(level).alias("level"), coef.cast("bigint").alias("coef"), F.lit(op).alias("op"))))

    leaf = (F.col("kind") == "leaf") & ~(F.col("has_grand") & F.col("after_total"))
    enter("L5", F.col("value").isNotNull(), ["section", "row_ord", "grp", "col"], F.lit(1), ">=")
    enter("L2", F.col("last") & ((F.col("kind") == "total") | leaf), ["section", "grp", "col"], F.when(F.col("kind") == "total", 1).otherwise(-1))
    if not persons_independent:
        totals = cells(wide.where(normalize_age(F.col("age")) == "total"))
        on = active(totals, {"_l3": ("grp", first_group, "section"), "_l4": ("section", first_section, "grp")})
        long = long.join(on, "table_id", "left")
        enter("L1", F.lit(True), ["section", "row_ord", "grp"], F.when(F.col("col") == "persons", 1).otherwise(-1))
        enter("L3", F.col("_l3"), ["section", "row_ord", "col"], F.when(F.col("grp") == first_group, 1).otherwise(-1))
        enter("L4", F.col("_l4") & F.col("last"), ["age_norm", "grp", "col"], F.when(F.col("section") == first_section, 1).otherwise(-1))
    subs = F.transform(
        F.when(F.col("last"), F.col("subs")),
        lambda s: F.struct(F.concat_ws("|", F.lit("L2S"), "section", "grp", "col", s["sub"]).alias("cid"), F.lit("L2S").alias("level"), s["coef"].cast("bigint").alias("coef"), F.lit("=").alias("op")),
    )
    found = F.filter(F.concat(F.array(*member), F.coalesce(subs, F.filter(F.array(*member), lambda _: F.lit(False)))), lambda m: m.isNotNull())
    each = long.select("table_id", "section", "row_ord", "age_norm", "grp", "col", "value", F.explode(found).alias("_m"))
    zero = F.lit(0).cast("bigint")
    terms = each.select("table_id", "_m.cid", "_m.level", "section", "row_ord", "age_norm", "grp", "col", "_m.coef", "value", "_m.op", zero.alias("rhs"), zero.alias("tol"))
    return terms if known is None else terms.unionByName(known_totals(cells(wide), known))


def evaluate(terms: DataFrame) -> DataFrame:
    """One row per counted constraint: (table_id, cid, level, diff, passed)."""
    sums = terms.groupBy("table_id", "cid", "level").agg(
        F.sum(F.col("coef") * F.col("value")).alias("_lhs"),
        F.count_if(F.col("value").isNull()).alias("_nulls"),
        F.min("op").alias("_op"),
        F.min("rhs").alias("_rhs"),
        F.min("tol").alias("_tol"),
        F.max("coef").alias("_plus"),
        F.min("coef").alias("_minus"),
    )
    diff = F.col("_lhs") - F.col("_rhs")
    passed = F.when(F.col("_op") == "=", F.abs(diff) <= F.col("_tol")).otherwise(diff >= 0)
    # A sum needs both of its sides; signs and known totals have one.
    sums = sums.where("_nulls = 0 AND (level IN ('L5', 'KT') OR (_plus > 0 AND _minus < 0))")
    return sums.select("table_id", "cid", "level", diff.alias("diff"), passed.alias("passed"))


def reevaluate(long: DataFrame, terms: DataFrame) -> DataFrame:
    """evaluate() of the same constraints with the values of long."""
    return evaluate(terms.drop("value").join(long.select(*CELL, "value"), CELL))


def summary(checks: DataFrame) -> DataFrame:
    """Passed and failed by table and level, with subtotals by table and in all (nulls)."""
    return checks.rollup("table_id", "level").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.bool_and("passed").alias("all_passed"),
    )


def blame(terms: DataFrame, checks: DataFrame) -> DataFrame:
    """Cells by the number of failures that they take part in."""
    failed = checks.where("NOT passed").select("table_id", "cid")
    hit = terms.join(failed, ["table_id", "cid"])
    return hit.groupBy("table_id", "section", "row_ord", "grp", "col").agg(F.count(F.lit(1)).alias("score"))


def required_rows(wide: DataFrame, labels: list[str], key: list[str]) -> DataFrame:
    """Labels that a table must show, with whether it does: a missing one is a failure of the strict variant."""
    have = wide.select(*key, normalize_age(F.col("age")).alias("age_norm")).distinct()
    asked = wide.select(*key).distinct().select(*key, F.explode(F.array(*[F.lit(x) for x in labels])).alias("age_norm"))
    found = have.withColumn("_found", F.lit(True))
    return asked.join(found, [*key, "age_norm"], "left").select(*key, "age_norm", F.col("_found").isNotNull().alias("present"))
