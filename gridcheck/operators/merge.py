"""Pages, districts, schemas: putting several readings of one thing together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcheck.functions.text import normalize_district, strip_number_prefix


def continue_conditions(pages: DataFrame, key: list[str]) -> DataFrame:
    """Of pages (key, page_no, cond, marked, lo, hi): open pages, which say
    Total without a mark of it, take the condition of the page before if
    their first age rank follows its last, and so on along a chain; else that
    of the page after if that one says something and follows.

    A page that takes its predecessor's condition continues its run: runs are
    numbered by a running sum, and the first page of a run settles it.
    """
    w = Window.partitionBy(*key).orderBy("page_no")
    open_ = (F.col("cond") == "Total") & ~F.col("marked") & F.col("lo").isNotNull()
    linked = open_ & (F.col("lo") == F.lag("hi").over(w) + 1)
    chained = pages.withColumns({"_open": open_, "_linked": F.coalesce(linked, F.lit(False)), "_next": F.lead("cond").over(w), "_next_lo": F.lead("lo").over(w)})
    ahead = F.when(F.col("_open") & ~F.col("_linked") & (F.col("_next") != "Total") & (F.col("_next_lo") == F.col("hi") + 1), F.col("_next"))
    chained = chained.withColumn("_own", F.coalesce(ahead, F.col("cond"))).withColumn("_run", F.sum((~F.col("_linked")).cast("int")).over(w))
    first = F.first("_own").over(Window.partitionBy(*key, "_run").orderBy("page_no"))
    return chained.withColumn("condition", first).drop("_open", "_linked", "_next", "_next_lo", "_own", "_run")


def positional_names(rows: DataFrame, key: list[str]) -> DataFrame:
    """Of rows (key, page_no, pos, name): a missing name is the first that any page shows at that place, without its number; else _row_pos."""
    clean = F.when(~F.lower(F.coalesce("name", F.lit(""))).isin("", "null", "none"), F.trim(strip_number_prefix(F.col("name"))))
    named = rows.withColumn("_clean", clean)
    w = Window.partitionBy(*key, "pos").orderBy("page_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = F.coalesce("_clean", F.first("_clean", ignorenulls=True).over(w), F.concat(F.lit("_row_"), F.col("pos").cast("string")))
    return named.withColumn("district", filled).drop("_clean")


def merge_pages(rows: DataFrame, key: list[str]) -> DataFrame:
    """The last page wins for each cell: key are the columns of a cell."""
    w = Window.partitionBy(*key).orderBy(F.desc("page_no"))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def sum_conditions(rows: DataFrame, key: list[str], parts: tuple[str, ...] = ("Unmarried", "Married", "Widowed")) -> DataFrame:
    """Total of the civil conditions where all are there: (key, condition, value) gives (key, value)."""
    p = rows.groupBy(*key).pivot("condition", list(parts)).agg(F.max("value"))
    total = F.col(parts[0])
    for x in parts[1:]:
        total = total + F.col(x)
    return p.select(*key, total.alias("value")).where("value IS NOT NULL")


def match_districts(pred: DataFrame, truth: DataFrame, within: list[str]) -> DataFrame:
    """Names of pred to those of truth: equal once normalised, then, among
    the rest, where one contains the other, the longest name of truth first.
    Each name is used once: of several that are equal once normalised, the
    first goes with the first. A truth of which nothing is left matches none.
    Greedy within a group, which is a list of places."""
    nth = lambda c: F.row_number().over(Window.partitionBy(*within, c).orderBy("name"))
    p = pred.withColumn("_p", normalize_district(F.col("name"))).withColumn("_nth", nth("_p"))
    t = truth.withColumn("_t", normalize_district(F.col("name"))).where("_t <> ''").withColumn("_nth", nth("_t"))
    equal = p.withColumn("_t", F.col("_p")).join(t.withColumnRenamed("name", "match"), [*within, "_t", "_nth"]).select(*within, "name", "match")
    p, t = p.drop("_nth"), t.drop("_nth")
    left = p.join(equal, [*within, "name"], "left_anti")
    free = t.join(equal.select(*within, F.col("match").alias("name")), [*within, "name"], "left_anti").withColumnRenamed("name", "match")
    pairs = left.join(free, within).where(F.contains("_p", F.col("_t")) | F.contains("_t", F.col("_p")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.select(*within, "name", "match").schema)

    def greedy(pdf):
        import pandas as pd

        used, out = set(), []
        order = pdf.assign(_len=pdf["_t"].str.len()).sort_values(["name", "_len", "match"], ascending=[True, False, True])
        for name, options in order.groupby("name", sort=True):
            hit = next((m for m in options["match"] if m not in used), None)
            if hit is not None:
                used.add(hit)
                out.append((*[pdf[c].iloc[0] for c in within], name, hit))
        return pd.DataFrame(out, columns=[*within, "name", "match"])

    loose = pairs.groupBy(*within).applyInPandas(greedy, schema)
    return equal.withColumn("how", F.lit("equal")).unionByName(loose.withColumn("how", F.lit("contained")))


def merge_schemas(schemas: DataFrame, key: list[str], preferred: str) -> DataFrame:
    """Several readings (key, model, title, data_type, year, labels, right_frac)
    of one table's schema: the longest title, the majority of scalars (empty
    and 0 don't count, the preferred model breaks ties), the union of labels,
    the largest fraction."""

    def vote(col: str) -> DataFrame:
        some = schemas.where(F.col(col).isNotNull() & ~F.col(col).cast("string").isin("", "0"))
        n = some.groupBy(*key, col).agg(F.count(F.lit(1)).alias("_n"), F.max((F.col("model") == preferred).cast("int")).alias("_p"))
        best = F.min(F.struct((-F.col("_n")).alias("n"), (-F.col("_p")).alias("p"), F.col(col)))
        return n.groupBy(*key).agg(best[col].alias(col))

    merged = schemas.groupBy(*key).agg(
        F.min(F.struct((-F.length("title")).alias("n"), "title"))["title"].alias("title"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("labels")))), ",").alias("labels"),
        F.max("right_frac").alias("right_frac"),
    )
    return merged.join(vote("data_type"), key, "left").join(vote("year"), key, "left")


def compare_schemas(items: DataFrame, key: list[str], n_models: int) -> DataFrame:
    """Of (key, model, item): who shows an item and whether all do."""
    got = items.groupBy(*key, "item").agg(F.array_sort(F.collect_set("model")).alias("_m"))
    return got.select(*key, "item", F.array_join("_m", ",").alias("models"), (F.size("_m") == n_models).alias("unanimous"))


def merge_groups(parts: DataFrame, key: list[str]) -> DataFrame:
    """Rows of partial readings (key, age, grp, value, schema_ord) merged by
    raw age, groups in a map; rows follow the schema's order, unknown ages last."""
    rows = parts.groupBy(*key, "age").agg(F.min("schema_ord").alias("_o"), F.array_sort(F.collect_list(F.struct("grp", "value"))).alias("_g"))
    w = Window.partitionBy(*key).orderBy(F.coalesce("_o", F.lit(2**31 - 1)), "age")
    cells = F.array_join(F.transform("_g", lambda g: F.concat_ws("=", g["grp"], g["value"].cast("string"))), ",")
    return rows.select(*key, "age", F.row_number().over(w).alias("row_ord"), cells.alias("cells"))


def line_clusters(marks: DataFrame, key: list[str], gap: int = 6) -> DataFrame:
    """Runs of positions y no more than gap apart: first, last and middle of each (gaps and islands)."""
    w = Window.partitionBy(*key).orderBy("y")
    new = F.coalesce((F.col("y") - F.lag("y").over(w)) > gap, F.lit(True)).cast("int")
    runs = marks.select(*key, "y").distinct().withColumn("_new", new).withColumn("cluster", F.sum("_new").over(w))
    spans = runs.groupBy(*key, "cluster").agg(F.min("y").alias("first"), F.max("y").alias("last"))
    return spans.withColumn("middle", F.expr("(first + last) div 2"))


def row_strips(clusters: DataFrame, key: list[str], padding: int = 2, least: int = 15) -> DataFrame:
    """Strips between neighbouring lines, padded, of a least height."""
    w = Window.partitionBy(*key).orderBy("middle")
    strips = clusters.withColumn("bottom", F.lead("middle").over(w) + padding).withColumn("top", F.greatest(F.col("middle") - padding, F.lit(0)))
    return strips.where(F.col("bottom") - F.col("top") >= least).select(*key, "cluster", "top", "bottom")
