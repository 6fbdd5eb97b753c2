"""Scoring queries: the observed cells are predictions, the clean ones the truth."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcheck.operators import constraints as c
from gridcheck.operators import score as s
from gridcheck.plans import tables as t

KEY = ["table_id", "section", "age_norm", "grp", "col"]


def _u(name: str, source: str) -> str:
    age = "CASE WHEN row_ord = 99 THEN 'total' ELSE age END AS age_norm"
    return f"{name} AS (" + " UNION ALL ".join(f"SELECT table_id, section, {age}, row_ord, grp, '{k}' AS col, {k} AS value FROM {source}" for k in t.COLS) + ")"


#: Predictions lack every eighth row and one table in nine.
LACK = "(table_id + row_ord) % 8 <> 5 AND table_id % 9 <> 4"
BOTH = f"WITH {t.SQL}, {_u('truth', 'clean')}, {_u('seen', 'obs')}, pred AS (SELECT * FROM seen WHERE {LACK})"


def both(spark, d):
    return c.cells(t.obs(spark, d)).where(LACK), c.cells(t.clean(spark, d))


ACC = """count(*) FILTER (WHERE want = got) AS exact, count(*) AS total, round(count(*) FILTER (WHERE want = got) / count(*), 6) AS rate,
  round(coalesce(avg(CASE WHEN want IS DISTINCT FROM got THEN abs(want - coalesce(got, 0)) END), 0), 4) AS mae"""


def score_exact(spark, d):
    p, g = both(spark, d)
    return s.accuracy(s.on_predictions(p, g, KEY), ["table_id"])


def score_gt_left(spark, d):
    p, g = both(spark, d)
    return s.accuracy(s.on_truth(p, g, KEY), ["table_id"])


def score_flexible(spark, d):
    """Accuracy on predictions beside the number of truths without one."""
    p, g = both(spark, d)
    hit = s.accuracy(s.on_predictions(p, g, KEY), ["table_id"]).select("table_id", "exact", "total")
    lost = s.unmatched(p, g, KEY).groupBy("table_id").agg(F.count(F.lit(1)).alias("unmatched"))
    return hit.join(lost, "table_id", "full").na.fill(0)


def unmatched_gt(spark, d):
    p, g = both(spark, d)
    return s.unmatched(p, g, KEY)


def score_generous(spark, d):
    p, g = both(spark, d)
    out = s.generous(p, g, KEY, ["table_id", "section", "age_norm"])
    return out.groupBy("table_id").agg(F.count_if("exact").alias("exact"), F.count_if("generous").alias("generous"), F.count(F.lit(1)).alias("total"))


def value_anywhere(spark, d):
    p, g = both(spark, d)
    return s.value_anywhere(g, p.where("value IS NOT NULL")).groupBy("table_id").agg(F.count(F.lit(1)).alias("hits"))


def row_context(spark, d):
    """Rows of a few spellings of columns, of which one in seven only has odd names."""
    wide = t.obs(spark, d).where("grp <> 'ALL'").withColumn("age_norm", F.when(F.col("row_ord") == 99, "total").otherwise(F.col("age")))
    plain = F.col("row_ord") % 7 != 3
    names = F.array(*[F.when(plain, F.concat(F.lit(k), F.lit("_"), F.col("grp"))).otherwise(F.concat(F.lit(f"c{i}_"), F.col("grp"))) for i, k in enumerate(t.COLS)])
    per = wide.withColumn("_e", F.arrays_zip(names.alias("k"), F.array(*t.COLS).alias("v"))).withColumn("_e", F.explode("_e"))
    rows = per.groupBy("table_id", "section", "age_norm").agg(F.map_from_entries(F.collect_list(F.struct("_e.k", "_e.v"))).alias("fields"))
    truth = c.cells(t.clean(spark, d)).where("grp <> 'ALL'")
    spell = [F.concat_ws("_", "col", "grp"), F.concat_ws("_", "grp", "col")]
    out = s.row_context(rows, truth, ["table_id", "section", "age_norm"], spell)
    return out.groupBy("table_id").agg(F.count_if("hit").alias("hits"), F.count(F.lit(1)).alias("total"))


CONTEXT = f"""WITH {t.SQL}, {_u('truth', 'clean')}, {_u('seen', 'obs')}
SELECT g.table_id, count(*) FILTER (WHERE CASE WHEN o.value IS NOT NULL AND g.row_ord % 7 <> 3 THEN o.value = g.value
  ELSE EXISTS (SELECT 1 FROM seen x WHERE x.table_id = g.table_id AND x.section = g.section AND x.row_ord = g.row_ord AND x.grp <> 'ALL' AND x.value = g.value) END) AS hits, count(*) AS total
FROM truth g LEFT JOIN seen o USING (table_id, section, row_ord, grp, col) WHERE g.grp <> 'ALL' GROUP BY g.table_id"""


def containment(spark, d):
    """Customer names, some cut at an end and some left out, matched to full ones within lists of eight."""
    cu = t.load(spark, d, "customer").withColumn("list", F.expr("c_custkey div 8"))
    cut = F.when(F.col("c_custkey") % 4 == 0, F.expr("substring(c_name, 1, length(c_name) - 1)")).when(F.col("c_custkey") % 4 != 3, F.col("c_name"))
    pred = cu.select("list", cut.alias("label")).where("label IS NOT NULL")
    return s.containment(cu.select("list", F.col("c_name").alias("label")), pred, ["list"])


CONTAIN = """WITH t AS (SELECT c_custkey // 8 AS list, c_name AS label, CASE c_custkey % 4 WHEN 0 THEN substr(c_name, 1, length(c_name) - 1) WHEN 3 THEN NULL ELSE c_name END AS m FROM customer)
SELECT DISTINCT list, t.label, first_value(p.m) OVER (PARTITION BY list, t.label ORDER BY CASE WHEN p.m = t.label THEN 0 ELSE 1 END, p.m) AS matched
FROM t JOIN (SELECT list, m FROM t WHERE m IS NOT NULL) p USING (list) WHERE p.m = t.label OR contains(t.label, p.m) OR contains(p.m, t.label)"""


def relative_error(spark, d):
    p, g = both(spark, d)
    return s.relative_error(s.on_predictions(p.where("value IS NOT NULL"), g, KEY), ["section", "grp"])


def score_rollup(spark, d):
    """Micro totals by section and group with their subtotals."""
    p, g = both(spark, d)
    m = s.on_truth(p, g, KEY).rollup("section", "grp").agg(F.count_if(F.col("want") == F.col("got")).alias("exact"), F.count(F.lit(1)).alias("total"))
    return m.select(F.coalesce("section", F.lit("*")).alias("section"), F.coalesce("grp", F.lit("*")).alias("grp"), "exact", "total")


def gt_patch(spark, d):
    _, g = both(spark, d)
    patches = spark.createDataFrame([(1, "A", "0-5", 1), (2, "N", "5-10", 2), (77, "R", "0-5", 3)], "table_id bigint, section string, age_norm string, patch bigint")
    return s.patched(g.select(*KEY, "value"), patches, ["table_id", "section", "age_norm"]).where("section <> 'ALL'")


def gt_rollup(spark, d):
    """Single rows folded into one bracket, the others kept."""
    g = c.cells(t.clean(spark, d)).where("row_ord < 99")
    age = F.when(F.col("row_ord") <= 4, "0-20").otherwise(F.col("age_norm"))
    return g.groupBy("table_id", "section", "grp", "col", age.alias("age")).agg(F.sum("value").alias("value"))


def _labels(spark, d):
    li = t.load(spark, d, "lineitem")
    of = lambda status: li.where(F.col("l_linestatus") == status).select("l_partkey", "l_linenumber").distinct()
    return of("F"), of("O")


LAB = """WITH f AS (SELECT DISTINCT l_partkey, l_linenumber FROM lineitem WHERE l_linestatus = 'F'), o AS (SELECT DISTINCT l_partkey, l_linenumber FROM lineitem WHERE l_linestatus = 'O')"""


def missing_labels(spark, d):
    f, o = _labels(spark, d)
    return f.exceptAll(o)


def common_labels(spark, d):
    f, o = _labels(spark, d)
    return f.intersect(o)


def symmetric_labels(spark, d):
    f, o = _labels(spark, d)
    f, o = f.withColumn("_f", F.lit(1)), o.withColumn("_o", F.lit(1))
    side = F.when(F.col("_o").isNull(), "F").when(F.col("_f").isNull(), "O")
    return f.join(o, ["l_partkey", "l_linenumber"], "full").withColumn("side", side).where("side IS NOT NULL").select("l_partkey", "l_linenumber", "side")


def label_union(spark, d):
    """The union of labels in order of first appearance."""
    first = t.load(spark, d, "lineitem").groupBy("l_partkey", "l_linenumber").agg(F.min("l_orderkey").alias("_o"))
    seen = F.transform(F.array_sort(F.collect_list(F.struct("_o", "l_linenumber"))), lambda r: r["l_linenumber"].cast("string"))
    return first.groupBy("l_partkey").agg(F.array_join(seen, ",").alias("labels"))


QUERIES = [
    ("score_exact", score_exact, f"{BOTH} SELECT g.table_id, {ACC} FROM (SELECT p.*, g.value AS want, p.value AS got FROM pred p JOIN truth g USING (table_id, section, age_norm, grp, col)) g GROUP BY g.table_id"),
    ("score_gt_left", score_gt_left, f"{BOTH} SELECT table_id, {ACC} FROM (SELECT g.table_id, g.value AS want, p.value AS got FROM truth g LEFT JOIN pred p USING (table_id, section, age_norm, grp, col)) GROUP BY table_id"),
    (
        "score_flexible",
        score_flexible,
        f"""{BOTH} SELECT table_id, count(*) FILTER (WHERE want = got) AS exact, count(*) FILTER (WHERE has) AS total, count(*) FILTER (WHERE has IS NULL) AS unmatched
        FROM (SELECT g.table_id, g.value AS want, p.value AS got, p.has FROM truth g LEFT JOIN (SELECT *, true AS has FROM pred) p USING (table_id, section, age_norm, grp, col)) GROUP BY table_id""",
    ),
    ("unmatched_gt", unmatched_gt, f"{BOTH} SELECT table_id, section, age_norm, grp, col FROM truth g ANTI JOIN pred p USING (table_id, section, age_norm, grp, col)"),
    (
        "score_generous",
        score_generous,
        f"""{BOTH} SELECT table_id, count(*) FILTER (WHERE ex) AS exact, count(*) FILTER (WHERE ex OR gen) AS generous, count(*) AS total FROM (
        SELECT g.table_id, coalesce(p.value = g.value, false) AS ex, EXISTS (SELECT 1 FROM pred x WHERE x.table_id = g.table_id AND x.section = g.section AND x.age_norm = g.age_norm AND x.value = g.value) AS gen
        FROM truth g LEFT JOIN pred p USING (table_id, section, age_norm, grp, col)) GROUP BY table_id""",
    ),
    ("value_anywhere", value_anywhere, f"{BOTH} SELECT table_id, count(*) AS hits FROM truth WHERE value IN (SELECT value FROM pred WHERE value IS NOT NULL) GROUP BY table_id"),
    ("row_context", row_context, CONTEXT),
    ("score_containment", containment, CONTAIN),
    (
        "relative_error",
        relative_error,
        f"""{BOTH} SELECT section, grp, count(*) AS n, count(*) FILTER (WHERE want = got) AS exact,
        round(coalesce(avg(CASE WHEN want <> got THEN abs(want - got) / greatest(abs(want), 1) END), 0), 6) AS mean_rel
        FROM (SELECT g.section, g.grp, g.value AS want, p.value AS got FROM truth g JOIN pred p USING (table_id, section, age_norm, grp, col) WHERE p.value IS NOT NULL) GROUP BY section, grp""",
    ),
    (
        "score_rollup",
        score_rollup,
        f"""{BOTH} SELECT coalesce(s, '*') AS section, coalesce(g, '*') AS grp, exact, total FROM (SELECT g.section AS s, g.grp AS g, count(*) FILTER (WHERE g.value = p.value) AS exact, count(*) AS total
        FROM truth g LEFT JOIN pred p USING (table_id, section, age_norm, grp, col) GROUP BY ROLLUP (g.section, g.grp))""",
    ),
    (
        "gt_patch",
        gt_patch,
        f"""{BOTH} SELECT table_id, section, age_norm, grp, col, CASE WHEN table_id = 1 AND section = 'A' AND age_norm = '0-5' THEN 1
        WHEN table_id = 2 AND section = 'N' AND age_norm = '5-10' THEN 2 ELSE value END AS value FROM truth WHERE section <> 'ALL'""",
    ),
    (
        "gt_rollup",
        gt_rollup,
        f"""{BOTH} SELECT table_id, section, grp, col, CASE WHEN row_ord <= 4 THEN '0-20' ELSE age_norm END AS age, CAST(sum(value) AS BIGINT) AS value FROM truth WHERE row_ord < 99 GROUP BY ALL""",
    ),
    ("missing_labels", missing_labels, f"{LAB} SELECT * FROM f EXCEPT SELECT * FROM o"),
    ("common_labels", common_labels, f"{LAB} SELECT * FROM f INTERSECT SELECT * FROM o"),
    ("symmetric_labels", symmetric_labels, f"{LAB} SELECT *, 'F' AS side FROM (SELECT * FROM f EXCEPT SELECT * FROM o) UNION ALL SELECT *, 'O' FROM (SELECT * FROM o EXCEPT SELECT * FROM f)"),
    (
        "label_union",
        label_union,
        "SELECT l_partkey, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY o, l_linenumber) AS labels FROM (SELECT l_partkey, l_linenumber, min(l_orderkey) AS o FROM lineitem GROUP BY ALL) GROUP BY l_partkey",
    ),
]
