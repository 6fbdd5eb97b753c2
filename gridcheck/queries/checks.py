"""Constraint queries: derive, verify, summarise, blame."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcheck.operators import constraints as c
from gridcheck.plans import tables as t

LONG = f"""{t.SQL}, long AS (
  SELECT table_id, section, age, CASE WHEN row_ord = 99 THEN 'total' ELSE age END AS age_norm, row_ord, grp, 'persons' AS col, persons AS value FROM obs
  UNION ALL SELECT table_id, section, age, CASE WHEN row_ord = 99 THEN 'total' ELSE age END, row_ord, grp, 'males', males FROM obs
  UNION ALL SELECT table_id, section, age, CASE WHEN row_ord = 99 THEN 'total' ELSE age END, row_ord, grp, 'females', females FROM obs
)"""
L1 = """SELECT table_id, concat_ws('|', 'L1', section, row_ord, grp) AS cid, 'L1' AS level, persons - males - females AS diff,
  persons = males + females AS passed FROM obs WHERE persons IS NOT NULL AND males IS NOT NULL AND females IS NOT NULL"""
L5 = """SELECT table_id, concat_ws('|', 'L5', section, row_ord, grp, col) AS cid, 'L5' AS level, value AS diff, value >= 0 AS passed
  FROM long WHERE value IS NOT NULL"""
L2 = """SELECT table_id, concat_ws('|', 'L2', section, grp, col) AS cid, 'L2' AS level,
  CAST(sum(CASE WHEN row_ord = 99 THEN value ELSE -value END) AS BIGINT) AS diff,
  sum(CASE WHEN row_ord = 99 THEN value ELSE -value END) = 0 AS passed
  FROM long GROUP BY table_id, section, grp, col HAVING count(*) = count(value) AND max(row_ord) = 99 AND count(*) > 1"""
ON3 = """on3 AS (
  SELECT table_id FROM (
    SELECT table_id, section, col, max(CASE WHEN grp = 'ALL' THEN value END) AS v, sum(CASE WHEN grp <> 'ALL' THEN value END) AS s
    FROM long WHERE row_ord = 99 GROUP BY table_id, section, col
    HAVING count(*) = count(value) AND count(CASE WHEN grp = 'ALL' THEN 1 END) > 0 AND count(CASE WHEN grp <> 'ALL' THEN 1 END) > 0)
  GROUP BY table_id HAVING count(*) = count(CASE WHEN abs(v - s) <= greatest(v * 0.001, 10.0) THEN 1 END)
    AND 4 * count(CASE WHEN v = s THEN 1 END) >= 3 * count(*)
)"""
ON4 = ON3.replace("on3", "on4").replace("section, col", "grp, col").replace("grp = 'ALL'", "section = 'ALL'").replace("grp <> 'ALL'", "section <> 'ALL'")
L3 = """SELECT table_id, concat_ws('|', 'L3', section, row_ord, col) AS cid, 'L3' AS level,
  CAST(sum(CASE WHEN grp = 'ALL' THEN value ELSE -value END) AS BIGINT) AS diff, sum(CASE WHEN grp = 'ALL' THEN value ELSE -value END) = 0 AS passed
  FROM long WHERE table_id IN (SELECT table_id FROM on3) GROUP BY table_id, section, row_ord, col HAVING count(*) = count(value)"""
L4 = """SELECT table_id, concat_ws('|', 'L4', age_norm, grp, col) AS cid, 'L4' AS level,
  CAST(sum(CASE WHEN section = 'ALL' THEN value ELSE -value END) AS BIGINT) AS diff, sum(CASE WHEN section = 'ALL' THEN value ELSE -value END) = 0 AS passed
  FROM long WHERE table_id IN (SELECT table_id FROM on4) GROUP BY table_id, age_norm, grp, col HAVING count(*) = count(value)"""
ALL = f"WITH {LONG}, {ON3}, {ON4}, checks AS ({L1} UNION ALL {L5} UNION ALL {L2} UNION ALL {L3} UNION ALL {L4})"


def cells(spark, d):
    return c.cells(t.obs(spark, d), drop_nulls=True).select(*c.CELL, "age_norm", "value")


def filled(spark, d):
    return c.with_persons(t.obs(spark, d)).select(*t.KEYS, *t.COLS)


def verify_l1(spark, d):
    return c.evaluate(c.row_balance(c.cells(t.obs(spark, d))))


def verify_l2(spark, d):
    wide = t.obs(spark, d)
    return c.evaluate(c.vertical(c.cells(wide), c.row_kinds(wide)))


def verify_l3(spark, d):
    return c.evaluate(c.cross_group(c.cells(t.obs(spark, d))))


def verify_l4(spark, d):
    return c.evaluate(c.cross_section(c.cells(t.obs(spark, d))))


def verify_l5(spark, d):
    return c.evaluate(c.non_negative(c.cells(t.obs(spark, d))))


def verify_incidence(spark, d):
    return c.evaluate(c.incidence(t.obs(spark, d)))


def verify_summary(spark, d):
    """Checks by table and level; -1 and ALL name the subtotals."""
    rolled = c.summary(c.evaluate(c.incidence(t.obs(spark, d))))
    return rolled.withColumns({"table_id": F.coalesce("table_id", F.lit(-1).cast("bigint")), "level": F.coalesce("level", F.lit("ALL"))})


def _ranges(spark, d):
    """Sections of range labels: part sizes as single years, and five-year and wider rows after them."""
    p = t.load(spark, d, "part")
    n = F.col("p_partkey") % 24
    five = F.expr("int(n div 6) * 5")
    last = (n % 6) == 5
    lo = F.when(last, five).otherwise(five + n % 6)
    hi = F.when(last, five + 5).otherwise(five + n % 6 + 1 + F.when((F.col("p_size") % 9 == 0) & (n % 6 == 2), 1).otherwise(0))
    rows = p.withColumn("n", n)
    return rows.select(
        F.expr("p_partkey div 24").alias("section"), F.col("n").cast("int").alias("row_ord"), F.concat_ws("-", lo.cast("string"), hi.cast("string")).alias("age_norm")
    )


def subtotal_tiling(spark, d):
    out = c.subtotal_tiling(_ranges(spark, d), ["section"])
    return out.select("section", "row_ord", "age_norm", F.array_join("components", ",").alias("components"))


RANGES = """ranges AS (
  SELECT p_partkey // 24 AS section, CAST(n AS INTEGER) AS row_ord, CASE WHEN n % 6 = 5 THEN n // 6 * 5 ELSE n // 6 * 5 + n % 6 END AS lo,
    CASE WHEN n % 6 = 5 THEN n // 6 * 5 + 5 ELSE n // 6 * 5 + n % 6 + 1 + CASE WHEN p_size % 9 = 0 AND n % 6 = 2 THEN 1 ELSE 0 END END AS hi
  FROM (SELECT *, p_partkey % 24 AS n FROM part)
)"""
TILING = f"""WITH RECURSIVE {RANGES}, walk AS (
  SELECT section, row_ord, lo AS lo0, hi AS hi0, row_ord AS at, hi AS need, 0 AS n, '' AS names FROM ranges WHERE hi - lo > 1
  UNION ALL
  SELECT w.section, w.row_ord, w.lo0, w.hi0, r.row_ord, r.lo, w.n + 1, r.lo || '-' || r.hi || CASE WHEN w.n > 0 THEN ',' ELSE '' END || w.names
  FROM walk w JOIN ranges r ON r.section = w.section AND r.row_ord = w.at - 1 AND r.hi = w.need
  WHERE NOT (w.need = w.lo0 AND w.n >= 2)
)
SELECT section, row_ord, lo0 || '-' || hi0 AS age_norm, names AS components FROM walk WHERE need = lo0 AND n >= 2"""


def known_totals(spark, d):
    """Totals that are known from elsewhere, as constraints among all others."""
    wide = t.obs(spark, d).where("grp = 'ALL' AND section = 'ALL'")
    known = c.cells(t.clean(spark, d)).where("grp = 'ALL' AND section = 'ALL' AND table_id = 1").select("age_norm", "col", F.col("value").alias("expected"))
    return c.evaluate(c.incidence(wide, known=known)).where("level = 'KT'").select("table_id", "cid", "diff", "passed")


def strict_rows(spark, d):
    """Rows that every section must show; a missing one is a failure."""
    leaf = t.obs(spark, d).where("grp <> 'ALL' AND (table_id + row_ord) % 11 <> 0")
    return c.required_rows(leaf, ["0-5", "5-10", "30-35", "total"], ["table_id", "section"])


def blame_rank(spark, d):
    terms = c.incidence(t.obs(spark, d))
    scored = c.blame(terms, c.evaluate(terms))
    best = Window.partitionBy("table_id").orderBy(F.desc("score"), "section", "row_ord", "grp", "col")
    return scored.withColumn("rank", F.row_number().over(best))


BLAME = f"""{ALL}, bad AS (SELECT table_id, cid FROM checks WHERE NOT passed), terms AS (
  SELECT *, concat_ws('|', 'L1', section, row_ord, grp) AS cid FROM long
  UNION ALL SELECT *, concat_ws('|', 'L5', section, row_ord, grp, col) FROM long
  UNION ALL SELECT *, concat_ws('|', 'L2', section, grp, col) FROM long
  UNION ALL SELECT *, concat_ws('|', 'L3', section, row_ord, col) FROM long
  UNION ALL SELECT *, concat_ws('|', 'L4', age_norm, grp, col) FROM long
), scored AS (
  SELECT table_id, section, row_ord, grp, col, count(*) AS score FROM terms JOIN bad USING (table_id, cid) GROUP BY ALL
)
SELECT *, CAST(row_number() OVER (PARTITION BY table_id ORDER BY score DESC, section, row_ord, grp, col) AS INTEGER) AS rank FROM scored"""


def topk_triples(spark, d):
    """The first ten (section, row, group) of each table to look at again, by their best blame."""
    ranked = blame_rank(spark, d).groupBy("table_id", "section", "row_ord", "grp").agg(F.min("rank").alias("rank"))
    best = Window.partitionBy("table_id").orderBy("rank")
    return ranked.withColumn("nth", F.row_number().over(best)).where("nth <= 10")


QUERIES = [
    ("cells_long", cells, f"WITH {LONG} SELECT table_id, section, row_ord, grp, col, age_norm, value FROM long WHERE value IS NOT NULL"),
    ("persons_filled", filled, f"WITH {t.SQL} SELECT table_id, section, row_ord, grp, coalesce(persons, males + females) AS persons, males, females FROM obs"),
    ("verify_l1", verify_l1, f"WITH {LONG} {L1}"),
    ("verify_l2", verify_l2, f"WITH {LONG} {L2}"),
    ("verify_l3", verify_l3, f"WITH {LONG}, {ON3} {L3}"),
    ("verify_l4", verify_l4, f"WITH {LONG}, {ON4} {L4}"),
    ("verify_l5", verify_l5, f"WITH {LONG} {L5}"),
    ("verify_incidence", verify_incidence, f"{ALL} SELECT * FROM checks"),
    (
        "verify_summary",
        verify_summary,
        f"""{ALL} SELECT coalesce(table_id, -1) AS table_id, coalesce(level, 'ALL') AS level, count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed,
        count(*) FILTER (WHERE NOT passed) AS failed, bool_and(passed) AS all_passed FROM checks GROUP BY ROLLUP (checks.table_id, checks.level)""",
    ),
    ("subtotal_tiling", subtotal_tiling, TILING),
    (
        "known_totals",
        known_totals,
        f"""WITH {LONG}, want AS (SELECT row_ord, 'persons' AS col, persons AS v FROM clean WHERE grp = 'ALL' AND section = 'ALL' AND table_id = 1
          UNION ALL SELECT row_ord, 'males', males FROM clean WHERE grp = 'ALL' AND section = 'ALL' AND table_id = 1
          UNION ALL SELECT row_ord, 'females', females FROM clean WHERE grp = 'ALL' AND section = 'ALL' AND table_id = 1)
        SELECT table_id, concat_ws('|', 'KT', section, row_ord, grp, col) AS cid, value - v AS diff, value = v AS passed
        FROM long JOIN want USING (row_ord, col) WHERE grp = 'ALL' AND section = 'ALL' AND value IS NOT NULL""",
    ),
    (
        "strict_rows",
        strict_rows,
        f"""WITH {t.SQL}, have AS (SELECT DISTINCT table_id, section, CASE WHEN row_ord = 99 THEN 'total' ELSE age END AS age_norm
          FROM obs WHERE grp <> 'ALL' AND (table_id + row_ord) % 11 <> 0), asked AS (
          SELECT DISTINCT table_id, section, unnest(['0-5', '5-10', '30-35', 'total']) AS age_norm FROM have)
        SELECT a.*, h.age_norm IS NOT NULL AS present FROM asked a LEFT JOIN have h USING (table_id, section, age_norm)""",
    ),
    ("blame_rank", blame_rank, BLAME),
    (
        "topk_triples",
        topk_triples,
        f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY table_id ORDER BY rank) AS INTEGER) AS nth FROM (
          SELECT table_id, section, row_ord, grp, min(rank) AS rank FROM ({BLAME}) GROUP BY ALL)) WHERE nth <= 10""",
    ),
]
