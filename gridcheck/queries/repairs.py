"""Repair queries over the observed tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcheck.functions.text import CONFUSED
from gridcheck.operators import constraints as c
from gridcheck.operators import repair as r
from gridcheck.operators import solve
from gridcheck.operators import vote
from gridcheck.plans import tables as t
from gridcheck.queries.checks import LONG

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
STEPS = [1, -1, 3, -3, 5, -5, 20, -20, 300, -500, 1000, 12, 0, 2000, 808]


def _targets(spark, d):
    li = t.load(spark, d, "lineitem")
    target = F.element_at(F.array(*[F.lit(s) for s in STEPS]), (F.col("l_orderkey") % len(STEPS) + 1).cast("int")).cast("bigint")
    sign = F.when(F.col("l_linenumber") == 6, -1).otherwise(1)
    return li.select(*LINE, (F.floor("l_extendedprice") * sign).alias("value"), target.alias("target")).distinct()


TARGETS = f"""targets AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(floor(l_extendedprice) AS BIGINT) * CASE WHEN l_linenumber = 6 THEN -1 ELSE 1 END AS value,
  CAST([{', '.join(map(str, STEPS))}][l_orderkey % {len(STEPS)} + 1] AS BIGINT) AS target FROM lineitem)"""
CONF = "confusions AS (SELECT CAST(p[1] AS BIGINT) AS a, CAST(p[2] AS BIGINT) AS b FROM (SELECT unnest([" + ", ".join(f"'{p}'" for p in CONFUSED) + "]) AS p))"
SINGLE = f"""{TARGETS}, {CONF}, digits AS (
  SELECT *, CAST(substr(s, CAST(pos + 1 AS BIGINT), 1) AS BIGINT) AS d, CAST(10 ** (length(s) - 1 - pos) AS BIGINT) AS size
  FROM (SELECT *, unnest(range(length(s))) AS pos FROM (SELECT *, CAST(abs(value) AS VARCHAR) AS s FROM targets))
), single AS (SELECT *, (b - a) * size AS change FROM digits JOIN confusions ON a = d)"""


def digit_fix(spark, d):
    return r.digit_fixes(_targets(spark, d))


def two_digit_fix(spark, d):
    return r.two_digit_fixes(_targets(spark, d), LINE)


def attempt_repair(spark, d):
    return r.balance_rows(t.obs(spark, d)).where("repaired").select(*t.KEYS, "old_persons", "persons")


def _conf(spark, d):
    wide = t.obs(spark, d)
    return wide.withColumns({f"conf_{k}": ((F.col("row_ord") * (i + 2) + F.col("table_id")) % 4) / 4 for i, k in enumerate(t.COLS)})


CONFS = ", ".join(f"((row_ord * {i + 2} + table_id) % 4) / 4 AS conf_{k}" for i, k in enumerate(t.COLS))


def enforce_row(spark, d):
    return r.enforce_rows(_conf(spark, d)).where("field IS NOT NULL").select(*t.KEYS, "field", "old", "new", "label")


def enforce_total(spark, d):
    return r.enforce_totals(c.cells(t.obs(spark, d)), ["table_id", "section", "grp", "col"])


def _failures(spark, d):
    wide = t.obs(spark, d)
    terms = c.vertical(c.cells(wide), c.row_kinds(wide))
    key = terms.select("table_id", "cid", "section", "grp", "col").distinct()
    return c.evaluate(terms).where("NOT passed").join(key, ["table_id", "cid"])


def mf_swap_signature(spark, d):
    return r.swap_signature(_failures(spark, d), ["table_id", "section", "grp"])


L2F = """fail AS (SELECT table_id, section, grp, col, CAST(sum(CASE WHEN row_ord = 99 THEN value ELSE -value END) AS BIGINT) AS diff FROM long
  GROUP BY ALL HAVING count(*) = count(value) AND sum(CASE WHEN row_ord = 99 THEN value ELSE -value END) <> 0)"""


def column_confusion(spark, d):
    """Of a table's two groups, the later copies the earlier in three rows of four for some tables."""
    long = c.cells(t.clean(spark, d)).where("grp <> 'ALL'")
    copied = long.where("grp = 'F'").select("table_id", "section", "row_ord", "col", F.col("value").alias("_f"))
    joined = long.join(copied, ["table_id", "section", "row_ord", "col"], "left")
    value = F.when((F.col("grp") == "O") & (F.col("table_id") % 5 == 1) & (F.col("row_ord") % 4 > 0), F.coalesce("_f", "value")).otherwise(F.col("value"))
    return r.confused_groups(joined.withColumn("value", value), ["table_id", "section"])


CONFUSION = f"""WITH {LONG}, cl AS (SELECT table_id, section, row_ord, grp, unnest(['persons', 'males', 'females']) AS col, unnest([persons, males, females]) AS value FROM clean WHERE grp <> 'ALL'),
m AS (SELECT o.table_id, o.section, o.row_ord, o.col, f.value AS l, CASE WHEN o.table_id % 5 = 1 AND o.row_ord % 4 > 0 THEN f.value ELSE o.value END AS v
  FROM cl o JOIN cl f ON f.table_id = o.table_id AND f.section = o.section AND f.row_ord = o.row_ord AND f.col = o.col AND o.grp = 'O' AND f.grp = 'F')
SELECT table_id, section, 'O' AS grp, 'F' AS left_grp, count(*) AS cells, count(*) FILTER (WHERE l = v) AS equal FROM m GROUP BY table_id, section HAVING 2 * count(*) FILTER (WHERE l = v) > count(*)"""


def cross_group_discrepancy(spark, d):
    return r.discrepancies(c.cells(t.obs(spark, d)), ["table_id", "section", "row_ord", "col"])


def _weighed(spark, d):
    conf = ((F.col("row_ord") * 3 + F.col("table_id") + F.ascii("grp")) % 5) / 4
    return c.cells(t.obs(spark, d)).withColumn("conf", conf)


def reconcile_candidate(spark, d):
    return r.deduced(_weighed(spark, d), ["table_id", "section", "row_ord", "col"])


def reconcile_fixpoint(spark, d):
    """The deductions to a fixed point: equations across groups and, in rows, of persons; a cell that one settles is strong in the other."""
    return solve.reconcile_tables(_weighed(spark, d))


def _chained(spark, d):
    """Clean leaves of the groups F and O, the cell (F, males) off by 5 and weak, and persons of F off by 9 and weak: the males follow from ALL, then the persons from the row."""
    long = c.cells(t.clean(spark, d)).where("section <> 'ALL'")
    both = F.count(F.lit(1)).over(Window.partitionBy("table_id", "section", "row_ord", "col")) == 3
    long = long.withColumn("_both", both).where("_both").drop("_both")
    males, persons = (F.col("grp") == "F") & (F.col("col") == "males"), F.col("col") == "persons"
    value = F.when(males, F.col("value") + 5).when(persons & (F.col("grp") == "F"), F.col("value") + 9).otherwise(F.col("value"))
    return long.withColumn("value", value).withColumn("conf", F.when(males | persons, 0.25).otherwise(1.0))


def reconcile_chain(spark, d):
    """Two rounds are needed: persons of F depend on males that the first round mends."""
    return solve.reconcile_tables(_chained(spark, d), rows=True).where("grp = 'F'").select("table_id", "section", "row_ord", "col", "old", "new")


RECON = f"""WITH {LONG}, w AS (SELECT *, ((row_ord * 3 + table_id + ascii(grp)) % 5) / 4 AS conf, CASE WHEN grp = 'ALL' THEN 1 ELSE -1 END AS k FROM long),
e AS (SELECT *, sum(CASE WHEN conf < 0.75 THEN 1 ELSE 0 END) OVER q AS weak, sum(k * value) OVER q AS total, count(*) OVER q - count(value) OVER q AS gaps
  FROM w WINDOW q AS (PARTITION BY table_id, section, row_ord, col))
SELECT table_id, section, row_ord, col, grp, value AS old, CAST(value - k * total AS BIGINT) AS new FROM e WHERE conf < 0.75 AND weak = 1 AND gaps = 0 AND total <> 0 AND value - k * total >= 0"""


def row_cascade(spark, d):
    wide = t.obs(spark, d)
    changed = F.element_at(F.array(*[F.lit(k) for k in t.COLS]), (F.col("row_ord") % 3 + 1).cast("int"))
    holes = wide.withColumn("females", F.when(F.col("table_id") % 4 != 1, F.col("females"))).withColumn("males", F.when(F.col("table_id") % 4 != 2, F.col("males")))
    return r.cascade(holes.withColumn("changed", changed)).select(*t.KEYS, *[F.coalesce(k, F.lit(-1).cast("bigint")).alias(k) for k in t.COLS])


CASCADE = f"""WITH {t.SQL}, h AS (SELECT table_id, section, row_ord, grp, persons AS p, CASE WHEN table_id % 4 <> 2 THEN males END AS m, CASE WHEN table_id % 4 <> 1 THEN females END AS f,
  ['persons', 'males', 'females'][row_ord % 3 + 1] AS ch FROM obs)
SELECT table_id, section, row_ord, grp, coalesce(CASE WHEN ch <> 'persons' AND m IS NOT NULL AND f IS NOT NULL THEN m + f ELSE p END, -1) AS persons,
  coalesce(CASE WHEN ch = 'persons' AND p IS NOT NULL AND f IS NOT NULL AND m IS NULL AND p >= f THEN p - f ELSE m END, -1) AS males,
  coalesce(CASE WHEN ch = 'persons' AND p IS NOT NULL AND m IS NOT NULL AND f IS NULL AND p >= m THEN p - m ELSE f END, -1) AS females FROM h"""


def truncated_sections(spark, d):
    wide = t.obs(spark, d).where("NOT (section = 'R' AND row_ord BETWEEN 4 AND 7 AND table_id % 3 = 0)")
    long, kinds = c.cells(wide), c.row_kinds(wide)
    terms = c.vertical(long, kinds)
    key = terms.select("table_id", "cid", "section").distinct()
    return r.truncated(kinds, c.evaluate(terms).where("NOT passed").join(key, ["table_id", "cid"]), least=5)


TRUNC = f"""WITH {LONG}, kept AS (SELECT * FROM long WHERE NOT (section = 'R' AND row_ord BETWEEN 4 AND 7 AND table_id % 3 = 0)),
n AS (SELECT table_id, section, count(DISTINCT age_norm) AS n FROM kept WHERE row_ord < 99 GROUP BY ALL), m AS (SELECT *, max(n) OVER (PARTITION BY table_id) AS most FROM n),
{L2F.replace('FROM long', 'FROM kept')}, w AS (SELECT table_id, section, max(abs(diff)) AS worst FROM fail GROUP BY ALL)
SELECT * FROM m JOIN w USING (table_id, section) WHERE n < most - 1 AND worst >= 5"""


CHAIN = f"""WITH {t.SQL}, two AS (SELECT table_id, section, row_ord FROM clean WHERE section <> 'ALL' GROUP BY ALL HAVING count(*) = 3), x AS (SELECT * FROM clean JOIN two USING (table_id, section, row_ord) WHERE grp = 'F')
SELECT table_id, section, row_ord, 'males' AS col, males + 5 AS old, males AS new FROM x UNION ALL SELECT table_id, section, row_ord, 'persons', persons + 9, persons FROM x"""

QUERIES = [
    ("reconcile_chain", reconcile_chain, CHAIN),
    (
        "digit_fix",
        digit_fix,
        f"""WITH {SINGLE} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, value, target, CASE WHEN value >= 0 THEN value + target ELSE value - target END AS fixed
        FROM single WHERE change = target""",
    ),
    (
        "two_digit_fix",
        two_digit_fix,
        f"""WITH {SINGLE} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, value, target, CAST(p1 AS INTEGER) AS p1, CAST(p2 AS INTEGER) AS p2, CASE WHEN value < 0 THEN value - target ELSE value + target END AS fixed
        FROM (SELECT x.l_orderkey, x.l_linenumber, x.l_partkey, x.l_suppkey, x.value, x.target, x.pos AS p1, y.pos AS p2, row_number() OVER (PARTITION BY x.l_orderkey, x.l_linenumber, x.l_partkey, x.l_suppkey, x.value ORDER BY x.pos, x.b, y.pos, y.b) AS n
          FROM single x JOIN single y ON x.l_orderkey = y.l_orderkey AND x.l_linenumber = y.l_linenumber AND x.l_partkey = y.l_partkey AND x.l_suppkey = y.l_suppkey AND x.value = y.value AND x.pos < y.pos AND y.change = x.target - x.change) WHERE n = 1""",
    ),
    (
        "attempt_repair",
        attempt_repair,
        f"WITH {t.SQL} SELECT table_id, section, row_ord, grp, persons AS old_persons, males + females AS persons FROM obs WHERE persons <> males + females",
    ),
    (
        "enforce_row",
        enforce_row,
        f"""WITH {t.SQL}, a AS (SELECT table_id, section, row_ord, grp, abs(persons) AS p, abs(males) AS m, abs(females) AS f, {CONFS} FROM obs),
        o AS (SELECT *, unnest([1, 2, 3]) AS k FROM a WHERE p <> m + f),
        q AS (SELECT *, CASE k WHEN 1 THEN 'persons' WHEN 2 THEN 'males' ELSE 'females' END AS field, CASE k WHEN 1 THEN p WHEN 2 THEN m ELSE f END AS old,
          CASE k WHEN 1 THEN m + f WHEN 2 THEN p - f ELSE p - m END AS new, CASE k WHEN 1 THEN conf_persons WHEN 2 THEN conf_males ELSE conf_females END AS cf FROM o)
        SELECT table_id, section, row_ord, grp, field, old, new, CASE WHEN abs(new - old) / greatest(abs(old), 1) < 0.001 THEN 'high' WHEN abs(new - old) / greatest(abs(old), 1) < 0.01 THEN 'medium' ELSE 'low' END AS label
        FROM q WHERE new >= 0 QUALIFY row_number() OVER (PARTITION BY table_id, section, row_ord, grp ORDER BY cf DESC, k) = 1""",
    ),
    (
        "enforce_total",
        enforce_total,
        f"""WITH {LONG}, s AS (SELECT table_id, section, grp, col, max(CASE WHEN row_ord = 99 THEN value END) AS old, CAST(sum(CASE WHEN row_ord < 99 THEN value END) AS BIGINT) AS new
          FROM long GROUP BY ALL HAVING count(CASE WHEN row_ord < 99 AND value IS NULL THEN 1 END) = 0)
        SELECT *, CASE WHEN abs(old - new) / greatest(abs(new), 1) < 0.001 THEN 'high' WHEN abs(old - new) / greatest(abs(new), 1) < 0.01 THEN 'medium' ELSE 'low' END AS label,
          abs(old - new) / greatest(abs(new), 1) < 0.01 AS corrected FROM s WHERE old <> new""",
    ),
    (
        "mf_swap_signature",
        mf_swap_signature,
        f"""WITH {LONG}, {L2F} SELECT * FROM (SELECT table_id, section, grp, max(CASE WHEN col = 'males' THEN diff END) AS d_males, max(CASE WHEN col = 'females' THEN diff END) AS d_females FROM fail GROUP BY ALL)
        WHERE d_males + d_females = 0 AND d_males <> 0""",
    ),
    ("column_confusion", column_confusion, CONFUSION),
    (
        "cross_group_discrepancy",
        cross_group_discrepancy,
        f"""WITH {LONG} SELECT *, total - parts AS diff FROM (SELECT table_id, section, row_ord, col, max(CASE WHEN grp = 'ALL' THEN value END) AS total, CAST(sum(CASE WHEN grp <> 'ALL' THEN value END) AS BIGINT) AS parts
        FROM long GROUP BY ALL HAVING count(*) = count(value)) WHERE total <> parts""",
    ),
    ("reconcile_candidate", reconcile_candidate, RECON),
    ("reconcile_fixpoint", reconcile_fixpoint, RECON),
    ("row_cascade", row_cascade, CASCADE),
    ("truncated_sections", truncated_sections, TRUNC),
]
