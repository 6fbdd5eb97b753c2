"""Queries whose answer is known beforehand: sheets of ground truth, planted
errors with the clean tables as their repair, sections with Grand Totals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcheck.functions import text
from gridcheck.operators import constraints as c
from gridcheck.operators import repair as r
from gridcheck.operators import score as s
from gridcheck.operators import solve, vote
from gridcheck.plans import tables as t
from gridcheck.queries.checks import LONG, ON3, ON4
from gridcheck.sources import ground_truth

# --- sheets --------------------------------------------------------------------------------


def _grid(spark, d):
    """A sheet for each table: the groups F and O side by side, every second sheet without sub-headers, 3-5 as a date."""
    w = t.obs(spark, d).where("grp <> 'ALL'").groupBy("table_id", "section", "row_ord", "age").pivot("grp", ["F", "O"]).agg(*[F.max(k).alias(k) for k in t.COLS])
    number = lambda k: F.coalesce(F.when(F.col("row_ord") % 2 == 0, F.concat(F.col(k).cast("string"), F.lit(".0"))).otherwise(F.col(k).cast("string")), F.lit(""))
    age = F.when(F.col("row_ord") == 1, F.lit("1901-03-05 00:00:00")).otherwise(F.col("age"))
    block = lambda g: [F.lit(""), F.col("section"), age, *[number(f"{g}_{k}") for k in t.COLS]]
    order = Window.partitionBy("table_id").orderBy("section", "row_ord")
    body = w.select(F.col("table_id").alias("sheet"), (F.row_number().over(order) + 2).alias("row_no"), F.array(*block("F"), *block("O")).alias("cells"))
    sheets = w.select(F.col("table_id").alias("sheet")).distinct()
    names = sheets.select("sheet", F.lit(1).alias("row_no"), F.array(*[F.lit({0: "F", 6: "O"}.get(k, "")) for k in range(12)]).alias("cells"))
    heads = ["", "District", "Age", "Persons", "Males", "Females"] * 2
    fields = sheets.where("sheet % 2 = 0").select("sheet", F.lit(2).alias("row_no"), F.array(*[F.lit(h) for h in heads]).alias("cells"))
    return names.unionByName(fields).unionByName(body)


def ground_truth_groups(spark, d):
    return ground_truth.read_groups(_grid(spark, d)).select("sheet", "grp", "district", "age_norm", *t.COLS)


def ground_truth_single(spark, d):
    return ground_truth.read_single(_grid(spark, d), "N").select("sheet", "age", *t.COLS)


def ground_truth_wide(spark, d):
    """Three conditions side by side in the fixed columns of the wide layout."""
    w = t.obs(spark, d).where("grp = 'ALL' AND section <> 'ALL'").groupBy("table_id", "row_ord", "age").pivot("section", ["A", "N", "R"]).agg(*[F.max(k).alias(k) for k in ("males", "females")])
    at = {8: F.lit("East"), 9: F.col("age")} | {k + i: F.col(f"{x}_{col}").cast("string") for x, k in zip("ANR", (11, 17, 23), strict=True) for i, col in enumerate(("males", "females"))}
    cells = F.array(*[at.get(k, F.lit("")) for k in range(1, 25)])
    grid = w.select(F.col("table_id").alias("sheet"), (F.col("row_ord") + 2).alias("row_no"), cells.alias("cells"))
    return ground_truth.read_wide(grid).select("sheet", "district", "age", "condition", "males", "females")


_AGE = "CASE WHEN row_ord = 1 THEN '3-5' WHEN row_ord = 99 THEN '{total}' ELSE age END"

# --- planted errors ------------------------------------------------------------------------

#: A digit for each digit, of the pairs that scans confuse.
OTHER = [8, 7, 7, 8, 9, 8, 8, 1, 3, 4]


def _planted(spark, d):
    """The clean tables, each with one error: by table_id % 5 a digit, a digit and its neighbour, a swap, a sign, two digits of two cells."""
    other = lambda x, unit: (F.get(F.array(*[F.lit(o) for o in OTHER]), (F.floor(x / unit) % 10).cast("int")) - F.floor(x / unit) % 10) * unit
    at = F.expr("section = ['A', 'N', 'R'][table_id % 3] AND row_ord = 2 + table_id % 4 AND grp = 'F'".replace("['A', 'N', 'R'][table_id % 3]", "element_at(array('A', 'N', 'R'), int(table_id % 3) + 1)"))
    m, f, k = F.col("males"), F.col("females"), F.col("table_id") % 5
    new_m = F.when(k == 0, m + other(m, 1)).when(k == 1, m + other(m, 1) + other(m, 10)).when(k == 2, f).when(k == 3, -m).otherwise(m + other(m, 1))
    new_f = F.when(k == 2, m).when(k == 4, f + other(f, 1)).otherwise(f)
    return t.clean(spark, d).withColumns({"males": F.when(at & (m >= 10), new_m).otherwise(m), "females": F.when(at & (m >= 10), new_f).otherwise(f)})


def solver_repair(spark, d):
    """Every planted error is found and undone: what the repairs leave differs nowhere from the clean tables."""
    log = solve.repair_tables(c.incidence(_planted(spark, d))).where("action <> 'none'")
    ends = log.groupBy("table_id", "section", "row_ord", "grp", "col").agg(F.min_by("old", "step").alias("old"), F.max_by("new", "step").alias("new"))
    return ends.where("old <> new")


def _other_sql(x: str, unit: int) -> str:
    return f"({OTHER}[{x} // {unit} % 10 + 1] - {x} // {unit} % 10) * {unit}"


PLANTED = f"""{t.SQL}, hit AS (
  SELECT *, table_id % 5 AS k FROM clean WHERE section = ['A', 'N', 'R'][table_id % 3 + 1] AND row_ord = 2 + table_id % 4 AND grp = 'F' AND males >= 10
), planted AS (
  SELECT table_id, section, row_ord, grp, 'males' AS col, CAST(CASE k WHEN 0 THEN males + {_other_sql('males', 1)} WHEN 1 THEN males + {_other_sql('males', 1)} + {_other_sql('males', 10)}
    WHEN 2 THEN females WHEN 3 THEN -males ELSE males + {_other_sql('males', 1)} END AS BIGINT) AS old, males AS new FROM hit
  UNION ALL
  SELECT table_id, section, row_ord, grp, 'females', CAST(CASE k WHEN 2 THEN males ELSE females + {_other_sql('females', 1)} END AS BIGINT), females FROM hit WHERE k IN (2, 4)
) SELECT * FROM planted WHERE old <> new"""


def ensemble_solve(spark, d):
    """Five readings of the group F of each section: most cells are read alike, one column misses its sum by what two readings agree on; votes and sums restore the clean values."""
    truth = c.cells(t.clean(spark, d)).where("section <> 'ALL' AND grp = 'F'")
    reads = truth.withColumn("reading", F.explode(F.sequence(F.lit(1), F.lit(5))))
    wrong = (F.col("row_ord") == F.col("table_id") % 7 + 1) & (F.col("reading") <= 3) & (F.col("col") == "males")
    value = F.when(wrong, F.col("value") + 7).otherwise(F.col("value"))
    key = ["table_id", "section", "grp", "age_norm", "row_ord", "col"]
    return solve.ensemble_tables(vote.histogram(reads.withColumn("value", value), key), 5).select("table_id", "section", "grp", "age_norm", "col", "value")


def reverify(spark, d):
    """The constraints of the observed tables, held against the clean ones."""
    terms = c.incidence(t.obs(spark, d))
    return c.reevaluate(c.cells(t.clean(spark, d)), terms).groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("passed"))


REVERIFY = f"""WITH {LONG}, {ON3}, {ON4}, n AS (
  SELECT 'L1' AS level, count(*) AS n FROM obs UNION ALL SELECT 'L5', count(value) FROM long
  UNION ALL SELECT 'L2', count(*) FROM (SELECT table_id, section, grp FROM obs GROUP BY ALL HAVING max(row_ord) = 99 AND count(*) > 1), range(3)
  UNION ALL SELECT 'L3', count(*) FROM (SELECT DISTINCT table_id, section, row_ord, col FROM long WHERE table_id IN (SELECT table_id FROM on3))
  UNION ALL SELECT 'L4', count(*) FROM (SELECT DISTINCT table_id, age_norm, grp, col FROM long WHERE table_id IN (SELECT table_id FROM on4)))
SELECT level, n, n AS passed FROM n WHERE n > 0"""

# --- sections with subtotals and a Grand Total ---------------------------------------------


def _grand(spark, d):
    """Per section: leaves, 0-10 after its two parts, Total, a row after it, Grand Total; some subtotals and Grand Totals are off."""
    w = t.clean(spark, d).where("grp = 'F' AND section <> 'ALL'")
    at = F.when(F.col("row_ord") == 99, 50).when(F.col("row_ord") <= 2, F.col("row_ord")).otherwise(F.col("row_ord") + 1)
    base = w.select("table_id", "section", "age", at.cast("int").alias("row_ord"), "grp", *t.COLS)
    fold = lambda rows, age, n, plus: rows.groupBy("table_id", "section", "grp").agg(*[F.sum(k).alias(k) for k in t.COLS]).select(
        "table_id", "section", F.lit(age).alias("age"), F.lit(n).alias("row_ord"), "grp", *[(F.col(k) + plus).alias(k) for k in t.COLS]
    )
    both = base.where("row_ord <= 2").withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("table_id", "section"))).where("_n = 2").drop("_n")
    ten = fold(both, "0-10", 3, F.when(F.col("table_id") % 4 == 1, 2).otherwise(0))
    rest = base.where("row_ord = 50").select("table_id", "section", F.lit("Not stated").alias("age"), F.lit(51).alias("row_ord"), "grp", *[(F.col(k) % 7).alias(k) for k in t.COLS])
    grand = fold(base.where("row_ord = 50").unionByName(rest), "Grand Total", 52, F.when(F.col("table_id") % 3 == 0, 1).otherwise(0))
    return base.unionByName(ten).unionByName(rest).unionByName(grand)


def grand_totals(spark, d):
    checks = c.evaluate(c.incidence(_grand(spark, d))).where("level IN ('L2', 'L2S')")
    return checks.select("table_id", "cid", "level", "diff", "passed")


GRAND = f"""WITH {t.SQL}, w AS (SELECT table_id, section, row_ord, unnest(['persons', 'males', 'females']) AS col, unnest([persons, males, females]) AS v FROM clean WHERE grp = 'F' AND section <> 'ALL'),
two AS (SELECT table_id, section, col FROM w WHERE row_ord <= 2 GROUP BY ALL HAVING count(*) = 2)
SELECT table_id, concat_ws('|', 'L2', section, 'F', col) AS cid, 'L2' AS level, CAST(sum(CASE WHEN row_ord = 99 THEN v ELSE -v END) AS BIGINT) AS diff, sum(CASE WHEN row_ord = 99 THEN v ELSE -v END) = 0 AS passed
FROM w GROUP BY table_id, section, col
UNION ALL SELECT table_id, concat_ws('|', 'L2S', section, 'F', col, '0-10'), 'L2S', CASE WHEN table_id % 4 = 1 THEN 2 ELSE 0 END, table_id % 4 <> 1 FROM two
UNION ALL SELECT table_id, concat_ws('|', 'L2S', section, 'F', col, 'grandtotal'), 'L2S', CASE WHEN table_id % 3 = 0 THEN 1 ELSE 0 END, table_id % 3 <> 0 FROM w WHERE row_ord = 99"""


def _shares(spark, d):
    """Shares per 1000 of order priorities by status, and the printed 1000: a proportional table."""
    o = t.load(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy("o_orderstatus"))
    age = F.substring("o_orderpriority", 1, 1)
    share = o.select(F.lit(0).cast("bigint").alias("table_id"), F.col("o_orderstatus").alias("section"), age.alias("age"), age.cast("int").alias("row_ord"), F.floor(F.col("n") * 1000 / whole + 0.5).cast("bigint").alias("persons"))
    total = share.select("table_id", "section", F.lit("Total").alias("age"), F.lit(99).alias("row_ord"), F.lit(1000).cast("bigint").alias("persons")).distinct()
    return share.unionByName(total).select("table_id", "section", "age", "row_ord", F.lit("g").alias("grp"), "persons", F.lit(None).cast("bigint").alias("males"), F.lit(None).cast("bigint").alias("females"))


def proportional_tolerance(spark, d):
    """Rounded shares may miss the printed 1000 by two for each of their rows."""
    wide = _shares(spark, d)
    return c.evaluate(c.vertical(c.cells(wide), c.row_kinds(wide), proportional=True)).select("cid", "diff", "passed")


PROPORTIONAL = """WITH n AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
s AS (SELECT o_orderstatus, CAST(floor(n * 1000 / sum(n) OVER (PARTITION BY o_orderstatus) + 0.5) AS BIGINT) AS share FROM n)
SELECT 'L2|' || o_orderstatus || '|g|persons' AS cid, CAST(1000 - sum(share) AS BIGINT) AS diff, abs(sum(share) - 1000) <= 2 * count(*) AS passed FROM s GROUP BY o_orderstatus"""


def structural_sections(spark, d):
    """Sections of which the tables of some numbers were read a column too far: males hold persons, and the total row ten times its value."""
    far = F.col("table_id") % 5 == 2
    wide = t.clean(spark, d).where("grp <> 'ALL' AND section <> 'ALL'")
    seen = c.cells(wide.withColumns({"males": F.when(far, F.col("persons") * 3).otherwise(F.col("males")), "females": F.when(far & (F.col("row_ord") > 1), F.col("persons") * 5).otherwise(F.col("females"))}))
    truth = c.cells(wide).select(*c.CELL, F.col("value").alias("_t"))
    bad = seen.join(truth, c.CELL).where("value <> _t").withColumn("diff", F.col("value") - F.col("_t"))
    return r.structural(bad)


STRUCTURAL = f"""WITH {t.SQL}, w AS (SELECT * FROM clean WHERE grp <> 'ALL' AND section <> 'ALL' AND table_id % 5 = 2),
b AS (SELECT table_id, section, persons * 3 AS v, males AS t FROM w UNION ALL SELECT table_id, section, persons * 5, females FROM w WHERE row_ord > 1)
SELECT table_id, section, count(*) AS n, count(*) FILTER (WHERE abs(v - t) * 2 > abs(v)) AS huge FROM b WHERE v <> t GROUP BY ALL HAVING count(*) >= 10 AND count(*) FILTER (WHERE abs(v - t) * 2 > abs(v)) >= count(*) // 2"""


def column_numbers(spark, d):
    """Rows that number the columns, told from rows of data."""
    o = t.load(spark, d, "orders")
    k = (F.col("o_orderkey") % 7).cast("int")
    cells = F.when(F.col("o_orderkey") % 3 == 0, F.transform(F.sequence(F.lit(1), k + 2), lambda x: x.cast("string"))).otherwise(
        F.transform(F.sequence(F.lit(0), k), lambda x: F.when(x % 2 == 0, F.col("o_custkey").cast("string")).otherwise(F.lit("12")))
    )
    return o.select("o_orderkey", text.is_number_row(cells).alias("numbers"))


def readings_concat(spark, d):
    """The readings of three passes one after the other, each cell with the pass that it comes from."""
    wide = t.obs(spark, d)
    passes = [c.cells(wide.where(F.col("table_id") % 3 >= k)).select(*c.CELL, "value").withColumn("pass", F.lit(k)) for k in range(3)]
    return passes[0].unionByName(passes[1]).unionByName(passes[2])


def group_filter(spark, d):
    """The first group of a fuzzy name, the section by place, brackets without totals."""
    p = t.load(spark, d, "part").select("p_size", "p_partkey", F.when(F.col("p_partkey") % 6 == 0, F.concat(F.lit("Total "), F.col("p_type"))).otherwise(F.concat(F.initcap("p_type"), F.lit(". "))).alias("name"))
    place = F.row_number().over(Window.partitionBy("p_size").orderBy("p_partkey"))
    cleaned = p.withColumn("clean", F.lower(F.expr("trim(BOTH '. ' FROM name)"))).withColumn("place", place)
    return cleaned.where("NOT startswith(clean, 'total')").where("place <= 5").select("p_size", "clean", "place")


def check_columns(spark, d):
    """The check columns of a sheet: each row's balance, and per section the sum of the leaves against the printed Total, as marks or differences."""
    wide = t.obs(spark, d)
    off = F.col("persons") - F.col("males") - F.col("females")
    mark = lambda x: F.when(x == 0, "✓").when(x.isNotNull(), F.concat(F.lit("✗ "), x.cast("string"))).otherwise("")
    rows = wide.select(*t.KEYS, *t.COLS, mark(off).alias("check_row"))
    whole = Window.partitionBy("table_id", "section", "grp")
    sums = {f"sum_{k}": F.sum(F.when(F.col("row_ord") < 99, F.col(k))).over(whole) for k in t.COLS}
    last = F.col("row_ord") == 99
    return rows.withColumns(sums).withColumns({f"check_{k}": F.when(last, mark(F.col(k) - F.col(f"sum_{k}"))) for k in t.COLS}).drop(*sums)


_mark = lambda x: f"CASE WHEN {x} = 0 THEN '✓' WHEN {x} IS NOT NULL THEN '✗ ' || CAST({x} AS VARCHAR) ELSE '' END"
CHECKS = f"""WITH {t.SQL}, s AS (SELECT *, {', '.join(f"CAST(sum(CASE WHEN row_ord < 99 THEN {k} END) OVER (PARTITION BY table_id, section, grp) AS BIGINT) AS s_{k}" for k in t.COLS)} FROM obs)
SELECT table_id, section, row_ord, grp, persons, males, females, {_mark('(persons - males - females)')} AS check_row,
  {', '.join(f"CASE WHEN row_ord = 99 THEN {_mark(f'({k} - s_{k})')} END AS check_{k}" for k in t.COLS)} FROM s"""


def province_score(spark, d):
    """The province scorer in one: pages merged, the last of a cell winning, names matched, cells scored by truth."""
    from gridcheck.operators import merge

    truth = c.cells(t.clean(spark, d)).where("grp = 'F' AND section <> 'ALL'")
    pages = c.cells(t.obs(spark, d)).where("grp = 'F' AND section <> 'ALL'")
    first = pages.withColumn("value", F.col("value") + 1).withColumn("page_no", F.lit(1)).where("row_ord <= 4")
    both = first.unionByName(pages.withColumn("page_no", F.lit(2)).where("row_ord >= 3"))
    named = merge.merge_pages(both, ["table_id", "section", "row_ord", "grp", "col"]).withColumn("district", F.concat(F.lower("section"), F.lit("rea district")))
    names = merge.match_districts(
        named.select("table_id", F.col("district").alias("name")).distinct(), truth.select("table_id", F.concat(F.col("section"), F.lit("REA")).alias("name")).distinct(), ["table_id"]
    )
    found = named.join(names.select("table_id", F.col("name").alias("district"), "match"), ["table_id", "district"]).withColumn("section", F.substring("match", 1, 1))
    key = ["table_id", "section", "age_norm", "grp", "col"]
    return s.accuracy(s.on_truth(found.select(*key, "row_ord", "value"), truth.select(*key, "row_ord", "value"), key), ["table_id"])


PROVINCE = f"""WITH {LONG}, {LONG[LONG.index('long AS'):].replace('long AS', 'true_ AS').replace('FROM obs', 'FROM clean')},
x AS (SELECT g.table_id, g.value AS want, CASE WHEN o.row_ord >= 3 THEN o.value ELSE o.value + 1 END AS got FROM true_ g
  LEFT JOIN long o USING (table_id, section, row_ord, grp, col) WHERE g.grp = 'F' AND g.section <> 'ALL')
SELECT table_id, count(*) FILTER (WHERE want = got) AS exact, count(*) AS total, round(count(*) FILTER (WHERE want = got) / count(*), 6) AS rate,
  round(coalesce(avg(CASE WHEN want IS DISTINCT FROM got THEN abs(want - coalesce(got, 0)) END), 0), 4) AS mae FROM x GROUP BY table_id"""

QUERIES = [
    (
        "ground_truth_groups",
        ground_truth_groups,
        f"""WITH {t.SQL} SELECT table_id AS sheet, grp, section AS district, {_AGE.format(total='total')} AS age_norm, persons, males, females FROM obs
        WHERE grp <> 'ALL' AND coalesce(persons, males, females) IS NOT NULL""",
    ),
    (
        "ground_truth_single",
        ground_truth_single,
        f"""WITH {t.SQL} SELECT table_id AS sheet, {_AGE.format(total='Total')} AS age, persons, coalesce(males, 0) AS males, coalesce(females, 0) AS females FROM obs
        WHERE grp = 'F' AND section = 'N' AND persons IS NOT NULL""",
    ),
    (
        "ground_truth_wide",
        ground_truth_wide,
        f"""WITH {t.SQL}, a AS (SELECT DISTINCT table_id, row_ord, age FROM obs WHERE grp = 'ALL' AND section <> 'ALL'), k AS (SELECT unnest(['A', 'N', 'R']) AS section, unnest(['unmarried', 'married', 'widowed']) AS condition)
        SELECT a.table_id AS sheet, 'East' AS district, a.age, k.condition, coalesce(o.males, 0) AS males, coalesce(o.females, 0) AS females
        FROM a CROSS JOIN k LEFT JOIN obs o ON o.table_id = a.table_id AND o.row_ord = a.row_ord AND o.section = k.section AND o.grp = 'ALL'""",
    ),
    ("solver_repair", solver_repair, f"WITH {PLANTED}"),
    ("ensemble_solve", ensemble_solve, f"WITH {LONG[:LONG.index(', long AS')]}, {LONG[LONG.index('long AS'):].replace('FROM obs', 'FROM clean')} SELECT table_id, section, grp, age_norm, col, value FROM long WHERE grp = 'F' AND section <> 'ALL'"),
    ("reverify_clean", reverify, REVERIFY),
    ("grand_totals", grand_totals, GRAND),
    ("proportional_tolerance", proportional_tolerance, PROPORTIONAL),
    ("structural_sections", structural_sections, STRUCTURAL),
    (
        "column_numbers",
        column_numbers,
        """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN true ELSE (SELECT 10 * count(*) >= 6 * (o_orderkey % 7 + 1) FROM (SELECT unnest(range(o_orderkey % 7 + 1)) AS x)
          WHERE x % 2 = 1 OR o_custkey < 100) END AS numbers FROM orders""",
    ),
    ("readings_concat", readings_concat, f"WITH {LONG} SELECT table_id, section, row_ord, grp, col, value, CAST(k AS INTEGER) AS pass FROM long JOIN range(3) r(k) ON table_id % 3 >= k"),
    (
        "group_filter",
        group_filter,
        """WITH n AS (SELECT p_size, p_partkey, CASE WHEN p_partkey % 6 = 0 THEN 'total ' ELSE '' END || lower(p_type) AS clean, CAST(row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS INTEGER) AS place FROM part)
        SELECT p_size, clean, place FROM n WHERE NOT starts_with(clean, 'total') AND place <= 5""",
    ),
    ("check_columns", check_columns, CHECKS),
    ("province_score", province_score, PROVINCE),
]
