"""Ingest, pages, districts, schemas, markdown and line geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcheck.functions import text as x
from gridcheck.operators import constraints as c
from gridcheck.operators import merge as m
from gridcheck.plans import tables as t
from gridcheck.sources import documents, markdown

# --- pages: a user is a table, events in time order are pages ------------------------------

CONDS = ("Total", "Total", "Unmarried", "Total", "Widowed")


def _pages(spark, d):
    e = t.load(spark, d, "events").select("user_id", "event_id")
    k = F.col("event_id")
    cond = F.element_at(F.array(*[F.lit(v) for v in CONDS]), (k * 7 % len(CONDS) + 1).cast("int"))
    lo = (F.col("event_id") % 3).cast("int")
    return e.select("user_id", k.alias("page_no"), cond.alias("cond"), (k % 11 == 0).alias("marked"), lo.alias("lo"), (lo + F.when(k % 2 == 0, 0).otherwise(1) + (k % 5 == 0).cast("int")).alias("hi"))


PAGES = f"""pages_ AS (SELECT user_id, event_id AS page_no, [{', '.join(repr(v) for v in CONDS)}][event_id * 7 % {len(CONDS)} + 1] AS cond, event_id % 11 = 0 AS marked, CAST(event_id % 3 AS INTEGER) AS lo,
  CAST(event_id % 3 + CASE WHEN event_id % 2 = 0 THEN 0 ELSE 1 END + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS hi FROM events)"""


def page_continuity(spark, d):
    return m.continue_conditions(_pages(spark, d), ["user_id"]).select("user_id", "page_no", "cond", "condition")


CONTINUITY = f"""WITH {PAGES}, a AS (SELECT *, cond = 'Total' AND NOT marked AS op, coalesce(cond = 'Total' AND NOT marked AND lo = lag(hi) OVER w + 1, false) AS linked,
    lead(cond) OVER w AS nc, lead(lo) OVER w AS nl FROM pages_ WINDOW w AS (PARTITION BY user_id ORDER BY page_no)),
  b AS (SELECT *, CASE WHEN op AND NOT linked AND nc <> 'Total' AND nl = hi + 1 THEN nc ELSE cond END AS own,
    sum(CASE WHEN linked THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY page_no) AS run FROM a)
SELECT user_id, page_no, cond, first_value(own) OVER (PARTITION BY user_id, run ORDER BY page_no) AS condition FROM b"""


def _named(spark, d):
    li = t.load(spark, d, "lineitem")
    name = F.when(F.col("l_partkey") % 3 == 0, F.concat(F.col("l_linenumber").cast("string"), F.lit(" Place "), (F.col("l_partkey") % 10).cast("string"))).when(F.col("l_partkey") % 3 == 1, "null")
    return li.select(F.col("l_suppkey").alias("sheet"), F.col("l_orderkey").alias("page_no"), F.col("l_linenumber").alias("pos"), F.col("l_partkey"), name.alias("name"))


def positional_fill(spark, d):
    rows = _named(spark, d).groupBy("sheet", "page_no", "pos").agg(F.min("name").alias("name"))
    return m.positional_names(rows, ["sheet"]).select("sheet", "page_no", "pos", "district")


NAMED = """named AS (SELECT l_suppkey AS sheet, l_orderkey AS page_no, l_linenumber AS pos, l_partkey,
  CASE WHEN l_partkey % 3 = 0 THEN l_linenumber || ' Place ' || (l_partkey % 10) WHEN l_partkey % 3 = 1 THEN 'null' END AS name FROM lineitem)"""


def merge_pages(spark, d):
    """Cells of several pages: the last page wins."""
    li = t.load(spark, d, "lineitem").groupBy("l_suppkey", "l_linenumber", F.col("l_orderkey").alias("page_no")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("value"))
    return m.merge_pages(li, ["l_suppkey", "l_linenumber"])


def civil_sum(spark, d):
    li = t.load(spark, d, "lineitem")
    cond = F.element_at(F.array(F.lit("Unmarried"), F.lit("Married"), F.lit("Widowed")), (F.col("l_linenumber") % 3 + 1).cast("int"))
    rows = li.groupBy("l_suppkey", "l_returnflag", cond.alias("condition")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("value")).where("value % 5 <> 0")
    return m.sum_conditions(rows, ["l_suppkey", "l_returnflag"])


def district_match(spark, d):
    """Nation names against edited copies within a region."""
    n = t.load(spark, d, "nation")
    k = F.col("n_nationkey")
    edited = F.when(k % 4 == 0, F.concat(F.lower("n_name"), F.lit(" district"))).when(k % 4 == 1, F.concat(F.col("n_name"), F.lit(" and Hills"))).when(k % 4 == 2, F.upper("n_name"))
    return m.match_districts(n.select("n_regionkey", F.col("n_name").alias("name")), n.where(edited.isNotNull()).select("n_regionkey", edited.alias("name")), ["n_regionkey"])


def schema_merge(spark, d):
    p = t.load(spark, d, "part")
    schemas = p.select(
        (F.col("p_partkey") % 40).alias("table_id"),
        F.concat(F.lit("m"), (F.expr("p_partkey div 40") % 5).cast("string")).alias("model"),
        F.concat(F.col("p_name"), F.expr("repeat('x', p_size % 7)")).alias("title"),
        F.element_at(F.array(F.lit(""), F.lit("absolute"), F.lit("proportional")), (F.col("p_size") % 3 + 1).cast("int")).alias("data_type"),
        (F.when(F.col("p_size") % 4 == 0, 0).otherwise(1890 + F.col("p_size") % 3)).alias("year"),
        F.array(F.col("p_brand"), F.col("p_type")).alias("labels"),
        (F.col("p_size") / 64).alias("right_frac"),
    )
    return m.merge_schemas(schemas, ["table_id"], "m1")


def _mode(col):
    return f"""(SELECT table_id, {col} FROM (SELECT table_id, {col}, row_number() OVER (PARTITION BY table_id ORDER BY count(*) DESC, max(CASE WHEN model = 'm1' THEN 1 ELSE 0 END) DESC, {col}) AS n
      FROM s WHERE CAST({col} AS VARCHAR) NOT IN ('', '0') GROUP BY table_id, {col}) WHERE n = 1)"""


SCHEMA = f"""WITH s AS (SELECT p_partkey % 40 AS table_id, 'm' || (p_partkey // 40 % 5) AS model, p_name || repeat('x', p_size % 7) AS title, ['', 'absolute', 'proportional'][p_size % 3 + 1] AS data_type,
  CASE WHEN p_size % 4 = 0 THEN 0 ELSE 1890 + p_size % 3 END AS year, [p_brand, p_type] AS labels, p_size / 64 AS right_frac FROM part)
SELECT a.*, dt.data_type, y.year FROM (SELECT table_id, (list(title ORDER BY length(title) DESC, title))[1] AS title, array_to_string(list_sort(list_distinct(flatten(list(labels)))), ',') AS labels, max(right_frac) AS right_frac
  FROM s GROUP BY table_id) a LEFT JOIN {_mode('data_type')} dt USING (table_id) LEFT JOIN {_mode('year')} y USING (table_id)"""


def schema_compare(spark, d):
    p = t.load(spark, d, "part").select((F.col("p_partkey") % 40).alias("table_id"), (F.col("p_partkey") % 3).alias("model"), F.col("p_brand").alias("item"))
    return m.compare_schemas(p, ["table_id"], 3)


def group_merge(spark, d):
    wide = t.obs(spark, d).where("grp <> 'ALL' AND section <> 'ALL' AND (table_id + row_ord + ascii(grp)) % 9 <> 2")
    parts = wide.select("table_id", "section", "age", "grp", F.coalesce("males", F.lit(-1)).alias("value"), F.when(F.col("row_ord") % 6 != 4, F.col("row_ord")).alias("schema_ord"))
    return m.merge_groups(parts, ["table_id", "section"])


# --- nested documents and answers ----------------------------------------------------------


def nested_round_trip(spark, d):
    """Observations to nested documents, through a model's answer in text, and back."""
    wide = t.obs(spark, d).where("section <> 'ALL'")
    docs = documents.nested(wide.withColumn("_hidden", F.lit(1)), ["table_id"])
    body = F.concat_ws(",", F.transform("sections", lambda s: F.concat(F.lit('{"name":"'), s["name"], F.lit('","rows":'), s["rows"], F.lit("}"))))
    raw = docs.select("table_id", F.concat(F.lit('Sure:\n```json\n{"metadata":{"title":"x"},"sections":['), body, F.lit("]}\n```")).alias("text"))
    back = documents.unnest(documents.parse_answers(raw), ["table_id"])
    return back.select("table_id", "section", "age", "grp", *t.COLS)


def row_answers(spark, d):
    """Lists of rows in answers: bare arrays, and objects whose longest list counts, whatever its key."""
    o = t.load(spark, d, "orders")
    row = F.format_string('{"age":"%d-%d","persons":%d}', F.col("o_custkey"), F.col("o_custkey") + 5, F.col("o_orderkey"))
    k = F.col("o_orderkey") % 3
    text = (
        F.when(k == 0, F.concat(F.lit("```\n["), row, F.lit("]\n```")))
        .when(k == 1, F.concat(F.lit('{"note":"ok","rows":['), row, F.lit("]}")))
        .otherwise(F.concat(F.lit('So: {"notes":[{"age":"x"}],"table":['), row, F.lit(","), row, F.lit('],"n":2}')))
    )
    out = documents.parse_rows(o.select("o_orderkey", text.alias("text")), "age string, persons bigint")
    return out.select("o_orderkey", F.explode("rows").alias("r")).select("o_orderkey", "r.age", "r.persons")


def flat_answers(spark, d):
    """Answers that hold sections, and answers whose rows stand alone, as the section All."""
    o = t.load(spark, d, "orders")
    row = F.format_string('{"age":"0-5","groups":{"X":{"males":%d,"females":%d}}}', F.col("o_orderkey"), F.col("o_custkey"))
    k = F.col("o_orderkey") % 3
    text = (
        F.when(k == 0, F.concat(F.lit('{"sections":[{"name":"S","rows":['), row, F.lit("]}]}")))
        .when(k == 1, F.concat(F.lit('{"metadata":{"title":"t"},"rows":['), row, F.lit("]} ")))
        .otherwise(F.lit('{"rows":[]}'))
    )
    parsed = documents.parse_answers(o.select("o_orderkey", text.alias("text")))
    return documents.unnest(parsed, ["o_orderkey"]).select("o_orderkey", "section", "age", "grp", *t.COLS)


# --- markdown ------------------------------------------------------------------------------


def _markdown(spark, d):
    """A page of text per table and section, with a short table before the long one, two labels that open sections of rows, and a
    Total row. Every second table prints persons, and one in three has its spans drawn together."""
    w = t.obs(spark, d).where("grp <> 'ALL'")
    p = w.groupBy("table_id", "section", "row_ord", "age").pivot("grp", ["F", "O"]).agg(*[F.max(c).alias(c[0]) for c in t.COLS])
    shown = lambda k: F.concat(F.lit(" | "), F.coalesce(F.col(k).cast("string"), F.lit("..")))
    three, two = [f"{g}_{c}" for g in "FO" for c in "pmf"], [f"{g}_{c}" for g in "FO" for c in "mf"]
    odd = F.col("table_id") % 2 == 1
    values = F.when(odd, F.concat(*map(shown, two))).otherwise(F.concat(*map(shown, three)))
    blank = F.when(odd, F.lit(" | " * 3)).otherwise(F.lit(" | " * 5))
    label = lambda name: F.concat(F.lit(f"| {name} | "), blank, F.lit(" |\n"))
    opens = F.when(F.col("row_ord") == 1, label("1. North")).when(F.col("row_ord") == 4, label("2. South")).otherwise(F.lit(""))
    line = F.concat(opens, F.lit("| "), F.col("age"), values, F.lit(" |"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_ord", line.alias("l")))), lambda r: r["l"]), "\n")
    g = p.groupBy("table_id", "section").agg(body.alias("body"))
    top = (
        F.when(F.col("table_id") % 3 == 0, F.lit("| AGE | MARRIED | WIDOWED. |"))
        .when(odd, F.lit("| AGE | MARRIED | | WIDOWED. | |"))
        .otherwise(F.lit("| AGE | MARRIED | | | WIDOWED. | | |"))
    )
    sub = F.when(odd, F.lit("| | Males. | Females | Males | Females |\n| --- |\n| 1 | 2 | 3 | 4 | 5 |")).otherwise(
        F.lit("| | Persons | Males. | Females | Persons | Males | Females |\n| --- |\n| 1 | 2 | 3 | 4 | 5 | 6 | 7 |")
    )
    text = F.concat(F.lit("Ages\n| a | b |\n| --- | --- |\n\n"), top, F.lit("\n"), sub, F.lit("\n"), F.col("body"), F.lit("\nnotes"))
    return g.select(F.concat_ws("/", F.col("table_id").cast("string"), "section").alias("doc"), text.alias("text"))


def markdown_blocks(spark, d):
    rows = markdown.longest_block(_markdown(spark, d), "doc")
    return rows.select("doc", "row_no", F.array_join("cells", "|").alias("cells"))


def markdown_tables(spark, d):
    out = markdown.read_tables(_markdown(spark, d), "doc")
    return out.select("doc", "section", "sec_ord", "age", "row_ord", "grp", *t.COLS)


_MD_CELLS = ", ".join(f"max(CASE WHEN grp = '{g}' THEN {c} END) AS {g}{c[0]}" for g in "FO" for c in t.COLS)
_shown = lambda names: " || '|' || ".join(f"coalesce(CAST({n} AS VARCHAR), '..')" for n in names)
MD = f"""{t.SQL}, w AS (SELECT table_id, section, row_ord, age, table_id || '/' || section AS doc, {_MD_CELLS} FROM obs WHERE grp <> 'ALL' GROUP BY ALL),
  md_lines AS (
    SELECT doc, row_ord, 1 AS o, age || '|' || CASE WHEN table_id % 2 = 1 THEN {_shown(["Fm", "Ff", "Om", "Of"])} ELSE {_shown(["Fp", "Fm", "Ff", "Op", "Om", "Of"])} END AS cells FROM w
    UNION ALL SELECT doc, row_ord, 0, CASE row_ord WHEN 1 THEN '1. North' ELSE '2. South' END || repeat('|', CASE WHEN table_id % 2 = 1 THEN 4 ELSE 6 END) FROM w WHERE row_ord IN (1, 4)),
  md_heads AS (
    SELECT DISTINCT doc, CASE WHEN table_id % 3 = 0 THEN 'AGE|MARRIED|WIDOWED.' WHEN table_id % 2 = 1 THEN 'AGE|MARRIED||WIDOWED.|' ELSE 'AGE|MARRIED|||WIDOWED.||' END AS top,
      CASE WHEN table_id % 2 = 1 THEN '|Males.|Females|Males|Females' ELSE '|Persons|Males.|Females|Persons|Males|Females' END AS sub,
      CASE WHEN table_id % 2 = 1 THEN '1|2|3|4|5' ELSE '1|2|3|4|5|6|7' END AS nums FROM w),
  md_blocks AS (
    SELECT doc, 0 AS row_no, top AS cells FROM md_heads UNION ALL SELECT doc, 1, sub FROM md_heads UNION ALL SELECT doc, 2, nums FROM md_heads
    UNION ALL SELECT doc, CAST(2 + row_number() OVER (PARTITION BY doc ORDER BY row_ord, o) AS INTEGER), cells FROM md_lines),
  md_long AS (
    SELECT table_id, doc, row_ord, age, 'MARRIED' AS grp, Fp AS p, Fm AS m, Ff AS f FROM w UNION ALL SELECT table_id, doc, row_ord, age, 'WIDOWED', Op, Om, Of FROM w)"""


def parse_quality(spark, d):
    wide = t.obs(spark, d).where("grp <> 'ALL' AND section <> 'ALL' AND NOT (table_id % 6 = 2 AND row_ord > 2)")
    holed = wide.withColumns({k: F.when((F.col("table_id") % 5 != 3) | (F.col("row_ord") == i), F.col(k)) for i, k in enumerate(t.COLS)})
    return markdown.parse_quality(holed, ["table_id"])


# --- line geometry -------------------------------------------------------------------------


def _marks(spark, d):
    """Dark rows: the seconds of a day in which a type of event happens."""
    return t.load(spark, d, "events").select("event_type", (F.unix_timestamp("ts") % 86400).cast("int").alias("y")).distinct()


MARKS = "marks AS (SELECT DISTINCT event_type, CAST(epoch(date_trunc('second', ts)) AS BIGINT) % 86400 AS y FROM events)"
CLUSTERS = f"""{MARKS}, n AS (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY event_type ORDER BY y) > 6 THEN 1 WHEN lag(y) OVER (PARTITION BY event_type ORDER BY y) IS NULL THEN 1 ELSE 0 END AS new FROM marks),
  r AS (SELECT *, sum(new) OVER (PARTITION BY event_type ORDER BY y) AS cluster FROM n),
  clusters AS (SELECT event_type, CAST(cluster AS BIGINT) AS cluster, CAST(min(y) AS INTEGER) AS first, CAST(max(y) AS INTEGER) AS last, CAST((min(y) + max(y)) // 2 AS BIGINT) AS middle FROM r GROUP BY ALL)"""


def line_clusters(spark, d):
    return m.line_clusters(_marks(spark, d), ["event_type"]).withColumn("middle", F.col("middle").cast("bigint"))


def row_strips(spark, d):
    return m.row_strips(m.line_clusters(_marks(spark, d), ["event_type"]), ["event_type"]).select("event_type", "cluster", F.col("top").cast("bigint"), F.col("bottom").cast("bigint"))


def dark_rows(spark, d):
    """Image rows of which 30 % are dark: orders are pixels, a day is a row, the price is the brightness."""
    o = t.load(spark, d, "orders")
    dark = o.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("row")).agg(F.count(F.lit(1)).alias("pixels"), F.count_if(F.col("o_totalprice") % 256 < 128).alias("dark"))
    return dark.where("dark * 10 >= pixels * 3")


QUERIES = [
    ("page_continuity", page_continuity, CONTINUITY),
    (
        "positional_fill",
        positional_fill,
        f"""WITH {NAMED}, r AS (SELECT sheet, page_no, pos, min(name) AS name FROM named GROUP BY ALL),
        c AS (SELECT *, CASE WHEN lower(coalesce(name, '')) NOT IN ('', 'null', 'none') THEN trim(regexp_replace(name, '^\\d+\\.?\\s+', '')) END AS cl FROM r)
        SELECT sheet, page_no, pos, coalesce(cl, first_value(cl IGNORE NULLS) OVER (PARTITION BY sheet, pos ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), '_row_' || pos) AS district FROM c""",
    ),
    (
        "merge_pages",
        merge_pages,
        """SELECT l_suppkey, l_linenumber, page_no, value FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY page_no DESC) AS n FROM (
        SELECT l_suppkey, l_linenumber, l_orderkey AS page_no, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS value FROM lineitem GROUP BY ALL)) WHERE n = 1""",
    ),
    (
        "civil_sum",
        civil_sum,
        """WITH r AS (SELECT l_suppkey, l_returnflag, l_linenumber % 3 AS k, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS v FROM lineitem GROUP BY ALL)
        SELECT l_suppkey, l_returnflag, CAST(sum(v) AS BIGINT) AS value FROM r WHERE v % 5 <> 0 GROUP BY ALL HAVING count(*) = 3""",
    ),
    (
        "district_match",
        district_match,
        """WITH e AS (SELECT n_regionkey, n_name, n_nationkey % 4 AS k, CASE n_nationkey % 4 WHEN 0 THEN lower(n_name) || ' district' WHEN 1 THEN n_name || ' and Hills' WHEN 2 THEN upper(n_name) END AS match FROM nation)
        SELECT n_regionkey, n_name AS name, match, CASE k WHEN 1 THEN 'contained' ELSE 'equal' END AS how FROM e WHERE match IS NOT NULL""",
    ),
    ("schema_merge", schema_merge, SCHEMA),
    (
        "schema_compare",
        schema_compare,
        """SELECT p_partkey % 40 AS table_id, p_brand AS item, string_agg(DISTINCT CAST(p_partkey % 3 AS VARCHAR), ',' ORDER BY CAST(p_partkey % 3 AS VARCHAR)) AS models, count(DISTINCT p_partkey % 3) = 3 AS unanimous FROM part GROUP BY ALL""",
    ),
    (
        "group_merge",
        group_merge,
        f"""WITH {t.SQL}, p AS (SELECT table_id, section, age, grp, coalesce(males, -1) AS v, CASE WHEN row_ord % 6 <> 4 THEN row_ord END AS o FROM obs WHERE grp <> 'ALL' AND section <> 'ALL' AND (table_id + row_ord + ascii(grp)) % 9 <> 2)
        SELECT table_id, section, age, CAST(row_number() OVER (PARTITION BY table_id, section ORDER BY coalesce(o, 2147483647), age) AS INTEGER) AS row_ord, cells
        FROM (SELECT table_id, section, age, min(o) AS o, string_agg(grp || '=' || v, ',' ORDER BY grp) AS cells FROM p GROUP BY ALL)""",
    ),
    (
        "nested_round_trip",
        nested_round_trip,
        f"WITH {t.SQL} SELECT table_id, section, age, grp, coalesce(persons, males + females) AS persons, males, females FROM obs WHERE section <> 'ALL'",
    ),
    (
        "row_answers",
        row_answers,
        "SELECT o_orderkey, o_custkey || '-' || (o_custkey + 5) AS age, o_orderkey AS persons FROM orders JOIN range(2) r(n) ON n = 0 OR o_orderkey % 3 = 2",
    ),
    (
        "flat_answers",
        flat_answers,
        """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'S' ELSE 'All' END AS section, '0-5' AS age, 'X' AS grp, o_orderkey + o_custkey AS persons, o_orderkey AS males, o_custkey AS females
        FROM orders WHERE o_orderkey % 3 < 2""",
    ),
    (
        "markdown_blocks",
        markdown_blocks,
        f"WITH {MD} SELECT doc, row_no, cells FROM md_blocks",
    ),
    (
        "markdown_tables",
        markdown_tables,
        f"""WITH {MD}, o AS (
          SELECT *, count(*) FILTER (WHERE row_ord IN (1, 4)) OVER (PARTITION BY doc, grp ORDER BY row_ord) AS n,
            max(CASE WHEN row_ord IN (1, 4) THEN row_ord END) OVER (PARTITION BY doc, grp ORDER BY row_ord) AS opened FROM md_long)
        SELECT doc, CASE opened WHEN 1 THEN 'North' WHEN 4 THEN 'South' ELSE 'All' END AS section, CAST(n AS INTEGER) AS sec_ord, age,
          CAST(row_number() OVER (PARTITION BY doc, grp, n ORDER BY row_ord) AS INTEGER) AS row_ord, grp,
          CASE WHEN table_id % 2 = 1 THEN coalesce(m, 0) + coalesce(f, 0) ELSE coalesce(p, 0) END AS persons, coalesce(m, 0) AS males, coalesce(f, 0) AS females FROM o""",
    ),
    (
        "parse_quality",
        parse_quality,
        f"""WITH {t.SQL}, h AS (SELECT table_id, section, row_ord, grp, CASE WHEN table_id % 5 <> 3 OR row_ord = 0 THEN persons END AS p, CASE WHEN table_id % 5 <> 3 OR row_ord = 1 THEN males END AS m,
          CASE WHEN table_id % 5 <> 3 OR row_ord = 2 THEN females END AS f FROM obs WHERE grp <> 'ALL' AND section <> 'ALL' AND NOT (table_id % 6 = 2 AND row_ord > 2)),
        q AS (SELECT table_id, count(DISTINCT section) AS sections, count(DISTINCT grp) AS groups, count(DISTINCT section || '/' || row_ord) AS rows, round((count(p) + count(m) + count(f)) / (3 * count(*)), 4) AS fill FROM h GROUP BY table_id)
        SELECT *, sections >= 1 AND groups >= 1 AND rows >= 3 AND fill >= 0.3 AS usable FROM q""",
    ),
    ("line_clusters", line_clusters, f"WITH {CLUSTERS} SELECT * FROM clusters"),
    (
        "row_strips",
        row_strips,
        f"""WITH {CLUSTERS}, s AS (SELECT event_type, cluster, greatest(middle - 2, 0) AS top, lead(middle) OVER (PARTITION BY event_type ORDER BY middle) + 2 AS bottom FROM clusters)
        SELECT event_type, cluster, CAST(top AS BIGINT) AS top, CAST(bottom AS BIGINT) AS bottom FROM s WHERE bottom - top >= 15""",
    ),
    (
        "dark_rows",
        dark_rows,
        """SELECT strftime(o_orderdate, '%Y-%m-%d') AS row, count(*) AS pixels, count(*) FILTER (WHERE o_totalprice % 256 < 128) AS dark FROM orders GROUP BY ALL
        HAVING count(*) FILTER (WHERE o_totalprice % 256 < 128) * 10 >= count(*) * 3""",
    ),
]
