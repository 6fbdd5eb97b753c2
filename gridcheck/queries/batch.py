"""Batch queries: orders are items, lineitem rows their checks, events a log."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcheck.operators import batch as b
from gridcheck.operators import constraints as c
from gridcheck.plans import tables as t
from gridcheck.sources import documents


def _states(spark, d):
    li = t.load(spark, d, "lineitem").where("l_orderkey % 5 <> 3")
    found = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        (F.min("l_linenumber") < 3).alias("ok"), F.count_if(F.col("l_quantity") > 4).alias("total_checks"), F.count_if(F.col("l_quantity") > 45).alias("failed")
    )
    return b.classify(t.load(spark, d, "orders"), found, ["o_orderkey"])


STATES = """found AS (SELECT l_orderkey AS o_orderkey, min(l_linenumber) < 3 AS ok, count(*) FILTER (WHERE l_quantity > 4) AS n, count(*) FILTER (WHERE l_quantity > 45) AS f FROM lineitem WHERE l_orderkey % 5 <> 3 GROUP BY ALL),
states AS (SELECT o_orderkey, CASE WHEN f.n IS NULL THEN 'missing' WHEN NOT ok OR n = 0 THEN 'corrupt' WHEN f = 0 THEN 'perfect' ELSE 'has_failures' END AS state FROM orders LEFT JOIN found f USING (o_orderkey))"""


def result_classifier(spark, d):
    return _states(spark, d)


def worklist(spark, d):
    return b.worklist(_states(spark, d), rerun_failures=True)


def cached_items(spark, d):
    """Items that no earlier run has done."""
    done = t.load(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return t.load(spark, d, "orders").join(done, "o_orderkey", "left_anti").select("o_orderkey", "o_orderpriority")


def status_counters(spark, d):
    return _states(spark, d).agg(F.count(F.lit(1)).alias("processed"), *[F.count_if(F.col("state") == s).alias(s) for s in ("missing", "corrupt", "perfect", "has_failures")])


def bytes_by_province(spark, d):
    docs = t.load(spark, d, "documents")
    return docs.groupBy(F.col("source").alias("province")).agg(F.count(F.lit(1)).alias("items"), F.sum(F.octet_length("text").cast("bigint")).alias("bytes"))


def province_items(spark, d):
    """Items of one province, whatever its case, with where their outputs go."""
    docs = t.load(spark, d, "documents")
    path = F.concat(F.lit("/scans/"), F.upper("source"), F.lit("/"), (1891 + F.col("doc_id") % 5 * 10).cast("string"), F.lit("/page "), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, F.lit("_1891")).otherwise(F.lit("")), F.lit(".png"))
    rows = docs.select("doc_id", path.alias("path")).withColumn("p", documents.place_of(F.col("path")))
    return rows.where(F.lower("p.province") == "src7").select("doc_id", "p.province", "p.year", documents.output_name(F.col("path"), F.col("p.year")).alias("name"))


PLACE = """WITH p AS (SELECT doc_id, lower(source) AS province, CAST(1891 + doc_id % 5 * 10 AS VARCHAR) AS year, 'page ' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '_1891' ELSE '' END AS stem FROM documents)
SELECT doc_id, province, year, CASE WHEN suffix(stem, year) THEN stem ELSE stem || '_' || year END AS name FROM p WHERE province = 'src7'"""


def consecutive_failures(spark, d):
    e = t.load(spark, d, "events").select("user_id", "ts", "event_id", (F.col("event_type").isin("error", "view")).alias("failed"))
    return b.failure_runs(e, ["user_id"], ["ts", "event_id"], 3).select("user_id", F.col("n"))


RUNS = """WITH e AS (SELECT user_id, ts, event_id, event_type IN ('error', 'view') AS failed FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, failed ORDER BY ts, event_id) AS run FROM e)
SELECT user_id, count(*) AS n FROM r WHERE failed GROUP BY user_id, run HAVING count(*) >= 3"""


def rate_eta(spark, d):
    e = t.load(spark, d, "events").select("user_id", "event_id", (F.col("event_id") % 97 + 1).alias("seconds"))
    return b.progress(e, ["user_id"], ["event_id"]).select("user_id", "event_id", F.col("n").cast("bigint"), "elapsed", "rate", "left")


def age_order_check(spark, d):
    """Labels of part sizes in the order of keys, with totals and means between."""
    p = t.load(spark, d, "part")
    age = F.when(F.col("p_partkey") % 9 == 4, "Total").when(F.col("p_partkey") % 9 == 7, "Mean Age").otherwise(F.concat_ws("-", "p_size", F.col("p_size") + 5))
    rows = p.select((F.col("p_partkey") % 50).alias("section"), F.col("p_partkey").alias("row_ord"), age.alias("age"))
    return b.age_order(rows, ["section"])


ORDER = """WITH r AS (SELECT p_partkey % 50 AS section, p_partkey AS row_ord, p_size, p_size || '-' || (p_size + 5) AS age FROM part WHERE p_partkey % 9 NOT IN (4, 7)),
l AS (SELECT *, lag(age) OVER w AS before, lag(p_size) OVER w AS p FROM r WINDOW w AS (PARTITION BY section ORDER BY row_ord)) SELECT section, row_ord, age, before FROM l WHERE p_size < p"""


def dedup_policies(spark, d):
    """First-wins and last-wins values of repeated keys."""
    li = t.load(spark, d, "lineitem").select("l_partkey", "l_linenumber", (F.col("l_orderkey") * 1000 + F.col("l_suppkey")).alias("row_ord"), F.col("l_quantity").cast("bigint").alias("value"))
    li = li.groupBy("l_partkey", "l_linenumber", "row_ord").agg(F.max("value").alias("value"))
    key = ["l_partkey", "l_linenumber"]
    first = c.first_wins(li, key).select(*key, F.col("value").alias("first"))
    return first.join(c.last_wins(li, key).select(*key, F.col("value").alias("last")), key)


DEDUP = """WITH l AS (SELECT l_partkey, l_linenumber, l_orderkey * 1000 + l_suppkey AS o, max(CAST(l_quantity AS BIGINT)) AS v FROM lineitem GROUP BY ALL)
SELECT l_partkey, l_linenumber, arg_min(v, o) AS first, arg_max(v, o) AS last FROM l GROUP BY ALL"""


def total_rows(spark, d):
    """The printed Total of each group, or the sum of the leaves where none is printed."""
    wide = t.obs(spark, d).where("NOT (row_ord = 99 AND table_id % 3 = 1)")
    total = lambda k: F.coalesce(F.max(F.when(F.col("row_ord") == 99, F.col(k))), F.sum(F.when(F.col("row_ord") < 99, F.col(k)))).alias(k)
    return wide.groupBy("table_id", "section", "grp").agg(*map(total, t.COLS))


def top_failures(spark, d):
    """Fifty largest failures of the batch, by size and place."""
    wide = t.obs(spark, d)
    bad = c.evaluate(c.row_balance(c.cells(wide))).where("NOT passed")
    return bad.orderBy(F.desc(F.abs("diff")), "table_id", "cid").limit(50).select("table_id", "cid", "diff")


def phase_counts(spark, d):
    return t.load(spark, d, "events").groupBy(F.col("event_type").alias("phase")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean"))


def after_total(spark, d):
    """Rows before and after the Total of their section."""
    li = t.load(spark, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("v"))
    age = F.when(F.col("v") % 5 == 0, "Total").otherwise(F.concat_ws("-", F.col("l_linenumber").cast("string"), (F.col("l_linenumber") + 1).cast("string")))
    rows = li.select(F.col("l_suppkey").alias("table_id"), F.lit("s").alias("section"), F.col("l_linenumber").alias("row_ord"), age.alias("age"))
    return c.row_kinds(rows).select("table_id", "row_ord", "kind", "after_total")


AFTER = """WITH r AS (SELECT l_suppkey AS table_id, l_linenumber AS row_ord, sum(CAST(l_quantity AS BIGINT)) % 5 = 0 AS tot FROM lineitem GROUP BY ALL)
SELECT table_id, row_ord, CASE WHEN tot THEN 'total' ELSE 'leaf' END AS kind, coalesce(bool_or(tot) OVER (PARTITION BY table_id ORDER BY row_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS after_total FROM r"""


QUERIES = [
    ("result_classifier", result_classifier, f"WITH {STATES} SELECT * FROM states"),
    ("worklist", worklist, f"WITH {STATES} SELECT * FROM states WHERE state <> 'perfect'"),
    ("cached_items", cached_items, "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"),
    (
        "status_counters",
        status_counters,
        f"WITH {STATES} SELECT count(*) AS processed, " + ", ".join(f"count(*) FILTER (WHERE state = '{s}') AS {s}" for s in ("missing", "corrupt", "perfect", "has_failures")) + " FROM states",
    ),
    ("bytes_by_province", bytes_by_province, "SELECT source AS province, count(*) AS items, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY source"),
    ("province_items", province_items, PLACE),
    ("consecutive_failures", consecutive_failures, RUNS),
    (
        "rate_eta",
        rate_eta,
        """WITH e AS (SELECT user_id, event_id, row_number() OVER w AS n, CAST(sum(event_id % 97 + 1) OVER w AS BIGINT) AS elapsed, count(*) OVER (PARTITION BY user_id) AS total FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
        SELECT user_id, event_id, n, elapsed, round(n * 60 / elapsed, 4) AS rate, round((total - n) * elapsed / n, 4) AS left FROM e""",
    ),
    ("age_order_check", age_order_check, ORDER),
    ("dedup_policies", dedup_policies, DEDUP),
    (
        "total_rows",
        total_rows,
        f"""WITH {t.SQL} SELECT table_id, section, grp, {', '.join(f"coalesce(max(CASE WHEN row_ord = 99 THEN {k} END), CAST(sum(CASE WHEN row_ord < 99 THEN {k} END) AS BIGINT)) AS {k}" for k in t.COLS)}
        FROM obs WHERE NOT (row_ord = 99 AND table_id % 3 = 1) GROUP BY ALL""",
    ),
    (
        "top_failures",
        top_failures,
        f"""WITH {t.SQL} SELECT table_id, concat_ws('|', 'L1', section, row_ord, grp) AS cid, persons - males - females AS diff FROM obs WHERE persons <> males + females
        ORDER BY abs(persons - males - females) DESC, table_id, cid LIMIT 50""",
    ),
    ("phase_counts", phase_counts, "SELECT event_type AS phase, count(*) AS n, round(avg(value), 4) AS mean FROM events GROUP BY event_type"),
    ("after_total", after_total, AFTER),
]
