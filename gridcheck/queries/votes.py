"""Vote queries. Readings: a part is a cell, its line items are readings of
l_quantity % 4, the supplier's key modulo 3 is the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcheck.operators import vote as v
from gridcheck.plans import tables as t

KEY = ["l_partkey"]
READS = """reads AS (
  SELECT l_partkey, l_orderkey * 10 + l_linenumber AS reading, 'm' || (l_suppkey % 3) AS model,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS BIGINT) % 4 END AS value FROM lineitem
)"""
PRICES = """prices AS (
  SELECT l_partkey, l_orderkey * 10 + l_linenumber AS reading,
         CAST(floor(l_extendedprice) AS BIGINT) * CASE WHEN l_linenumber = 6 THEN -1 ELSE 1 END AS value FROM lineitem
)"""


def reads(spark, d):
    return t.load(spark, d, "lineitem").select(
        "l_partkey",
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("reading"),
        F.concat(F.lit("m"), (F.col("l_suppkey") % 3).cast("string")).alias("model"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("bigint") % 4).alias("value"),
    )


def prices(spark, d):
    sign = F.when(F.col("l_linenumber") == 6, -1).otherwise(1)
    return t.load(spark, d, "lineitem").select(
        "l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("reading"), (F.floor("l_extendedprice") * sign).alias("value")
    )


def _majority(key: str, source: str) -> str:
    return f"""SELECT {key}, CAST(trunc(median(value) FILTER (WHERE votes = top)) AS BIGINT) AS value, max(top) AS top, CAST(sum(votes) AS BIGINT) AS total, list(value) AS vs, list(votes) AS ns
    FROM (SELECT *, max(votes) OVER (PARTITION BY {key}) AS top FROM (
      SELECT {key}, value, count(*) AS votes FROM {source} WHERE value IS NOT NULL GROUP BY {key}, value)) GROUP BY {key}"""


def _won(key: str, source: str) -> str:
    return f"""SELECT {key}, value, coalesce(ns[list_position(vs, value)], top) AS votes, round(coalesce(ns[list_position(vs, value)], top) / total, 4) AS confidence
    FROM ({_majority(key, source)})"""


def histogram(spark, d):
    return v.histogram(reads(spark, d), KEY)


HIST = f"""WITH {READS} SELECT l_partkey, value, votes, seen, CAST(row_number() OVER (PARTITION BY l_partkey ORDER BY votes DESC, seen, value) AS INTEGER) AS rank
FROM (SELECT l_partkey, value, count(*) AS votes, min(reading) AS seen FROM reads WHERE value IS NOT NULL GROUP BY ALL)"""


def majority_vote(spark, d):
    return v.majority(reads(spark, d), KEY)


def cross_model(spark, d):
    return v.cross_model(reads(spark, d), KEY)


def two_stage(spark, d):
    return v.two_stage(reads(spark, d), KEY)


def lock(spark, d):
    coarse = reads(spark, d).withColumn("value", F.when(F.col("value") < 3, 1).otherwise(F.col("value")))
    return v.locked(coarse, KEY, 5)


def top2(spark, d):
    return histogram(spark, d).where("rank <= 2").select("l_partkey", "value", "votes", "rank")


def digit_vote(spark, d):
    return v.digits(prices(spark, d), KEY)


def digit_ensemble(spark, d):
    return v.digit_ensemble(prices(spark, d), KEY)


DIGITS = f"""{PRICES}, place AS (
  SELECT l_partkey, k AS place, substr(reverse(CAST(abs(value) AS VARCHAR)), CAST(k + 1 AS BIGINT), 1) AS digit
  FROM (SELECT *, unnest(range(length(CAST(abs(value) AS VARCHAR)))) AS k FROM prices)
), tied AS (
  SELECT l_partkey, place, list_sort(list(digit)) AS ds FROM (
    SELECT *, max(n) OVER (PARTITION BY l_partkey, place) AS top FROM (SELECT l_partkey, place, digit, count(*) AS n FROM place GROUP BY ALL)) WHERE n = top GROUP BY ALL
), sized AS (
  SELECT l_partkey, CAST(sum(CAST(ds[len(ds) // 2 + 1] AS BIGINT) * CAST(10 ** place AS BIGINT)) AS BIGINT) AS size FROM tied GROUP BY ALL
), voted AS (
  SELECT l_partkey, size * CASE WHEN 2 * count(*) FILTER (WHERE value < 0) > count(*) THEN -1 ELSE 1 END AS value FROM sized JOIN prices USING (l_partkey) GROUP BY l_partkey, size
)"""


def _candidates(spark, d):
    """Candidates of three columns of an order: line quantities by line number modulo 3, persons as their sum plus noise."""
    li = t.load(spark, d, "lineitem").withColumn("value", F.col("l_quantity").cast("bigint"))
    votes = lambda f: li.where(f).groupBy("l_orderkey", "value").agg(F.count(F.lit(1)).alias("votes"))
    return votes("l_linenumber % 3 = 0"), votes("l_linenumber % 3 = 1"), votes("l_linenumber % 3 = 2")


CAND = """cand AS (SELECT l_orderkey, l_linenumber % 3 AS k, CAST(l_quantity AS BIGINT) AS value, count(*) AS votes FROM lineitem GROUP BY ALL)"""


def best_pair(spark, d):
    a, b, _ = _candidates(spark, d)
    target = t.load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 60 + 20).alias("target"))
    return v.best_pair(a, b, target, ["l_orderkey"])


def best_triple(spark, d):
    m, f, p = _candidates(spark, d)
    return v.best_triple(p, m, f, ["l_orderkey"])


QUERIES = [
    ("candidate_histogram", histogram, HIST),
    ("majority_vote", majority_vote, f"WITH {READS} {_won('l_partkey', 'reads')}"),
    (
        "cross_model_vote",
        cross_model,
        f"""WITH {READS}, won AS ({_won('l_partkey', 'reads')})
        SELECT w.*, m.models FROM won w LEFT JOIN (SELECT r.l_partkey, string_agg(DISTINCT r.model, ',' ORDER BY r.model) AS models
          FROM reads r JOIN won x ON x.l_partkey = r.l_partkey AND x.value = r.value GROUP BY ALL) m USING (l_partkey)""",
    ),
    (
        "two_stage_vote",
        two_stage,
        f"""WITH {READS}, inner_ AS (SELECT l_partkey, model, value FROM ({_won('l_partkey, model', 'reads')})) {_won('l_partkey', 'inner_')}""",
    ),
    (
        "lock_supermajority",
        lock,
        f"""SELECT l_partkey, value, votes FROM (SELECT *, sum(votes) OVER (PARTITION BY l_partkey) AS total FROM ({HIST.replace("SELECT l_partkey, value, count(*)", "SELECT l_partkey, CASE WHEN value < 3 THEN 1 ELSE value END AS value, count(*)")}))
        WHERE rank = 1 AND ((votes = 5 AND total = 5) OR votes * 4 >= total * 3)""",
    ),
    ("top2_candidates", top2, f"SELECT l_partkey, value, votes, rank FROM ({HIST}) WHERE rank <= 2"),
    ("digit_vote", digit_vote, f"WITH {DIGITS} SELECT * FROM voted"),
    (
        "digit_ensemble",
        digit_ensemble,
        f"""WITH {DIGITS} SELECT l_partkey, v.value, round(avg(CASE WHEN p.value = v.value THEN 1.0 ELSE 0.0 END), 4) AS agreement, count(*) AS n_readings,
        string_agg(CAST(p.value AS VARCHAR), ',' ORDER BY p.reading, p.value) AS all_values FROM prices p JOIN voted v USING (l_partkey) GROUP BY l_partkey, v.value""",
    ),
    (
        "best_pair",
        best_pair,
        f"""WITH {CAND} SELECT l_orderkey, a, b, score FROM (SELECT a.l_orderkey, a.value AS a, b.value AS b, a.votes + b.votes AS score,
          row_number() OVER (PARTITION BY a.l_orderkey ORDER BY a.votes + b.votes DESC, a.value, b.value) AS n
        FROM cand a JOIN cand b ON a.l_orderkey = b.l_orderkey AND a.k = 0 AND b.k = 1 AND a.value + b.value = a.l_orderkey % 60 + 20
        JOIN orders o ON o.o_orderkey = a.l_orderkey) WHERE n = 1""",
    ),
    (
        "best_triple",
        best_triple,
        f"""WITH {CAND} SELECT l_orderkey, p, m, f, score FROM (SELECT p.l_orderkey, p.value AS p, m.value AS m, f.value AS f, p.votes + m.votes + f.votes AS score,
          row_number() OVER (PARTITION BY p.l_orderkey ORDER BY p.votes + m.votes + f.votes DESC, p.value, m.value) AS n
        FROM cand p JOIN cand m ON m.l_orderkey = p.l_orderkey AND p.k = 2 AND m.k = 0
        JOIN cand f ON f.l_orderkey = p.l_orderkey AND f.k = 1 AND f.value = p.value - m.value) WHERE n = 1""",
    ),
]
