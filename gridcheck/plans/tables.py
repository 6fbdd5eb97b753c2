"""Census-like relations derived from the driver's tables, and the SQL that
says the same for the oracles.

obs is wide: one row per table, section, row and column group, with persons,
males and females. Leaves are sums of lineitem quantities; totals, the group
ALL and the section ALL are sums of clean leaves. Errors are then put in by
arithmetic on the keys, so every run sees the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = 40
KEYS = ["table_id", "section", "row_ord", "grp"]
COLS = ["persons", "males", "females"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_id, section, age, row_ord, grp, persons, males, females) without errors."""
    qty = F.col("l_quantity").cast("bigint")
    even = F.col("l_suppkey") % 2 == 0
    leaf = (
        load(spark, sf_dir, "lineitem")
        .groupBy(
            (F.col("l_partkey") % TABLES).alias("table_id"),
            F.col("l_returnflag").alias("section"),
            F.col("l_linenumber").cast("int").alias("row_ord"),
            F.col("l_linestatus").alias("grp"),
        )
        .agg(F.sum(F.when(even, qty).otherwise(0)).alias("males"), F.sum(F.when(even, 0).otherwise(qty)).alias("females"))
    )
    # One pass over the leaves gives the total rows, the group ALL and the section ALL.
    cubes = (
        leaf.withColumn("section", F.explode(F.array("section", F.lit("ALL"))))
        .withColumn("grp", F.explode(F.array("grp", F.lit("ALL"))))
        .withColumn("row_ord", F.explode(F.array("row_ord", F.lit(99))))
        .groupBy(*KEYS)
        .agg(F.sum("males").alias("males"), F.sum("females").alias("females"))
    )
    n = F.col("row_ord")
    age = F.when(n == 99, "Total").otherwise(F.concat_ws("-", ((n - 1) * 5).cast("string"), (n * 5).cast("string")))
    return cubes.withColumn("age", age).withColumn("persons", F.col("males") + F.col("females")).select(
        "table_id", "section", "age", "row_ord", "grp", *COLS
    )


def _mark() -> Column:
    return F.col("table_id") * 3 + F.col("row_ord") * 5 + F.ascii("section") + F.ascii("grp") * 3


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clean() with errors: one residue of the key's mark has 500 persons
    too many, others swap males and females, lose a value or drop it below zero."""
    m = _mark()
    return (
        clean(spark, sf_dir)
        .withColumn("_m", m % 37)
        .withColumn("persons", F.when(F.col("_m") == 0, F.col("persons") + 500).when(F.col("_m") == 7, None).otherwise(F.col("persons")))
        .withColumn("_f", F.col("females"))
        .withColumn("females", F.when(F.col("_m") == 3, F.col("males")).when(F.col("_m") == 11, -F.col("females")).otherwise(F.col("females")))
        .withColumn("males", F.when(F.col("_m") == 3, F.col("_f")).otherwise(F.col("males")))
        .drop("_m", "_f")
    )


#: CTEs clean and obs for DuckDB.
SQL = f"""
leaf AS (
  SELECT l_partkey % {TABLES} AS table_id, l_returnflag AS section, l_linenumber AS row_ord, l_linestatus AS grp,
         sum(CASE WHEN l_suppkey % 2 = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS males,
         sum(CASE WHEN l_suppkey % 2 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END) AS females
  FROM lineitem GROUP BY 1, 2, 3, 4
), grown AS (
  SELECT table_id, unnest([section, 'ALL']) AS section, row_ord, grp, males, females FROM leaf
), grown2 AS (
  SELECT table_id, section, row_ord, unnest([grp, 'ALL']) AS grp, males, females FROM grown
), grown3 AS (
  SELECT table_id, section, unnest([row_ord, 99]) AS row_ord, grp, males, females FROM grown2
), clean AS (
  SELECT table_id, section, CASE WHEN row_ord = 99 THEN 'Total' ELSE ((row_ord - 1) * 5) || '-' || (row_ord * 5) END AS age,
         CAST(row_ord AS INTEGER) AS row_ord, grp, CAST(sum(males + females) AS BIGINT) AS persons,
         CAST(sum(males) AS BIGINT) AS males, CAST(sum(females) AS BIGINT) AS females
  FROM grown3 GROUP BY table_id, section, row_ord, grp
), marked AS (
  SELECT *, (table_id * 3 + row_ord * 5 + ascii(section) + ascii(grp) * 3) % 37 AS m FROM clean
), obs AS (
  SELECT table_id, section, age, row_ord, grp, CASE m WHEN 0 THEN persons + 500 WHEN 7 THEN NULL ELSE persons END AS persons,
         CASE m WHEN 3 THEN females ELSE males END AS males,
         CASE m WHEN 3 THEN males WHEN 11 THEN -females ELSE females END AS females
  FROM marked
)"""
