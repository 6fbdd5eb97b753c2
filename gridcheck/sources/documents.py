"""Sources and sinks of tables: result documents, tidy files, logs, images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcheck.functions.text import tolerant_json

GROUP = "struct<persons:bigint,males:bigint,females:bigint>"
META = "struct<title:string,region:string,year:int,data_type:string,column_groups:array<string>>"
ROW = f"struct<age:string,groups:map<string,{GROUP}>>"
TABLE = f"struct<metadata:{META},sections:array<struct<name:string,rows:array<{ROW}>>>>"
RESULT = "source_image string, extraction_method string, api_calls int, elapsed_seconds double, metadata struct<title:string,region:string,year:int,data_type:string,column_groups:array<string>>, data array<struct<name:string,rows:array<map<string,string>>>>, constraints struct<total_checks:int,passed:int,failed:int,all_passed:boolean,failures:array<struct<level:string,section:string,age:string,group:string,col:string,detail:string,diff:bigint>>>"
LOG = "image string, output_dir string, status string, checks int, failures int, error string, elapsed_seconds double, timestamp timestamp"
TIDY = "section string, age string, grp string, persons bigint, males bigint, females bigint"


def images(spark: SparkSession, root: str, glob: str = "*.png") -> DataFrame:
    """Images under root, one row per path, with length and time; their bytes are read only if selected."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root).dropDuplicates(["path"])


def place_of(path: Column) -> Column:
    """Province and year of .../PROVINCE/YEAR/file, in lower case."""
    return F.struct(F.lower(F.regexp_extract(path, r"([^/]+)/(\d{4})/[^/]+$", 1)).alias("province"), F.regexp_extract(path, r"/(\d{4})/[^/]+$", 1).alias("year"))


def output_name(path: Column, year: Column) -> Column:
    """File name without extension, the year appended unless the name ends in it."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")
    return F.when(F.endswith(stem, year), stem).otherwise(F.concat_ws("_", stem, year))


def results(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(RESULT).json(glob)


def tidy(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TIDY).csv(path, header=True)


def batch_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).json(path)


def write_tidy(obs: DataFrame, path: str) -> None:
    obs.select("section", "age", "grp", "persons", "males", "females").write.mode("overwrite").csv(path, header=True)


def write_combined(obs: DataFrame, path: str) -> None:
    """All tables in one Parquet set, partitioned by the table's source."""
    obs.write.mode("overwrite").partitionBy("source_image").parquet(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.withColumn("timestamp", F.current_timestamp()).write.mode("append").json(path)


def nested(obs: DataFrame, key: list[str]) -> DataFrame:
    """One document per key: sections, rows, groups, in their printed order; hidden columns (with a leading underscore) stay out."""
    shown = obs.select(*[c for c in obs.columns if not c.startswith("_")])
    cell = F.map_from_entries(F.collect_list(F.struct("grp", F.struct("persons", "males", "females"))))
    rows = shown.groupBy(*key, "section", "row_ord", "age").agg(cell.alias("groups"))
    ordered = F.array_sort(F.collect_list(F.struct("row_ord", "age", F.to_json("groups").alias("g"))))
    sections = rows.groupBy(*key, "section").agg(
        F.transform(ordered, lambda r: F.struct(r["age"].alias("age"), F.from_json(r["g"], f"map<string,{GROUP}>").alias("groups"))).alias("rows")
    )
    return sections.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col("section").alias("name"), F.to_json("rows").alias("rows")))).alias("sections"))


def unnest(parsed: DataFrame, key: list[str], table: str = "table") -> DataFrame:
    """Observations of parsed tables (a struct like TABLE): ordinals of sections and rows kept, groups exploded, persons filled."""
    s = parsed.select(*key, F.posexplode(F.col(table)["sections"]).alias("sec_ord", "_s"))
    r = s.select(*key, "sec_ord", F.col("_s.name").alias("section"), F.posexplode("_s.rows").alias("row_ord", "_r"))
    g = r.select(*key, "section", "sec_ord", F.col("_r.age").alias("age"), "row_ord", F.explode("_r.groups").alias("grp", "_v"))
    return g.select(*key, "section", "sec_ord", "age", "row_ord", "grp", F.coalesce("_v.persons", F.col("_v.males") + F.col("_v.females")).alias("persons"), "_v.males", "_v.females")


def parse_answers(raw: DataFrame, text_col: str = "text") -> DataFrame:
    """raw with table, the tolerant parse of an answer: its sections, or its flat rows as the section All; null if it shows neither."""
    t = tolerant_json(F.col(text_col), TABLE)
    flat = tolerant_json(F.col(text_col), f"struct<metadata:{META},rows:array<{ROW}>>")
    whole = F.struct(flat["metadata"].alias("metadata"), F.array(F.struct(F.lit("All").alias("name"), flat["rows"].alias("rows"))).alias("sections"))
    return raw.withColumn("table", F.when(F.size(t["sections"]) > 0, t).when(F.size(flat["rows"]) > 0, whole))


def parse_rows(raw: DataFrame, fields: str, text_col: str = "text") -> DataFrame:
    """raw with rows, an array of structs: a JSON array anywhere in the text
    that isn't a JSON object, else the longest list of a JSON object, the
    first among equals."""
    kind = f"array<struct<{fields}>>"
    wrapped = F.map_values(tolerant_json(F.col(text_col), "map<string,string>"))
    lists = F.filter(F.transform(wrapped, lambda v: F.when(F.startswith(F.ltrim(v), F.lit("[")), F.from_json(v, kind))), lambda v: v.isNotNull())
    longest = F.get(F.filter(lists, lambda v: F.size(v) == F.array_max(F.transform(lists, lambda x: F.size(x)))), F.lit(0))
    as_list = tolerant_json(F.col(text_col), kind, "[", "]")
    return raw.withColumn("rows", F.coalesce(longest, as_list))
