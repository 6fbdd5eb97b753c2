"""Ground-truth sheets as grids: (sheet, row_no from 1, cells array of text).

A spreadsheet exported to CSV or Parquet is such a grid. Layouts are found
from the header rows of each sheet, a few cells, and joined to its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcheck.functions.text import excel_age, normalize_age
from gridcheck.operators.constraints import last_wins

#: Columns of a block, in order, after its first one.
FIELDS = ("district", "age", "persons", "males", "females")


def _cell(at: Column) -> Column:
    """The cell of a column counted from 1, null if it is empty or not there."""
    found = F.trim(F.get("cells", at - 1))
    return F.when(found != "", found)


def _whole(c: Column) -> Column:
    """A number cut to an integer, else null."""
    n = c.try_cast("double")
    return F.when(~F.isnan(n) & (F.abs(n) < 1e18), n.cast("bigint"))


def age_label(c: Column) -> Column:
    """The age of a cell; a date, which a spreadsheet made of a range, is month-day again."""
    day = F.to_date(F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2})( 00:00:00)?$", 1).try_cast("date"))
    return F.coalesce(F.when(day.isNotNull(), excel_age(day)), c)


def read_groups(grid: DataFrame) -> DataFrame:
    """(sheet, grp, row_no, district, age_norm, persons, males, females).

    Row 1 names the groups where they start; row 2 heads their columns, and
    where it heads none of a group's, the fields follow its start in order.
    A sheet that names none has one group, Total. Rows without a district, an
    age or any number are left out; of a repeated label the last row counts.
    """
    heads = grid.where("row_no <= 2").groupBy("sheet").agg(
        F.max(F.when(F.col("row_no") == 1, F.col("cells"))).alias("_names"), F.max(F.when(F.col("row_no") == 2, F.col("cells"))).alias("_fields")
    )
    named = F.filter(F.transform("_names", lambda n, i: F.struct(F.trim(n).alias("grp"), (i + 1).alias("start"))), lambda g: g["grp"] != "")
    single = F.array(F.struct(F.lit("Total").alias("grp"), F.lit(1).alias("start")))
    heads = heads.select("sheet", "_fields", F.explode(F.when(F.size(named) > 0, named).otherwise(single)).alias("_g"))
    shown = F.transform(F.slice(F.coalesce("_fields", F.array().cast("array<string>")), F.col("_g.start"), F.lit(7)), lambda f: F.lower(F.trim(f)))
    place = [F.array_position(shown, name) for name in FIELDS]
    none = F.forall(F.array(*place), lambda p: F.coalesce(p, F.lit(0)) == 0)
    at = [
        F.when(none, F.col("_g.start") + k).when(p > 0, F.col("_g.start") + p.cast("int") - 1).otherwise(k + 1).alias(f"_{name}")
        for k, (name, p) in enumerate(zip(FIELDS, place, strict=True), 1)
    ]
    layout = heads.select("sheet", F.col("_g.grp").alias("grp"), *at)
    rows = grid.where("row_no > 2").join(layout, "sheet")
    found = rows.select(
        "sheet",
        "grp",
        "row_no",
        _cell(F.col("_district")).alias("district"),
        normalize_age(age_label(_cell(F.col("_age")))).alias("age_norm"),
        *[_whole(_cell(F.col(f"_{c}"))).alias(c) for c in FIELDS[2:]],
    )
    some = found.where("district IS NOT NULL AND age_norm <> '' AND coalesce(persons, males, females) IS NOT NULL")
    return last_wins(some, ["sheet", "grp", "district", "age_norm"], "row_no")


def read_single(grid: DataFrame, district: str | None = None) -> DataFrame:
    """(sheet, row_no, district, age, persons, males, females) of sheets with one group in columns 2 to 6 and data
    from row 3: rows without a district or persons are left out, missing males and females count 0."""
    rows = grid.where("row_no > 2").select(
        "sheet",
        "row_no",
        _cell(F.lit(2)).alias("district"),
        age_label(_cell(F.lit(3))).alias("age"),
        _whole(_cell(F.lit(4))).alias("persons"),
        *[F.coalesce(_whole(_cell(F.lit(k))), F.lit(0).cast("bigint")).alias(c) for k, c in ((5, "males"), (6, "females"))],
    )
    some = rows.where("district IS NOT NULL AND persons IS NOT NULL")
    return some.where(F.col("district") == district) if district else some


#: Of the wide layout: the columns of district and age, and those of males of each condition, females after them.
WIDE_DISTRICT, WIDE_AGE, WIDE = 8, 9, {"unmarried": 11, "married": 17, "widowed": 23}


def read_wide(grid: DataFrame) -> DataFrame:
    """(sheet, row_no, district, age, condition, males, females) of sheets whose conditions stand side by side; what is missing counts 0."""
    zero = F.lit(0).cast("bigint")
    sides = [
        F.struct(F.lit(name).alias("condition"), *[F.coalesce(_whole(_cell(F.lit(k + i))), zero).alias(c) for i, c in enumerate(("males", "females"))])
        for name, k in WIDE.items()
    ]
    rows = grid.where("row_no > 2").withColumn("_district", _cell(F.lit(WIDE_DISTRICT))).where("_district IS NOT NULL")
    each = rows.select("sheet", "row_no", F.col("_district").alias("district"), age_label(_cell(F.lit(WIDE_AGE))).alias("age"), F.explode(F.array(*sides)).alias("_s"))
    return each.select("sheet", "row_no", "district", "age", "_s.*")
