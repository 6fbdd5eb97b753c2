"""Golden values of the scalar functions."""

import itertools

import pytest
from pyspark.sql import functions as F

from gridcheck.functions import text as x
from gridcheck.operators.solve import PAIRS


def col(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_normalize_age(spark):
    labels = ["0–5", "Total 0-5", "60 & over", "40-44.", "15--19", "Total", "Grand Total", "Mean Age", None]
    assert col(spark, x.normalize_age, labels) == ["0-5", "0-5", "60andover", "40-44", "15-19", "total", "grandtotal", "meanage", None]
    assert col(spark, x.normalize_age_reading, ["60 & over", " 60 and over ", "Total", "total  5–9", "‘0-5’;"]) == ["60&over", "60andover", "total", "5-9", "0-5"]
    assert col(spark, x.normalize_age_bare, ["Total", "Total 0-5"]) == ["", "0-5"]
    assert col(spark, x.normalize_age_keep_total, ["Total", "Total 0-5"]) == ["total", "0-5"]
    assert col(spark, x.normalize_age_everywhere, ["Total", "Grand Total"]) == ["", "grand"]


def test_keys_and_labels(spark):
    assert col(spark, x.clean_age_key, ["", "..", "…", "0-5"]) == [None, "total", "total", "0-5"]
    assert col(spark, x.clean_label, ["Total ....", "TOTAL—", "total -…", "Total 0-5"]) == ["Total", "TOTAL—", "Total", "Total 0-5"]
    assert col(spark, x.is_age_label, ["0-5", "0 — 5", "60 & over", "Total 0-5", "Not stated", "Bombay"]) == [True] * 5 + [False]
    assert col(spark, x.normalize_district, ["Naga Hills District", "Cachar (Plains)"]) == ["naga", "cachar"]


def test_values(spark):
    texts = ["823,622", "..", "—", "", "x1", None, " 1 2 "]
    assert col(spark, x.normalize_value, texts) == [823622, 0, 0, 0, None, None, 12]
    assert col(spark, x.safe_int, texts) == [823622, None, None, None, None, None, 12]
    assert col(spark, x.parse_cell_value, ["1,384·8", "2·5", "…", "7"]) == [1385, 2, 0, 7]
    assert col(spark, x.gt_number, ["12.9", "-3.2", "x", ".5"]) == [12, -3, None, 0]
    assert col(spark, x.numbers, ["a 1,234 b 5 c 12"]) == [[1234, 5, 12]]
    assert col(spark, x.drop_digit_underscores, ["1_000_000 a_b"]) == ["1000000 a_b"]


def brute_fix(value, target):
    size, found = abs(value), set()
    text = str(size)
    for k, ch in enumerate(text):
        for other in range(10):
            if (int(ch), other) in PAIRS and (other - int(ch)) * 10 ** (len(text) - 1 - k) == target:
                found.add(size + target if value >= 0 else -(size + target))
    assert len(found) < 2
    return next(iter(found), None)


def test_digit_fix(spark):
    cases = [(53818, -500), (20000, 2000), (-8123, 1000), (5, 0)]
    cases += [(v, s * d * 10**k) for v in (0, 9, 38, 805, 12345, -67890) for s, d, k in itertools.product((1, -1), range(1, 10), range(6))]
    df = spark.createDataFrame([(i, v, t) for i, (v, t) in enumerate(cases)], "i int, v bigint, t bigint")
    got = [r[0] for r in df.orderBy("i").select(x.digit_fix(F.col("v"), F.col("t"))).collect()]
    assert got[:2] == [53318, None] and got == [brute_fix(v, t) for v, t in cases]


def test_tolerant_json(spark):
    raw = ['```json\n{"k": 1_000}\n```', 'Sure: {"k": 2} bye', "{broken", None, "[1, 2]"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, v string")
    got = df.orderBy("i").select(x.tolerant_json(F.col("v"), "k bigint")["k"].alias("k"), x.tolerant_json(F.col("v"), "array<int>", "[", "]").alias("a")).collect()
    assert [r.k for r in got] == [1000, 2, None, None, None] and got[4].a == [1, 2]


def test_crop(spark):
    df = spark.createDataFrame([(0, 0.0, 0.3), (1, 0.6, 0.9), (2, 0.05, 0.95)], "i int, l double, r double")
    got = [r[0] for r in df.orderBy("i").select(x.crop_fractions(F.col("i"), F.col("l"), F.col("r"), F.lit(0.15))).collect()]
    assert got[0].right_frac == pytest.approx(0.4) and got[0].left_frac is None
    assert (got[1].right_frac, got[1].left_frac, got[1].label_right_frac) == (pytest.approx(0.93), pytest.approx(0.58), 0.15)
    assert got[2].right_frac is None
