"""Scalar functions on labels and numbers, Column -> Column.

Several age normalizers exist because the scorers and solvers of the domain
don't agree on what a label's identity is; each states its own rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The dash code points that count as a hyphen.
DASHES = "‐‑‒–—―−﹘﹣－"
# Marks that stand for an empty cell, hence zero.
EMPTY_MARKS = ("", "..", ".", "-", "—")
# Age brackets in their printed order.
AGE_ORDER = ("0-4", "5-9", "10-14", "15-19", "20-24", "25-29", "30-34", "35-39", "40-44", "45-49", "50-54", "55-59", "60andover")


def _rx(c: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(c, pattern, to)


def let(value: Column, then) -> Column:
    """then(value), with value worked out once, however often then uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def normalize_dash(c: Column) -> Column:
    return F.translate(c, DASHES, "-" * len(DASHES))


def normalize_age(c: Column) -> Column:
    """Canonical: en and em dash to hyphen, spaces out, lower case, & spelt
    out, hyphen runs to one, final dots off, a leading "total" off unless
    that is all there is."""
    s = F.lower(F.replace(F.translate(c, "–—", "--"), F.lit(" "), F.lit("")))
    s = F.rtrim(_rx(F.replace(s, F.lit("&"), F.lit("and")), "-{2,}", "-"), F.lit("."))
    rest = _rx(s, "^total")
    return F.when(rest == "", s).otherwise(rest)


def normalize_age_reading(c: Column) -> Column:
    """Of the voters: more dashes, "total" off only before a space and unless
    nothing would be left, all white space and light punctuation out, & kept."""
    s = F.translate(c, "‒–—―", "----")
    rest = F.trim(_rx(s, r"(?i)^total\s+"))
    s = F.lower(_rx(F.when(rest == "", s).otherwise(rest), r"\s+"))
    return _rx(s, "[.,;:'\"‘’“”]")


def normalize_age_bare(c: Column) -> Column:
    """Of the row scorers: "total" goes even when it stands alone."""
    return _rx(F.replace(F.lower(F.translate(c, "–—", "--")), F.lit(" "), F.lit("")), "^total")


def normalize_age_keep_total(c: Column) -> Column:
    """As the bare one, but a lone "total" stays."""
    s = F.replace(F.lower(F.translate(c, "–—", "--")), F.lit(" "), F.lit(""))
    rest = _rx(s, "^total")
    return F.when(rest == "", s).otherwise(rest)


def normalize_age_everywhere(c: Column) -> Column:
    """Of the evaluation: every "total" goes."""
    return F.replace(F.replace(F.lower(F.translate(c, "–—", "--")), F.lit(" "), F.lit("")), F.lit("total"), F.lit(""))


def clean_age_key(c: Column) -> Column:
    """Empty is null; a label of dots and dashes only is the total."""
    s = F.trim(c)
    return F.when(s == "", None).when(s.rlike(r"^[.\-_…]+$"), "total").otherwise(s)


def clean_label(c: Column) -> Column:
    """A total followed by nothing but dots, dashes or ellipses is Total."""
    return F.when(F.trim(c).rlike(r"(?i)^total\s*[.\-…]+$"), "Total").otherwise(c)


def _whole(c: Column) -> Column:
    """An optionally signed integer, else null."""
    return F.when(c.rlike(r"^[+-]?\d{1,18}$"), c.try_cast("bigint"))


def normalize_value(c: Column) -> Column:
    """Text of a cell: empty marks are 0, separators go, else an integer or null."""
    s = F.trim(c)
    return F.when(s.isin(*EMPTY_MARKS), 0).otherwise(_whole(_rx(s, "[, ]"))).cast("bigint")


def safe_int(c: Column) -> Column:
    """As normalize_value, but an empty text is null, and marks are no zeros."""
    return _whole(_rx(F.trim(c), "[, ]"))


def normalize_number(c: Column) -> Column:
    """A number of parsed JSON as a cell: rounded half to even; null, NaN and infinities are 0, as empty cells are."""
    x = c.cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0).otherwise(F.bround(x)).cast("bigint")


def safe_number(c: Column) -> Column:
    """As normalize_number, but what is no number is null."""
    x = c.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), F.bround(x).cast("bigint"))


def parse_cell_value(c: Column) -> Column:
    """As normalize_value; an ellipsis is 0 too, and a middle-dot decimal is rounded half to even."""
    s = F.trim(c)
    digits = _rx(s, "[, ]")
    decimal = F.when(digits.rlike(r"^\d+·\d+$"), F.bround(F.replace(digits, F.lit("·"), F.lit(".")).try_cast("double")).cast("bigint"))
    return F.when(s.isin(*EMPTY_MARKS, "…"), 0).otherwise(F.coalesce(decimal, _whole(digits))).cast("bigint")


def gt_number(c: Column) -> Column:
    """A number of any spelling, truncated, else null."""
    s = F.trim(c)
    return F.when(s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), s.try_cast("double")).cast("bigint")


def drop_digit_underscores(c: Column) -> Column:
    return _rx(c, r"(?<=\d)_(?=\d)")


def numbers(c: Column) -> Column:
    """The integers in a text, in order, thousands separators allowed inside."""
    found = F.regexp_extract_all(c, F.lit(r"\b(\d[\d,]*\d|\d)\b"), F.lit(1))
    return F.filter(F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("bigint")), lambda x: x.isNotNull())


def normalize_district(c: Column) -> Column:
    """Lower case without the words for kinds of districts, letters and digits only."""
    return _rx(_rx(F.lower(c), r"\b(district|state|division|plains|hills)\b"), "[^a-z0-9]")


def strip_number_prefix(c: Column) -> Column:
    return _rx(c, r"^\d+\.?\s+")


def range_start(c: Column) -> Column:
    return F.regexp_extract(c, r"^(\d+)", 1).try_cast("int")


def range_end(c: Column) -> Column:
    return F.when(c.rlike(r"^\d+-\d+$"), F.regexp_extract(c, r"^\d+-(\d+)$", 1)).try_cast("int")


def age_rank(c: Column) -> Column:
    return (F.array_position(F.array(*[F.lit(a) for a in AGE_ORDER]), c) - 1).cast("int")


def is_age_label(c: Column) -> Column:
    """Ranges, "n and over", totals and the three labels of unknown or mean age."""
    s = F.trim(c)
    return (
        s.rlike(r"^\d+\s*[-—–]\s*\d+$")
        | s.rlike(r"(?i)^\d+\s*(and|&)\s*over")
        | s.rlike(r"(?i)^(total|grand\s*total)")
        | F.lower(s).isin("mean age", "not stated", "age not stated")
    )


def is_number_row(cells: Column) -> Column:
    """At least 60 % of the cells are integers of one or two digits: the row that numbers the columns."""
    hits = F.size(F.filter(cells, lambda x: F.trim(x).rlike(r"^\d{1,2}$")))
    return hits * 10 >= F.size(cells) * 6


def each_sex(title: Column) -> Column:
    return F.contains(F.lower(title), F.lit("each sex"))


def denominator(title: Column) -> Column:
    return F.replace(F.regexp_extract(title, r"(?i)(\d[,\d]*)\s+of\s+each\s+sex", 1), F.lit(","), F.lit("")).try_cast("int")


def header_kind(c: Column) -> Column:
    """persons, males or females for a sub-header's label, else null."""
    s = F.lower(F.rtrim(F.trim(c), F.lit(".")))
    return F.when(s.isin("persons", "p", "total"), "persons").when(s.isin("males", "m", "male"), "males").when(s.isin("females", "f", "female"), "females")


def excel_age(d: Column) -> Column:
    """An age range that a spreadsheet took for a date: month-day."""
    return F.concat_ws("-", F.month(d).cast("string"), F.dayofmonth(d).cast("string"))


def change_label(old: Column, new: Column) -> Column:
    """How far a correction goes: under 0.1 % high, under 1 % medium, else low confidence."""
    share = F.abs(new - old) / F.greatest(F.abs(old), F.lit(1))
    return F.when(share < 0.001, "high").when(share < 0.01, "medium").otherwise("low")


def implausible(old: Column, new: Column, population: Column) -> Column:
    """Why a correction is not plausible, or null."""
    return (
        F.when(new < 0, "negative")
        .when(new > population, "above population")
        .when((old > 10) & (F.abs(new - old) > 0.5 * old), "change above half")
    )


def civil_condition(groups: Column, title: Column) -> Column:
    """Unmarried, Married, Widowed or Total: by the first group whose name says so, else by the title."""

    def of_group(g: Column) -> Column:
        g = F.lower(normalize_dash(g))
        has = lambda word: F.contains(g, F.lit(word))
        return F.when(has("unmarried"), "Unmarried").when(has("total married"), "Married").when(has("widowed"), "Widowed")

    t = F.lower(F.coalesce(title, F.lit("")))
    in_title = lambda word: F.contains(t, F.lit(word))
    named = F.filter(F.transform(groups, of_group), lambda x: x.isNotNull())
    return F.coalesce(
        F.get(named, F.lit(0)),
        F.when(in_title("unmarried"), "Unmarried").when(in_title("widowed"), "Widowed").when(in_title("married"), "Married"),
        F.lit("Total"),
    )


def crop_fractions(index: Column, left: Column, right: Column, first_left: Column) -> Column:
    """Crop of a column group: right_frac with a margin of 0.10, or of 0.03
    for a composite crop, which takes the labels left of the first group too;
    null where the whole width stays."""
    composite = (index > 0) & (left > 0.10)
    wide = F.least(F.lit(1.0), right + F.when(composite, 0.03).otherwise(0.10))
    return F.struct(
        F.when(wide < 0.98, wide).when(composite, 1.0).alias("right_frac"),
        F.when(composite, F.greatest(F.lit(0.0), left - 0.02)).alias("left_frac"),
        F.when(composite, first_left).alias("label_right_frac"),
    )


def strip_fences(c: Column) -> Column:
    """Without the lines that open or close a fenced block."""
    return F.array_join(F.filter(F.split(c, "\n"), lambda x: ~F.ltrim(x).startswith("```")), "\n")


def outer_slice(c: Column, opening: str, closing: str) -> Column:
    """From the first opening to the last closing mark, or null."""
    first, back = F.instr(c, opening), F.instr(F.reverse(c), closing)
    length = F.length(c) - back + 1 - first + 1
    return F.when((first > 0) & (back > 0) & (length > 1), F.substring(c, first, length))


def tolerant_json(c: Column, schema: str, opening: str = "{", closing: str = "}") -> Column:
    """A model's answer as JSON: without fences and digit underscores, whole or else its outer slice; null if neither parses.
    A document that parses to nothing of the schema counts as unparsed."""
    s = drop_digit_underscores(strip_fences(c))
    cut = outer_slice(s, opening, closing)
    options = {"mode": "PERMISSIVE"}
    whole = F.when(F.trim(s).startswith(opening) & F.trim(s).endswith(closing), F.from_json(s, schema, options))
    return F.coalesce(whole, F.from_json(cut, schema, options))


def digit_fix(value: Column, target: Column) -> Column:
    """value after the one change of a confusable digit that moves its
    magnitude by target, else null.

    target must be +-d * 10^k; the digit w at place k becomes w +- d, and the
    pair must be confusable. For negative values the signed value moves the
    other way.
    """
    size, mag = F.abs(value), F.abs(target)
    text = mag.cast("string")
    simple = text.rlike("^[1-9]0*$")
    place = F.length(text) - 1
    step = F.substring(text, 1, 1).cast("int") * F.signum(target).cast("int")
    digit = F.substring(F.reverse(size.cast("string")), place + 1, 1).try_cast("int")
    pair = F.concat(digit.cast("string"), (digit + step).cast("string"))
    fits = simple & (F.length(size.cast("string")) > place) & (digit + step).between(0, 9) & pair.isin(*CONFUSED)
    return F.when(fits, F.when(value >= 0, value + target).otherwise(value - target))


def _confused() -> list[str]:
    return sorted({p for a, b in CONFUSABLE for p in (a + b, b + a)})


# Digits that scans confuse with one another.
CONFUSABLE = [
    ("0", "1"), ("0", "3"), ("0", "5"), ("0", "6"), ("0", "8"), ("0", "9"),
    ("1", "4"), ("1", "7"),
    ("2", "3"), ("2", "5"), ("2", "7"),
    ("3", "5"), ("3", "6"), ("3", "8"), ("3", "9"),
    ("4", "5"), ("4", "7"), ("4", "9"),
    ("5", "6"), ("5", "8"), ("5", "9"),
    ("6", "7"), ("6", "8"), ("6", "9"),
    ("8", "9"),
]
CONFUSED = _confused()
