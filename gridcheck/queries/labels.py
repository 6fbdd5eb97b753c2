"""Label and number functions over strings built from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcheck.functions import text as x
from gridcheck.plans import tables as t

FORMS = [
    "{a}–{b}", "Total {a}-{b}", "{a} & over", "{a}-{b}.", "{a}--{b}", "Total", "Grand Total", "Mean Age", " {a} and over ",
    "TOTAL  {a} — {b}", "…", "Total ....", "{a} - {b}", "Not stated", "'{a}‑{b}’;", "", "{a}", "total/{b}", "Age {a} total {b}",
]
NUMBERS = [
    "{q},{r}", "..", "—", "", "x{q}", "{q}", " {q} {r} ", "…", "1,3{q}·5", "-{q}", "{q}.7", ".", "{q}·4", "12,{q}", "{q}e1", "-",
]


def _spark_form(form: str, **values):
    parts, rest = [], form
    while rest:
        at = rest.find("{")
        if at < 0:
            parts.append(F.lit(rest))
            break
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(values[rest[at + 1]].cast("string"))
        rest = rest[at + 3 :]
    return F.concat(*parts) if parts else F.lit("")


def _sql_form(form: str, **values) -> str:
    out = "'" + form.replace("'", "''") + "'"
    for k, v in values.items():
        out = out.replace("{" + k + "}", f"' || {v} || '")
    return out


def _pick(forms, number, **values):
    out = None
    for k, form in enumerate(forms):
        c = number == k
        out = F.when(c, _spark_form(form, **values)) if out is None else out.when(c, _spark_form(form, **values))
    return out


def _pick_sql(forms, number, **values) -> str:
    return f"CASE {number} " + " ".join(f"WHEN {k} THEN {_sql_form(f, **values)}" for k, f in enumerate(forms)) + " END"


def ages(spark, d):
    a = F.col("p_size")
    return t.load(spark, d, "part").select("p_partkey", _pick(FORMS, F.col("p_partkey") % len(FORMS), a=a, b=a + 5).alias("label"))


AGES = f"""ages AS (SELECT p_partkey, {_pick_sql(FORMS, f'p_partkey % {len(FORMS)}', a='p_size', b='(p_size + 5)')} AS label FROM part)"""
TWO_DASH = "replace(replace({}, '–', '-'), '—', '-')"


def _first(s):
    return f"CASE WHEN regexp_replace({s}, '^total', '') = '' THEN {s} ELSE regexp_replace({s}, '^total', '') END"


CANON = "rtrim(regexp_replace(replace(lower(replace(" + TWO_DASH.format("label") + ", ' ', '')), '&', 'and'), '-{2,}', '-', 'g'), '.')"
PLAIN = "lower(replace(" + TWO_DASH.format("label") + ", ' ', ''))"
READ0 = "replace(replace(replace(replace(label, '‒', '-'), '–', '-'), '—', '-'), '―', '-')"
READ1 = f"trim(regexp_replace({READ0}, '^(?i:total)\\s+', ''))"
READ = f"regexp_replace(lower(regexp_replace(CASE WHEN {READ1} = '' THEN {READ0} ELSE {READ1} END, '\\s+', '', 'g')), '[.,;:''\"‘’“”]', '', 'g')"


def age_normalizers(spark, d):
    c = F.col("label")
    return ages(spark, d).select(
        "p_partkey",
        x.normalize_age(c).alias("canonical"),
        x.normalize_age_reading(c).alias("reading"),
        x.normalize_age_bare(c).alias("bare"),
        x.normalize_age_keep_total(c).alias("keep_total"),
        x.normalize_age_everywhere(c).alias("everywhere"),
        F.coalesce(x.clean_age_key(x.normalize_age(c)), F.lit("<null>")).alias("clean_key"),
        x.clean_label(c).alias("clean_label"),
    )


AGE_SQL = f"""WITH {AGES} SELECT p_partkey, {_first(CANON)} AS canonical, {READ} AS reading, regexp_replace({PLAIN}, '^total', '') AS bare,
  {_first(PLAIN)} AS keep_total, replace({PLAIN}, 'total', '') AS everywhere,
  CASE WHEN trim({_first(CANON)}) = '' THEN '<null>' WHEN regexp_matches(trim({_first(CANON)}), '^[.\\-_…]+$') THEN 'total' ELSE trim({_first(CANON)}) END AS clean_key,
  CASE WHEN regexp_matches(trim(label), '^(?i:total)\\s*[.\\-…]+$') THEN 'Total' ELSE label END AS clean_label
FROM ages"""


def age_probes(spark, d):
    c = F.col("label")
    n = x.normalize_age(c)
    return ages(spark, d).select(
        "p_partkey",
        x.is_age_label(c).alias("is_label"),
        F.coalesce(x.range_start(n), F.lit(-1)).alias("lo"),
        F.coalesce(x.range_end(n), F.lit(-1)).alias("hi"),
        x.age_rank(n).alias("rank"),
        x.normalize_dash(c).alias("dashed"),
    )


DASHED = "label"
for _d in x.DASHES:
    DASHED = f"replace({DASHED}, '{_d}', '-')"
PROBE_SQL = f"""WITH {AGES}, n AS (SELECT *, {_first(CANON)} AS n FROM ages) SELECT p_partkey,
  regexp_matches(trim(label), '^\\d+\\s*[-—–]\\s*\\d+$') OR regexp_matches(trim(label), '^(?i:\\d+\\s*(and|&)\\s*over)')
    OR regexp_matches(trim(label), '^(?i:total|grand\\s*total)') OR lower(trim(label)) IN ('mean age', 'not stated', 'age not stated') AS is_label,
  coalesce(TRY_CAST(nullif(regexp_extract(n, '^(\\d+)', 1), '') AS INTEGER), -1) AS lo,
  coalesce(TRY_CAST(nullif(regexp_extract(n, '^\\d+-(\\d+)$', 1), '') AS INTEGER), -1) AS hi,
  CAST(coalesce(list_position([{', '.join(repr(a) for a in x.AGE_ORDER)}], n), 0) - 1 AS INTEGER) AS rank, {DASHED} AS dashed FROM n"""


def values(spark, d):
    li = t.load(spark, d, "lineitem")
    q, r = F.col("l_quantity").cast("bigint"), F.col("l_suppkey")
    return li.select("l_orderkey", "l_linenumber", _pick(NUMBERS, (F.col("l_orderkey") + F.col("l_linenumber")) % len(NUMBERS), q=q, r=r).alias("s"))


VALUES = f"""vals AS (SELECT l_orderkey, l_linenumber, {_pick_sql(NUMBERS, f'((l_orderkey + l_linenumber) % {len(NUMBERS)})', q='CAST(l_quantity AS BIGINT)', r='l_suppkey')} AS s FROM lineitem)"""
INT = "CASE WHEN regexp_matches({0}, '^[+-]?\\d{{1,18}}$') THEN CAST({0} AS BIGINT) END"
BARE = "regexp_replace(trim(s), '[, ]', '', 'g')"


def value_parsers(spark, d):
    c = F.col("s")
    out = values(spark, d).select(
        "l_orderkey", "l_linenumber", x.normalize_value(c).alias("cell"), x.safe_int(c).alias("vote"), x.parse_cell_value(c).alias("markdown"), x.gt_number(c).alias("truth")
    )
    return out.fillna(-999999)


VALUE_SQL = f"""WITH {VALUES} SELECT l_orderkey, l_linenumber,
  coalesce(CASE WHEN trim(s) IN ('', '..', '.', '-', '—') THEN 0 ELSE {INT.format(BARE)} END, -999999) AS cell,
  coalesce({INT.format(BARE)}, -999999) AS vote,
  coalesce(CASE WHEN trim(s) IN ('', '..', '.', '-', '—', '…') THEN 0 WHEN regexp_matches({BARE}, '^\\d+·\\d+$')
    THEN CAST(round_even(CAST(replace({BARE}, '·', '.') AS DOUBLE), 0) AS BIGINT) ELSE {INT.format(BARE)} END, -999999) AS markdown,
  coalesce(CASE WHEN regexp_matches(trim(s), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)$') THEN CAST(trunc(CAST(trim(s) AS DOUBLE)) AS BIGINT) END, -999999) AS truth
FROM vals"""


def number_extraction(spark, d):
    n = x.numbers(F.col("text"))
    docs = t.load(spark, d, "documents")
    return docs.select(
        "doc_id", F.size(n).cast("bigint").alias("n"), F.size(F.array_distinct(n)).cast("bigint").alias("n_distinct"), F.array_join(F.transform(n, lambda v: v.cast("string")), ",").alias("numbers")
    )


NUM_SQL = """WITH f AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '\\b(\\d[\\d,]*\\d|\\d)\\b', 1), lambda v: TRY_CAST(replace(v, ',', '') AS BIGINT)), lambda v: v IS NOT NULL) AS n FROM documents)
SELECT doc_id, CAST(len(n) AS BIGINT) AS n, CAST(len(list_distinct(n)) AS BIGINT) AS n_distinct, array_to_string(n, ',') AS numbers FROM f"""


def district_names(spark, d):
    s = t.load(spark, d, "supplier")
    name = F.concat((F.col("s_suppkey") % 9).cast("string"), F.lit(" "), F.col("s_name"), F.element_at(F.array(*[F.lit(w) for w in (" District", " State (Hills)", " division", ", Plains", "shire")]), (F.col("s_suppkey") % 5 + 1).cast("int")))
    return s.select("s_suppkey", x.normalize_district(name).alias("key"), x.strip_number_prefix(name).alias("name"))


DISTRICT_SQL = """WITH n AS (SELECT s_suppkey, (s_suppkey % 9) || ' ' || s_name || [' District', ' State (Hills)', ' division', ', Plains', 'shire'][s_suppkey % 5 + 1] AS name FROM supplier)
SELECT s_suppkey, regexp_replace(regexp_replace(lower(name), '\\b(district|state|division|plains|hills)\\b', '', 'g'), '[^a-z0-9]', '', 'g') AS key,
regexp_replace(name, '^\\d+\\.?\\s+', '') AS name FROM n"""


def headings(spark, d):
    """Titles of tables and sub-headers: what sex columns, denominators and civil conditions they state."""
    o = t.load(spark, d, "orders")
    k = F.col("o_orderkey")
    title = F.concat(F.lit("Ages of "), F.element_at(F.array(*[F.lit(w) for w in ("1,000 of each sex", "the UNMARRIED", "10,000 of each Sex, Widowed", "married women", "population")]), (k % 5 + 1).cast("int")))
    head = F.element_at(F.array(*[F.lit(w) for w in ("Persons.", " M ", "females", "Total", "F.", "P", "age")]), (k % 7 + 1).cast("int"))
    groups = F.array(F.lit("POPULATION"), F.element_at(F.array(*[F.lit(w) for w in ("Total—Married", "x", "Widowed", "Total Unmarried")]), (k % 4 + 1).cast("int")))
    return o.select(
        "o_orderkey",
        x.each_sex(title).alias("each_sex"),
        F.coalesce(x.denominator(title), F.lit(0)).alias("denominator"),
        F.coalesce(x.header_kind(head), F.lit("-")).alias("header"),
        x.civil_condition(groups, title).alias("civil"),
        x.excel_age(F.col("o_orderdate")).alias("excel_age"),
    )


HEAD_SQL = """WITH o AS (SELECT o_orderkey, o_orderdate, 'Ages of ' || ['1,000 of each sex', 'the UNMARRIED', '10,000 of each Sex, Widowed', 'married women', 'population'][o_orderkey % 5 + 1] AS title,
  ['Persons.', ' M ', 'females', 'Total', 'F.', 'P', 'age'][o_orderkey % 7 + 1] AS head, ['Total—Married', 'x', 'Widowed', 'Total Unmarried'][o_orderkey % 4 + 1] AS g FROM orders)
SELECT o_orderkey, contains(lower(title), 'each sex') AS each_sex,
  coalesce(TRY_CAST(replace(nullif(regexp_extract(title, '(?i)(\\d[,\\d]*)\\s+of\\s+each\\s+sex', 1), ''), ',', '') AS INTEGER), 0) AS denominator,
  CASE lower(rtrim(trim(head), '.')) WHEN 'persons' THEN 'persons' WHEN 'p' THEN 'persons' WHEN 'total' THEN 'persons' WHEN 'males' THEN 'males' WHEN 'm' THEN 'males'
    WHEN 'male' THEN 'males' WHEN 'females' THEN 'females' WHEN 'f' THEN 'females' WHEN 'female' THEN 'females' ELSE '-' END AS header,
  CASE WHEN contains(lower(g), 'unmarried') THEN 'Unmarried' WHEN contains(lower(replace(g, '—', '-')), 'total married') THEN 'Married' WHEN contains(lower(g), 'widowed') THEN 'Widowed'
    WHEN contains(lower(title), 'unmarried') THEN 'Unmarried' WHEN contains(lower(title), 'widowed') THEN 'Widowed' WHEN contains(lower(title), 'married') THEN 'Married' ELSE 'Total' END AS civil,
  month(o_orderdate) || '-' || day(o_orderdate) AS excel_age FROM o"""


def model_answers(spark, d):
    """Answers of a model around the events' properties: fenced, with words around, with digit underscores, or broken."""
    e = t.load(spark, d, "events")
    p, k = F.col("props"), F.col("event_id") % 5
    raw = (
        F.when(k == 0, F.concat(F.lit("```json\n"), p, F.lit("\n```")))
        .when(k == 1, F.concat(F.lit("Here it is: "), p, F.lit(" Done.")))
        .when(k == 2, F.regexp_replace(p, r"(\d)(\d)", "$1_$2"))
        .when(k == 3, F.concat(F.lit("{"), p))
        .otherwise(F.lit("no answer"))
    )
    parsed = x.tolerant_json(raw, "k bigint")
    return e.select("event_id", F.coalesce(parsed["k"], F.lit(-1).cast("bigint")).alias("k"), x.drop_digit_underscores(raw).alias("plain"))


ANSWER_SQL = """WITH r AS (SELECT event_id, props, CASE event_id % 5 WHEN 0 THEN '```json' || chr(10) || props || chr(10) || '```' WHEN 1 THEN 'Here it is: ' || props || ' Done.'
  WHEN 2 THEN regexp_replace(props, '(\\d)(\\d)', '\\1_\\2', 'g') WHEN 3 THEN '{' || props ELSE 'no answer' END AS raw FROM events)
SELECT event_id, CASE WHEN event_id % 5 < 3 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE -1 END AS k,
  regexp_replace(regexp_replace(raw, '(\\d)_(\\d)', '\\1\\2', 'g'), '(\\d)_(\\d)', '\\1\\2', 'g') AS plain FROM r"""


def number_cells(spark, d):
    """Numbers of parsed JSON as cells: halves go to the even side."""
    li = t.load(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("n"))
    half = F.when(F.col("n") % 5 == 0, float("nan")).when(F.col("n") % 5 == 1, None).otherwise((F.col("n") - 100) / 2)
    return li.select("l_partkey", x.normalize_number(half).alias("normal"), x.safe_number(half).alias("safe"))


NUMBER_SQL = """WITH s AS (SELECT l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n FROM lineitem GROUP BY l_partkey),
h AS (SELECT l_partkey, CASE WHEN n % 5 > 1 THEN n - 100 END AS two FROM s)
SELECT l_partkey, coalesce(v, 0) AS normal, v AS safe FROM (SELECT l_partkey, CAST(round_even(two / 2.0, 0) AS BIGINT) AS v FROM h)"""


def corrections(spark, d):
    """How far corrections go and which are not plausible."""
    li = t.load(spark, d, "lineitem")
    old, new = F.col("l_suppkey") * 100, F.col("l_suppkey") * 100 + F.col("l_quantity").cast("bigint") * (F.col("l_linenumber") - 3)
    return li.select(
        "l_orderkey", "l_linenumber", x.change_label(old, new).alias("label"), F.coalesce(x.implausible(old, new, F.lit(9000)), F.lit("")).alias("reason")
    )


CORRECTION_SQL = """WITH c AS (SELECT l_orderkey, l_linenumber, l_suppkey * 100 AS o, l_suppkey * 100 + CAST(l_quantity AS BIGINT) * (l_linenumber - 3) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN abs(n - o) / greatest(abs(o), 1) < 0.001 THEN 'high' WHEN abs(n - o) / greatest(abs(o), 1) < 0.01 THEN 'medium' ELSE 'low' END AS label,
CASE WHEN n < 0 THEN 'negative' WHEN n > 9000 THEN 'above population' WHEN o > 10 AND abs(n - o) > 0.5 * o THEN 'change above half' ELSE '' END AS reason FROM c"""


def crops(spark, d):
    p = t.load(spark, d, "part")
    left, right = F.col("p_size") / 100, F.col("p_size") / 100 + 0.25
    c = x.crop_fractions(F.col("p_partkey") % 3, left, right, F.lit(0.15))
    return p.select("p_partkey", *[F.round(F.coalesce(c[k], F.lit(-1.0)), 6).alias(k) for k in ("right_frac", "left_frac", "label_right_frac")])


CROP_SQL = """WITH p AS (SELECT p_partkey, p_size / 100 AS l, p_size / 100 + 0.25 AS r, p_partkey % 3 > 0 AND p_size / 100 > 0.10 AS comp FROM part),
q AS (SELECT *, least(1.0, r + CASE WHEN comp THEN 0.03 ELSE 0.10 END) AS w FROM p)
SELECT p_partkey, round(CASE WHEN w < 0.98 THEN w WHEN comp THEN 1.0 ELSE -1.0 END, 6) AS right_frac,
round(CASE WHEN comp THEN greatest(0.0, l - 0.02) ELSE -1.0 END, 6) AS left_frac, CAST(CASE WHEN comp THEN 0.15 ELSE -1.0 END AS DOUBLE) AS label_right_frac FROM q"""


QUERIES = [
    ("age_normalizers", age_normalizers, AGE_SQL),
    ("age_probes", age_probes, PROBE_SQL),
    ("value_parsers", value_parsers, VALUE_SQL),
    ("number_extraction", number_extraction, NUM_SQL),
    ("district_names", district_names, DISTRICT_SQL),
    ("headings", headings, HEAD_SQL),
    ("model_answers", model_answers, ANSWER_SQL),
    ("number_cells", number_cells, NUMBER_SQL),
    ("corrections", corrections, CORRECTION_SQL),
    ("crop_fractions", crops, CROP_SQL),
]
