"""Constraints, votes, repairs, merging and sources on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from gridcheck.operators import constraints as c
from gridcheck.operators import merge, repair, solve, vote
from gridcheck.sources import documents, markdown
from gridcheck.streaming import batch_log

WIDE = "table_id bigint, section string, age string, row_ord int, grp string, persons bigint, males bigint, females bigint"


def table(table_id=1, sections=("ALL", "A", "B"), groups=("ALL", "X", "Y"), ages=10, seed=0):
    """A consistent table: the first section and group are sums of the others, the last row a Total."""
    rng = random.Random(seed + table_id)
    leaf = {(s, g, a): (rng.randint(100, 9000), rng.randint(100, 9000)) for s in sections[1:] for g in groups[1:] for a in range(ages)}
    rows = []
    for s in sections:
        for g in groups:
            for a in [*range(ages), "T"]:
                hit = [v for (x, y, z), v in leaf.items() if s in (x, "ALL") and g in (y, "ALL") and a in (z, "T")]
                m, f = sum(v[0] for v in hit), sum(v[1] for v in hit)
                label = "Total" if a == "T" else f"{5 * a}-{5 * a + 5}"
                rows.append((table_id, s, label, ages if a == "T" else a, g, m + f, m, f))
    return rows


def test_checks_of_a_full_table(spark):
    """R rows, G groups, S sections with active cross checks: the published identity, and L4 beside it."""
    rows = table()
    checks = c.evaluate(c.incidence(spark.createDataFrame(rows, WIDE)))
    n = {r.level: r["count"] for r in checks.groupBy("level").count().collect()}
    r, g, s = 11, 3, 3
    assert n == {"L1": r * g * s, "L5": 3 * r * g * s, "L2": 3 * g * s, "L3": 3 * r * s, "L4": 3 * r * g}
    assert checks.where("NOT passed").count() == 0


def test_one_wrong_digit_is_found_and_mended(spark):
    rows = table(7)
    k = next(i for i, r in enumerate(rows) if r[1] == "A" and r[4] == "X" and r[2] == "10-15")
    t, s, a, o, g, p, m, f = rows[k]
    wrong = next(v for change, v in sorted(solve.digit_moves(m).items()) if len(str(v)) == len(str(m)))
    rows[k] = (t, s, a, o, g, p, wrong, f)
    df = spark.createDataFrame(rows, WIDE)
    terms = c.incidence(df)
    checks = c.evaluate(terms)
    assert {r.level for r in checks.where("NOT passed").collect()} >= {"L1", "L2"}
    best = c.blame(terms, checks).orderBy(F.desc("score")).first()
    assert (best.section, best.row_ord, best.grp, best.col) == (s, o, g, "males")
    log = solve.repair_tables(terms).collect()
    assert log[0].after == 0 and any((x.section, x.row_ord, x.grp, x.col, x.new) == (s, o, g, "males", m) for x in log)


def test_incidence_agrees_with_a_plain_loop(spark):
    rng = random.Random(3)
    rows = [(*r[:5], *(None if rng.random() < 0.03 else v + (rng.random() < 0.05) for v in r[5:])) for r in table(3)]
    got = {x.cid: x["diff"] for x in c.evaluate(c.incidence(spark.createDataFrame(rows, WIDE)).where("level = 'L2'")).collect()}
    want = {}
    for s in ("ALL", "A", "B"):
        for g in ("ALL", "X", "Y"):
            for k, col in enumerate(("persons", "males", "females")):
                v = [r[5 + k] for r in rows if r[1] == s and r[4] == g]
                if None not in v:
                    want[f"L2|{s}|{g}|{col}"] = v[-1] - sum(v[:-1])
    assert got == want


def test_subtotals_and_grand_total(spark):
    labels = ["0-1", "1-2", "2-3", "3-4", "4-5", "0-5", "5-10", "Total", "Army", "Grand Total"]
    m = [1, 2, 3, 4, 5, 15, 10, 25, 7, 32]
    rows = [(1, "S", a, k, "ALL", 2 * v, v, v) for k, (a, v) in enumerate(zip(labels, m, strict=True))]
    df = spark.createDataFrame(rows, WIDE)
    kinds = {r.age: (r.kind, r.components, r.after_total) for r in c.row_kinds(df).collect()}
    assert kinds["0-5"] == ("subtotal", ["0-1", "1-2", "2-3", "3-4", "4-5"], False) and kinds["Army"] == ("leaf", None, True)
    checks = c.evaluate(c.incidence(df))
    assert {r.cid.split("|")[-1] for r in checks.where("level = 'L2S'").collect()} == {"0-5", "grandtotal"}
    assert checks.where("NOT passed").count() == 0


def test_inactive_cross_checks_and_tolerances(spark):
    rows = [(t, s, a, o, g, p + 400 * (g == "ALL" and a == "Total"), m, f) for t, s, a, o, g, p, m, f in table(5)]
    levels = {r.level for r in c.incidence(spark.createDataFrame(rows, WIDE)).select("level").distinct().collect()}
    assert "L3" not in levels and "L1" in levels
    shares = spark.createDataFrame([(1, "S", a, k, "ALL", None, v, v) for k, (a, v) in enumerate([("0-5", 300), ("5-10", 299), ("10-15", 404), ("Total", 1000)])], WIDE)
    long, kinds = c.cells(shares), c.row_kinds(shares)
    assert c.evaluate(c.vertical(long, kinds, proportional=True)).where("passed").count() == 2
    assert c.evaluate(c.vertical(long, kinds)).where("passed").count() == 0


def readings(spark, cells):
    rows = [(k, n, v) for k, vs in cells.items() for n, v in enumerate(vs)]
    return spark.createDataFrame(rows, "cell string, reading int, value bigint")


def test_votes(spark):
    r = readings(spark, {"a": [1355867, 1355667, 1350967], "b": [655808, 658857, 658857], "c": [1, 1, 2, 2], "d": [5, None, 9], "e": [1, 1, 3, 3, 2], "f": [488228, 488229, 488223], "g": [None]})
    got = {x.cell: (x.value, x.confidence) for x in vote.majority(r, ["cell"]).collect()}
    assert got == {"a": (1355667, 0.3333), "b": (658857, 0.6667), "c": (1, 0.5), "d": (7, 0.5), "e": (2, 0.2), "f": (488228, 0.3333)}
    r = readings(spark, {"a": [81234, 81224, 81224], "b": [1234, 234], "c": [1355867, 1355667, 1350967], "d": [-5, -5, 5], "e": [0]})
    assert {x.cell: x.value for x in vote.digits(r, ["cell"]).collect()} == {"a": 81224, "b": 1234, "c": 1355867, "d": -5, "e": 0}


def test_best_triple(spark):
    h = lambda xs: spark.createDataFrame([("k", v, n) for v, n in xs], "cell string, value bigint, votes bigint")
    p = h([(1355867, 1), (1355667, 1), (1350967, 1)])
    got = vote.best_triple(p, h([(658857, 2), (655808, 1)]), h([(696810, 2), (700059, 1)]), ["cell"]).first()
    assert (got.p, got.m, got.f, got.score) == (1355667, 658857, 696810, 5)


def test_enforce(spark):
    df = spark.createDataFrame([(1, 169510, 81224, 88285, None, None, None), (2, 100, 60, 50, 0.9, 0.5, 0.5), (3, 100, 60, 50, 0.1, 0.5, 0.9), (4, -7, 3, 4, None, None, None)],
                               "i int, persons bigint, males bigint, females bigint, conf_persons double, conf_males double, conf_females double")
    got = {r.i: (r.field, r.old, r.new, r.label) for r in repair.enforce_rows(df).collect()}
    assert got == {1: ("persons", 169510, 169509, "high"), 2: ("persons", 100, 110, "low"), 3: ("females", 50, 40, "low"), 4: (None, None, None, None)}


def test_swapped_columns_are_put_back(spark):
    rows = table(9)
    bad = [(t, s, a, o, g, p, f, m) if (s, o, g) == ("B", 4, "Y") else (t, s, a, o, g, p, m, f) for t, s, a, o, g, p, m, f in rows]
    log = solve.repair_tables(c.incidence(spark.createDataFrame(bad, WIDE))).collect()
    assert log[0].after == 0 and {x.action for x in log} == {"swap"}


def test_repair_never_raises_the_failures():
    rng = random.Random(5)
    for seed in range(20):
        rows = table(seed, ages=4)
        terms = []
        for t, s, a, o, g, p, m, f in rows:
            p, m, f = (v + rng.choice([0] * 9 + [10, -500, 3000]) for v in (p, m, f))
            terms += [(f"L1|{s}|{o}|{g}", "=", 0, 0, (s, o, g, col), k, v) for col, k, v in (("persons", 1, p), ("males", -1, m), ("females", -1, f))]
            terms += [(f"L2|{s}|{g}|{col}", "=", 0, 0, (s, o, g, col), 1 if a == "Total" else -1, v) for col, v in (("persons", p), ("males", m), ("females", f))]
        board, _, before = solve.repair(terms)
        again = solve.Board([(*x[:6], board.value[x[4]]) for x in terms])
        assert len(board.failing()) == len(again.failing()) <= before


def two_columns(rows):
    """Terms of rows (males, females, true males, true females) and of a last row, their true total."""
    cell = lambda o, col: ("S", o, "G", col)
    out, lines = [], [(o, m, f) for o, (m, f, _, _) in enumerate(rows)] + [(999, sum(r[2] for r in rows), sum(r[3] for r in rows))]
    for o, m, f in lines:
        out += [(f"L1|{o:03}", "=", 0, 0, cell(o, col), k, v) for col, k, v in (("persons", 1, m + f), ("males", -1, m), ("females", -1, f))]
        out += [(f"L2|{col}", "=", 0, 0, cell(o, col), 1 if o == 999 else -1, v) for col, v in (("persons", m + f), ("males", m), ("females", f))]
    return out


def test_pairs_are_tried_behind_many_failures_and_fixes():
    a, b = next((a, b) for a, b in sorted(solve.PAIRS) if 0 < a < b and (b, a) in solve.PAIRS)
    # In the last row males read b for a, females a for b. The males of rows before could be such a misreading too, their females, of a digit 9, not.
    wrong = (1000 + b * 100, 5000 + a * 100, 1000 + a * 100, 5000 + b * 100)
    plain = (1000 + b * 100, 5900, 1000 + b * 100, 5900)
    board, log, before = solve.repair(two_columns([plain, wrong]))
    assert before == 2 and board.failing() == [] and {(x[0], x[1][1]) for x in log} == {("paired", 1)}
    # Seven such rows: the right fix is the eighth.
    board, log, before = solve.repair(two_columns([plain] * 7 + [wrong]))
    assert before == 2 and board.failing() == [] and {(x[0], x[1][1]) for x in log} == {("paired", 7)}
    # Fifty failures before it that nothing settles.
    noise = [(f"L0|{k}", "=", 0, 0, ("N", k, "G", "persons"), 1, 333_333_333 + k) for k in range(50)] + [(f"L0|{k}", "=", 0, 0, ("N", k, "H", "persons"), -1, 2) for k in range(50)]
    board, log, before = solve.repair(noise + two_columns([plain, wrong]))
    assert before == 52 and len(board.failing()) == 50 and {x[0] for x in log} == {"paired"}


def test_rereadings_are_kept_only_if_failures_drop(spark):
    truth = {(r[1], r[3], r[4]): r[5:] for r in table(9)}
    bad = {("A", 2, "X"): (None, 11, 0), ("B", 4, "Y"): (70, 0, -5)}
    rows = [(*r[:5], *(x + d if d is not None else None for x, d in zip(r[5:], bad.get((r[1], r[3], r[4]), (0, 0, 0)), strict=True))) for r in table(9)]
    right, other = truth["A", 2, "X"], truth["A", 3, "X"]
    again = [
        (9, 1, "A", 3, "X", other[0] + 1, *other[1:]),  # breaks what held
        (9, 2, "A", 2, "X", *right),  # fills persons and mends males
        (9, 3, "B", 4, "Y", truth["B", 4, "Y"][0], None, None),  # mends persons alone
        (9, 4, "no", 4, "Y", 1, 2, 3),
        (9, 5, "A", 2, "X", *right),  # nothing new
        (8, 1, "A", 2, "X", *right),  # a table without terms
    ]
    df = spark.createDataFrame(again, "table_id bigint, nth bigint, section string, row_ord int, grp string, persons bigint, males bigint, females bigint")
    got = solve.recheck_tables(c.incidence(spark.createDataFrame(rows, WIDE)), df).collect()
    assert {(x.nth, x.section, x.row_ord, x.grp, x.col, x.old, x.new) for x in got} == {
        (2, "A", 2, "X", "persons", None, right[0]),
        (2, "A", 2, "X", "males", right[1] + 11, right[1]),
        (3, "B", 4, "Y", "persons", truth["B", 4, "Y"][0] + 70, truth["B", 4, "Y"][0]),
    }
    assert all(x.after < x.before for x in got)


def test_ensemble_uses_equations():
    cands = {("a", "persons"): [(30, 3)], ("a", "males"): [(12, 2), (10, 1)], ("a", "females"): [(20, 2), (26, 1)],
             ("b", "persons"): [(7, 3)], ("b", "males"): [(3, 3)], ("b", "females"): [(5, 1), (4, 1), (9, 1)],
             ("total", "persons"): [(37, 3)], ("total", "males"): [(13, 3)], ("total", "females"): [(24, 3)]}
    value, status = solve.ensemble(cands, 3, {"total": ["a", "b"]})
    assert [value["a", x] for x in solve.COLS] == [30, 10, 20] and value["b", "females"] == 4
    assert status["b", "females"] == "deduced" and status["a", "persons"] == "locked"


def test_reconcile_reaches_a_fixed_point():
    cells, conf = {"T": 10, "a": 3, "b": 9, "U": 20, "c": 11}, {"T": 0.9, "a": 0.9, "b": 0.4, "U": 0.9, "c": 0.5}
    log = solve.reconcile(cells, conf, [("U", ["b", "c"]), ("T", ["a", "b"])])
    assert log == [("b", 9, 7), ("c", 11, 13)]


def test_pages(spark):
    pages = [(1, 1, "Unmarried", False, 0, 3), (1, 2, "Total", False, 4, 6), (1, 3, "Total", False, 7, 9), (1, 4, "Total", True, 10, 12), (1, 5, "Total", False, 0, 3), (1, 6, "Married", False, 4, 6)]
    df = spark.createDataFrame(pages, "t int, page_no int, cond string, marked boolean, lo int, hi int")
    got = [r.condition for r in merge.continue_conditions(df, ["t"]).orderBy("page_no").collect()]
    assert got == ["Unmarried"] * 3 + ["Total", "Married", "Married"]
    rows = spark.createDataFrame([(1, 1, 0, "1 Bangalore"), (1, 2, 0, None), (1, 2, 1, "null"), (1, 1, 1, "")], "t int, page_no int, pos int, name string")
    assert sorted(r.district for r in merge.positional_names(rows, ["t"]).collect()) == ["Bangalore", "Bangalore", "_row_1", "_row_1"]


def test_districts(spark):
    p = spark.createDataFrame([("g", n) for n in ("Naga Hills", "Cachar", "Mysore City", "Zed")], "g string, name string")
    t = spark.createDataFrame([("g", n) for n in ("Naga", "Cachar Plains", "Mysore", "Mys")], "g string, name string")
    got = {r.name: (r.match, r.how) for r in merge.match_districts(p, t, ["g"]).collect()}
    assert got == {"Naga Hills": ("Naga", "equal"), "Cachar": ("Cachar Plains", "equal"), "Mysore City": ("Mysore", "contained")}


MD = """Title 1,000 of each sex
| x | y |
| --- | --- |

| Age. | POPULATION | | | UNMARRIED | | |
| | Persons. | Males. | Females. | Persons. | Males. | Females. |
| --- | --- | --- | --- | --- | --- | --- |
| 1 | 2 | 3 | 4 | 5 | 6 | 7 |
| All Religions | | | | | | |
| 0 — 5 | 1,384·8 | 700 | 685 | .. | 3 | x |
| Total | 1,000 | 400 | 600 | 300 | 100 | 200 |
| 1. Hindu | 900 | 400 | 500 | 300 | 100 | 200 |
| 0-5 | 900 | 400 | 500 | 300 | 100 | 200 |
end"""


def test_markdown(spark):
    df = spark.createDataFrame([(1, MD), (2, "none"), (3, None)], "i int, text string")
    got = [tuple(r)[1:] for r in markdown.read_tables(df, "i").orderBy("sec_ord", "row_ord", "grp").collect()]
    assert got[:2] == [("All Religions", 1, "0 — 5", 1, "POPULATION", 1385, 700, 685), ("All Religions", 1, "0 — 5", 1, "UNMARRIED", 0, 3, None)]
    assert [g[:4] for g in got[4:]] == [("Hindu", 2, "Total", 1)] * 2 + [("Hindu", 2, "0-5", 2)] * 2 and len(got) == 8
    assert markdown.parse_quality(markdown.read_tables(df, "i"), ["i"]).first().usable


def test_sinks_and_log(spark, tmp_path):
    obs = spark.createDataFrame([(1, "S", "0-5", 0, "X", 3, 1, 2), (1, "S", "Total", 1, "X", 3, 1, 2)], WIDE)
    documents.write_tidy(obs, str(tmp_path / "csv"))
    assert documents.tidy(spark, str(tmp_path / "csv")).count() == 2
    documents.write_combined(obs.withColumn("source_image", F.lit("a.png")), str(tmp_path / "all"))
    assert spark.read.parquet(str(tmp_path / "all")).where("source_image = 'a.png'").count() == 2
    log = spark.createDataFrame([("a", "perfect", 5, 0), ("b", "has_failures", 7, 2)], "image string, status string, checks int, failures int")
    documents.append_log(log, str(tmp_path / "log"))
    documents.append_log(log.limit(1), str(tmp_path / "log"))
    assert documents.batch_log(spark, str(tmp_path / "log")).count() == 3
    query = batch_log.start(batch_log.status_windows(batch_log.read_log(spark, str(tmp_path / "log"))), "statuses", str(tmp_path / "chk"))
    query.processAllAvailable()
    query.stop()
    assert {(r.status, r.items) for r in spark.sql("SELECT status, sum(items) AS items FROM statuses GROUP BY status").collect()} == {("perfect", 2), ("has_failures", 1)}
    (tmp_path / "img" / "p").mkdir(parents=True)
    (tmp_path / "img" / "p" / "a.png").write_bytes(b"1")
    (tmp_path / "img" / "b.txt").write_bytes(b"2")
    assert documents.images(spark, str(tmp_path / "img")).count() == 1


@pytest.mark.parametrize("wrapped", [False, True])
def test_row_answers(spark, wrapped):
    body = '[{"age":"0-5","persons":1}]'
    raw = spark.createDataFrame([('{"rows": ' + body + "}" if wrapped else "```\n" + body + "\n```",)], "text string")
    assert documents.parse_rows(raw, "age string, persons bigint").first().rows[0].persons == 1
