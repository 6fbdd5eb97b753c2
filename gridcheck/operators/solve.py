"""Per-table search: what a join and an aggregation can't express.

The kernels are plain Python over lists and dicts, one table at a time, and
run inside applyInPandas grouped by table. A trial of a change touches only
the constraints that hold the changed cells: their residuals move by
coefficient * change, so its cost is the degree of the cell, not the table.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcheck.functions.text import CONFUSED

ROUNDS, STEPS = 3, 50
PAIRS = {(int(p[0]), int(p[1])) for p in CONFUSED}


def digit_moves(value: int) -> dict[int, int]:
    """New values, by the change of magnitude, of one confusable digit."""
    size, out = abs(value), {}
    for place, ch in enumerate(reversed(str(size))):
        for other in range(10):
            if (int(ch), other) in PAIRS:
                change = (other - int(ch)) * 10**place
                out[change] = size + change if value >= 0 else -(size + change)
    return out


class Board:
    """The cells and constraints of one table."""

    def __init__(self, terms: list[tuple]):
        """terms: (cid, op, rhs, tol, cell, coef, value)."""
        self.value: dict = {}
        self.of_cell: dict = defaultdict(list)
        self.members: dict = defaultdict(list)
        self.rule: dict = {}
        for cid, op, rhs, tol, cell, coef, value in terms:
            self.value[cell] = value
            self.of_cell[cell].append((cid, coef))
            self.members[cid].append((cell, coef))
            self.rule[cid] = (op, rhs, tol)
        self.residual = {}
        for cid, cells in self.members.items():
            if cid.split("|")[0] not in ("L5", "KT") and len({k > 0 for _, k in cells}) < 2:
                continue
            values = [(self.value[c], k) for c, k in cells]
            if all(v is not None for v, _ in values):
                self.residual[cid] = sum(k * v for v, k in values) - self.rule[cid][1]

    def fails(self, cid, residual) -> bool:
        op, _, tol = self.rule[cid]
        return residual < 0 if op == ">=" else abs(residual) > tol

    def failing(self, level: str | None = None) -> list:
        return [c for c, r in self.residual.items() if (level is None or c.split("|")[0] == level) and self.fails(c, r)]

    def gain(self, change: dict) -> int:
        """By how many the failures would drop if change {cell: new value} were made."""
        moved: dict = defaultdict(int)
        for cell, new in change.items():
            for cid, coef in self.of_cell[cell]:
                if cid in self.residual:
                    moved[cid] += coef * (new - self.value[cell])
        return sum(self.fails(c, self.residual[c]) - self.fails(c, self.residual[c] + d) for c, d in moved.items())

    def apply(self, change: dict) -> None:
        for cell, new in change.items():
            for cid, coef in self.of_cell[cell]:
                if cid in self.residual:
                    self.residual[cid] += coef * (new - self.value[cell])
            self.value[cell] = new

    def row(self, cell):
        return [(*cell[:-1], col) for col in ("persons", "males", "females")]


def swaps(board: Board):
    """Rows whose males and females change places, in all groups of a row or in one."""
    rows = sorted({c[:-1] for c in board.value}, key=str)
    by_line: dict = defaultdict(list)
    marked = {c for cid in board.failing() for c, _ in board.members[cid]}
    for r in rows:
        if any((*r, col) in marked for col in ("males", "females")):
            by_line[r[:2]].append(r)
    for group in [*by_line.values(), *[[r] for rs in by_line.values() for r in rs]]:
        change = {}
        for r in group:
            m, f = (*r, "males"), (*r, "females")
            if board.value.get(m) is not None and board.value.get(f) is not None and board.value[m] != board.value[f]:
                change |= {m: board.value[f], f: board.value[m]}
        if change:
            yield "swap", change


def single_digits(board: Board):
    """For each failure, each of its cells: the one digit that would settle it, alone and with the row's persons."""
    for cid in board.failing():
        if board.rule[cid][0] != "=":
            continue
        for cell, coef in board.members[cid]:
            value = board.value[cell]
            change = -board.residual[cid] * coef
            new = digit_moves(value).get(change if value >= 0 else -change)
            if new is None:
                continue
            yield "digit", {cell: new}
            p = board.row(cell)[0]
            if cell[-1] != "persons" and board.value.get(p) is not None:
                yield "digit_with_persons", {cell: new, p: board.value[p] + new - value}


def with_total(board: Board, first: str = "ALL"):
    """A digit of a part and the same change of the total group's cell, whose own sum hid it; persons of both follow."""
    for cid in board.failing():
        if board.rule[cid][0] != "=":
            continue
        for cell, coef in board.members[cid]:
            section, row_ord, grp, col = cell
            whole = (section, row_ord, first, col)
            value = board.value[cell]
            new = digit_moves(value).get(-board.residual[cid] * coef * (1 if value >= 0 else -1))
            if new is None or grp == first or board.value.get(whole) is None:
                continue
            change = {cell: new, whole: board.value[whole] + new - value}
            yield "digit_with_total", change
            persons = [board.row(x)[0] for x in change]
            if col != "persons" and all(board.value.get(p) is not None for p in persons):
                yield "digit_with_totals", change | {p: board.value[p] + new - value for p in persons}


def negatives(board: Board):
    for cid in board.failing("L5"):
        for cell, _ in board.members[cid]:
            yield "sign", {cell: abs(board.value[cell])}


def paired_digits(board: Board):
    """Two cells of two failures of one size that settle them together."""
    failing = [c for c in board.failing() if board.rule[c][0] == "="]
    alike: dict = defaultdict(list)
    for cid in failing:
        alike[abs(board.residual[cid])].append(cid)
    fixes: dict = {}
    for cid in failing:
        if len(alike[abs(board.residual[cid])]) < 2:
            continue
        fixes[cid] = []
        for cell, coef in board.members[cid]:
            v, change = board.value[cell], -board.residual[cid] * coef
            new = digit_moves(v).get(change if v >= 0 else -change)
            if new is not None:
                fixes[cid].append((cell, new))
    place: dict = defaultdict(int)
    for a in failing:
        size = abs(board.residual[a])
        place[size] += 1
        for b in alike[size][place[size] :]:
            for (x, nx), (y, ny) in product(fixes[a], fixes[b]):
                if x != y:
                    yield "paired", {x: nx, y: ny}


def two_digits(board: Board):
    for cid in board.failing():
        if board.rule[cid][0] != "=":
            continue
        for cell, coef in board.members[cid]:
            v = board.value[cell]
            need = -board.residual[cid] * coef * (1 if v >= 0 else -1)
            one = digit_moves(abs(v))
            for change, size in one.items():
                second = digit_moves(size).get(need - change)
                if second is not None and second != abs(v):
                    yield "two_digits", {cell: second if v >= 0 else -second}
                    break


def rebalance(board: Board):
    """persons := males + females, as a last resort."""
    for cid in board.failing("L1"):
        p, m, f = board.row(board.members[cid][0][0])
        yield "persons", {p: board.value[m] + board.value[f]}


STRATEGIES = (negatives, swaps, single_digits, paired_digits, with_total, two_digits, rebalance)


def repair(terms: list[tuple]) -> tuple[Board, list[tuple], int]:
    """Greedy cascade: the first change that strictly lowers the failures is made, and the strategies start over."""
    board = Board(terms)
    before, log = len(board.failing()), []
    for _ in range(ROUNDS):
        changed = False
        for strategy in STRATEGIES:
            for _ in range(STEPS):
                hit = next(((kind, ch) for kind, ch in strategy(board) if board.gain(ch) > 0), None)
                if hit is None:
                    break
                kind, change = hit
                log += [(kind, cell, board.value[cell], new) for cell, new in change.items()]
                board.apply(change)
                changed = True
        if not changed or not board.failing():
            break
    return board, log, before


def repair_tables(terms: DataFrame) -> DataFrame:
    """The log of repair() for every table of an incidence with values."""

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["cid", "section", "row_ord", "grp", "col"])
        rows = [
            (r.cid, r.op, int(r.rhs), int(r.tol), (r.section, int(r.row_ord), r.grp, r.col), int(r.coef), None if pd.isna(r.value) else int(r.value))
            for r in pdf.itertuples()
        ]
        board, log, before = repair(rows)
        out = [(int(pdf.table_id.iloc[0]), step, k, *cell, old, new, before, len(board.failing())) for step, (k, cell, old, new) in enumerate(log)]
        out = out or [(int(pdf.table_id.iloc[0]), 0, "none", None, None, None, None, None, None, before, before)]
        return pd.DataFrame(out, columns=["table_id", "step", "action", "section", "row_ord", "grp", "col", "old", "new", "before", "after"]).astype({"row_ord": "Int32", "old": "Int64", "new": "Int64"})

    return terms.groupBy("table_id").applyInPandas(
        run, "table_id long, step int, action string, section string, row_ord int, grp string, col string, old long, new long, before long, after long"
    )


COLS = ("persons", "males", "females")


def recheck(terms: list[tuple], readings: list[dict]) -> tuple[Board, list[tuple], int]:
    """Re-readings {cell: value} in order: each is put in and kept only if the failures drop. Null and unknown cells stay as they are."""
    board = Board(terms)
    before, log = len(board.failing()), []
    for k, reading in enumerate(readings):
        change = {c: v for c, v in reading.items() if v is not None and c in board.value and v != board.value[c]}
        trial = board
        if any(board.value[c] is None for c in change):
            # A filled cell brings in constraints that weren't counted.
            trial = Board([(*t[:6], change.get(t[4], board.value[t[4]])) for t in terms])
            gain = len(board.failing()) - len(trial.failing())
        else:
            gain = board.gain(change)
        if gain > 0:
            log += [(k, cell, board.value[cell], new) for cell, new in change.items()]
            if trial is board:
                board.apply(change)
            board = trial
    return board, log, before


def recheck_tables(terms: DataFrame, readings: DataFrame) -> DataFrame:
    """The kept cells of re-readings (table_id, nth, section, row_ord, grp, persons, males, females), tried in the order of nth
    and then of their keys and values, for every table of an incidence with values."""
    key = ["section", "row_ord", "grp"]

    def run(left, right):
        import pandas as pd

        number = lambda v: None if pd.isna(v) else int(v)
        rows = [
            (r.cid, r.op, int(r.rhs), int(r.tol), (r.section, int(r.row_ord), r.grp, r.col), int(r.coef), number(r.value))
            for r in left.sort_values(["cid", *key, "col"]).itertuples()
        ]
        again = right.dropna(subset=["row_ord"]).sort_values(["nth", *key, *COLS]).to_dict("records")
        board, log, before = recheck(rows, [{(r["section"], int(r["row_ord"]), r["grp"], c): number(r[c]) for c in COLS} for r in again])
        out = [(int(again[k]["table_id"]), number(again[k]["nth"]), *cell, old, new, before, len(board.failing())) for k, cell, old, new in log]
        out = pd.DataFrame(out, columns=["table_id", "nth", *key, "col", "old", "new", "before", "after"])
        return out.astype({"nth": "Int64", "row_ord": "Int32", "old": "Int64", "new": "Int64"})

    return terms.groupBy("table_id").cogroup(readings.groupBy("table_id")).applyInPandas(
        run, "table_id long, nth long, section string, row_ord int, grp string, col string, old long, new long, before long, after long"
    )


def ensemble(candidates: dict, n_readings: int, groups: dict[str, list[str]], known: dict | None = None) -> tuple[dict, dict]:
    """Values and statuses of the cells (age, col) of one group of columns.

    candidates: {cell: [(value, votes), ...] by rank}. Known totals and
    settled votes are locked; equations of rows (P = M + F) and of groups
    (total = parts) then deduce what they can, to a fixed point; totals that
    are known choose among the two best candidates of each open part by a
    subset-sum over votes; what is left takes the exact triple or pair of
    most votes, else the most popular value.
    """
    value: dict = {}
    status: dict = {}
    for cell, v in (known or {}).items():
        value[cell], status[cell] = v, "locked"
    for cell, cands in candidates.items():
        if cell in value or not cands:
            continue
        present = sum(n for _, n in cands)
        v, n = cands[0]
        if (n == n_readings == present) or 4 * n >= 3 * present:
            value[cell], status[cell] = v, "locked"
    ages = list(dict.fromkeys(a for a, _ in candidates))

    def propagate():
        moved = True
        while moved:
            moved = False
            for a in ages:
                p, m, f = ((a, c) for c in COLS)
                for target, how in ((p, lambda: value[m] + value[f]), (m, lambda: value[p] - value[f]), (f, lambda: value[p] - value[m])):
                    if target not in value and all(x in value for x in (p, m, f) if x != target) and how() >= 0:
                        value[target], status[target], moved = how(), "deduced", True
            for total, parts in groups.items():
                for c in COLS:
                    cells = [(q, c) for q in parts]
                    gaps = [x for x in cells if x not in value]
                    if not gaps and (total, c) not in value:
                        value[total, c], status[total, c], moved = sum(value[x] for x in cells), "deduced", True
                    elif len(gaps) == 1 and (total, c) in value:
                        v = value[total, c] - sum(value[x] for x in cells if x in value)
                        if v >= 0:
                            value[gaps[0]], status[gaps[0]], moved = v, "deduced", True

    propagate()
    for total, parts in groups.items():
        for c in COLS:
            gaps = [(q, c) for q in parts if (q, c) not in value]
            if (total, c) not in value or not gaps:
                continue
            need = value[total, c] - sum(value[q, c] for q in parts if (q, c) in value)
            best = {0: (0, ())}
            for cell in gaps:
                step: dict = {}
                for s, (votes, picks) in best.items():
                    for v, n in candidates.get(cell, [])[:2]:
                        if s + v <= need and (s + v not in step or votes + n > step[s + v][0]):
                            step[s + v] = (votes + n, (*picks, v))
                best = step
            if need in best:
                for cell, v in zip(gaps, best[need][1], strict=True):
                    value[cell], status[cell] = v, "combined"
    propagate()
    for a in ages:
        p, m, f = ((a, c) for c in COLS)
        open_ = [x for x in (p, m, f) if x not in value]
        if not open_:
            continue
        options = [[(value[x], 0)] if x in value else candidates.get(x, []) for x in (p, m, f)]
        exact = [(n1 + n2 + n3, -i, (v1, v2, v3)) for i, ((v1, n1), (v2, n2), (v3, n3)) in enumerate(product(*options)) if v1 == v2 + v3]
        for k, x in enumerate((p, m, f)):
            if x in open_ and exact:
                value[x], status[x] = max(exact)[2][k], "triple"
            elif x in open_ and candidates.get(x):
                value[x], status[x] = candidates[x][0][0], "popular"
    return value, status


def ensemble_tables(hist: DataFrame, n_readings: int, total: str = "total") -> DataFrame:
    """ensemble() for each (table_id, section, grp) of a candidate histogram (age_norm, row_ord, col, value, votes, rank)."""

    def run(pdf):
        import pandas as pd

        cands: dict = defaultdict(list)
        for r in pdf.sort_values(["row_ord", "col", "rank"]).itertuples():
            cands[r.age_norm, r.col].append((int(r.value), int(r.votes)))
        ages = list(dict.fromkeys(a for a, _ in cands))
        groups = {total: [a for a in ages if a != total]} if total in ages else {}
        value, status = ensemble(cands, n_readings, groups)
        key = [pdf[k].iloc[0] for k in ("table_id", "section", "grp")]
        return pd.DataFrame([(*key, a, c, v, status[a, c]) for (a, c), v in value.items()], columns=["table_id", "section", "grp", "age_norm", "col", "value", "status"])

    return hist.groupBy("table_id", "section", "grp").applyInPandas(run, "table_id long, section string, grp string, age_norm string, col string, value long, status string")


def reconcile(cells: dict, conf: dict, equations: list[tuple], threshold: float = 0.75, rounds: int = 10) -> list[tuple]:
    """Confidence deduction to a fixed point over equations (total, parts):
    the only weak cell of an equation takes the value that the others imply
    and is strong from then on. Returns (cell, old, new)."""
    log = []
    for _ in range(rounds):
        moved = False
        for total, parts in equations:
            members = [total, *parts]
            if any(cells.get(x) is None for x in members) or cells[total] == sum(cells[x] for x in parts):
                continue
            weak = [x for x in members if conf.get(x, 0.5) < threshold]
            if len(weak) != 1:
                continue
            x = weak[0]
            new = sum(cells[q] for q in parts) if x == total else cells[total] - sum(cells[q] for q in parts if q != x)
            if new >= 0:
                log.append((x, cells[x], new))
                cells[x], conf[x], moved = new, threshold, True
        if not moved:
            break
    return log


def reconcile_tables(long: DataFrame, first: str = "ALL", rows: bool = False) -> DataFrame:
    """reconcile() across groups for every table of (table_id, section, row_ord, grp, col, value, conf); with rows, also
    by persons = males + females, so that what one equation settles serves the others."""

    def run(pdf):
        import pandas as pd

        cells, conf, lines = {}, {}, defaultdict(list)
        for r in pdf.sort_values(["section", "row_ord", "col", "grp"]).itertuples():
            cell = (r.section, int(r.row_ord), r.col, r.grp)
            cells[cell] = None if pd.isna(r.value) else int(r.value)
            conf[cell] = float(r.conf)
            lines[cell[:3]].append(cell)
        equations = [(next(x for x in xs if x[3] == first), [x for x in xs if x[3] != first]) for xs in lines.values() if any(x[3] == first for x in xs)]
        if rows:
            places = dict.fromkeys((s, n, g) for s, n, _, g in cells)
            equations += [((s, n, "persons", g), [(s, n, "males", g), (s, n, "females", g)]) for s, n, g in places]
        log = reconcile(cells, conf, equations)
        return pd.DataFrame([(int(pdf.table_id.iloc[0]), *x, old, new) for x, old, new in log], columns=["table_id", "section", "row_ord", "col", "grp", "old", "new"])

    return long.groupBy("table_id").applyInPandas(run, "table_id long, section string, row_ord int, col string, grp string, old long, new long")
