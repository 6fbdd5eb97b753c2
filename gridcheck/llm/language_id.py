"""Language identification by cross-parsing entropy.

For every language a suffix automaton of a bounded amount of labelled text is
built on the driver. A text is parsed against each automaton into phrases,
each the longest match with the labelled text from where the last one ended;
the language that needs the fewest phrases, normalised by the length of the
text and of the labelled text, wins. All texts of a chunk advance together:
they are cut into segments, and one table lookup per symbol follows the
automaton of one language for every segment at once, as if a phrase began
there. The state in which the segment before ended is then followed over the
border until it meets the state that was followed from there, which it does
after a few symbols; from then on both parses are one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcheck.llm.common import first_rows, map_texts

#: Bounds of the labelled sample for each language: documents, characters of each, symbols in all.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_SYMBOLS = 48, 4000, 16_000
#: Symbols of a text that are parsed side by side with the others; phrases run on over the borders.
SEGMENT = 512
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """The lower-case code point of each letter, 0 for all else; a letter whose lower case is longer keeps its first code point."""
    out = np.zeros(0x110000, np.int32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            out[c] = ord(ch.lower()[0])
    return out


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(_letters())
    return _LETTERS[0]


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters, runs of all else as one 0, of all texts in a row; how many and how many letters in each."""
    sizes = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
    raw = letters()[np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32)]
    owner = np.repeat(np.arange(len(texts)), sizes)
    keep = raw > 0
    keep[1:] |= (raw[:-1] > 0) & (owner[1:] == owner[:-1])
    raw, owner = raw[keep], owner[keep]
    return raw, np.bincount(owner, minlength=len(texts)), np.bincount(owner, weights=raw > 0, minlength=len(texts)).astype(np.int64)


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton whose paths from state 0 spell the substrings of text."""
    link, length, move = [-1], [0], [{}]
    last = 0
    for c in text:
        cur = len(move)
        move.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in move[p]:
            move[p][c] = cur
            p = link[p]
        if p >= 0:
            q = move[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(move)
                move.append(dict(move[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[cur] = clone
                while p >= 0 and move[p].get(c) == q:
                    move[p][c] = clone
                    p = link[p]
        last = cur
    return move


@dataclass
class Parser:
    """Automata as tables. tables[l][state * width + symbol] is twice the
    offset of the next state, plus 1 if the symbol starts a phrase."""

    languages: list[str]
    alphabet: np.ndarray
    tables: list[np.ndarray]
    lengths: list[int]

    @classmethod
    def fit(cls, samples: dict[str, list[int]]) -> Parser:
        """samples: symbols of labelled text by language."""
        found = sorted({c for s in samples.values() for c in s} | {0})
        width = len(found) + 1  # the last symbol stands for letters that no language has
        number = {c: k for k, c in enumerate(found)}
        tables = []
        for language in sorted(samples):
            move = suffix_automaton([number[c] for c in samples[language]])
            table = np.full((len(move), width), -1, np.int64)
            for state, to in enumerate(move):
                for c, nxt in to.items():
                    table[state, c] = 2 * width * nxt
            # A symbol that can't extend the phrase starts the next; one that the language lacks is a phrase alone.
            start = np.maximum(table[0], 0) + 1
            table[1:] = np.where(table[1:] >= 0, table[1:], start)
            table[0] = start
            tables.append(table.ravel().astype(np.int32))
        return cls(sorted(samples), np.array(found, np.int32), tables, [len(samples[k]) for k in sorted(samples)])

    def _numbers(self, raw: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.alphabet, raw), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == raw, at, len(self.alphabet)).astype(np.int32)

    def phrases(self, raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases of every text (rows) in each language (columns)."""
        segments = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(sizes)), segments)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(segments) - segments, segments)
        start = np.repeat(np.cumsum(sizes) - sizes, segments) + nth * SEGMENT
        length = np.minimum(SEGMENT, sizes[owner] - nth * SEGMENT)
        order = np.argsort(-length, kind="stable")
        owner, start, length = owner[order], start[order], length[order]
        out = np.zeros((len(sizes), len(self.tables)), np.int64)
        if not len(owner):
            return out
        code = np.append(self._numbers(raw), np.zeros(SEGMENT, np.int32))
        columns = np.ascontiguousarray(code[start[None, :] + np.arange(length[0])[:, None]])
        live = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
        # The segment before each one in its text, or -1.
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        before = np.where(nth[order] > 0, rank[order - 1], -1)
        for k, table in enumerate(self.tables):
            states = np.zeros((length[0] + 1, len(owner)), np.int32)
            count = np.zeros(len(owner), np.int32)
            for t, n in enumerate(live):
                step = table.take(states[t, :n] + columns[t, :n])
                count[:n] += step & 1
                np.right_shift(step, 1, out=states[t + 1, :n])
            self._join_segments(table, states, columns, length, before, count)
            out[:, k] = np.bincount(owner, weights=count, minlength=len(sizes))
        return out

    @staticmethod
    def _join_segments(table, states, columns, length, before, count) -> None:
        """Correct states and count, of segments that were parsed from state 0, for the states in which the segments before them end."""
        todo = np.flatnonzero(before >= 0)
        while len(todo):
            came = states[length[before[todo]], before[todo]]
            todo, came = todo[came != states[0, todo]], came[came != states[0, todo]]
            ended = states[length[todo], todo].copy()
            at, state, t = todo, came, 0
            while len(at):
                old, new = table.take(states[t, at] + columns[t, at]), table.take(state + columns[t, at])
                count[at] += (new & 1) - (old & 1)
                states[t, at] = state
                state, t = new >> 1, t + 1
                apart = state != states[t, at]
                last = apart & (t == length[at])
                states[t, at[last]] = state[last]
                apart &= ~last
                at, state = at[apart], state[apart]
            # A segment that the new state changed to its end passes another state on.
            moved = np.zeros(len(length), bool)
            moved[todo[states[length[todo], todo] != ended]] = True
            todo = np.flatnonzero((before >= 0) & moved[before])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of each text and a score: its share of the inverse entropies, 0 where there is no letter."""
        raw, sizes, n_letters = symbols(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        bits = self.phrases(raw, sizes) * np.log2(np.maximum(self.lengths, 2)) / np.maximum(sizes, 1)[:, None]
        inverse = 1 / np.maximum(bits, 1e-12)
        best = inverse.argmax(1)
        score = inverse[np.arange(len(texts)), best] / inverse.sum(1)
        some = n_letters > 0
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)], np.where(some, score, 0.0).tolist()


def remainder(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 4


def train(docs: DataFrame, held_out_remainder: int = 2) -> Parser:
    """A parser from at most SAMPLE_DOCS documents of each language, those of
    the lowest hash among the labelled rows whose crc32(doc_id) modulo 4 is
    another; from each a stretch of at most SAMPLE_CHARS characters."""
    known = docs.where(F.col("lang").isNotNull() & (remainder() != held_out_remainder) & (F.length("text") > 0))
    # Documents of ordinary length come first; ids alone are sorted.
    ids = known.select("doc_id", "lang", (F.length("text") < 200).alias("_short"), F.xxhash64("doc_id", F.lit("sample")).alias("_hash"))
    first = Window.partitionBy("lang").orderBy("_short", "_hash", "doc_id")
    likely = first_rows(ids, "lang", F.col("_short"), F.col("_hash"), SAMPLE_DOCS)
    chosen = likely.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= SAMPLE_DOCS)
    nth = {(r["doc_id"], r["lang"]): r["_nth"] for r in chosen.select("doc_id", "lang", "_nth").collect()}
    if not nth:
        return Parser.fit({})
    rows = known.where(F.col("doc_id").isin(sorted({i for i, _ in nth}))).groupBy("doc_id", "lang")
    rows = rows.agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text")).collect()
    samples: dict[str, list[int]] = {}
    for r in sorted((r for r in rows if (r["doc_id"], r["lang"]) in nth), key=lambda r: (r["lang"], nth[r["doc_id"], r["lang"]])):
        raw, _, _ = symbols([r["text"]])
        kept = samples.setdefault(r["lang"], [])
        kept += raw[: SAMPLE_SYMBOLS - len(kept)].tolist()
    return Parser.fit({k: v for k, v in samples.items() if any(v)})


def identify(docs: DataFrame, parser: Parser, keep_text: bool = True) -> DataFrame:
    """docs with lang_pred and score (0 to 1).

    Defined cases: a null text and one without a letter give `und` and 0, as
    does every text if no labelled text was there to learn from; any length is
    read whole; equal texts give equal results; ties go to the language first
    in order; an empty table gives an empty result; other columns pass
    through, and clashing lang_pred or score columns of docs are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(parser)  # bounded by SAMPLE_SYMBOLS for each language

    def make():
        known = shared.value
        return lambda column: known.predict(column.to_pylist())

    return map_texts(docs, make, [("lang_pred", "string"), ("score", "double")], drop=() if keep_text else ("text",))


def digest(docs: DataFrame) -> DataFrame:
    out = identify(docs.select("doc_id", "text"), train(docs.select("doc_id", "text", "lang")), keep_text=False)
    return out.select("doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
