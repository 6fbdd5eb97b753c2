"""Quality rules: base counts, then a linear-chain CRF over the lines.

Each line of a text is an observation with a few numeric features; Viterbi
decoding marks it content or boilerplate, and the share of the words'
characters that stand in content lines decides whether the document stays.
The CRF is fitted on the driver from a bounded sample of labelled documents;
everything else works on whole texts, a chunk of documents at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcheck.llm.common import first_rows, map_texts, trim_driver
from gridcheck.llm.wordhash import IS_SPACE, Texts, mix, windows

#: Bounds of the training sample: documents of either quality, characters and lines of each.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_LINES = 300, 20_000, 1000
MIN_WORDS, MAX_REPEATED_PERCENT, MIN_CONTENT = 10, 20, 0.5
REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"

SPACE, UPPER, LOWER, DIGIT, SYMBOL, PIPE, SHOUT, STOP, OTHER, LEAD, TAIL = range(11)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[IS_SPACE] = SPACE
CLASS[65:91], CLASS[97:123], CLASS[48:58] = UPPER, LOWER, DIGIT
CLASS[list(SYMBOLS)] = SYMBOL
CLASS[list(b"|")] = PIPE
CLASS[list(b"!")] = SHOUT
CLASS[list(b".,;:?")] = STOP
CLASS[0x80:0xC0], CLASS[0xC0:] = TAIL, LEAD
N_FEATURES = 14


def _repeated(key: np.ndarray) -> np.ndarray:
    """Which entries occur twice or more."""
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(key), bool)
    return twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key


@dataclass
class Lines:
    """Base counts per text, and features and weight of each line."""

    base: dict[str, np.ndarray]
    per_text: np.ndarray
    features: np.ndarray
    chars: np.ndarray


def describe(texts: Texts) -> Lines:
    data, offsets, n = texts.data, texts.offsets, texts.n
    breaks = np.flatnonzero(data == 10)
    per_text = texts.per_text(breaks) + 1
    # Line k of the chunk: the first of a text starts at its offset, the others after a break.
    first = np.cumsum(per_text) - per_text
    start = np.zeros(int(per_text.sum()), np.int64)
    later = np.ones(len(start), bool)
    later[first] = False
    start[first], start[later] = offsets[:-1], breaks + 1
    end = np.empty_like(start)
    last = np.zeros(len(start), bool)
    last[first + per_text - 1] = True
    end[last], end[~last] = offsets[1:], breaks
    text_of_line = np.repeat(np.arange(n), per_text)
    # The break at the end of a line is counted with it, as space.
    length = np.diff(np.append(start, len(data)))
    owner = np.repeat(np.arange(len(start)), length)
    found = np.bincount(owner * 11 + CLASS[data], minlength=11 * len(start)).reshape(-1, 11)
    chars = found[:, 1:TAIL].sum(1)
    w_start, w_end = texts.words()
    line_of_word = owner[w_start] if len(w_start) else np.zeros(0, np.int64)
    n_words_line = np.bincount(line_of_word, minlength=len(start))
    words = texts.per_text(w_start)
    text_of_word = np.repeat(np.arange(n), words)
    at, key = windows(texts.hashes(w_start, w_end), words, REPEAT_WINDOW)
    again = np.zeros(len(w_start), bool)
    if len(at):
        hit = at[_repeated(mix(key + text_of_word[at].astype(np.uint64)))]
        for k in range(REPEAT_WINDOW):
            again[hit + k] = True
    solid = np.flatnonzero(n_words_line > 0)
    line_key = mix(texts.hashes(start[solid], end[solid]) + text_of_line[solid].astype(np.uint64))
    order = np.argsort(line_key, kind="stable")
    dup = np.zeros(len(start), bool)
    dup[solid[order[1:]]] = line_key[order[1:]] == line_key[order[:-1]]
    again_line = np.bincount(line_of_word[again], minlength=len(start))
    per = lambda x: np.bincount(text_of_line, weights=x, minlength=n).astype(np.int64)
    base = {
        "n_words": words.astype(np.int64),
        "word_chars": per(chars),
        "n_symbols": per(found[:, SYMBOL] + found[:, PIPE]),
        "n_dup_lines": per(dup),
        "n_repeat_words": per(again_line),
    }
    c, w = np.maximum(chars, 1), np.maximum(n_words_line, 1)
    letters = found[:, UPPER] + found[:, LOWER] + found[:, LEAD]
    head = np.where(n_words_line > 0, CLASS[data[np.minimum(start, max(len(data) - 1, 0))]] if len(data) else 0, SPACE)
    foot = CLASS[data[np.maximum(end - 1, 0)]] if len(data) else np.zeros(len(start), np.uint8)
    features = np.stack(
        [
            np.ones(len(start)),
            np.log1p(n_words_line) / 4,
            found[:, SYMBOL] / w,
            found[:, PIPE] / w,
            found[:, SHOUT] / w,
            found[:, STOP] / w,
            found[:, UPPER] / np.maximum(letters, 1),
            found[:, DIGIT] / c,
            letters / c,
            np.minimum(c / w, 40) / 10,
            (head == UPPER) | (head == LEAD),
            (foot == STOP) & (n_words_line > 0),
            dup,
            again_line / w,
        ],
        axis=1,
    )
    return Lines(base, per_text, features, chars)


@dataclass
class ChainCRF:
    """Two labels, 0 boilerplate and 1 content. weight scores label 1 against
    label 0; move[a, b] scores label b after label a."""

    weight: np.ndarray
    move: np.ndarray

    def viterbi(self, features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """The best labelling of each text's lines; all texts advance together, line by line."""
        score = features @ self.weight
        out = np.zeros(len(score), np.int8)
        order = np.argsort(-per_text, kind="stable")
        size = per_text[order]
        first = (np.cumsum(per_text) - per_text)[order]
        live = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right") if len(size) else []
        zero, one = np.zeros(len(size)), np.zeros(len(size))
        back = np.zeros((len(score), 2), bool)
        m = self.move
        for t, k in enumerate(live):
            at = first[:k] + t
            if t:
                stay0, from1 = zero[:k] + m[0, 0], one[:k] + m[1, 0]
                from0, stay1 = zero[:k] + m[0, 1], one[:k] + m[1, 1]
                back[at, 0], back[at, 1] = from1 > stay0, stay1 >= from0
                zero[:k], one[:k] = np.maximum(stay0, from1), np.maximum(from0, stay1)
            one[:k] += score[at]
        label = one >= zero
        for t in range(len(live) - 1, -1, -1):
            k = live[t]
            at = first[:k] + t
            out[at] = label[:k]
            if t:
                label[:k] = np.where(label[:k], back[at, 1], back[at, 0])
        return out


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 300) -> np.ndarray:
    w = np.zeros(x.shape[1])
    balance = np.where(y, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ ((p - y) * balance) / len(y) + 1e-3 * w
        h = (x * (p * (1 - p) * balance)[:, None]).T @ x / len(y) + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(features: np.ndarray, per_text: np.ndarray, good: np.ndarray, steps: int = 80) -> ChainCRF:
    """A CRF from texts whose quality as a whole is known.

    A poor text holds ordinary lines too: a plain logistic model of single
    lines first says which of its lines look like those of good texts; the
    chain is then fitted to these labels by its log-likelihood.
    """
    if not len(good) or good.all() or not good.any():
        return ChainCRF(np.eye(1, features.shape[1])[0], np.zeros((2, 2)))
    line_good = np.repeat(good, per_text)
    plain = _logistic(features, line_good)
    label = line_good | (features @ plain > 0)
    # Texts advance together, line by line, the longest first; all lines lie in flat arrays, nothing is padded.
    order = np.argsort(-per_text, kind="stable")
    size, first = per_text[order], (np.cumsum(per_text) - per_text)[order]
    live = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
    inner = np.ones(len(label), bool)  # lines with another of their text after them
    inner[first + size - 1] = False
    at = np.flatnonzero(inner)
    counted = np.bincount(2 * label[at] + label[at + 1], minlength=4).reshape(2, 2)
    w, m = plain.copy(), np.zeros((2, 2))
    moved_w, moved_m, seen_w, seen_m = np.zeros_like(w), np.zeros_like(m), np.zeros_like(w), np.zeros_like(m)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    node, alpha, beta = (np.zeros((len(label), 2)) for _ in range(3))
    for step in range(1, steps + 1):
        node[:, 1] = features @ w
        alpha[first] = node[first]
        for t, k in enumerate(live[1:], 1):
            here = first[:k] + t
            alpha[here] = node[here] + np.logaddexp(alpha[here - 1, :1] + m[0], alpha[here - 1, 1:] + m[1])
        beta[first + size - 1] = 0
        for t in range(len(live) - 2, -1, -1):
            here = first[: live[t + 1]] + t
            right = node[here + 1] + beta[here + 1]
            beta[here] = np.logaddexp(right[:, :1] + m[:, 0], right[:, 1:] + m[:, 1])
        end = np.cumsum(per_text) - 1
        z = np.logaddexp(alpha[end, 0], alpha[end, 1])[owner]
        p1 = np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - z, 0))
        joint = alpha[at][:, :, None] + m + (node + beta)[at + 1][:, None, :] - z[at][:, None, None]
        expected = np.exp(np.minimum(joint, 0)).sum(0)
        g_w = features.T @ (p1 - label) / len(label) + 1e-4 * w
        g_m = (expected - counted) / len(label) + 1e-3 * m
        for value, g, first_, second in ((w, g_w, moved_w, seen_w), (m, g_m, moved_m, seen_m)):
            first_ += 0.1 * (g - first_)
            second += 0.01 * (g * g - second)
            value -= 0.1 * (first_ / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return ChainCRF(w, m)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_DOCS, max_chars: int = SAMPLE_CHARS, max_lines: int = SAMPLE_LINES) -> ChainCRF:
    """fit() on at most per_class documents of either quality, those of the
    lowest hash of doc_id among the ones of at most max_chars characters and
    max_lines lines.

    Defined cases: without labels, or with labels of one quality only, the
    CRF marks every line content; of several labels of a document the least
    counts, of several texts of a doc_id the least; labels other than 0 and
    1, null doc_ids and null texts aren't learnt from; of documents whose
    hashes are equal the lower doc_id comes first.
    """
    import pyarrow as pa

    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    fits = (F.length("text") <= max_chars) & (F.regexp_count("text", F.lit("\n")) < max_lines) & F.col("doc_id").isNotNull()
    sized = docs.where(fits).select("doc_id")
    hashed = F.xxhash64("doc_id")
    order = Window.partitionBy("quality").orderBy(hashed, "doc_id")
    likely = first_rows(known.join(sized.distinct(), "doc_id"), "quality", F.lit(False), hashed, per_class)
    chosen = likely.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= per_class)
    ids = {r["doc_id"]: r["quality"] for r in chosen.select("doc_id", "quality").collect()}  # 2 * per_class at most
    if not ids:
        return fit(np.zeros((0, N_FEATURES)), np.zeros(0, np.int64), np.zeros(0, bool))
    one_each = docs.where(F.col("doc_id").isin(list(ids)) & fits).groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = sorted((r["doc_id"], r["text"]) for r in one_each.collect())
    lines = describe(Texts(pa.array([t for _, t in rows], pa.large_string())))
    crf = fit(lines.features, lines.per_text, np.array([ids[i] == 1 for i, _ in rows]))
    del rows, one_each, lines
    trim_driver(docs.sparkSession)
    return crf


FIELDS = [(k, "long") for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    ("content_chars", "long"),
    ("base_failed", "boolean"),
    ("kept", "boolean"),
]


def judge(lines: Lines, crf: ChainCRF) -> list[np.ndarray]:
    """The columns of FIELDS."""
    base = lines.base
    content = crf.viterbi(lines.features, lines.per_text)
    owner = np.repeat(np.arange(len(lines.per_text)), lines.per_text)
    chars = np.bincount(owner, weights=lines.chars * content, minlength=len(lines.per_text)).astype(np.int64)
    failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEATED_PERCENT * base["n_words"])
    return [*base.values(), chars, failed, ~failed & (chars >= MIN_CONTENT * base["word_chars"])]


def rate(docs: DataFrame, crf: ChainCRF, keep_text: bool = True) -> DataFrame:
    """docs with the columns of FIELDS.

    content_chars: characters of words in lines that the CRF marks content;
    kept: the base counts don't fail and content holds at least half of all.

    Defined cases: a null or empty text has one empty line and no words, so
    base_failed is true; any length is read whole; equal rows give equal
    results; an empty table gives an empty result; other columns pass
    through, and those of docs with the name of a field are replaced.
    """

    def make():
        return lambda column: judge(describe(Texts(column)), crf)

    return map_texts(docs, make, FIELDS, drop=() if keep_text else ("text",))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    narrow = docs.select("doc_id", "text")
    return rate(narrow, train(narrow, labels), keep_text=False)
