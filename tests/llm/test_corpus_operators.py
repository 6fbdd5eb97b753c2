"""The corpus operators against plain Python, with nulls, empty and long
texts, ties, repeated rows, empty tables and clashing extra columns."""

import collections
import hashlib
import itertools
import random
import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridcheck.llm import (
    chat_format,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    quality_rules,
    token_counts,
    topk_search,
)
from gridcheck.llm.wordhash import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOCAB = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def corpus():
    """Small, with one hot source, copies, near copies, common lines, odd texts and a very long one."""
    rng = random.Random(5)
    rows, k = [], itertools.count()
    add = lambda text, source="s0", lang="en": rows.append((next(k), text, lang, source, len(text or "")))
    base = [prose(rng, 60) for _ in range(12)]
    for b in base:
        for _ in range(3):
            add("Menu | Home\n" + b)
        words = b.split()
        words[7] = "changed"
        add(" ".join(words), "s1")
        add(b.upper(), "s2")
    for n in range(30):
        add("\n".join([prose(rng, rng.randint(1, 25)) for _ in range(rng.randint(1, 6))] + ["  Common LINE\t"]), f"s{n % 4}")
    for odd in ("", None, " ", "\n\n", "one", "two words", "é É\nÉ é", "a\r\nb", "日本 語\x00", "Common line"):
        add(odd, None)
    add(prose(rng, 20_000) + "\n" + "x" * 5000, "s3")
    rows.append(rows[0])
    rows.append((None, base[0], None, "s0", 3))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOC).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def ascii_lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def test_line_dedup(docs, none):
    rows = corpus()
    held = collections.defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            held[ascii_lower(line.strip(" \t\n\x0b\x0c\r"))].add(i)
    gone = {k for k, v in held.items() if k and len(v) >= 10}
    want = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if ascii_lower(x.strip(" \t\n\x0b\x0c\r")) not in gone]
        want.append((str(i), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = [(str(r[0]), *r[1:]) for r in line_dedup.digest(docs).collect()]
    assert gone and sorted(got) == sorted(want)
    assert line_dedup.digest(none).count() == 0


def test_line_dedup_keeps_the_first_and_other_columns(spark):
    rows = [(2, "b\na", "x"), (1, "a\na\nc", "y"), (3, "A ", "z"), (3, "A ", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_lines string")
    out = line_dedup.dedup_lines(df, min_docs=2, keep_first=True).select("doc_id", "kept_text", "n_lines").collect()
    assert sorted(map(tuple, out)) == [(1, "a\nc", 3), (2, "b", 2), (3, "", 1), (3, "", 1)]


def test_line_dedup_shuffles_no_text(docs):
    plan = line_dedup.line_bitmaps(docs)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange" in x and "text" in x]
    assert not exchanges


def parse_chat(text):
    out, at = [], 0
    while at < len(text):
        head = re.compile(r"<\|(system|assistant|user:([^|]*))\|>\n").match(text, at)
        end = text.index("<|end|>", head.end())
        out.append((head[1].split(":")[0], head[2], text[head.end() : end].replace("<||", "<|")))
        at = end + len("<|end|>\n")
    return out


def test_chat_round_trip(spark):
    rows = [(1, 0, "system", "be <|end|> kind"), (1, 1, "ann", "hi <|"), (1, 2, "bob|>\n", None), (1, 3, "ann", "<|assistant|>\nno"), (1, 3, "ann", "<|assistant|>\nno")]
    rows += [(2, t, "u", "x" * (t % 3)) for t in range(1200)] + [(3, 0, None, "who"), (None, 0, "ann", "lost"), (4, None, "ann", "when"), (5, 1, "system", "alone")]
    out = chat_format.perspectives(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    by = {(r.conv_id, r.part, r.speaker): r for r in out}
    assert sorted(by, key=str) == sorted([(1, 0, "ann"), (1, 0, "bob|>\n"), (2, 0, "u"), (2, 1, "u"), (2, 2, "u"), (4, None, "ann"), (None, 0, "ann")], key=str)
    ann = by[1, 0, "ann"]
    assert parse_chat(ann.text) == [("system", None, "be <|end|> kind"), ("assistant", None, "hi <|"), ("user", "bob%7C%3E%0A", ""), ("assistant", None, "<|assistant|>\nno")]
    spans = [tuple(map(int, s.split(":"))) for s in ann.target_spans.split()]
    assert [ann.text[a:b] for a, b in spans] == ["hi <||<|end|>", "<||assistant|>\nno<|end|>"]
    assert ann.n_turns == 4 and ann.n_targets == 2 and ann.target_chars == sum(b - a for a, b in spans)
    assert by[2, 2, "u"].n_turns == 1200 - 1024


def test_chat_parts_join_to_the_whole_dialogue(spark):
    rng = random.Random(4)
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "only here"), (1, 700, "system", "be brief"), (1, None, "dee", "when"), (1, None, None, "who")]
    rows += [(1, t, rng.choice(["bob", "cy"]), "x" * rng.randint(0, 5)) for t in range(2, 600)] + [(1, t, "cy", f"t{t} <|") for t in range(1600, 1700)]
    rows += [(2, 3, "system", "a"), (2, 600, "system", "b"), (3, 3, "ann", "a"), (3, 600, "system", "b"), (4, 3, "ann", "a"), (5, None, "ann", "b")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    parts = collections.defaultdict(list)
    for r in sorted(chat_format.perspectives(df).collect(), key=lambda r: -1 if r.part is None else r.part):
        parts[r.conv_id, r.speaker].append(r)
    whole = collections.defaultdict(list)
    for r in sorted(chat_format.perspectives(df, part=10**6).collect(), key=lambda r: -1 if r.part is None else r.part):
        whole[r.conv_id, r.speaker].append(r)
    assert set(parts) == set(whole) == {(1, "ann"), (1, "bob"), (1, "cy"), (1, "dee"), (3, "ann"), (4, "ann"), (5, "ann")}
    assert {len(v) for k, v in parts.items() if k[0] == 1} == {4}
    for key, rs in parts.items():
        text = "".join(r.text for r in rs)
        assert text == "".join(r.text for r in whole[key])
        assert sum(r.n_turns for r in rs) == sum(r.n_turns for r in whole[key]) == len(parse_chat(text)) == len({x for x in rows if x[0] == key[0]})
        for r in rs:
            spans = [tuple(map(int, s.split(":"))) for s in r.target_spans.split()]
            assert [r.text[a:b] for a, b in spans] == re.findall(r"(?s)<\|assistant\|>\n(.*?<\|end\|>)", r.text)
            assert len(spans) == r.n_targets and sum(b - a for a, b in spans) == r.target_chars


def test_token_counts(docs, none):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.digest(docs).collect()}
    want = {(i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for i, t, *_ in corpus()}
    assert got == want
    assert token_counts.digest(none).count() == 0


def test_token_counts_of_random_strings():
    import public_tokenizers
    import sentencepiece

    file = public_tokenizers.path("piece_bpe_32k.model")
    sp, counter, rng = sentencepiece.SentencePieceProcessor(model_file=file), token_counts.PieceCounter(file), random.Random(3)
    parts = ["the", " ", "  ", "\n", "é", "ß", "日", "ing", "<s>", "\t", "🤷", "1", "--", "▁", "\x00", "aaaa" * 40, "tion" * 30]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    texts += ["".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(n)) for n in (47, 48, 49, 500, 20_000)]
    texts += [c * n for c in ("a", "e", "ab", "日本", "the", "ss", "=") for n in (47, 48, 49, 997, 5000)]
    assert counter.count(texts) == [len(x) for x in sp.encode(texts)]
    assert counter.count([]) == [] and counter.count([None, "", " "]) == [0, 0, len(sp.encode(" "))]


def test_language_id(spark, none):
    rng = random.Random(1)
    words = {"en": ["the", "ship", "with", "thing", "when", "would"], "de": ["schiff", "und", "nicht", "wenn", "wäre", "über"], "fr": ["bateau", "où", "était", "quand", "avec", "très"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(5, 60))), lang) for i, lang in enumerate(["en", "de", "fr"] * 60)]
    rows += [(1000, None, "en"), (1001, "12 34 !", "de"), (1002, "", "fr"), (None, "the ship", None), (1003, "日本", "en"), (1004, "wenn und nicht " * 4000, "fr")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = {r.doc_id: r for r in language_id.digest(df).collect()}
    assert len(out) == len(rows)
    for i, text, lang in rows[:180]:
        assert out[i].lang_pred == lang and out[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= out[i].score <= 1
    assert [out[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and out[1004].lang_pred == "de" and out[None].held_out is False
    assert language_id.digest(none).count() == 0


def test_language_id_parses_longest_matches():
    rng = random.Random(2)
    samples = {k: [97 + rng.randrange(4) for _ in range(300)] for k in "xy"}
    samples["y"] = [97 + k % 3 for k in range(900)]
    parser = language_id.Parser.fit(samples)
    texts = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 1300))) for _ in range(20)]
    # Phrases that run over several segments, and one that is out of step with every segment.
    texts += ["abc" * 900, "d" + "abc" * 700 + "dd" + "abc" * 300, "bca" * 250 + "x" + "cab" * 200]
    raw, sizes, _ = language_id.symbols(texts)
    got = parser.phrases(raw, sizes)
    at = np.cumsum(sizes) - sizes
    for k, lang in enumerate("xy"):
        known = "".join(map(chr, samples[lang]))
        for a, n, found in zip(at, sizes, got[:, k], strict=True):
            s, phrases, i = "".join(map(chr, raw[a : a + n])), 0, 0
            while i < len(s):
                j = i + 1
                while j <= len(s) and s[i:j] in known:
                    j += 1
                i, phrases = max(j - 1, i + 1), phrases + 1
            assert found == phrases


def water_level(sizes, weights, cap=3):
    total, capped, target = sum(sizes.values()), set(), {}
    while True:
        rest = [k for k in sizes if k not in capped]
        spare = total - sum(cap * sizes[k] for k in capped)
        level = spare / sum(weights[k] for k in rest) if rest else 0
        over = [k for k in rest if level * weights[k] > cap * sizes[k] + 1e-9]
        if not over:
            return {k: cap * sizes[k] if k in capped else level * weights[k] for k in sizes}
        capped |= set(over)


def test_mixing(docs, none, spark):
    rows = mixing.digest(docs).collect()
    again = mixing.digest(docs.repartition(7)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, rows)) == sorted(map(key, again)) and len(rows) == len(corpus())
    want = collections.Counter()
    for _, text, _, source, _ in corpus():
        want[source] += len(WORD.findall(text or ""))
    order = sorted(want, key=lambda s: (s is None, s or ""))
    target = water_level(dict(want), {s: k % 3 + 1 for k, s in enumerate(order)})
    taken = collections.Counter()
    for r, (i, text, _, source, _) in zip(sorted(rows, key=lambda r: str((r.doc_id, r.size))), sorted(corpus(), key=lambda r: str((r[0], len(WORD.findall(r[1] or ""))))), strict=True):
        assert r.doc_id == i and r.size == len(WORD.findall(text or "")) and r.taken <= 3 * r.size
        assert r.source_size == want[source] and r.target == pytest.approx(target[source])
        taken[source] += r.taken
    for s in want:
        assert abs(taken[s] - target[s]) <= 64 + 0.01 * target[s]
    assert mixing.digest(none).count() == 0
    blank = mixing.digest(spark.createDataFrame([(1, None, "en", "a", 0), (2, " ", "en", None, 1)], DOC)).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2


def test_mixing_comes_from_its_draws(spark):
    """Each shard's counts are drawn, other seeds take other amounts, all within the tolerance, and every drawn slot is one place."""
    rows = [(i, "w " * 400, "en", f"s{i % 6}", 800) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOC)
    taken = []
    for seed in (0, 1):
        out = mixing.mix(docs, shard=1000, seed=seed, spans=True).cache()
        got = {r.source: (r.t, r.target) for r in out.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).collect()}
        assert all(abs(t - target) <= 64 + 0.01 * target for t, target in got.values())
        taken.append({s: t for s, (t, _) in got.items()})
        spans = out.select("source", "taken", F.explode("taken_spans").alias("s")).select("source", "s.*")
        places = spans.groupBy("shard", "slot").agg(F.count_distinct("source").alias("n"), F.sum(F.col("last") - F.col("first")).alias("words"))
        assert places.where("n <> 1 OR words > 64").count() == 0
        assert spans.where("slot < 0 OR slot >= 1000").count() == 0
    assert taken[0] != taken[1]
    sources = mixing.targets(docs.groupBy("source").agg(F.lit(200_000).cast("long").alias("source_size")))
    total = sources.agg(F.sum("_slots")).first()[0]
    got = {(r["_shard"], r["_sid"]): r["_n"] for r in mixing.drawn_slots(spark, sources, 6, total, 1000).collect()}
    ends, start = [], 0
    for r in sorted(sources.collect(), key=lambda r: r["_sid"]):
        ends.append((start, start + r["_slots"], r["_sid"]))
        start += r["_slots"]
    want = collections.Counter()
    for s in range(total):
        u = int(hashlib.md5(f"0:{s}".encode()).hexdigest()[:15], 16) % total
        want[s // 1000, next(sid for lo, hi, sid in ends if lo <= u < hi)] += 1
    assert got == dict(want)


def test_mixing_wide_numbers_agree(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("i"), F.lit(997).cast("long").alias("n"), (F.col("id") % 4).cast("int").alias("s"))
    out = df.select(mixing.permuted(F.col("i"), F.col("n"), F.col("s"), False).alias("a"), mixing.permuted(F.col("i"), F.col("n"), F.col("s"), True).alias("b"))
    assert out.where("a <> b").count() == 0
    one = df.where("i < 997").select(mixing.permuted(F.col("i"), F.col("n"), F.lit(2), False).alias("a"))
    assert one.distinct().count() == 997


def test_mixed_documents(docs):
    plan = {str((r.doc_id, r.size)): r for r in mixing.digest(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = collections.Counter()
    texts = {str(i): t or "" for i, t, *_ in corpus()}
    for r in out.collect():
        assert r.n_chars == len(r.text)
        if len(WORD.findall(r.text)) == len(WORD.findall(texts[str(r.doc_id)])):
            assert r.text.strip() == texts[str(r.doc_id)].strip()
        got[r.doc_id] += len(WORD.findall(r.text))
    for i in got:
        if i not in (0, None):
            assert got[i] == next(r.taken for r in plan.values() if r.doc_id == i)


def shingles(text):
    w = WORD.findall(ascii_lower(text or ""))
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def test_near_dedup(docs, none):
    rows = corpus()
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(b)] = find(a)
    want = []
    for k, (i, *_) in enumerate(rows):
        comp = i if i is None else min(rows[x][0] for x in range(len(rows)) if find(x) == find(k) and rows[x][0] is not None)
        want.append((str(i), len(sets[k]), str(comp), i == comp))
    got = [(str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dedup.digest(docs).collect()]
    assert sorted(got) == sorted(want)
    assert near_dedup.digest(none).count() == 0
    kept = {(str(i), t) for (i, t, *_), w in zip(rows, want, strict=True) if w[3]}
    out = near_dedup.dedup(docs).collect()
    assert len(out) == len(kept) and {(str(r.doc_id), r.text) for r in out} == kept


def test_dedup_goes_by_rows(spark):
    """A text isn't lost because another one of its doc_id is a copy; of equal rows one stays, with all its columns."""
    rng = random.Random(8)
    w, x, y = (prose(rng, 40) for _ in range(3))
    rows = [(3, w, "a"), (5, x, "b"), (5, w, "c"), (7, y, "e"), (7, y, "d"), (7, y, "d"), (8, y, "f"), (None, y, "g"), (9, None, "h"), (9, None, "h"), (10, None, "i")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _id string")
    got = sorted(map(str, (tuple(r) for r in near_dedup.dedup(docs).collect())))
    assert got == sorted(map(str, [(3, w, "a"), (5, x, "b"), (7, y, "d"), (None, y, "g"), (9, None, "h"), (10, None, "i")]))


def test_near_dedup_closes_mixed_buckets(spark):
    """Chains of texts, each near its neighbours only: the hub of a bucket is far from most."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(40):
        for j in range(2):
            words[rng.randrange(120)] = f"x{k}-{j}"
        rows.append((100 - k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.digest(df).collect()}
    sets, links = {i: shingles(t) for i, t in rows}, collections.defaultdict(set)
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            links[a].add(b), links[b].add(a)
    for start in sets:
        seen, todo = {start}, [start]
        while todo:
            for x in links[todo.pop()] - seen:
                seen.add(x), todo.append(x)
        assert got[start] == min(seen)


@pytest.mark.parametrize("percent", [60, 90])
def test_near_dedup_takes_the_percent_in_every_step(spark, percent):
    """A chain whose neighbours are alike by some 84 percent: one component at 60, none at 90."""
    rng, words, rows = random.Random(9), [f"w{k}" for k in range(120)], []
    for k in range(30):
        for j in range(2):
            words[rng.randrange(120)] = f"x{k}-{j}"
        rows.append((k, " ".join(words)))
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
            lo, hi = sorted((label[a], label[b]))
            label = {i: lo if x == hi else x for i, x in label.items()}
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, percent).collect()} == label
    assert (1 - (percent / 100) ** near_dedup.bands(percent)[1]) ** near_dedup.bands(percent)[0] < 2e-6
    assert near_dedup.bands(75) == (24, 3)
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(df, 10)


def test_super_minhash_estimates_jaccard():
    rng = np.random.default_rng(4)
    for n, shared in ((8, 6), (60, 45), (900, 600)):
        hits = 0
        for _ in range(60):
            both = rng.integers(0, 2**63, shared, dtype=np.uint64)
            a, b = (np.sort(np.concatenate([both, rng.integers(0, 2**63, n - shared, dtype=np.uint64)])) for _ in range(2))
            sig = near_dedup.super_minhash(np.concatenate([a, b]), np.array([n, n]))
            hits += (sig[0] == sig[1]).sum()
        assert hits / (60 * near_dedup.SLOTS) == pytest.approx(shared / (2 * n - shared), abs=0.03)


def test_topk(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(700, 12)).astype(np.float32)
    rows = [(int(i), [float(v) for v in x[i % 650]]) for i in range(700)]
    rows += [(5000, None), (5050, [1.0, None] + [0.0] * 10), (5100, [float("nan")] * 12), (5150, []), (5200, [0.5, 0.25]), (6000, [float("inf")] * 12), (None, [0.0] * 12), rows[50]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    q = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows[:700]}
    got = collections.defaultdict(list)
    for r in topk_search.top_k(df).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    want = {}
    for i in range(0, 700, 50):
        best = sorted((-int(q[i] @ q[j]), j) for j in q if j != i)[:5]
        want[i] = [(k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert {k: sorted(v) for k, v in got.items()} == want  # 5200 has no candidate of its length
    assert topk_search.top_k(df.where("false")).count() == 0


def test_topk_bounds_keep_ties_and_large_numbers():
    rng = np.random.default_rng(8)
    hold = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    for scale in (2, 300, 2**30, 2**45):
        x = rng.integers(-scale, scale, (400, 6))
        x[200:240] = x[100]
        ids = np.arange(400) * 3
        full = x[:30].astype(object) @ x.T.astype(object)
        cut = [(k, ids[a : a + 100], x[a : a + 100].astype(float)) for k, a in enumerate(range(0, 400, 100))]
        for blocks in ([(0, ids, x.astype(float))], cut):
            q, v, s, read, there = topk_search.top_of_blocks(blocks, [(0, ids[:30], x[:30].astype(float))], 5, counted=True)
            assert 0 <= read <= there == 30 * 400 * 6
            for a in range(30):
                best = sorted((-hold(full[a][b]), int(ids[b])) for b in range(400) if b != a)[:5]
                assert [(-t, i) for o, t, i in zip(q, s, v, strict=True) if o == ids[a]] == best


def test_topk_stops_reading_where_lists_allow():
    """Few weights decide: the other lists are hardly read. The mark of one block spares entries of the next."""
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(4000, 32)) * 256 / (1 + np.arange(32)) ** 1.5)
    ids = np.arange(4000)
    ask = [(0, ids[:40], x[:40])]
    *_, read, there = topk_search.top_of_blocks([(0, ids, x)], ask, 5, counted=True)
    assert read < 0.3 * there
    halves = [(0, ids[:2000], x[:2000]), (1, ids[2000:], x[2000:])]
    together = topk_search.top_of_blocks(halves, ask, 5, counted=True)
    apart = [topk_search.top_of_blocks([h], ask, 5, counted=True) for h in halves]
    assert together[3] < apart[0][3] + apart[1][3]


def test_topk_takes_large_components(spark):
    rows = [(0, [1.0, 0.0]), (1, [1e7, 2.0]), (2, [1e30, 0.0]), (50, [1e7, 0.0]), (3, [-1e30, 0.0]), (4, [0.5, 0.5])]
    got = [tuple(r) for r in topk_search.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), k=2).collect()]
    ten = 256 * 10_000_000
    assert sorted(got) == [(0, 1, 2, 2**63 - 1), (0, 2, 1, 256 * ten), (50, 1, 2, 2**63 - 1), (50, 2, 1, ten * ten)]


def test_license_scan(spark):
    text = "Intro here. Licensed under the Apache License, Version 2.0. All rights reserved.\nMIT License\nlicensed under the mit license!  You may not use this file except in compliance with the License."
    rows = [(1, text), (2, None), (3, ""), (4, "Software licence unknown."), (5, "x. " * 20_000 + "Released under the MIT License."), (6, "GPL? " * 3 + "This work is licensed under the GNU General Public License, version 3.")]
    out = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out[1].sentence_ids == "apache-2-ref;reserved;mit-title;mit-ref;apache-2-use"
    assert out[1].licences == "MIT;Apache-2.0;All-Rights-Reserved" and out[1].leftover == "mit-title;apache-2-use"
    assert [out[k].licences for k in (2, 3, 4, 5, 6)] == ["", "", "", "MIT", "GPL-3.0-only"]
    full = ("apache-2-ref", "apache-2-use", "apache-2-copy", "apache-2-warranty", "apache-2-see")
    by_id = {v: k for k, v in license_scan.SENTENCES.items()}
    whole = "\n".join(by_id[i].capitalize() + "." for i in full)
    got = license_scan.scan(spark.createDataFrame([(1, whole)], "doc_id bigint, text string")).first()
    assert got.licences == "Apache-2.0" and got.leftover == ""


def test_license_scan_of_wrapped_texts(spark):
    import textwrap

    by_id = {v: k for k, v in license_scan.SENTENCES.items()}
    rows, want = [], []
    for name, ids in license_scan.RULES:
        paragraphs = [by_id[i].capitalize() + ("" if i.endswith("title") else ".") for i in ids]
        for width, mark, gap in ((70, "", "\n\n"), (40, "# ", "\n#\n"), (76, " * ", "\n *\n"), (50, "// ", "\n"), (60, "", "\r\n\r\n")):
            rows.append((len(rows), gap.join(textwrap.fill(p, width, initial_indent=mark, subsequent_indent=mark) for p in paragraphs)))
            want.append((name, ";".join(ids)))
        rows.append((len(rows), textwrap.fill("Some words before. " + "  ".join(paragraphs) + " And after.", 72)))
        want.append((name, ";".join(ids)) if not ids[0].endswith("title") else None)
    mit = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
    rows.append((len(rows), mit))
    want.append(("MIT", "mit-title;mit-grant;mit-notice;mit-warranty;mit-liability"))
    # Blank lines part sentences, and a known one ends where a line or a sentence does.
    rows += [(len(rows), "Released under\n\nthe MIT\n\nLicense"), (len(rows) + 1, "Released under the MIT\nLicense or so"), (len(rows) + 2, "a\n" * 30_000 + "\n" * 30_000 + "All\nrights\nreserved")]
    want += [("", ""), ("", ""), ("All-Rights-Reserved", "reserved")]
    got = {r.doc_id: (r.licences, r.sentence_ids) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [(rows[k][1], got[k]) for k in range(len(rows)) if want[k] and got[k] != want[k]] == []


def test_license_scan_finds_every_known_sentence(spark):
    known = list(license_scan.SENTENCES.items())
    assert [s for s, _ in known if not re.search(license_scan.HINT, s)] == []
    got = license_scan.scan(spark.createDataFrame([(k, s) for k, (s, _) in enumerate(known)], "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_known, r.sentence_ids) for r in got} == {k: (1, i) for k, (_, i) in enumerate(known)}
    notice = "This Source Code Form is subject to the terms of the Mozilla Public License, v 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    got = license_scan.scan(spark.createDataFrame([(1, notice)], "doc_id bigint, text string")).first()
    assert (got.sentence_ids, got.licences, got.leftover) == ("mpl-2-ref;mpl-2-copy", "MPL-2.0", "")


ISC = """ISC License

Copyright (c) 2021, Some One

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""
ZLIB = """  This software is provided 'as-is', without any express or implied
  warranty.  In no event will the authors be held liable for any damages
  arising from the use of this software.

  Permission is granted to anyone to use this software for any purpose,
  including commercial applications, and to alter it and redistribute it
  freely, subject to the following restrictions:

  1. The origin of this software must not be misrepresented; you must not
     claim that you wrote the original software. If you use this software
     in a product, an acknowledgment in the product documentation would be
     appreciated but is not required.
  2. Altered source versions must be plainly marked as such, and must not be
     misrepresented as being the original software.
  3. This notice may not be removed or altered from any source distribution.
"""
BSD_3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
APACHE = """/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
"""
GNU = """# This {what} is free software: you can redistribute it and/or modify
# it under the terms of the GNU {kind} as published by
# the Free Software Foundation, either version {version} of the License, or
# (at your option) any later version.
#
# This {what} is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU {kind} for more details.
#
# You should have received a copy of the GNU {kind}
# along with this {what}.  If not, see <https://www.gnu.org/licenses/>.
"""
BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:

The copyright notices in the Software and this entire statement, including
the above license grant, this restriction and the following disclaimer,
must be included in all copies of the Software, in whole or in part, and
all derivative works of the Software, unless such copies or derivative
works are solely in the form of machine-executable object code generated by
a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT
SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE
FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.
"""


def test_license_scan_of_whole_texts(spark):
    """Public texts as they are printed, each known whole, with nothing left over."""
    general, lesser, affero = "General Public License", "Lesser General Public License", "Affero General Public License"
    want = [
        ("ISC", ISC), ("Zlib", ZLIB), ("BSD-3-Clause", BSD_3), ("Apache-2.0", APACHE), ("BSL-1.0", BOOST),
        ("GPL-3.0-or-later", GNU.format(what="program", kind=general, version="3")),
        ("GPL-2.0-or-later", GNU.format(what="program", kind=general, version="2")),
        ("LGPL-3.0-or-later", GNU.format(what="library", kind=lesser, version="3")),
        ("AGPL-3.0-or-later", GNU.format(what="program", kind=affero, version="3")),
        ("BSD-2-Clause", BSD_3[: BSD_3.index("3. Nei")] + BSD_3[BSD_3.index("THIS SOFTWARE IS") :]),
        ("0BSD", ISC.replace("ISC License", "").replace(""", provided that the above
copyright notice and this permission notice appear in all copies.""", ".")),
        ("CC0-1.0", "To the extent possible under law, the author has waived all copyright\nand related or neighboring rights to this work."),
        ("EPL-2.0", "// This program and the accompanying materials are made available under the\n// terms of the Eclipse Public License 2.0 which is available at\n// https://www.eclipse.org/legal/epl-2.0/\n"),
        ("LGPL-2.1-or-later", "// SPDX-License-Identifier: LGPL-2.1-or-later\nint x;"),
    ]
    docs = spark.createDataFrame([(k, "code before();\n\n" + text + "\n\nafter it") for k, (_, text) in enumerate(want)], "doc_id bigint, text string")
    got = {r.doc_id: (r.licences, r.leftover) for r in license_scan.scan(docs).collect()}
    assert [got[k] for k in range(len(want))] == [(name, "") for name, _ in want]
    assert license_scan.scan(docs.where("false")).count() == 0


def test_packing_covers_every_id_once(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.pack(docs).collect()
    want = collections.Counter()
    for i, t, *_ in corpus():
        want[str(i), tuple(tok.encode(t or "", add_special_tokens=False).ids + [1])] += 1
    by_doc, by_seq = collections.defaultdict(dict), collections.defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4")
        assert len(ids) == p.length > 0
        by_doc[str(p.doc_id), p.doc_tokens].setdefault(p.start, []).append(ids)
        by_seq[p.sequence_id].append((p.offset, p.length))
    for (i, ids), n in want.items():
        parts = by_doc[i, len(ids)]
        assert sum(len(x) for v in parts.values() for x in v) == n * len(ids)
        assert all(tuple(x.tolist()) == ids[s : s + len(x)] for s, v in parts.items() for x in v)
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)
    assert packing.pack(none).count() == 0
    crc = {(str(r.doc_id), r.start, r.sequence_id, r.offset): r.ids_crc32 for r in packing.digest(docs).collect()}
    assert all(crc[str(p.doc_id), p.start, p.sequence_id, p.offset] == zlib.crc32(bytes(p.ids)) for p in pieces)


def test_packing_encodes_as_the_library_does():
    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    tok, mine, rng = Tokenizer.from_file(file), packing.ChunkEncoder(file), random.Random(2)
    parts = ["The", "in", " ", "\n", "É", "́", "'s", "'", "12", "...", "<|endoftext|>", "\t", "日", "\x1f", " ", "K", "İ", "Œ", "ſ", "ß", ",", "_", "|>", "ª", "\x0b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    got = [ids.tolist() for ids in mine.encode(mine.terms(pa.array(texts)), 1)]
    assert got == [[*e.ids, 1] for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_packing_puts_neighbours_together():
    rng = random.Random(7)
    topics = [[f"t{k}w{j}" for j in range(40)] for k in range(4)]
    number: dict = {}
    docs = [np.array([number.setdefault(rng.choice(topics[k % 4]), len(number)) for _ in range(200)], np.int32) for k in range(80)]
    order = packing.order_shard(docs, np.full(80, 201), 2048)
    assert sorted(order.tolist()) == list(range(80))
    same = sum(order[k] % 4 == order[k + 1] % 4 for k in range(79))
    assert same > 70


def test_packing_scores_terms_that_many_documents_hold():
    rng = np.random.default_rng(3)
    shared = np.arange(50, dtype=np.int32)
    # Every third document is a copy of one text, whose terms no other document has; the others are of words of their own and a few common ones.
    docs = [shared if k % 3 == 0 else np.append(rng.integers(0, 40, 5) + 100, np.arange(20) + 1000 + 20 * k).astype(np.int32) for k in range(60)]
    index = packing.BM25(docs)
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    tf = [collections.Counter(d.tolist()) for d in docs]
    df = collections.Counter(t for c in tf for t in c)
    for seed in (0, 1, 2, 59):
        got = index.scores(seed)
        for d in range(n):
            parts = [np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * tf[d][t] * 2.2 / (tf[d][t] + 1.2 * (0.25 + 0.75 * len(docs[d]) / mean)) for t in tf[seed] if df[t] > 1]
            assert got[d] == pytest.approx(sum(parts), rel=1e-5)
    order = packing.order_shard(docs, np.full(60, 100), 2000).tolist()
    assert {d % 3 for d in order[:20]} == {0}
    few = [np.array([1, 2, 3, k + 10], np.int32) for k in range(8)]  # a small last shard
    assert (packing.BM25(few).scores(0) > 0).all()


def base_counts(t):
    t = t or ""
    w = WORD.findall(t)
    seen, dup, cover = set(), 0, set()
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    for k in range(len(w) - 4):
        if n[tuple(w[k : k + 5])] > 1:
            cover |= set(range(k, k + 5))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(cover)


def test_quality_base_counts():
    rng = random.Random(11)
    texts = ["", None, "\n\n", "a\n\na\na", "x " * 30, "é ü z\n\x85", "a b c d e a b c d e", "a\r\na\r\n", " \n \n"]
    texts += ["".join(rng.choice(["a", "b ", "\n", " ", "#", "é", "|", "c d e f g ", "\t"]) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    base = quality_rules.describe(Texts(pa.array(texts))).base
    got = list(zip(*(base[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), strict=True))
    assert got == [base_counts(t) for t in texts]


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(3)
    crf = quality_rules.ChainCRF(rng.normal(size=4), rng.normal(size=(2, 2)))
    sizes = np.array([1, 5, 3, 8, 1])
    x = rng.normal(size=(int(sizes.sum()), 4))
    got, at = crf.viterbi(x, sizes), 0
    for n in sizes:
        s = x[at : at + n] @ crf.weight
        value = lambda y: sum(s[k] for k in range(n) if y[k]) + sum(crf.move[a, b] for a, b in itertools.pairwise(y))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=int(n)), key=value)
        assert value(tuple(got[at : at + n])) == pytest.approx(value(best))
        at += n


def test_quality_rules(spark, none):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(120):
        good = k % 3 > 0
        lines = [prose(rng, rng.randint(15, 30)).capitalize() + "." if good else " | ".join(rng.choice(VOCAB) + "*#" for _ in range(12)) for _ in range(4)]
        rows.append((k, "\n".join(lines)))
        labels.append((k, int(good), 0))
    rows += [(500, None), (501, "few words"), (502, prose(rng, 40_000)), (None, rows[1][1])]
    labels += [(9999, 1, 0), (3, None, None), (None, 1, 0)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kept", F.lit("clash"))
    out = {r.doc_id: r for r in quality_rules.digest(d, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()}
    assert len(out) == len(rows)
    assert sum(out[k].kept == (k % 3 > 0) for k in range(120)) >= 118
    assert out[500].base_failed and out[501].base_failed and not out[500].kept
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality_rules.digest(d, empty).count() == len(rows)
    assert quality_rules.digest(none, empty).count() == 0
