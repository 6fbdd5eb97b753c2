"""The pipeline's stages on a small corpus, each against what it promises."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from gridcheck.llm import language_id, license_scan, line_dedup, mixing, near_dedup, packing, quality_rules, token_counts

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "river stone window garden market letter summer winter bridge castle forest island meadow harbor valley engine".split()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    rng = random.Random(12)
    line = lambda: " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(rng.randint(8, 16))).capitalize() + "."
    rows = []
    for k in range(90):
        text = "\n".join(line() for _ in range(5))
        if k % 5 == 0:
            text = "\n".join(" | ".join(rng.choice(WORDS) + "##%" for _ in range(10)) for _ in range(4))
        elif k % 3 == 0:
            text += "\nSubscribe to our letter today."
        rows.append((k, text, "en", f"s{k % 3}", len(text)))
    rows += [(200 + k, rows[1][1], "en", "s0", 1) for k in range(4)]
    rows += [(300, None, None, None, None), (301, "", "en", "s0", 0), (302, "too short", "en", "s1", 9)]
    return rows


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    rows = corpus()
    spark.createDataFrame(rows, DOC).write.parquet(str(folder / "documents.parquet"))
    labels = [(i, int(i % 5 > 0), 0) for i, *_ in rows if i < 90]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder)


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = docs.collect()
    rated = {r.doc_id for r in seen["quality rules"]}
    assert rated == {i for i, *_ in corpus() if (i < 90 and i % 5) or 200 <= i < 300}
    assert all("Subscribe" not in r.text for r in seen["line dedup"]) and {r.doc_id for r in seen["line dedup"]} == rated
    assert {r.doc_id for r in seen["near dedup"]} == {i for i in rated if i < 200}
    words = {s: sum(len(WORD.findall(r.text)) for r in seen["near dedup"] if r.source == s) for s in ("s0", "s1", "s2")}
    mixed = {s: sum(len(WORD.findall(r.text)) for r in seen["mixing"] if r.source == s) for s in words}
    total = sum(words.values())
    assert all(abs(mixed[s] - total * w / 6) <= 64 + 0.01 * total for s, w in zip(words, (1, 2, 3), strict=True))
    assert sum(p.length for p in seen["packing"]) > sum(mixed.values())


#: Names that operators use within or return, a name with a dot, and other cases of letters.
CLASHES = """_fp _bits _id _of drop _drop _key _words _turn _mine _nth _spans taken_spans _ids _state _text _comp _sig _n _at _last _row
label node a b x.y Kept n_lines n_dropped kept_text n_words word_chars n_symbols n_dup_lines n_repeat_words content_chars base_failed
n_known sentence_ids licences leftover n_bytes n_tokens over_limit lang_pred score size source_size target taken start length ids""".split()


def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows and shared ids."""
    long = "\n".join(f"{w} stands in line {k} of a long and plain text." for k, w in enumerate(WORDS * 400))
    rows = [(i, text, "en", f"s{i % 3}", len(text or "")) for i, text in enumerate([corpus()[1][1], corpus()[2][1], long, "", None, "\n", "a b"])]
    rows += [rows[0], rows[0], (0, rows[1][1], "en", "s0", 5), (None, rows[1][1], None, None, None), (None, None, None, None, None), rows[4], rows[3]]
    return rows


OPERATORS = {
    "op1": lambda d: line_dedup.dedup_lines(d, min_docs=2),
    "op3": token_counts.count_tokens,
    "op4": lambda d: language_id.identify(d, language_id.train(d)),
    "op5": mixing.mixed_documents,
    "op6": near_dedup.dedup,
    "op8": license_scan.scan,
    "op10": lambda d: quality_rules.rate(d, quality_rules.train(d, d.selectExpr("doc_id", "int(doc_id % 2) AS quality"))),
}
RETURNED = {
    "op1": {"n_lines", "n_dropped", "kept_text"},
    "op3": {"n_bytes", "n_tokens", "over_limit"},
    "op4": {"lang_pred", "score"},
    "op8": {"n_known", "sentence_ids", "licences", "leftover"},
    "op10": {n for n, _ in quality_rules.FIELDS},
}


@pytest.mark.parametrize("name", [*OPERATORS, *(n for n, _ in corpus_pipeline.STAGES[:-1])])
def test_odd_rows_and_clashing_names(spark, sf_dir, name):
    """Results are those without the extra columns, whose values come back, but for those of a name that an operator returns."""
    plain = spark.createDataFrame(odd_rows(), DOC)
    extra = plain.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in CLASHES])
    stage = dict(corpus_pipeline.STAGES).get(name)
    run = OPERATORS[name] if name in OPERATORS else lambda d: stage(spark, d, sf_dir)
    out, want = run(extra), run(plain)
    returned = {r.lower() for r in RETURNED.get(name, ())}
    kept = [c for c in extra.columns if c.lower() not in returned]
    assert [c for c in out.columns if c in kept] == kept
    rows = [r.asDict() for r in out.collect()]
    assert all(r[c] == (None if r["doc_id"] is None else f"{c}{r['doc_id']}") for r in rows for c in CLASHES if c in kept)
    columns = [c for c in want.columns if c.lower() in returned or c in plain.columns]
    key = lambda r: tuple(str(r[c]) for c in columns)
    assert sorted(map(key, rows)) == sorted(key(r.asDict()) for r in want.collect())
    assert run(extra.where("false")).count() == 0


def test_operators_and_packing_ignore_extra_columns(spark):
    plain = spark.createDataFrame(odd_rows(), DOC)
    extra = plain.select("*", *[F.lit(c).alias(c) for c in CLASHES])
    for digest in (line_dedup.digest, token_counts.digest, language_id.digest, mixing.digest, near_dedup.digest, license_scan.digest, packing.digest):
        got, want = ([tuple(map(str, r)) for r in digest(d).collect()] for d in (extra, plain))
        assert sorted(got) == sorted(want), digest.__module__
        assert digest(extra.where("false")).count() == 0


def test_run_and_registration(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    known = __spark_entry__.queries()
    assert "pipeline" in known and all(any(n.startswith(f"op{k}_") for n in known) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(known)


def test_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], DOC)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
