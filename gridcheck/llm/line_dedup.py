"""Line dedup, DataFrame operations only.

Every line becomes (128-bit hash, document, position). The hashes are range
partitioned with the document as second key, so one line that half the corpus
holds is spread over many partitions, and sorted by document and position
within them; streaming over that order yields the first occurrence in each
document. Documents per hash are counted with map-side partial sums. What
comes back per document is a sparse bitmap of 64-line words, never text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcheck.llm.common import SPACES, UPPER, ascii_lower, checkpointed, free_name, small

KEY = ["_h1", "_h2"]


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """One row (doc_id, _fp, drop) per document that loses lines.

    _fp is xxhash64(text) and tells rows apart that share a doc_id; drop maps
    a word number w to 64 bits, bit b of which stands for line 64 * w + b and
    is set if the line goes; words and documents that are not there keep all.
    A key counts once per doc_id. With keep_first, the first occurrence in
    the order (doc_id, _fp, position) of a key stays, nulls first.
    """
    line = F.posexplode(_lines(F.col("text"))).alias("_pos", "_line")
    lines = (
        docs.select("doc_id", F.xxhash64("text").alias("_fp"), line)
        .withColumn("_key", line_key(F.col("_line")))
        .where(F.length("_key") >= min_chars)
        .select(F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"), "doc_id", "_fp", "_pos")
    )
    # The hashes are read three times, by the sampler of ranges, the sort and the join; the texts once.
    lines = checkpointed(lines)
    # (hash, document) are the range keys, so that the window below needs no further exchange.
    dealt = lines.repartitionByRange(*KEY, "doc_id").sortWithinPartitions(*KEY, "doc_id", "_fp", "_pos")
    in_doc = Window.partitionBy(*KEY, "doc_id").orderBy("_fp", "_pos")
    first = dealt.withColumn("_nth", F.row_number().over(in_doc)).where("_nth = 1")
    found = (
        first.groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("_docs"), F.min(F.struct("doc_id", "_fp", "_pos")).alias("_first"))
        .where(F.col("_docs") >= min_docs)
    )
    # A table of its own: its size decides on a broadcast, and beyond that both sides of the join are plain exchanges, which Spark can split where a key is hot.
    found = checkpointed(found if keep_first else found.select(*KEY))
    hits = lines.join(small(found, found.count()), KEY, "inner" if keep_first else "left_semi")
    if keep_first:
        hits = hits.where(~F.struct("doc_id", "_fp", "_pos").eqNullSafe(F.col("_first")))
    words = hits.groupBy("doc_id", "_fp", F.shiftright("_pos", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, _pos & 63)")).alias("_bits")
    )
    entry = F.collect_list(F.struct("_word", "_bits"))
    return words.groupBy("doc_id", "_fp").agg(F.map_from_entries(entry).alias("drop"))


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """docs with three more columns: n_lines, n_dropped and kept_text.

    A line's key is line_key(). Keys of at least min_chars code points found
    in at least min_docs documents lose all their lines (with keep_first: all
    but the first in the corpus).

    Defined cases: a null or empty text is one empty line; a key shorter than
    min_chars is never dropped; rows with one doc_id count as one document,
    each loses its own lines, and null doc_ids are one document; equal rows
    give equal results; an empty table gives an empty result; other columns
    pass through, and a clashing n_lines, n_dropped or kept_text of docs is
    replaced.
    """
    bitmaps = line_bitmaps(docs.select("doc_id", "text"), min_docs, min_chars, keep_first)
    source = docs.drop("n_lines", "n_dropped", "kept_text")
    fp, bits, id_, of, drop = free_name(source, "_fp", "_bits", "_id", "_of", "_drop")
    left = source.withColumn(fp, F.xxhash64("text"))
    right = bitmaps.toDF(id_, of, drop)
    joined = left.join(right, left["doc_id"].eqNullSafe(right[id_]) & (left[fp] == right[of]), "left")
    lines = _lines(F.col("text"))
    n_words = F.floor((F.size(lines) - 1) / 64).cast("int")
    dense = F.transform(F.sequence(F.lit(0), n_words), lambda w: F.coalesce(F.try_element_at(drop, w), F.lit(0).cast("long")))
    out = joined.withColumn(bits, F.when(F.col(drop).isNotNull(), dense))
    kept = F.filter(
        lines, lambda _, i: F.call_function("getbit", F.get(bits, F.floor(i / 64).cast("int")), i % 64) == 0
    )
    dropped = F.aggregate(F.map_values(drop), F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w))
    return out.select(
        *[F.col(f"`{c}`") for c in source.columns],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(dropped, F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col(bits).isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


SQL = f"""
WITH lines AS (
  SELECT doc_id, pos, l[pos] AS line, len(l) AS n_lines,
         translate(trim(l[pos], E' \\t\\n\\x0b\\x0c\\r'), '{UPPER}', '{UPPER.lower()}') AS key
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), common AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(c.key) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN common c ON c.key = lines.key
GROUP BY doc_id
"""
