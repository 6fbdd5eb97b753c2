"""The corpus pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents, the last the pieces of the packed
sequences. run() holds each stage's rows in the shared checkpoint folder
before the next begins, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcheck.llm import line_dedup, mixing, near_dedup, packing, quality_rules
from gridcheck.llm.common import checkpointed, shielded, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Defined cases: a null or empty text, or one of fewer than ten words, goes;
    without labels of both qualities only the base counts reject; equal rows
    stay or go alike; an empty table gives an empty result; all columns pass
    through, those with the operator's names too.
    """
    crf = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return shielded(docs, [n for n, _ in quality_rules.FIELDS], lambda d: quality_rules.rate(d, crf).where("kept"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from all of them.

    Defined cases: a null text becomes an empty one; a document that loses
    every line stays, empty; rows of one doc_id count as one document; equal
    rows give equal results; an empty table gives an empty result; n_chars,
    if there, becomes the length of what is left; all other columns pass
    through, those with the operator's names too.
    """

    def kept(d: DataFrame) -> DataFrame:
        out = line_dedup.dedup_lines(d).withColumn("text", F.col("kept_text"))
        return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out

    return shielded(docs, ("n_lines", "n_dropped", "kept_text"), kept)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least doc_id.

    Defined cases: those of near_dedup.dedup(); a text without words is near
    to none and stays; all columns pass through.
    """
    return near_dedup.dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become the words that the mix takes, a row for each time round.

    Defined cases: those of mixing.mixed_documents(); a text without words
    goes; n_chars, if there, becomes the new length; all other columns pass
    through.
    """
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 2048 tokens.

    Defined cases: those of packing.pack(); each row, equal ones too, is a
    document; an empty table gives no pieces; extra columns are ignored.
    """
    return packing.digest(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL has no word for the CRF and the tokenizer; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
