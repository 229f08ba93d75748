"""From raw documents to token ids: the text operators as stages, each on what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import bpe, decontaminate, line_dedup, near_copies, quality_classifier, simhash
from tallyward.llm.queries import table, tokenizer
from tallyward.llm.text import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    docs = docs.select(*COLUMNS)
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model).where(F.col("score") >= 0.5).select(*COLUMNS)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of runs of lines, and of one or two lines of over 50 words; n_chars follows the text."""
    cut = line_dedup.dedup_lines(docs.select(*COLUMNS), passage=line_dedup.PASSAGE)
    return cut.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal or nearly equal fingerprints, then of near copies (five-word shingles, Jaccard similarity 0.8 or more).

    Both marks come first; texts move once.
    """
    docs = docs.select(*COLUMNS)
    return near_copies.keep_one(docs, among=simhash.near_duplicates(docs))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item."""
    return decontaminate.keep_clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document."""
    return bpe.encode(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", cut_lines),
    ("simhash near-dedup", keep_one_of_each),
    ("benchmark decontamination", keep_clean),
    ("bpe encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is stored in the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier and the tokenizer cannot be written in SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None
