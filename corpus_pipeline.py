"""From ``documents`` to packed training sequences, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (bin_slack, compress_quality, jaccard_join, quality_rules,
                          suffix_dedup)
from quayside.llm.frames import table, written
from quayside.llm.queries import held_out, vocabulary_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives a half or more."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = compress_quality.fit(docs, labels)
    score = compress_quality.score_column(spark, model, F.col("text"))
    return docs.where(score >= 0.5)


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    return quality_rules.keep(docs, quality_rules.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word n-grams."""
    return jaccard_join.one_of_each(docs, n=5, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that a smaller id holds too."""
    out = suffix_dedup.without_repeats(docs, length=50)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens in as few sequences as minimum bin slack finds."""
    return bin_slack.pack_documents(docs, vocabulary_path())


STAGES = [("quality classifier", classify), ("quality rules", judge),
          ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", repeats),
          ("best-fit packing", pack)]

#: SQL can express neither the classifier, the rules' model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared
    folder and read back as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
