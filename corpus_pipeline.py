"""From raw documents to token ids: five stages, each written before the next one reads it.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps with their columns; the
last one returns the token counts and digests of the texts that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import decontaminate, jaccard_join, line_dedup, piece_codec, quality
from tillstar.llm.common import stored, text_key, unused
from tillstar.llm.queries import piece_model, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; a document of which nothing stays goes.

    ``n_chars`` counts the characters that stay.
    """
    kept = line_dedup.without_repeated_runs(docs, extended=True)
    kept = kept.filter((F.col("n_removed") == 0) | (F.col("text") != ""))
    shorter = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", shorter.cast("long")).select(docs.columns)


def jaccard_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id.

    Rows that repeat an id with different texts are different documents: each is judged by its own
    text, and of those of the least id in a group one stays. Documents without an id stay. Rows
    that repeat both id and text become one.
    """
    found = jaccard_join.grouped(docs)
    others = found.filter("doc_id <> component_id or tag <> first_tag")
    name = unused(docs, "tag")
    others = others.select("doc_id", F.col("tag").alias(name)).distinct()
    told = docs.withColumn(name, text_key()).join(others, ["doc_id", name], "left_anti")
    return told.select(docs.columns).dropDuplicates(["doc_id", "text"])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each text: their number, and digests of the ids and of the text they decode to."""
    coded = piece_codec.with_digests(docs.select("doc_id", "text"), piece_model())
    return coded.drop("text")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", jaccard_join_stage),
    ("benchmark_decontamination", decontamination),
    ("sentencepiece", sentencepiece_codec),
]

# The classifier and the tokenizer have no SQL form: the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
