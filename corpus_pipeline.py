"""The corpus pipeline: quality rules, toxicity, line dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import bagminhash, line_dedup, packing, repetition, toxicity
from tallyforge.llm.queries import tokenizer_path
from tallyforge.llm.staging import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep. A null or empty text, or one under fifty words, goes; rows that repeat are judged alike; an empty table stays empty."""
    return repetition.judge(repetition.with_repetition(docs)).where("kept").select(*docs.columns)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; the model learns from the labelled rows among ``docs``.

    A null or empty text scores 0 and stays; rows that repeat score alike; without labelled rows no document is toxic; an empty table stays empty.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.with_score(docs, model).where(F.col("score") < toxicity.THRESHOLD).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sites share, short or long; ``n_chars`` follows the text.

    Of the documents that hold a shared line the one with the least id keeps it, in all its rows. A null text stays null; an empty table stays empty.
    """
    cleaned = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast("long"))
    return cleaned.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the least id.

    Null and empty texts are one class; rows without an id all stay; of rows that repeat one stays; an empty table stays empty.
    """
    return bagminhash.keep_one(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences; a null or empty text is one piece, its end token; an empty table has none."""
    pieces = packing.tokenize_pieces(docs, tokenizer_path("byte_bpe_50k.json"))
    pieces = pieces.select("doc_id", "piece", "start", F.col("length").cast("long"), F.crc32("ids").alias("ids_crc32"))
    return packing.best_fit_pack(pieces)


STAGES = [("quality_rules", quality_rules), ("toxicity", toxicity_filter), ("line_dedup", dedup_lines), ("near_dedup", near_dedup), ("packing", pack)]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
