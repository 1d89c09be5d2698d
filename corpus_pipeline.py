"""The corpus pipeline: toxicity, repeats, near copies, benchmark leaks, pieces.

Each stage takes all that its predecessor kept, from Parquet, and its decisions are final.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import exact, leaks, near, pieces, toxic
from millrace.llm.common import read, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that a model fitted on the labelled ones finds toxic."""
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    score = toxic.fit_toxic(docs, labels).probability(F.col("text"))
    scored = docs.select(F.struct(*docs.columns).alias("_row"), score.alias("_score"))
    return scored.where(F.col("_score") < toxic.THRESHOLD).select("_row.*")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest ``doc_id`` stays."""
    return exact.drop_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return near.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a benchmark item, whole or with a few edits."""
    found = leaks.with_leaks(docs.withColumn("_row", F.struct(*docs.columns)), read(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks.items") == 0).select("_row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their pieces; decoding them gives the text back."""
    import public_tokenizers

    return pieces.with_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_repeats),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pieces", encode),
]
# A fitted model, alignments and merges are beyond SQL; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied one after the other to the documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
