"""Corpus pipeline: stages that each call one of the training-data operators.

``run`` writes each stage's result as Parquet in the shared checkpoint folder and reads
it again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import exact, neardup, packing, suffix
from tessera.llm.common import new_name, written
from tessera.llm.queries import QUALITY_AT, WORD_BPE, quality_scores
from tessera.session import read_table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = new_name(docs, "score")
    return quality_scores(spark, docs, sf_dir, score).where(F.col(score) >= QUALITY_AT).drop(score)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact_copies(docs, exact.DigestIndex(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs, percent=80, trees=neardup.MOST_TREES)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long repeats leave the text, by whole characters; n_chars follows."""
    left = suffix.remove_repeats(docs, length=200, characters=True)
    text = F.when(F.col("_record.text").isNotNull(), F.decode("_kept", "UTF-8"))
    new = {"text": text, "n_chars": F.when(F.size("_removed") > 0, F.length(text).cast("long")).otherwise(F.col("_record.n_chars"))}
    return left.select(*[new.get(c, F.col(f"_record.`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, WORD_BPE, 2048).drop("_row")


STAGES = [("quality", good_quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("suffix_array", repeat_removal),
          ("packing", pack)]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
