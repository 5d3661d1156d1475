"""The corpus pipeline: stages over ``documents``, each reading what the one before has kept.

Language identification drops documents it rejects, near-dedup keeps one document of each group, substring dedup cuts
repeated passages out of the texts, decontamination drops documents that hold benchmark text, packing turns the rest into
token sequences.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.llm.blocks import substring_dedup
from layerwright.llm.contamination import decontaminated
from layerwright.llm.language import fit_languages, identified
from layerwright.llm.minhash import near_duplicates
from layerwright.llm.packing import packed_sequences
from layerwright.llm.tables import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
OTHERS = ("text", "lang", "source", "n_chars")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letters, or further from all languages than their own documents are."""
    judged = identified(docs, fit_languages(docs), carry=OTHERS)
    return judged.where("NOT rejected").select(COLUMNS)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 80 % of their 5-word shingles, directly or through others, keep the smallest id."""
    dropped = near_duplicates(docs, words=5, percent=80).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut 50-word runs that also start in a document with a smaller id; ``n_chars`` follows the text."""
    cut = substring_dedup(docs, window=50, block=25, carry=("lang", "source", "n_chars"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("bigint")
    return cut.withColumn("n_chars", n_chars).select(COLUMNS)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which 5 % of the words or more lie in 13-word windows of benchmark items."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = decontaminated(docs, benchmark, window=13, percent=5, carry=OTHERS)
    return judged.where("NOT contaminated").select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 4096 with the ids of every piece."""
    return packed_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end=2)


STAGES = [
    ("language_id", keep_identified),
    ("minhash_near_dedup", keep_distinct),
    ("substring_dedup", cut_repeats),
    ("decontamination", keep_clean),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    for name, stage in STAGES[:-1]:
        docs, _ = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Clustering, signatures and tokens can't be expressed in SQL; tests compare with plain Python.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
