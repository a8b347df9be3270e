"""A corpus pipeline: five operators of ``corvid.llm`` in a row.

Each stage takes (spark, docs, sf_dir) and works on all that the stage
before it kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm import decontaminate, jaccard_join, language_id, packing, substring_dedup
from corvid.llm.common import read_table, written
from corvid.llm.queries import _tokenizer


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those without a letter, or like no language, go."""
    return language_id.keep_identified(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs, words=5, percent=80)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without sentences of repeated spans; n_chars follows; documents with nothing left go."""
    got = substring_dedup.without_repeats(docs)
    got = got.where("n_units_removed = 0 or length(text) > 0").drop("n_units_removed")
    return got.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else got


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 4096 tokens."""
    return packing.pack(docs, _tokenizer())


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", join_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("decontamination", remove_benchmark_leaks),
    ("packing", pack_sequences),
]

#: SQL can express neither the models nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
