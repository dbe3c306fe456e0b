"""From raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. `run` writes
each stage's rows as Parquet to the shared folder and reads them again for the next one, so a stage is computed once.
Nulls, empty texts, repeated rows, further columns and empty tables are taken as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postgrain.llm import decontaminate, jaccard_join, language, mixing, token_files
from postgrain.llm.queries import fold, table
from postgrain.llm.store import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a clear margin, learned from those outside one fold in four; others go."""
    learned = language.learn_dictionaries(docs, fold(4) != 2)
    return language.accepted(docs, learned)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return jaccard_join.one_of_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, none to three times."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token files: doc_id, start, n_tokens, ids_crc32, shard, position."""
    index = token_files.token_index(docs)
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "position")


STAGES = [
    ("language", identify_language),
    ("near duplicates", join_near_duplicates),
    ("benchmark", remove_benchmark),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

# Dictionaries of samples, random rounding and token ids are beyond SQL; tests compare each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return rows
