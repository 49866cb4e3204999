"""A training corpus from ``documents``: language ID, near copies, decontamination, mixing, token files.

Every stage gets all that its predecessor kept, as the Parquet that was written of it, and its decisions take effect. All stages but the last keep all columns of
their input, whatever their names; an empty table gives an empty one, and very long texts count whole. What becomes of null and empty texts, ties and repeated rows is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import langid
from tidemark.llm._shared import removed, scratch
from tidemark.llm.decontamination import clean
from tidemark.llm.jaccard_join import deduplicated
from tidemark.llm.mixing import mixed
from tidemark.llm.queries import vocabulary
from tidemark.llm.token_files import read_tokens, write_tokens


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; what the model rejects goes, and so do null and empty texts and those without a letter.

    The model learns from the labelled ones of the same table. Equal texts, and so repeated rows, all stay or all go; a null id or label makes no difference to a row's own fate.
    """
    return langid.recognised(docs, langid.fit(docs))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id, null ids last, of ties the smallest hash of the text.

    Null and empty texts stay; of rows that repeat one another one stays; other texts under a repeated id are not touched.
    """
    return deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark. Null and empty texts are clean; repeated rows all stay or all go; null items of the benchmark have no windows."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, twice at most. Null is a source of its own; null and empty texts have size 0; documents with equal ids are taken alike."""
    return mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus, read back: doc_id, start, n_tokens and ids_crc32, in ascending order of id (null first) and text. Null and empty texts have the end id alone; repeated rows are each written."""
    folder = scratch(spark, "tokens")
    return read_tokens(write_tokens(docs, folder, vocabulary()), folder, with_ids=False).withColumnRenamed("id", "doc_id")


STAGES = [("language_id", language_id), ("jaccard_join", jaccard_join), ("decontamination", decontamination), ("mixing", mixing), ("token_files", token_files)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "corpus")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
            if k:
                removed(spark, f"{folder}/{STAGES[k - 1][0]}")  # what was made of it is written
    return docs
