"""The queries of this subpackage: every operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid
from ._shared import scratch
from .chat import linked
from .decontamination import decontaminate
from .fingerprints import edited_fingerprints
from .jaccard_join import jaccard_join
from .licenses import license_scan
from .mixing import mix
from .token_files import read_tokens, write_tokens
from .url_filters import Rule, url_filter
from .warc import read_packages, write_packages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def add(f):
        QUERIES[name] = f
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The public tokenizer's file; its folder is on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_token_files")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "tokens")
    shards = write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary())
    return read_tokens(shards, folder, with_ids=False).withColumnRenamed("id", "doc_id")


RULES = [Rule("block", "com", "/en/"), Rule("allow", "example.com", "/en/7"), Rule("allow", "net", "/de/"), Rule("block", "example.net", "/de/8"), Rule("block", "org", "/es/")]


@query("op2_url_filters")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), RULES)


@query("op3_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "n_links", "copy_of")


@query("op4_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op5_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op6_licenses")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "block", "license", "nearest", "start", "end", "reduction", F.array_join("differences", " ").alias("differences"))


TOOLS = {
    "search": {"type": "object", "required": ["query"], "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 100}}, "additionalProperties": False},
    "calculate": {"type": "object", "required": ["expression"], "properties": {"expression": {"type": "string"}, "digits": {"type": "integer", "minimum": 0}}, "additionalProperties": False},
}


@query("op7_chat")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = linked(table(spark, sf_dir, "conversations"), TOOLS)
    return units.withColumn("errors", F.array_join("errors", "; "))


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return langid.predict(docs.select("doc_id", "text"), langid.fit(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op9_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return judged.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), items.alias("items_sha256"), "contaminated")


@query("op10_warc")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    files = write_packages(table(spark, sf_dir, "pages"), folder)
    read = read_packages(files, folder, with_payload=False)
    return read.select(F.col("page").try_cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").try_cast("long").alias("refers_to"))
