"""The registered queries of this subpackage: thin uses of its operators on the whole test tables.

Each is called with ``(spark, sf_dir)`` and returns a DataFrame.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, chat_tools, filter_audit, language_id, mixing, near_dup, ngram_join, personal_data, quality_rules, token_alignment, token_counts, vector_search, warc
from strata.llm.common import n_words
from strata.sources.checkpoint import table_dir

QUERIES = {}


def registered(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 5, 2, 1 of their sources, sizes in words."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, n_words(F.col("text")), keep=["doc_id"]).drop("copies")


@registered
def op2_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations taken as tool calls and results: linked, ordered, validated, as canonical JSON."""
    calls, results = chat_tools.turns_as_calls(table(spark, sf_dir, "conversations"))
    found = chat_tools.link(calls, results, chat_tools.TURN_SCHEMAS)
    return found.select("conv_id", "call_id", F.col("position").alias("turn"), "name", "status", "topo", "n_results", F.array_join("problems", ",").alias("problems"), "record")


@registered
def op3_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates (0.8 or more on five-word runs) of every document."""
    return near_dup.classes(table(spark, sf_dir, "documents"))


@registered
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans, and all spans with those that the trees accept."""
    found = personal_data.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[f"n_{k}" for k in personal_data.BASE_KINDS], F.sha2(personal_data.listed(F.col("base")), 256).alias("base_sha256"),
                        personal_data.listed(F.col("spans")).alias("spans"))


@registered
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 32k piece model, and whether they exceed 4096."""
    docs = table(spark, sf_dir, "documents").withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=("doc_id", "n_bytes"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


@registered
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as a web archive, read back and assembled by capture."""
    path = table_dir(spark)
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.page_records(spark, path)


@registered
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document (its source is the host) and of every page, and whether it is accepted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lit(None).cast("long").alias("page_id"), "text", F.col("lang").alias("said"), F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix"))
    host = language_id.url_host(F.col("url"))
    pages = table(spark, sf_dir, "pages").select(F.lit(None).cast("long").alias("doc_id"), "page_id", language_id.page_text(F.col("html")).alias("text"),
                                                 language_id.page_language(F.col("html")).alias("said"), host.alias("host"), F.substring_index(host, ".", -1).alias("suffix"))
    found = language_id.identify(docs.unionByName(pages), *[F.col(c) for c in ("text", "said", "host", "suffix")])
    return found.select("doc_id", "page_id", "language", "confidence", "accepted")


@registered
def op8_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest other vectors of every vector whose id is divisible by 100."""
    return vector_search.search(table(spark, sf_dir, "embeddings"), F.col("_id") % 100 == 0)


@registered
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, and whether the base rule and the learned rules keep it."""
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.learn_rules(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs.select("doc_id", "text"), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@registered
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with the 50k byte-level vocabulary and decoded again."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


@registered
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of 0.9 or more between the sets of its three-word runs."""
    return ngram_join.components(table(spark, sf_dir, "documents"))


@registered
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from the documents of each language, in all 120 orders."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of every document under the byte-level and the piece model."""
    return token_alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
