"""Documents to training tokens: five operators of ``strata.llm`` in a row.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of the documents.

Defined results: a null or empty text, or one without words, is rejected by the
language stage; whole texts of any length are worked on; of repeated rows and
of texts that are alike one stays, that of the smallest id, rows without an id
last; a null source is a source of its own; an empty table gives an empty
result; extra columns, however they are named, stay as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, language_id, mixing, near_dup, personal_data
from strata.llm.common import n_words
from strata.sources.checkpoint import materialize


def carried(docs: DataFrame) -> DataFrame:
    """The columns that operators read, and the whole row as one column that no operator's names can clash with."""
    return docs.select(F.struct("*").alias("doc"), "doc_id", "text", "lang", "source")


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the source is the host, the declared language the markup."""
    found = language_id.identify(carried(docs), F.col("text"), F.col("lang"), F.col("source"), F.lit(None).cast("string"))
    return found.where("accepted").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dup.keep_one(docs)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced, and their new length."""
    clean = personal_data.redact(carried(docs))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return clean.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    taken = mixing.mix(carried(docs), n_words(F.col("text"))).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("doc.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digest of the ids of each document, and of the text decoded from them."""
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES = [("language", languages), ("near_dup", near_duplicates), ("personal_data", personal), ("mixing", mixed), ("bpe", encoded)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
