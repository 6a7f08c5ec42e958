"""A corpus from raw documents to token ids, in five stages; each works on all rows that the one before it kept.

``STAGES`` lists (name, function). A function takes the session, the documents so far and the folder of the tables and gives a table that
is written as Parquet and read again before the next stage. All but the last give the columns of ``documents``.

Null texts count as empty and null ids as ids in every stage; extra columns are kept up to the last stage, whatever they are called, and an empty
table stays empty. What a stage does with repeated rows is said with it.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtables.llm import bpe, decontamination, jaccard, quality, repeats
from gridtables.llm.common import small_batches, staged
from gridtables.llm.queries import quality_rules, tokenizer
from gridtables.llm.registry import table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.3 or more; the labels of ``labels`` fit it, and no column but the text scores.

    An empty text is scored like any other. Repeated rows stay or go together.
    """
    return quality.kept_documents(docs, quality_rules(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group that links of 5-word shingles at 0.8 or more connect.

    Of repeated rows one stays; documents without a word all stay. A null id comes after all others.
    """
    return jaccard.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that also start elsewhere; n_chars follows; a document of which nothing is left goes.

    A text that was empty or null before stays as it is.
    """
    return repeats.cut_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark windows; those without words stay."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (packed little-endian unsigned 32-bit) and whether decoding gives the text back."""
    found = bpe.encode_column(docs.select("doc_id", "lang", "source", "text"), tokenizer(), decoded_col="decoded")
    return found.select(
        "doc_id", "lang", "source", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def _stage(function):
    """Every stage sends whole texts to Python workers, so it runs with small batches."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return function(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality", _stage(keep_quality)), ("near_copies", _stage(drop_near_copies)), ("repeats", _stage(cut_repeats)),
    ("decontamination", _stage(drop_contaminated)), ("bpe", _stage(encode)),
]
#: Fitted models, connected components and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
