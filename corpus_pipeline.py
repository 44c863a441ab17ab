"""The corpus pipeline: documents graded, deduplicated, decontaminated, pseudonymized and coded.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import bpe, decontaminate, ngram_join, pii, quality
from riskweave.llm.common import stored, table
from riskweave.llm.queries import PII_KEY, tokenizer_file


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier selects."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.grade(docs, model).filter("selected").select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.keep_one(docs).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_leaked(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal numbers and dates replaced; ``n_chars`` follows the text."""
    found = pii.pseudonymize(docs, PII_KEY)
    if "n_chars" in found.columns:
        found = found.withColumn("n_chars", F.when(F.col("n_replaced") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return found.select(docs.columns)


def coded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the tokens of each document that is left."""
    found = bpe.round_trip(docs.select("doc_id", "text"), tokenizer_file())
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("PII", with_pseudonyms),
    ("BPE encoding and decoding", coded),
]

#: No stage can be written in SQL as a whole; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
