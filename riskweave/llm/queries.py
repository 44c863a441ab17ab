"""The corpus queries by name; each runs its operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, html, language, lines, merkle, ngram_join, pii, quality, search, spans, spelling
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer file as installed on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op2_bpe_round_trip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, tokenizer_file()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.filter(language.in_training("doc_id")))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.is_held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


#: Key of the registered pseudonyms; a real job passes its own from a secret store.
PII_KEY = b"riskweave corpus queries"


@query
def op8_pseudonyms(spark, sf_dir):
    found = pii.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return found.select("doc_id", "n_replaced", "replaced", "text")


@query
def op9_maximal_conversations(spark, sf_dir):
    return chat.collapse_and_render(table(spark, sf_dir, "conversations"))


@query
def op10_repeated_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.remove_repeated_spans(docs).select("doc_id", "n_sentences", "n_removed", "text")


@query
def op6_benchmark_leaks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))


@query
def op1_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_main_text(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op5_quality_grades(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.grade(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "expected_grade", "p_wanted", "selected")


@query
def op7_top_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = search.top_k(docs, docs.filter("doc_id % 100 = 0"))
    return found.withColumn("score", F.round("score", 6))


@query
def op11_merkle_witnesses(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    leaves = docs.select("doc_id", "lang", merkle.row_digest(*columns).alias("leaf"), *columns[1:2], "n_chars", "text")
    tampers = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", lines.UPPER, lines.UPPER.lower())
    leaves = leaves.withColumn("text", F.when(tampers, lowered).otherwise(F.col("text")))
    leaves = leaves.select("doc_id", "lang", "leaf", merkle.row_digest(*columns).alias("tampered"))
    found = merkle.manifest(leaves, F.col("lang"), F.col("leaf"), [F.col("doc_id")])
    found = found.withColumn("folded_root", merkle.folded(F.col("row.tampered"), F.col("witness")))
    return found.select(
        "row.doc_id", F.col("digest").alias("leaf"), "subroot", "root", merkle.proof_digest(F.col("witness")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query
def op12_spelling_forms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def misspelt(run):
        """One run in 199, by the checksum of its place, loses a letter."""
        mark = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run))
        at = (mark % F.length(run)).cast("int")
        shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
        return F.when(mark % 199 == 0, shorter).otherwise(run)

    found = docs.select("doc_id", F.explode(spelling.runs(F.col("text"))).alias("run"))
    found = found.select(F.array(misspelt(F.col("run"))).alias("words"))
    return spelling.group_variants(found, F.col("words"))


@query
def op13_line_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lines.remove_repeated_lines(lines.by_falling_id(docs))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return found.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))
