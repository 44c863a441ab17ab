"""Language identification by compression.

Each language gets a zstandard raw-content dictionary: a bounded sample of its training texts.  A
text is compressed once with each dictionary, and the language whose dictionary leaves the fewest
bytes is chosen.  Long texts are compressed in pieces, each starting from the dictionary afresh, so
that the whole text counts and its own repetitions do not drown the dictionary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

UNDETERMINED = "und"
#: Sample of each language: so many texts at most, in an order that hashes their keys, and so many
#: bytes of them in its dictionary.
SAMPLE_TEXTS = 256
DICTIONARY_BYTES = 16 << 10
#: A language is learned from at most so many bytes of one text, so that no text fills its dictionary.
SAMPLE_BYTES = 2048
PIECE_BYTES = 4096
#: A level with lazy matching; small tables, since each call starts from a copy of them.
LEVEL, TABLE_LOG = 6, 13
#: Below this saving over the second-best language, as a share of its bytes, a decision is rejected.
MIN_MARGIN = 0.01
#: Saved share at which the score has gone half the way from an even guess to certainty.
SCALE = 0.02

#: ASCII letters stay, in lower case; other ASCII becomes a space; bytes of other letters stay.
_LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def plain(text: str) -> bytes:
    """Lower-case words in UTF-8, one space between; empty if the text has no letter."""
    words = b" ".join(text.lower().encode("utf-8").translate(_LETTERS).split())
    if words.isascii() or any(map(str.isalpha, text)):
        return words
    return b""


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries by language; languages with more training rows come first and win ties."""

    dictionaries: dict[str, bytes]

    def compressors(self) -> dict[str, zstandard.ZstdCompressor]:
        out = {}
        for lang, content in self.dictionaries.items():
            settings = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, source_size=PIECE_BYTES, dict_size=len(content), hash_log=TABLE_LOG,
                chain_log=TABLE_LOG, write_content_size=False, write_dict_id=False,
            )
            digested = zstandard.ZstdCompressionDict(content, zstandard.DICT_TYPE_RAWCONTENT)
            digested.precompute_compress(compression_params=settings)  # once, not for every text
            out[lang] = zstandard.ZstdCompressor(compression_params=settings, dict_data=digested)
        return out


def in_training(key: str = "doc_id", folds: int = 4, held_out: int = 2) -> Column:
    """Whether a row may be learned from: crc32 of the key as text, modulo the folds."""
    return ~is_held_out(key, folds, held_out)


def is_held_out(key: str = "doc_id", folds: int = 4, held_out: int = 2) -> Column:
    """A null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == held_out


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Dictionaries from a bounded sample of rows with a text and a language.

    At most SAMPLE_TEXTS texts a language come to the driver, SAMPLE_BYTES of each.  Rows are taken
    by the hash of key and text, so copies of a row count once and the sample does not depend on how
    the table is stored.  An empty table gives a model without languages.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL AND trim(text) <> ''")
    share = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("key", F.substring("text", 1, SAMPLE_BYTES))
    # four times the wanted share of each language first, then the exact top of that
    limit = F.lit(0.0)
    for name, n in sorted(share.items()):
        limit = F.when(F.col("lang") == name, F.lit(min(1.0, 4 * SAMPLE_TEXTS / n))).otherwise(limit)
    near = rows.select("lang", F.substring("text", 1, SAMPLE_BYTES).alias("text"), order.alias("o"))
    near = near.filter(F.pmod(F.col("o"), F.lit(1 << 30)) < limit * (1 << 30)).distinct()
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("o", "text")))
    chosen: dict[str, list[bytes]] = {name: [] for name in sorted(share, key=lambda x: (-share[x], x))}
    for r in ranked.filter(F.col("rank") <= SAMPLE_TEXTS).orderBy("lang", "rank").collect():
        chosen[r["lang"]].append(plain(r["text"]))
    return LanguageModel({
        name: b" ".join(texts)[:DICTIONARY_BYTES] or b" "
        for name, texts in chosen.items()
    })


def _decide(text: str | None, compressors: dict) -> tuple[str, float, bool]:
    letters = plain(text) if text else b""
    if not letters or not compressors:
        return UNDETERMINED, 0.0, True
    letters = b" %b " % letters
    pieces = [letters[i : i + PIECE_BYTES] for i in range(0, len(letters), PIECE_BYTES)]
    sizes = {lang: sum([len(c.compress(p)) for p in pieces]) for lang, c in compressors.items()}
    best = min(sizes, key=sizes.get)
    if len(sizes) == 1:
        return best, 1.0, False
    second = min(size for lang, size in sizes.items() if lang != best)
    margin = 1 - sizes[best] / second
    even = 1 / len(sizes)
    return best, even + (1 - even) * (1 - math.exp2(-margin / SCALE)), margin < MIN_MARGIN


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected`` (margin too narrow).

    Texts that are null, empty or without a letter are ``und`` with score 0, rejected.  A tie goes
    to the language with more training rows, rejected.  Columns of these names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most DICTIONARY_BYTES a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = sent.value.compressors()
        for batch in batches:
            found = [_decide(t, compressors) for t in batch.column(text).to_pylist()]
            names, scores, narrow = zip(*found) if found else ((), (), ())
            batch = batch.append_column("lang_pred", pa.array(names, pa.string()))
            batch = batch.append_column("score", pa.array(scores, pa.float64()))
            yield batch.append_column("rejected", pa.array(narrow, pa.bool_()))

    docs = docs.drop("lang_pred", "score", "rejected")
    return docs.mapInArrow(run, StructType(docs.schema.fields + [
        StructField("lang_pred", StringType()), StructField("score", DoubleType()),
        StructField("rejected", BooleanType()),
    ]))
