"""Removal of repeated passages by hashing runs of consecutive sentences.

A run starts or ends at every sentence and is as short as the least number of sentences and words
allows; a very long sentence is a run by itself.  Equal passages therefore hold equal runs, which
together cover all of a passage's sentences.  Each run's first row is found by one aggregation
over all runs; every later occurrence marks its sentences, which are then cut out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import mix, powers, row_key, stored

_BREAK = re.compile(r"\s*\n\s*|(?<=[.!?])\s+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Stands for a null document id, which comes last.
_NO_ID = (1 << 63) - 1
#: Column that tells apart rows of one id, or rows without one.
_ROW = "_row_of_id"


@dataclass(frozen=True)
class RunRule:
    """A run has at least so many sentences and words, or is one sentence of so many words."""

    sentences: int = 2
    words: int = 20
    single: int = 40


def sentence_starts(text: str) -> list[int]:
    """Offsets at which sentences start; breaks are line ends and white space after . ! ?"""
    starts = [0, *[m.end() for m in _BREAK.finditer(text)]]
    return starts[:-1] if len(starts) > 1 and starts[-1] == len(text) else starts


class Runs:
    """The runs of several texts: first and last sentence, hash, and the sentences of each text."""

    def __init__(self, texts: list[str | None], rule: RunRule):
        self.starts = [sentence_starts(t) if t else [] for t in texts]
        hashes, words = [], []
        for text, starts in zip(texts, self.starts):
            for a, b in zip(starts, [*starts[1:], len(text or "")]):
                tokens = text[a:b].lower().split()
                words.append(len(tokens))
                hashes.append(xxhash.xxh3_64_intdigest(" ".join(tokens)))
        n = len(words)
        self.first = np.concatenate([[0], np.cumsum([len(s) for s in self.starts])]).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(np.array(words, dtype=np.int64))]).astype(np.int64)
        at = np.arange(n)
        doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        low, high = self.first[doc], self.first[doc + 1]
        ahead = np.maximum(np.searchsorted(total, total[:-1] + rule.words) - 1, at + rule.sentences - 1)
        behind = np.minimum(np.searchsorted(total, total[1:] - rule.words, side="right") - 1, at - rule.sentences + 1)
        one = np.array(words, dtype=np.int64) >= rule.single
        from_here, to_here = ahead < high, behind >= low
        a = np.concatenate([at[from_here], behind[to_here], at[one]])
        b = np.concatenate([ahead[from_here], at[to_here], at[one]])
        pairs = np.unique(a * (n + 1) + b)
        self.a, self.b = pairs // (n + 1), pairs % (n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix(np.array(hashes, dtype=np.uint64)) * powers(_STEP, n), out=sums[1:])
        back = powers(_STEP_INVERSE, n + 1)
        spread = (sums[self.b + 1] - sums[self.a]) * back[self.a]
        self.hash = mix(spread + (self.b - self.a).astype(np.uint64)).view(np.int64)
        self.doc = doc[self.a] if n else np.zeros(0, dtype=np.int64)


def told_apart(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with a number that tells apart rows of one key by their text, and rows with a null
    key all; the latter are written once, so that every reader sees the same numbers."""
    no_key = F.col(key).cast("long").isNull()
    keyed = docs.filter(~no_key).withColumn(_ROW, row_key(text))
    return keyed.unionAll(stored(docs.filter(no_key).withColumn(_ROW, F.monotonically_increasing_id())))


def run_table(docs: DataFrame, key: str, text: str, rule: RunRule) -> DataFrame:
    """(h, id, row): each different run of each row of ``told_apart``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 500):
                runs = Runs(texts[at : at + 500], rule)
                order = np.lexsort((runs.hash, runs.doc))
                h, doc = runs.hash[order], runs.doc[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(h[new]), pa.array(ids[at + doc[new]]), pa.array(rows[at + doc[new]])], ["h", "id", "row"])

    texts = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("id"), F.col(text).alias("text"), _ROW)
    return texts.mapInArrow(run, "h long, id long, row long")


def remove_repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rule: RunRule = RunRule()
) -> DataFrame:
    """``docs`` without sentences in any run that occurred before, earlier in the same text or in a
    row that comes before; ``n_sentences`` and ``n_removed`` are added (replaced).

    Keys are whole numbers.  Rows come in order of keys, those with a null key last.  Different texts of one key count against
    each other, in order of their hashes, and so do all rows with a null key; only repeated rows, of
    the same key and text, do not.  Null texts stay null, empty ones empty, with no sentences.  Texts
    shorter than a run are kept, however often they occur.
    """
    docs = docs.drop("n_sentences", "n_removed")
    given, kinds = docs.columns, [f.dataType for f in docs.schema.fields]
    # columns go by their place here, whatever their names are
    key, text = (f"c{[g.lower() for g in given].index(c.lower())}" for c in (key, text))
    docs = docs.toDF(*[f"c{i}" for i in range(len(given))])
    docs = told_apart(docs, key, text)
    runs = run_table(docs, key, text, rule)
    who = F.struct("id", "row")
    firsts = runs.groupBy("h").agg(F.min(who).alias("first"), F.max(who).alias("last"))
    firsts = firsts.filter("first < last").select("h", "first")
    # a row's list is bounded by its own text
    marks = runs.join(firsts, "h").filter(who > F.col("first")).groupBy("id", "row").agg(F.collect_set("h").alias("marked"))
    same = (F.coalesce(docs[key].cast("long"), F.lit(_NO_ID)) == marks["id"]) & (docs[_ROW] == marks["row"])
    marked = docs.join(marks, same, "left")
    columns = [docs[f"c{i}"] for i in range(len(given))]
    place = int(text[1:])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marked = batch.column(place).to_pylist(), batch.column(batch.num_columns - 1)
            kept, sentences, removed = [], [], []
            for at in range(0, len(texts), 500):
                part = texts[at : at + 500]
                lists = marked.slice(at, len(part))
                elsewhere = set(lists.flatten().to_pylist())
                runs = Runs(part, rule)
                own = [set(x) if x else () for x in lists.to_pylist()] if elsewhere else [()] * len(part)
                covered: dict[int, set[int]] = {}
                seen: dict[int, set[int]] = {}
                order = np.argsort(runs.a, kind="stable")
                for h, d, a, b in zip(*(x[order].tolist() for x in (runs.hash, runs.doc, runs.a, runs.b))):
                    before = seen.setdefault(d, set())
                    if h in before or h in own[d]:
                        covered.setdefault(d, set()).update(range(a, b + 1))
                    before.add(h)
                for d, value in enumerate(part):
                    starts, base = runs.starts[d], int(runs.first[d])
                    gone = covered.get(d, ())
                    sentences.append(len(starts))
                    removed.append(len(gone))
                    if gone:
                        ends = [*starts[1:], len(value)]
                        value = "".join([value[a:b] for i, (a, b) in enumerate(zip(starts, ends)) if base + i not in gone]).rstrip()
                    kept.append(value)
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays[place] = pa.array(kept, pa.string())
            arrays += [pa.array(sentences, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = StructType([StructField(c, StringType() if i == place else kinds[i]) for i, c in enumerate(given)]
                        + [StructField("n_sentences", LongType()), StructField("n_removed", LongType())])
    names = schema.names
    return marked.select(*columns, "marked").mapInArrow(cut, schema)
