"""Quality grades by ordinal cumulative-link regression on hashed words.

One weight vector over hashed words is shared by all grades; ordered thresholds t_1 < t_2 < ... turn
the score s of a text into P(grade >= k) = logistic(s - t_k).  The expected grade is the sum of
these tail probabilities, and a text is selected by the tail probability of the wanted grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from .common import CHUNK_BYTES, chunks, slices, span_hashes

#: Cells that words are hashed into.
CELLS = 1 << 16
#: The model is fitted on at most so many graded texts, and so many bytes of them, taken in an order
#: that hashes their keys.
SAMPLE_TEXTS, SAMPLE_BYTES = 8192, 32 << 20
EPOCHS, BATCH, STEP, DECAY = 15, 256, 0.05, 1e-3
#: Small samples are gone through more often, for at least so many steps.
LEAST_STEPS = 300
#: A text is selected if it has at least the wanted grade with this probability.
WANTED_GRADE, LEAST_PROBABILITY = 2, 0.4

# lower case, and bytes that are neither letters, digits nor part of UTF-8 letters end a word
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PART = np.array([b > 127 or chr(b).isalnum() for b in range(256)])
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, cell, value) of each different cell of each text.

    Cells are of words, of the marks between words, and of whether words are in capitals; their
    values grow with the logarithm of their number, and marks and capitals with their share.
    """
    found = [_cells(texts[a:b], a) for a, b in chunks(texts)]
    none = np.zeros(0, np.int32), np.zeros(0, np.uint16), np.zeros(0)
    return tuple(map(np.concatenate, zip(none, *found)))


def _cells(texts: list[bytes], first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`features` of one chunk of texts, numbered from ``first``."""
    owner, cell, share = [], [], []
    joined = b" ".join(texts)
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    raw = np.frombuffer(joined, dtype=np.uint8)
    low = np.frombuffer(joined.translate(_LOWER), dtype=np.uint8)
    part = _PART[raw]
    for kind, inside in ((0, part), (1, ~part & ~_SPACE[raw])):
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK_BYTES)))
            base = starts[at]
            h = span_hashes(low[base : ends[to - 1]], starts[at:to] - base, ends[at:to] - base)
            cell.append(((h + np.uint64(kind)) >> np.uint64(48)).astype(np.int64))
            owner.append(np.searchsorted(begin, starts[at:to], side="right") - 1)
            share.append(np.full(to - at, kind))
            if kind == 0:
                capital = (raw[starts[at:to]] < 91) & (raw[ends[at:to] - 1] < 91) & (raw[starts[at:to]] > 64)
                capital &= ends[at:to] - starts[at:to] > 1
                cell.append(np.full(int(capital.sum()), 1))
                owner.append(owner[-1][capital])
                share.append(np.full(int(capital.sum()), 1))
            at = to
    if not cell:
        return np.zeros(0, np.int32), np.zeros(0, np.uint16), np.zeros(0)
    owner, cell, share = np.concatenate(owner), np.concatenate(cell), np.concatenate(share)
    key, place, count = np.unique(owner * CELLS + cell, return_index=True, return_counts=True)
    total = np.bincount(owner, minlength=len(texts))[key // CELLS]
    value = np.where(share[place] > 0, 10.0 * count / total, np.log2(1.0 + count) * 0.5)
    return (first + key // CELLS).astype(np.int32), (key % CELLS).astype(np.uint16), value


@dataclass(frozen=True)
class OrdinalModel:
    """Weights by cell, and thresholds in rising order; grades are 0 .. number of thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: list[bytes]) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...; one row a text."""
        text, cell, value = features(texts)
        score = np.bincount(text, value * self.weights[cell], minlength=len(texts))
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def fit(texts: list[bytes], grades: np.ndarray, n_grades: int) -> OrdinalModel:
    """Maximum likelihood by mini-batch Adam, with classes weighted by the root of their rarity."""
    text, cell, value = features(texts)
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    weights, gaps = np.zeros(CELLS), np.zeros(max(1, n_grades - 1))
    share = np.bincount(grades, minlength=n_grades) / max(1, len(grades))
    gaps[0], gaps[1:] = -1.0, np.log(0.5)
    importance = np.sqrt(1 / np.maximum(share, 1e-3))[grades]
    importance /= importance.mean() if len(importance) else 1
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (weights, gaps)]
    random, step = np.random.default_rng(7), 0
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // max(1, len(texts))))):
        order = random.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            n = first[chosen + 1] - first[chosen]
            entry = np.repeat(first[chosen] - np.cumsum(n) + n, n) + np.arange(n.sum())
            row = np.repeat(np.arange(len(chosen)), n)
            score = np.bincount(row, value[entry] * weights[cell[entry]], minlength=len(chosen))
            limits = np.concatenate([[-60.0], gaps[0] + np.concatenate([[0], np.cumsum(np.exp(gaps[1:]))]), [60.0]])
            grade = grades[chosen]
            tail = lambda k: 1 / (1 + np.exp(np.clip(limits[k] - score, -60, 60)))
            low, high = tail(grade), tail(grade + 1)
            p = np.maximum(low - high, 1e-9)
            d_low, d_high = low * (1 - low) / p, high * (1 - high) / p
            scale = importance[chosen] / len(chosen)
            d_score = -(d_low - d_high) * scale
            d_weights = np.bincount(cell[entry], value[entry] * d_score[row], minlength=CELLS) + DECAY * weights
            d_limit = np.bincount(grade, d_low * scale, minlength=n_grades + 1)
            d_limit -= np.bincount(grade + 1, d_high * scale, minlength=n_grades + 1)
            d_limit = d_limit[1:n_grades]
            d_gaps = np.array([d_limit.sum(), *(np.exp(gaps[i]) * d_limit[i:].sum() for i in range(1, len(gaps)))])
            step += 1
            for p_, g, (m, v) in zip((weights, gaps), (d_weights, d_gaps), state):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p_ -= STEP * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return OrdinalModel(weights, gaps[0] + np.concatenate([[0], np.cumsum(np.exp(gaps[1:]))]))


def _grade() -> Column:
    """The grade of a label: null, as unknown, where a null leaves it open."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, text, grade): 0 for toxic texts, 1 for poor ones, 2 for good ones.

    Rows without a text are left out, and labels whose nulls leave the grade open: a null toxic
    with quality 1, a null quality without toxic 1.
    """
    rated = labels.select(F.col("doc_id").alias("key"), _grade().alias("grade")).filter("grade IS NOT NULL AND key IS NOT NULL")
    rated = rated.groupBy("key").agg(F.min("grade").alias("grade"))
    fits = F.octet_length("text") <= SAMPLE_BYTES
    present = docs.filter(F.col("text").isNotNull() & fits).select(F.col("doc_id").alias("key")).distinct()
    chosen = rated.join(present, "key", "left_semi").orderBy(F.xxhash64("key"), "key").limit(SAMPLE_TEXTS)
    texts = docs.select(F.col("doc_id").alias("key"), "text").filter(F.col("text").isNotNull() & fits)
    return texts.join(F.broadcast(chosen), "key")  # SAMPLE_TEXTS rows


def train(docs: DataFrame, labels: DataFrame) -> OrdinalModel:
    """The model of a bounded sample of rated documents; without any label, every text has grade 2
    with probability one half.  Texts that do not fit into the sample any more are left out, smaller
    ones after them are not.  Of texts that share a key any may be learned from.

    Raises ValueError if documents and labels that say a grade are given, but no document that fits
    has such a label."""
    texts, grades, size = [], [], 0
    for r in graded(docs, labels).orderBy(F.xxhash64("key"), "key", F.xxhash64("text")).limit(SAMPLE_TEXTS).toLocalIterator():
        value = r["text"].encode("utf-8")
        if size + len(value) > SAMPLE_BYTES:
            continue
        texts.append(value)
        grades.append(r["grade"])
        size += len(value)
    if not texts:
        if not docs.filter("text IS NOT NULL").isEmpty() and not labels.filter(_grade().isNotNull()).isEmpty():
            raise ValueError("no document that fits into the sample has a label")
        return OrdinalModel(np.zeros(CELLS), np.zeros(2))
    return fit(texts, np.array(grades, dtype=np.int64), 3)


def grade(docs: DataFrame, model: OrdinalModel, text: str = "text", wanted: int = WANTED_GRADE,
          least: float = LEAST_PROBABILITY) -> DataFrame:
    """``docs`` with ``expected_grade``, ``p_wanted`` (probability of at least the wanted grade) and
    ``selected``; columns of these names are replaced.

    A null text has null grades and is not selected; an empty one is graded like any other.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # CELLS weights
    docs = docs.drop("expected_grade", "p_wanted", "selected")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = batch.column(text).to_pylist()
            coded = [v.encode("utf-8") if v else b"" for v in values]
            for a, b in chunks(coded):
                tails = sent.value.tails(coded[a:b])
                null = np.array([v is None for v in values[a:b]])
                part = batch.slice(a, b - a)
                part = part.append_column("expected_grade", pa.array(tails.sum(axis=1), mask=null))
                part = part.append_column("p_wanted", pa.array(tails[:, wanted - 1], mask=null))
                yield part.append_column("selected", pa.array((tails[:, wanted - 1] >= least) & ~null))

    return docs.mapInArrow(run, StructType(docs.schema.fields + [
        StructField("expected_grade", DoubleType()), StructField("p_wanted", DoubleType()),
        StructField("selected", BooleanType()),
    ]))
