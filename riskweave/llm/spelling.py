"""Spelling variants: the words of a corpus, near words one edit apart, and the form of each.

The words that may be near each other are brought together without comparing all: two words are
one insertion, deletion or replacement apart exactly if they agree before and after one place, so
they share the first half or the second half of the shorter one.  Words are grouped by half, a
group that is still large is halved again around the place of the edit, and so on; a group whose
place is fixed holds a few hundred words at most, as many as one letter can make.

Inside a group the words stand sorted, and all are looked up at once while the list is scanned:
a row of the edit matrix depends on the letters so far only, so the rows of the prefix that a word
shares with the one before it stay as they are.  Of a row only the three cells around the diagonal
can be one or less.  Where no looked-up word is within one edit of a prefix, all words of the list
that begin with it are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .lines import UPPER

#: Words have so many code points at least.
MIN_CHARS = 6
#: Words occur so often at least.
MIN_COUNT = 5
#: A form is so many times as frequent as the words it stands for.
RATIO = 5
#: Groups of more letters in all are halved again.
GROUP = 1 << 15

LETTERS = "A-Za-zÀ-ÿ"


def runs(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """The maximal runs of letters of ``text`` that have ``min_chars`` letters, A-Z in lower case."""
    lowered = F.translate(text, UPPER, UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))


def word_counts(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of ``words`` (word): those long and frequent enough.  Null words do not count."""
    counts = words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= min_count)


def near_pairs(words: list[str]) -> Iterator[tuple[int, int, int]]:
    """(i, j, place) of all words[i], words[j] one edit apart, i < j; ``words`` distinct, and sorted
    for speed: in another order fewer letters are shared and nothing else changes.

    Row d of the matrix between a looked-up word u and the first d letters of a list word has the
    cells u[:d-1], u[:d], u[:d+1].  ``rows[d]`` keeps it for all u that are still within one edit.
    ``place`` is the first place where both differ.
    """
    count, lengths = len(words), np.array([len(w) for w in words])
    width = int(lengths.max(initial=1)) or 1
    letters = np.zeros((count, width + 4), dtype=np.int32)  # two blanks before, two behind
    letters[:, 2:-2] = np.array(words, dtype=f"U{width}").view(np.int32).reshape(count, width)
    lcp = [0, *(letters[1:, 2:] != letters[:-1, 2:]).argmax(axis=1).tolist()]
    # row 0: u[:-1] (none, counted as far), u[:0], u[:1]
    rows = [(np.arange(count), np.tile(np.array([2, 0, 1], dtype=np.int8), (count, 1)))]
    skip_at = width + 1  # words that share so many letters with the last one are skipped
    for j in range(count):
        if lcp[j] >= skip_at:
            continue
        skip_at = width + 1
        del rows[lcp[j] + 1 :]
        for d in range(len(rows), lengths[j] + 1):
            alive, before = rows[d - 1]
            row = before + (letters[alive, d : d + 3] != letters[j, d + 1])
            np.minimum(row[:, :2], before[:, 1:] + 1, out=row[:, :2])
            np.minimum(row[:, 1], row[:, 0] + 1, out=row[:, 1])
            np.minimum(row[:, 2], row[:, 1] + 1, out=row[:, 2])
            within = (row <= 1).any(axis=1)
            if not within.any():
                skip_at = d
                break
            rows.append((alive[within], row[within]))
        else:
            alive, row = rows[lengths[j]]
            cell = lengths[alive] - lengths[j] + 1
            ok = (alive < j) & (cell >= 0) & (cell <= 2)
            alive, row, cell = alive[ok], row[ok], cell[ok]
            for i in alive[row[np.arange(len(cell)), cell] == 1].tolist():
                yield i, j, int((letters[i, 2:] != letters[j, 2:]).argmax())


def _keyed(words: DataFrame) -> DataFrame:
    """Members of the first groups: each word as the shorter and as the longer one of a pair.

    ``length`` is that of the shorter word, ``lo`` to ``hi`` are the places where the edit may be.
    """
    size = F.length("word")
    members = words.select("word", F.explode(F.array(size, size - 1)).alias("length"))
    return _halves(members.withColumns({"lo": F.lit(0), "hi": F.col("length") + 1}))


def _halves(members: DataFrame) -> DataFrame:
    """The two groups of each member with half as many places for the edit."""
    middle = F.expr("(lo + hi) div 2").cast("int")
    halves = F.array(
        F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi"))
    )
    split = members.select("word", "length", F.explode(halves).alias("part")).select("word", "length", "part.*")
    after = F.greatest(F.col("length") - F.col("hi"), F.lit(0))
    return split.withColumns(
        {"head": F.expr("left(word, lo)"), "tail": F.when(after > 0, F.expr("right(word, greatest(length - hi, 0))")).otherwise("")}
    )


_GROUP = ["length", "lo", "hi", "head", "tail"]


def near(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, near): both directions of all pairs of ``words`` (word, distinct) one edit apart."""
    members, found = stored(_keyed(words.select("word"))), None
    while True:
        sizes = members.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("size"))
        sizes = stored(sizes.filter("size > 1"))
        sized = members.join(sizes, _GROUP)
        # one place left: as many words as a letter has values, halving ends there
        small = (F.col("size") * (F.col("length") + 1) <= group) | (F.col("hi") - F.col("lo") <= 1)
        pairs = _scan(sized.filter(small).drop("size"))
        found = pairs if found is None else found.unionAll(pairs)
        if sizes.filter(~small).isEmpty():
            return found
        members = stored(_halves(sized.filter(~small).drop("size", "head", "tail")))


def _scan(members: DataFrame) -> DataFrame:
    """The pairs of every group, each found once: where the first difference is a place of the
    group and the shorter word has its length.  Only the letters between what all words of a group
    share at both ends are compared."""
    key = F.concat_ws("\0", "length", "lo", "hi", "head", "tail")
    ordered = members.select(key.alias("key"), "word").repartition("key").sortWithinPartitions("key", "word")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, words in _groups(batches):
            length, lo, hi, _, tail = key.split("\0")
            length, lo, hi, tail = int(length), int(lo), int(hi), len(tail)
            left, right = [], []
            for i, j, place in near_pairs([w[lo : len(w) - tail] for w in words]):
                if lo + place < hi and min(len(words[i]), len(words[j])) == length:
                    left += [words[i], words[j]]
                    right += [words[j], words[i]]
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], names=["word", "near"])

    return ordered.mapInArrow(pairs, "word string, near string")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """(key, sorted words) of every group of a sorted partition."""
    key, words = None, []
    for batch in batches:
        keys, own = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("key", "word"))
        for k, word in zip(keys, own):
            if k != key:
                if words:
                    yield key, words
                key, words = k, []
            words.append(word)
    if words:
        yield key, words


def forms(counts: DataFrame, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of ``counts`` (word, n; words distinct and not null).

    ``form`` is the near word with the largest n (ties: the first in code-point order) if that is
    ``ratio`` times as frequent, else null; ``root`` is the last word that forms lead to.  Counts
    grow along a way to the root, so with a ratio above 1 it has no loop.  No words give no rows.
    """
    if ratio < 2:
        raise ValueError("the ratio is 2 at least")
    counts = stored(counts.select("word", F.col("n").cast("long").alias("n")))
    links = near(counts, group).join(counts.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near")))
    linked = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    words = counts.join(linked, "word", "left")
    follows = F.col("best.near_n") >= F.col("n") * ratio
    words = stored(words.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(follows, F.col("best.near")).alias("form"), F.when(follows, F.col("best.near_n")).alias("form_n"),
    ))
    return words.join(_roots(words), "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(words: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: ways are doubled until none gets longer.

    n grows by the ratio at each step, so a way has at most 63 steps and doubling ends after six.
    """
    ways = stored(words.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = stored(ways.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("grew")))
        if longer.filter("grew").isEmpty():
            return longer.select("word", "root")
        ways = longer.select("word", "root")


def group_variants(docs: DataFrame, words: Column, ratio: int = RATIO, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """:func:`forms` of the words in ``docs``; ``words`` is an array of them a row.

    A null or empty array adds no words, repeated rows count again, an empty table gives no rows,
    other columns are not read.  Words of any length and texts of any length are taken whole.
    """
    found = docs.select(F.explode(words).alias("word"))
    return forms(word_counts(found, min_chars, min_count), ratio)
