"""Repeated lines removed, with the lines seen so far kept as levelled sorted runs of hashes.

A run is a table of line hashes, bucketed and sorted by them: for each line the number of rows of
a batch that hold it and, where no earlier run knows the line, the id that keeps it.  A batch adds
one run.  Which of its lines are new is found by anti-joins with the runs there are, each a merge
of two tables that are laid out alike, without moving a run.  When a level has ``fanout`` runs
they are merged into one of the next level, so a line is written again once a level and there are
never more than ``fanout`` runs a level.

Everything here is DataFrame work without Python on the executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, scratch_path
from .common import stored

#: Shorter lines (in code points, after stripping) are never removed.
MIN_CHARS = 40
#: Rows that must hold a line before it is removed from all but one.
MIN_DOCS = 5
#: Runs of a level that are merged into one of the next level.
FANOUT = 2

#: The letters that keys fold, no others.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANK = " \t\n\x0b\x0c\r"
_HASH = ["_h1", "_h2"]
_ROW = ["_r1", "_r2"]


def keys(text: Column) -> Column:
    """The key of every line of ``text`` (null: one empty line): stripped, A-Z in lower case."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.transform(F.split(lowered, "\n", -1), lambda line: F.btrim(line, F.lit(_BLANK)))


def _hashes(*parts: Column | str) -> tuple[Column, Column]:
    return tuple(F.xxhash64(F.lit(seed), *parts) for seed in (1, 2))


def line_counts(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(_h1, _h2, n, top): rows that hold each line and the largest id among them."""
    lines = docs.select(F.col(id_col).alias("_id"), F.explode(F.array_distinct(keys(F.col(text_col)))).alias("_key"))
    lines = lines.filter(F.length("_key") >= min_chars)
    h1, h2 = _hashes("_key")
    hashed = lines.select("_id", h1.alias("_h1"), h2.alias("_h2"))
    return hashed.groupBy(*_HASH).agg(F.count(F.lit(1)).alias("n"), F.max("_id").alias("top"))


@dataclass
class Run:
    """One sorted run on storage, oldest first within its level."""

    table: str
    path: str


@dataclass
class LineRuns:
    """The lines of all batches added so far.

    ``buckets`` is the number of parts of every run and stays the same for all of them; by default
    the session's number of shuffle partitions, which the counts of a batch are dealt into anyway.
    """

    spark: SparkSession
    fanout: int = FANOUT
    buckets: int | None = None
    levels: list[list[Run]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, rows: DataFrame) -> Run:
        run = Run(f"line_run_{uuid.uuid4().hex}", scratch_path(self.spark, "run"))
        writer = rows.write.format("parquet").option("path", run.path)
        writer.bucketBy(self.buckets, *_HASH).sortBy(*_HASH).saveAsTable(run.table)
        return run

    def _read(self, run: Run) -> DataFrame:
        return self.spark.table(run.table)

    def _drop(self, run: Run) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run.table}")
        discard(self.spark, run.path)

    def runs(self) -> list[Run]:
        """Oldest first: a higher level holds older batches."""
        return [run for level in reversed(self.levels) for run in level]

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> None:
        """Add the lines of one batch.  A line that no earlier batch has is kept by the largest id
        of this one."""
        own = self._write(line_counts(docs, id_col, text_col, min_chars))
        counts = self._read(own)
        new = reduce(lambda left, run: left.join(self._read(run).select(*_HASH), _HASH, "left_anti"), self.runs(), counts)
        added = counts.drop("top").join(new.select(*_HASH, F.col("top").alias("holder")), _HASH, "left")
        run = self._write(added)
        self._drop(own)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(run)
        self._compact()

    def _compact(self) -> None:
        for i, level in enumerate(self.levels):
            if len(level) < self.fanout:
                break
            merged = self._write(self._merged(level))
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(merged)
            self.levels[i] = []
            for run in level:
                self._drop(run)

    def _merged(self, runs: list[Run]) -> DataFrame:
        def merge(old: DataFrame, young: DataFrame) -> DataFrame:
            young = young.select(*_HASH, F.col("n").alias("_n"), F.col("holder").alias("_holder"))
            both = old.join(young, _HASH, "full")
            return both.select(
                *_HASH,
                (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n"),
                F.coalesce("holder", "_holder").alias("holder"),
            )

        return reduce(merge, map(self._read, runs))

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(_h1, _h2, holder): lines that at least ``min_docs`` rows hold, and the id that keeps each."""
        if not self.runs():
            raise ValueError("no batch was added")
        return stored(self._merged(self.runs()).filter(F.col("n") >= min_docs).select(*_HASH, "holder"))

    def drop(self) -> None:
        """Remove all runs from storage."""
        for run in self.runs():
            self._drop(run)
        self.levels = []


def without_lines(docs: DataFrame, repeated: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the ``repeated`` lines, except in the rows whose id keeps them.

    Columns: those of ``docs`` with the shortened text, then ``n_lines`` (before) and ``n_dropped``;
    an input column of one of these two names is replaced.
    """
    others = [c for c in docs.columns if c.lower() not in (id_col.lower(), text_col.lower(), "n_lines", "n_dropped")]
    r1, r2 = _hashes(F.isnull(id_col), id_col, F.isnull(text_col), text_col)
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), rest.alias("_rest"), r1.alias("_r1"), r2.alias("_r2"))
    lines = rows.select("_id", *_ROW, F.posexplode(keys(F.col("_text"))).alias("_place", "_key")).filter(F.length("_key") >= min_chars)
    h1, h2 = _hashes("_key")
    lines = lines.select("_id", *_ROW, "_place", h1.alias("_h1"), h2.alias("_h2"))
    # rows that agree in id and text are one row here: their marks are equal
    marks = lines.join(repeated, _HASH).filter(~F.col("_id").eqNullSafe(F.col("holder")))
    marks = marks.groupBy(*_ROW).agg(F.collect_set("_place").alias("_places"))
    all_lines = F.split(F.coalesce("_text", F.lit("")), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("_places"))
    shorter = F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n")
    return rows.join(marks, _ROW, "left").select(
        F.col("_id").alias(id_col),
        F.when(F.col("_places").isNull(), F.col("_text")).otherwise(shorter).alias(text_col),
        *[F.col("_rest").getField(c).alias(c) for c in others],
        F.size(all_lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("_places"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def remove_repeated_lines(
    batches: Iterable[DataFrame],
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    fanout: int = FANOUT,
) -> DataFrame:
    """All batches without the lines that at least ``min_docs`` of their rows hold.

    A repeated line stays where the largest id of the first batch that has it holds it, and goes
    everywhere else, all its places in a row alike.  Every row counts as a document: rows with the
    same id count one by one, and all rows of the keeping id keep the line.  A null id is below
    every other.  A null text is one empty line and stays null; an empty batch adds nothing; no
    batch at all raises ``ValueError``.  A text may be of any length: its line hashes are rows.
    Columns as in :func:`without_lines`; all batches have the same ones.
    """
    batches = list(batches)
    if not batches:
        raise ValueError("no batch was given")
    runs = LineRuns(batches[0].sparkSession, fanout)
    try:
        for batch in batches:
            runs.add(batch, id_col, text_col, min_chars)
        repeated = runs.repeated(min_docs)
    finally:
        runs.drop()
    return without_lines(reduce(DataFrame.unionByName, batches), repeated, id_col, text_col, min_chars)


def by_falling_id(docs: DataFrame, n: int = 4, id_col: str = "doc_id") -> list[DataFrame]:
    """``docs`` in ``n`` batches of similar size, larger whole-number ids first, nulls last.

    How even they are depends on an approximation, the rows of all batches together do not.
    """
    at = [1 - k / n for k in range(1, n)]
    found = docs.agg(F.percentile_approx(id_col, at, 10_000)).first()[0] or []
    bounds = sorted(set(found), reverse=True)
    value, batches, above = F.col(id_col), [], None
    for bound in bounds:
        below = F.lit(True) if above is None else value <= above
        batches.append(docs.filter((value > bound) & below))
        above = bound
    last = F.lit(True) if above is None else value.isNull() | (value <= above)
    return [*batches, docs.filter(last)]
