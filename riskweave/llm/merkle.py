"""Hash trees over tables: roots of ordered groups of rows and, for every row, its witness.

Up to eight consecutive nodes of a level make one node of the next, until one is left.  A witness
holds, level by level, what stands before and after a node among its siblings; with it the root
can be folded again from the row alone.

Trees are built by streaming appends.  A block is an aligned run of 8**3 nodes; its nodes are
appended one by one, every node appended attaches a partial witness to the open subtree it falls
into, and when the siblings of a subtree are complete the witnesses below it are extended by them.
Blocks are spread over tasks, and their roots are appended again as nodes of a smaller tree, so
every pass is 512 times smaller than the one below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

FAN = 8
#: Levels of a block.
LEVELS = 3
BLOCK = FAN**LEVELS

_WITNESS = T.ArrayType(T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())]))
_ARROW_WITNESS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def parent(digests: list[str]) -> str:
    """The digest of consecutive nodes: sha256 of their hex texts written one after the other."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def row_digest(*columns: str) -> Column:
    """sha256 of a row: per column ``-`` for null, else the byte length of its text, ``:``, the text."""
    def part(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, columns)), 256)


class Appender:
    """Nodes appended in order to a tree; ``witnesses`` grow as subtrees are completed."""

    def __init__(self) -> None:
        self.witnesses: list[list[tuple[str, str]]] = []
        #: per level the nodes of the open subtree: digest and the rows below it
        self.open: list[list[tuple[str, range]]] = [[]]

    def append(self, digest: str) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._place(0, digest, range(at, at + 1))

    def _place(self, level: int, digest: str, rows: range) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((digest, rows))
        if len(self.open[level]) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        nodes, self.open[level] = self.open[level], []
        digests = [digest for digest, _ in nodes]
        for i, (_, rows) in enumerate(nodes):
            step = ("".join(digests[:i]), "".join(digests[i + 1 :]))
            for row in rows:
                self.witnesses[row].append(step)
        self._place(level + 1, parent(digests), range(nodes[0][1].start, nodes[-1][1].stop))

    def close(self, levels: int | None) -> str:
        """The root: after ``levels`` levels, or (None) as soon as one node is left."""
        level = 0
        while True:
            waiting = sum(map(len, self.open[level:]))
            if level == levels or levels is None and waiting == 1 and self.open[level]:
                return self.open[level][0][0]
            if self.open[level]:
                self._complete(level)
            level += 1


def _height(total: int) -> int | None:
    """Levels of a block in a tree of ``total`` nodes: all of them unless it is the only block."""
    return LEVELS if total > BLOCK else None


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Every block of a partition that is sorted by block, one after the other."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        trees, blocks = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_tree", "_block"))
        start = 0
        while start < len(trees):
            end = start + 1
            while end < len(trees) and (trees[end], blocks[end]) == (trees[start], blocks[start]):
                end += 1
            if held and key != (trees[start], blocks[start]):
                yield pa.Table.from_batches(held)
                held = []
            key = trees[start], blocks[start]
            held.append(batch.slice(start, end - start))
            start = end
    if held:
        yield pa.Table.from_batches(held)


def _appended(block: pa.Table) -> tuple[Appender, str]:
    """The nodes of a block appended one by one, and its root."""
    appender = Appender()
    for digest in block["_digest"].to_pylist():
        appender.append(digest)
    return appender, appender.close(_height(block["_total"][0].as_py()))


def _by_block(nodes: DataFrame) -> DataFrame:
    """``nodes`` with a whole block in one partition, its nodes in order."""
    blocked = nodes.withColumn("_block", F.floor(F.col("_place") / BLOCK))
    return blocked.repartition("_tree", "_block").sortWithinPartitions("_tree", "_block", "_place")


def _block_roots(nodes: DataFrame) -> DataFrame:
    """(_tree, _place, _total, _digest): the root of every block, a node of the tree above."""
    fields = {"_tree": pa.string(), "_place": pa.int64(), "_total": pa.int64(), "_digest": pa.string()}

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            total = block["_total"][0].as_py()
            row = block["_tree"][0].as_py(), block["_block"][0].as_py(), -(-total // BLOCK), _appended(block)[1]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, fields.values())], names=list(fields))

    narrow = nodes.select("_tree", "_place", "_total", "_digest")
    return _by_block(narrow).mapInArrow(roots, "_tree string, _place long, _total long, _digest string")


def _extended(nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    """(_tree, _place, _digest, _values, _roots, _witness) of ``nodes``.

    ``above`` holds witness and roots of the block roots; they continue those of the block.  Its
    row travels with the first node of the block only.  Without it every tree is one block.
    """
    if above is None:
        nothing = {"_above": "CAST(NULL AS ARRAY<STRUCT<before: STRING, after: STRING>>)", "_up": "CAST(NULL AS ARRAY<STRING>)"}
        nodes = nodes.withColumns({name: F.expr(value) for name, value in nothing.items()})
    else:
        first = above.select("_tree", (F.col("_place") * BLOCK).alias("_place"), F.col("_witness").alias("_above"), F.col("_roots").alias("_up"))
        nodes = nodes.join(first, ["_tree", "_place"], "left")
    schema = T.StructType(
        [nodes.schema[c] for c in ("_tree", "_place", "_digest", "_values")]
        + [T.StructField("_roots", T.ArrayType(T.StringType())), T.StructField("_witness", _WITNESS)]
    )

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            appender, top = _appended(block)
            upper = block["_above"][0].as_py() or []
            roots = block["_up"][0].as_py() or [top]
            steps = [[*({"before": b, "after": a} for b, a in own), *upper] for own in appender.witnesses]
            kept = block.select(["_tree", "_place", "_digest", "_values"])
            kept = kept.append_column("_roots", pa.array([roots] * len(steps), pa.list_(pa.string())))
            yield from kept.append_column("_witness", pa.array(steps, _ARROW_WITNESS)).combine_chunks().to_batches()

    return _by_block(nodes).mapInArrow(extend, schema)


def _places(nodes: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``nodes`` (_tree, _digest, _values) with ``_place`` from 0 and ``_total`` per tree, in
    ``order``, and the largest total.

    Rows are dealt by ranges of tree and order, each range is numbered by itself, and the ranges
    before it are added from a table of one row per range and tree.  Rows that agree in everything
    are dealt by a number of their own, so that many of them do not meet in one range.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = stored(nodes.withColumn("_own", F.monotonically_increasing_id()))
    keys = [F.col(c).asc_nulls_first() for c in ("_tree", *order, "_digest", "_own")]
    ranged = told.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # numbered as they stand, and written: no retry deals or numbers them anew
    ranged = ranged.select("_tree", "_digest", "_values", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
    ranged = stored(ranged)
    per_part = ranged.groupBy("_tree", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    tree, before = W.partitionBy("_tree"), W.partitionBy("_tree").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = stored(per_part.select(
        "_tree", "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(tree).alias("_total"),
    ))
    numbered = ranged.join(offsets, ["_tree", "_part"]).withColumn("_place", F.col("_at") + F.col("_shift"))
    return numbered.select("_tree", "_place", "_total", "_digest", "_values"), offsets.agg(F.max("_total")).first()[0] or 0


def _levels(nodes: DataFrame, order: list[str]) -> list[DataFrame]:
    """The nodes with their places, the roots of their blocks, the roots of blocks of those, ...,
    and at last one root a tree."""
    bottom, largest = _places(nodes, order)
    levels = [bottom]
    while True:
        roots = _block_roots(levels[-1]).withColumn("_values", F.struct(F.lit(0).alias("none")))
        levels.append(stored(roots))
        if largest <= BLOCK:
            return levels
        largest = -(-largest // BLOCK)


def manifest(rows: DataFrame, tree: Column, digest: Column, order: list[Column]) -> DataFrame:
    """Every row with its place in a tree of trees, its roots and its witness.

    The rows of equal ``tree`` make one tree, in ``order`` (nulls first, ties by digest); the roots
    of all trees, ordered by ``tree`` (null first, by bytes), make the last one.  Columns: those of
    ``rows`` as struct ``row``, whatever their names; ``place`` in the own tree, from 0; ``digest``;
    ``subroot`` and ``root``; ``witness``, one (before, after) a level from the bottom to the root.
    A null tree is a tree of its own, repeated rows are nodes of their own, no rows give no rows.
    """
    key = F.coalesce(F.concat(F.lit("-"), tree.cast("string")), F.lit("+"))
    ordered = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    values = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    nodes = rows.select(key.alias("_tree"), digest.alias("_digest"), values.alias("_values"), *ordered)
    *levels, roots = _levels(nodes, [f"_o{i}" for i in range(len(order))])
    # the roots of the trees are appended to one more tree
    last = roots.select(F.lit("").alias("_tree"), "_digest", F.struct("_tree").alias("_values"), F.col("_tree").alias("_o0"))
    *last_levels, _ = _levels(last, ["_o0"])
    found = None
    for level in reversed(last_levels):
        found = _extended(level, found if found is None else stored(found))
    found = stored(found.select(
        F.col("_values._tree").alias("_tree"), F.lit(0).cast("long").alias("_place"),
        F.array("_digest", F.get("_roots", F.lit(0))).alias("_roots"), "_witness",
    ))
    for level in reversed(levels):
        found = _extended(level, found)
        if level is not levels[0]:
            found = stored(found)
    return found.select(
        F.col("_values").alias("row"), F.col("_place").alias("place"), F.col("_digest").alias("digest"),
        F.get("_roots", F.lit(0)).alias("subroot"), F.get("_roots", F.lit(1)).alias("root"), F.col("_witness").alias("witness"),
    )


def proof_digest(witness: Column) -> Column:
    """sha256 of all siblings of a witness, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(witness, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(digest: Column, witness: Column) -> Column:
    """The root that follows from a digest and its witness."""
    step = lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256)
    return F.aggregate(witness, digest, step)
