"""Chat logs: snapshots of growing conversations collapsed to the longest, then rendered.

Every turn prefix of a conversation has a rolling hash: the xor of the hashes of its turns, each
mixed with its place.  A conversation whose last hash is a shorter prefix of another one is a
snapshot of that; an anti-join drops it.  Of equal conversations the one with the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Marks of the rendered format; the same marks inside a text are broken by a space.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, p1, p2, n): the two 64-bit hashes of each turn prefix, n turns in all.

    Equal rows count once; turns are ordered by ``turn`` (null first), then by role and content.
    """
    content = [x for c in ("role", "text") for x in (F.col(c).isNull(), F.col(c))]
    rows = turns.select(
        "conv_id", "turn", F.xxhash64(F.lit(1), *content).alias("c1"), F.xxhash64(F.lit(2), *content).alias("c2")
    )
    rows = rows.groupBy("conv_id", "turn", "c1", "c2").agg(F.lit(1).alias("one")).drop("one")
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "c1", "c2")
    rows = rows.withColumn("place", F.row_number().over(order))
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("conv_id")
    return rows.select(
        "conv_id", "place",
        F.bit_xor(F.xxhash64("place", "c1")).over(so_far).alias("p1"),
        F.bit_xor(F.xxhash64("place", "c2")).over(so_far).alias("p2"),
        F.max("place").over(whole).alias("n"),
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): conversations that prefix no longer one, one of each set of
    equal ones, with the size of that set.  Rows with a null conv_id form one conversation."""
    prefixes = turn_prefixes(turns)
    full = prefixes.filter("place = n").groupBy("p1", "p2", "n").agg(
        F.min_by("conv_id", F.struct(F.col("conv_id").isNull(), "conv_id")).alias("conv_id"),
        F.count("*").alias("n_copies"),
    )
    shorter = prefixes.filter("place < n").select("p1", "p2", F.col("place").alias("n")).distinct()
    kept = full.join(shorter, ["p1", "p2", "n"], "left_anti")
    return kept.select("conv_id", F.col("n").cast("long").alias("n_turns"), "n_copies")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """``kept`` with the rendered conversation: one block a turn, role on the first line.

    A null role is written ``unknown`` and a null text as empty.
    """
    def safe(column: str, default: str):
        value = F.coalesce(F.col(column), F.lit(default))
        return F.regexp_replace(value, r"<\|(im_start|im_end)\|>", "< |$1|>")

    block = F.concat(
        F.lit(OPEN), safe("role", "unknown"), F.lit("\n"), safe("text", ""), F.lit(CLOSE + "\n")
    )
    rows = turns.select("conv_id", "turn", "role", "text", block.alias("block")).alias("t")
    rows = rows.join(kept.select("conv_id").alias("k"), F.expr("t.conv_id <=> k.conv_id"), "left_semi")
    parts = rows.groupBy("conv_id").agg(F.collect_set(F.struct("turn", "role", "text", "block")).alias("parts"))
    text = F.array_join(F.transform(F.array_sort("parts"), lambda p: p["block"]), "")
    parts = parts.select("conv_id", text.alias("rendered")).alias("r")
    return kept.alias("k").join(parts, F.expr("k.conv_id <=> r.conv_id")).select("k.*", "r.rendered")


def collapse_and_render(turns: DataFrame) -> DataFrame:
    """Maximal conversations of ``turns`` (conv_id, turn, role, text), rendered."""
    turns = turns.select("conv_id", "turn", "role", "text")
    return render(turns, maximal_conversations(turns))
