"""Near-duplicate documents by an exact Jaccard self-join of word n-gram sets.

Two documents link when 100 * |intersection| >= PERCENT * |union| of their sets of word n-grams.
The join keeps, of every set, a prefix of its rarest n-grams (by counts over the whole corpus):
linked sets share at least one n-gram of their prefixes.  Sets that share one are compared only if
their sizes, the places of the shared n-gram and counts of the rest by hash range allow a link; a
pair is verified once, on the whole sets.

Equal sets are one class from the start.  Within the list of classes that share an n-gram not all
pairs are made: in rounds, a few classes outside the list's largest component are paired with all
others of other components.  Linked ones merge, and a list is finished when the classes that have
not been paired with all others lie in one component.  So a group of N near copies costs about N
pairs, and no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, chunks, mix, powers, row_key, slices, span_hashes, stored
from .graph import connected_components

#: Cells of the table of n-gram counts; n-grams that share a cell share its count.
CELLS = 1 << 20
#: The table is summed in so many parts.
PARTS = 16
#: Hash ranges whose counts are compared before verification.
RANGES = 64
#: In each round so many times more classes of a list and size are paired with all others, from one on.
HUB_GROWTH = 8
#: Bits of the filter that skips texts not needed for verification: 4 MB.
FILTER_BITS = 1 << 25

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class JoinRule:
    """Words in an n-gram, and the least similarity in percent."""

    words: int = 5
    percent: int = 80


def word_hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of each word of a lower-case text."""
    space = _IS_SPACE[buffer]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):  # in blocks: the powers of a polynomial take 8 bytes a place
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK_BYTES)))
        low = starts[at]
        hashes[at:to] = span_hashes(buffer[low : ends[to - 1]], starts[at:to] - low, ends[at:to] - low)
        at = to
    return starts, hashes


def ngram_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, n-gram hash) of every different n-gram of each text, sorted.

    A text with fewer words than an n-gram has one, its whole sequence; one without words has none.
    """
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    joined = b" ".join(texts).translate(_LOWER)
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    starts, h = word_hashes(np.frombuffer(joined, dtype=np.uint8))
    first = np.searchsorted(starts, begin)  # of each text's words
    count = np.diff(first)
    step = powers(_STEP, words)
    grams, owner = [], []
    for k in range(1, words + 1):
        # texts with exactly k words if k is short, else all n-grams
        chosen = np.flatnonzero(count == k if k < words else count >= k)
        if not len(chosen):
            continue
        places = count[chosen] - k + 1
        at = np.repeat(first[chosen] - np.cumsum(places) + places, places) + np.arange(places.sum())
        total = np.full(len(at), k, dtype=np.uint64)
        for j in range(k):
            total += h[at + j] * step[j]
        grams.append(mix(total))
        owner.append(np.repeat(chosen, places))
    if not grams:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram, text = np.concatenate(grams), np.concatenate(owner)
    order = np.lexsort((gram, text))
    gram, text = gram[order], text[order]
    new = np.ones(len(gram), dtype=bool)
    new[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
    return text[new], gram[new]


def _sets(batch_texts: list[str | None], words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, end, offsets of the sets, n-grams) for stretches of a batch."""
    texts = [t.encode("utf-8") if t else b"" for t in batch_texts]
    for a, b in chunks(texts):
        text, gram = ngram_sets(texts[a:b], words)
        yield a, b, np.searchsorted(text, np.arange(b - a + 1)), gram


def _cells(gram: np.ndarray) -> np.ndarray:
    return (gram >> np.uint64(44)).astype(np.int64)


def _class(gram: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(gram.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def prefix_length(n: np.ndarray | int, percent: int):
    """n-grams of which sets of n linked ones share at least one."""
    return n - (n * percent + 99) // 100 + 1


def describe(rows: DataFrame, rule: JoinRule) -> DataFrame:
    """One row a document (kind 0: its key as part, hash of its text as row, size, class, counts by
    range) and, for each part of the table of counts, one a task (kind 1); all from one pass over the
    texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "part", "row", "n", "c1", "c2", "data"]
        counts = np.zeros(CELLS, dtype=np.uint32)
        for batch in slices(batches):
            ids, hashes = batch.column(0), batch.column(2)
            for a, b, at, gram in _sets(batch.column(1).to_pylist(), rule.words):
                counts += np.bincount(_cells(gram), minlength=CELLS).astype(np.uint32)
                sets = [gram[i:j] for i, j in zip(at, at[1:])]
                classes = [_class(s) for s in sets]
                ranges = np.repeat(np.arange(b - a), np.diff(at)) * RANGES + (gram >> np.uint64(58)).astype(np.int64)
                shares = np.bincount(ranges, minlength=(b - a) * RANGES).reshape(b - a, RANGES).astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    pa.array([0] * (b - a), pa.int32()), ids.slice(a, b - a), hashes.slice(a, b - a), pa.array(np.diff(at)),
                    pa.array([c[0] for c in classes], pa.int64()), pa.array([c[1] for c in classes], pa.int64()),
                    pa.array([s.tobytes() for s in shares], pa.binary()),
                ], names)
        parts = [zstandard.compress(p.tobytes(), 1) for p in counts.reshape(PARTS, -1)]
        zero = pa.array([0] * PARTS, pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array([1] * PARTS, pa.int32()), pa.array(range(PARTS), pa.int64()), zero, zero, zero, zero,
            pa.array(parts, pa.binary()),
        ], names)

    hashed = rows.select("id", "text", row_key("text").alias("row"))
    return hashed.mapInArrow(run, "kind int, part long, row long, n long, c1 long, c2 long, data binary")


def levels(described: DataFrame) -> np.ndarray:
    """For each cell a level that rises with its count (sixteen a doubling): one byte a cell.

    Tables of tasks are added up part by part as they arrive, in memory of one table.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                one = np.frombuffer(zstandard.decompress(data.as_py()), dtype=np.uint32)
                sums[part] = sums[part] + one if part in sums else one.astype(np.uint64)
        if sums:
            level = [np.minimum(np.log2(s + 1.0) * 8, 255).astype(np.uint8).tobytes() for s in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(level, pa.binary())], ["part", "level"])

    tables = described.filter("kind = 1").select("part", "data").repartition(PARTS, "part")
    found = {r["part"]: bytes(r["level"]) for r in tables.mapInArrow(add, "part long, level binary").collect()}
    empty = bytes(CELLS // PARTS)
    return np.frombuffer(b"".join([found.get(p, empty) for p in range(PARTS)]), dtype=np.uint8)


def prefixes(rows: DataFrame, rule: JoinRule, level: np.ndarray) -> DataFrame:
    """(g, cid, n, place): the rarest n-grams of each class, one row each."""
    sent = rows.sparkSession.sparkContext.broadcast(level)  # CELLS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for a, b, at, gram in _sets(batch.column(1).to_pylist(), rule.words):
                n = np.diff(at)
                owner = np.repeat(np.arange(b - a), n)
                order = np.lexsort((gram, sent.value[_cells(gram)], owner))
                kept = np.where(n > 0, prefix_length(n, rule.percent), 0)
                chosen = order[np.arange(len(gram)) - at[owner] < kept[owner]]
                classes = [_class(gram[i:j]) for i, j in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([c[0] for c in classes], pa.int64()), pa.array([c[1] for c in classes], pa.int64()),
                    pa.array(n.astype(np.int32)),
                    pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(kept)]).astype(np.int32), gram[chosen].view(np.int64)),
                ], ["cid", "c2", "n", "prefix"])

    sets = rows.mapInArrow(run, "cid long, c2 long, n int, prefix array<long>").filter("n > 0")
    one = sets.groupBy("cid", "c2").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    return one.select("cid", "n", F.posexplode("prefix").alias("place", "g")).select("g", "cid", "n", "place")


def _may_link(x: str, y: str, percent: int) -> Column:
    """Size and place filter for rows x and y of one n-gram that is the first they share."""
    n1, n2, p1, p2 = (F.col(c).cast("long") for c in (f"{x}.n", f"{y}.n", f"{x}.place", f"{y}.place"))
    sizes = (100 * F.least(n1, n2)) >= (percent * F.greatest(n1, n2))
    rest = 1 + F.least(n1 - p1 - 1, n2 - p2 - 1)
    return sizes & ((rest * (100 + percent)) >= (percent * (n1 + n2)))


def _range_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose counts by hash range leave room for enough shared n-grams."""
    x = classes.select(F.col("cid").alias("a"), F.col("data").alias("xa"))
    y = classes.select(F.col("cid").alias("b"), F.col("data").alias("xb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u4").reshape(-1, RANGES).astype(np.int64)
                for c in ("xa", "xb")
            )
            shared = np.minimum(one, two).sum(axis=1)
            fits = 100 * shared >= percent * (one.sum(axis=1) + two.sum(axis=1) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    return pairs.join(x, "a").join(y, "b").select("a", "b", "xa", "xb").mapInArrow(run, "a long, b long")


def _pack(gram: np.ndarray) -> bytes:
    """The upper 48 bits of each n-gram hash of a sorted set."""
    return np.ascontiguousarray(gram.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return wide.view(">u8").ravel().astype(np.uint64)


def _whole_sets(rows: DataFrame, described: DataFrame, pairs: DataFrame, rule: JoinRule) -> DataFrame:
    """(cid, data): the whole set of every class in ``pairs``, from one document of it."""
    wanted = pairs.select(F.col("a").alias("cid")).unionAll(pairs.select(F.col("b").alias("cid"))).distinct()
    holders = described.filter("kind = 0").join(wanted, F.col("c1") == F.col("cid"), "left_semi")
    holders = holders.groupBy("c1").agg(F.min("part").alias("holder"))
    spot = F.pmod(F.xxhash64("holder"), F.lit(FILTER_BITS))
    maps = holders.select((spot + 1).alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")
    )
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in maps.collect():  # at most FILTER_BITS in all
        one = np.frombuffer(r["bits"], dtype=np.uint8)
        bits[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096][: len(one)] = one
    sent = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spots = batch.column(2).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array((sent.value[spots >> 3] >> (spots & 7).astype(np.uint8) & 1).astype(bool)))
            for a, b, at, gram in _sets(batch.column(1).to_pylist(), rule.words):
                sets = [gram[i:j] for i, j in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([_class(s)[0] for s in sets], pa.int64()), pa.array([_pack(s) for s in sets], pa.binary()),
                ], ["cid", "data"])

    spots = rows.select("id", "text", F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)).alias("spot"))
    sets = spots.mapInArrow(run, "cid long, data binary")
    return sets.groupBy("cid").agg(F.first("data").alias("data")).join(wanted, "cid", "left_semi")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets (cid, data) are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = []
            for one, two in zip(batch.column("xa"), batch.column("xb")):
                x, y = _unpack(one.as_py()), _unpack(two.as_py())
                shared = len(np.intersect1d(x, y, assume_unique=True))
                fits.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    x = sets.select(F.col("cid").alias("a"), F.col("data").alias("xa"))
    y = sets.select(F.col("cid").alias("b"), F.col("data").alias("xb"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "xa", "xb").mapInArrow(run, "a long, b long")


def _labelled(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return lists.withColumn("comp", F.col("cid"))
    found = lists.join(labels, lists["cid"] == labels["node"], "left")
    return found.select(*lists.columns, F.coalesce("label", "cid").alias("comp"))


def linked_classes(rows: DataFrame, described: DataFrame, rule: JoinRule) -> DataFrame | None:
    """(node, label) of the classes that link with others, by rounds; none if no class does."""
    spark, percent = rows.sparkSession, rule.percent
    all_rows = prefixes(rows, rule, levels(described))
    shared = all_rows.groupBy("g").agg(F.count("*").alias("m")).filter("m > 1")
    lists = all_rows.join(shared, "g")
    # how many others a class meets over all lists; its rows are bounded by its own prefix
    lists = stored(lists.withColumn("meets", F.sum(F.col("m") - 1).over(W.partitionBy("cid"))).drop("m"))
    # classes link only if their sizes lie in the same step or in adjoining ones
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)))
    classes = described.filter("kind = 0").groupBy(F.col("c1").alias("cid")).agg(F.first("data").alias("data"))
    listed = lists.select("cid").distinct()  # only these are ever compared
    classes = stored(classes.join(listed, "cid", "left_semi"))
    labels, tested, hubs_each = None, None, 1
    while True:
        named = _labelled(lists, labels)
        sizes = named.groupBy("g", "comp").agg(F.count("*").alias("k"))
        open_lists = sizes.groupBy("g").agg(
            F.max_by("comp", F.struct("k", "comp")).alias("main"), F.count("*").alias("comps")
        ).filter("comps > 1").select("g", "main")
        # which of a list's classes are paired with all others in this round
        named = stored(named.join(open_lists, "g"))
        if named.isEmpty():
            return labels
        outside = named.filter("comp <> main")
        best = [F.desc("meets"), "cid"]
        outside = outside.withColumn("step", step)
        outside = outside.withColumn("turn", F.row_number().over(W.partitionBy("g", "step", "comp").orderBy(*best)))
        rank = F.row_number().over(W.partitionBy("g", "step").orderBy("turn", *best))
        hubs = outside.filter(F.col("turn") <= hubs_each).withColumn("rank", rank).filter(F.col("rank") <= hubs_each)
        hubs = hubs.select("g", "cid", "n", "place", "comp")
        x, y = named.alias("x"), hubs.alias("y")
        pairs = x.join(y, (F.col("x.g") == F.col("y.g")) & (F.col("x.comp") != F.col("y.comp")) & _may_link("x", "y", percent))
        pairs = pairs.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(_range_filter(pairs, classes, percent))
        tested = pairs if tested is None else tested.unionAll(pairs)
        if not pairs.isEmpty():
            sets = stored(_whole_sets(rows, described, pairs, rule))
            links = verify(pairs, sets, percent)
            if labels is not None:
                links = _contracted(links, labels)
            links = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
            if not links.isEmpty():
                merged = connected_components(links)
                labels = stored(merged if labels is None else _relabelled(labels, merged))
        lists = stored(named.select("g", "cid", "n", "place", "meets").join(hubs.select("g", "cid"), ["g", "cid"], "left_anti"))
        hubs_each *= HUB_GROWTH


def _contracted(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links between components instead of classes."""
    for end in ("a", "b"):
        links = links.join(labels, links[end] == labels["node"], "left").select(
            *[c for c in ("a", "b") if c != end], F.coalesce("label", end).alias(end)
        )
    return links


def _relabelled(labels: DataFrame, merged: DataFrame) -> DataFrame:
    new = merged.select(F.col("node").alias("label"), F.col("label").alias("new"))
    old = labels.join(new, "label", "left").select("node", F.coalesce("new", "label").alias("label"))
    # merged components that were single classes until now have no label yet
    return old.unionAll(merged.join(labels.select("node"), "node", "left_anti").select("node", "label"))


def _components(docs: DataFrame, key: str, text: str, rule: JoinRule) -> DataFrame:
    """(id, row, n, cid, comp): key, hash of the text, size, class and component of every row."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    described = stored(describe(rows, rule))
    labels = linked_classes(rows, described, rule)
    found = described.filter("kind = 0").select(F.col("part").alias("id"), "row", "n", F.col("c1").alias("cid"))
    return _labelled(found, labels)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: JoinRule = JoinRule()) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``.

    ``component_id`` is the smallest key that a row reaches over links, its own included.  Null and
    empty texts and texts of white space have size 0 and link with nothing.  Repeated rows and equal
    texts link; rows that share a key but differ in text are separate.  Null keys are no key to
    reach: a component with no other key has none.  Other columns are ignored.
    """
    named = _components(docs, key, text, rule)
    least = named.filter("n > 0").groupBy("comp").agg(F.min("id").alias("least"))
    joined = named.join(least, "comp", "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id"))
    return joined.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: JoinRule = JoinRule()) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest key.

    Every row is judged by its own text, by key and hash of the text: other rows of its key, or
    other rows without a key, do not go with it.  Documents without words all stay.  Rows with a null
    key stay only where no row with a key is in their component.  Of several texts with the kept key,
    or without any key, that with the smallest hash stays, and of repeated rows one.
    """
    named = _components(docs, key, text, rule).filter("n > 0")
    order = F.struct(F.isnull("id"), "id", "row")  # keys first, in order
    best = named.groupBy("comp").agg(F.min(order).alias("best"))
    drop = named.join(best, "comp").filter(order != F.col("best"))
    drop = drop.select(F.col("id").alias("dropped"), F.col("row").alias("dropped_text")).distinct()
    same = docs[key].cast("long").eqNullSafe(drop["dropped"]) & (row_key(docs[text]) == drop["dropped_text"])
    return docs.join(drop, same, "left_anti").dropDuplicates([key, text])
