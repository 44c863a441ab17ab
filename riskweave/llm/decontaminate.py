"""Benchmark decontamination by the q-gram lemma.

If a passage of a document is within e edits of a benchmark item of m bytes, both share at least
m + 1 - q - q*e q-grams, and the shared ones lie on diagonals (place in the document minus place in
the item) no more than e apart.  So shared q-grams are counted in overlapping bands of 2(e + 1)
diagonals; a band that reaches the bound is a candidate, which a banded alignment then verifies.

Texts are compared in lower case, with every run of ASCII white space and punctuation as one space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, row_key, slices

Q = 8
#: Edits allowed as a share of an item's bytes.
EDIT_RATE = 0.1
#: Items of fewer bytes are not evidence of a leak and are not searched for.
MIN_ITEM_BYTES = 32
#: Benchmark items are broadcast in blocks of about so many bytes; more items mean more passes.
BLOCK_BYTES = 2 << 20

_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_FOLD_BITS = 22
#: Cells that a chunk's band counts are hashed into.
_SPOTS = 1 << 20
#: Shared q-grams looked at together.
HITS = 1 << 21


def plain(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8").translate(_PLAIN).split())


def _grams(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number (Q is 8)."""
    windows = np.lib.stride_tricks.sliding_window_view(buffer, Q)
    return np.ascontiguousarray(windows).view(np.uint64).ravel()


def _fold(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FOLD_BITS)


def budget(m: int, rate: float = EDIT_RATE) -> int:
    """Edits allowed for an item of m bytes: the rate, or as many as leave a bound of one q-gram."""
    return max(0, min(int(m * rate), (m - Q) // Q))


@dataclass(frozen=True)
class ItemBlock:
    """Some benchmark items and an index of their q-grams."""

    ids: list[int]
    texts: list[bytes]
    rate: float

    def index(self) -> _Index:
        return _Index(self)


class _Index:
    def __init__(self, block: ItemBlock):
        self.ids, self.texts = block.ids, block.texts
        self.edits = np.array([budget(len(t), block.rate) for t in self.texts], dtype=np.int64)
        lengths = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.bound = lengths + 1 - Q - Q * self.edits
        codes = [_grams(np.frombuffer(t, dtype=np.uint8)) for t in self.texts]
        code = np.concatenate(codes)
        item = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes])
        order = np.argsort(code, kind="stable")
        code, self.item, self.place = code[order], item[order], place[order]
        self.code, self.start = np.unique(code, return_index=True)
        self.stop = np.append(self.start[1:], len(code))
        self.maybe = np.zeros(1 << _FOLD_BITS, dtype=bool)
        self.maybe[_fold(self.code)] = True

    def hits(self, buffer: np.ndarray) -> Iterator[tuple[float, float, np.ndarray, np.ndarray, np.ndarray]]:
        """(from, to, place in buffer, item, place in item): stretches of the buffer and every shared
        q-gram that a band of diagonals beginning in the stretch can hold.

        One stretch, unless the text repeats q-grams of the items so often that there are more than
        HITS; then as many as keep to that, each at least as long as an item.
        """
        if len(buffer) < Q or not len(self.code):
            return
        codes = _grams(buffer)
        at = np.flatnonzero(self.maybe[_fold(codes)])
        k = np.minimum(np.searchsorted(self.code, codes[at]), len(self.code) - 1)
        same = self.code[k] == codes[at]
        at, k = at[same], k[same]
        n = self.stop[k] - self.start[k]
        before = np.concatenate([[0], np.cumsum(n)])
        width = 2 * int(self.edits.max(initial=0)) + 2
        margin = max(map(len, self.texts)) + width

        def held(low: float, high: float) -> slice:
            return slice(*np.searchsorted(at, [low - width, high + margin]).tolist())

        def expanded(own: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            m = n[own]
            entry = np.repeat(self.start[k[own]] - np.cumsum(m) + m, m) + np.arange(m.sum())
            return np.repeat(at[own], m), self.item[entry], self.place[entry]

        if before[-1] <= HITS:
            yield -np.inf, np.inf, *expanded(slice(None))
            return
        low = -np.inf
        while low < len(buffer):
            step = margin
            while True:
                high = max(low, -margin) + 2 * step
                own = held(low, high)
                if high >= len(buffer) or before[own.stop] - before[own.start] > HITS:
                    break
                step *= 2
            high = max(low, -margin) + step if step > margin or high < len(buffer) else np.inf
            yield low, high, *expanded(held(low, high))
            low = high


def banded_distance(item: bytes, text: bytes, low: int, high: int, limit: int) -> tuple[int, int, int] | None:
    """Fewest edits between ``item`` and any stretch of ``text``, on diagonals low .. high, and the
    stretch (edits, start, end); none if over the limit.  The best with the leftmost end is taken.
    """
    width = high - low + 1
    columns = np.arange(width)
    body = np.frombuffer(text, dtype=np.uint8)
    far = len(item) + len(text) + 1
    # row i, slot k: item[:i] against text up to i + low + k; the start travels with the cost
    ends = low + columns
    inside = (ends >= 0) & (ends <= len(text))
    scale = 1 << 40  # cost * scale + start: the smallest cost, then the leftmost start
    cost = np.where(inside, ends, far * scale).astype(np.int64)
    for i, byte in enumerate(item, 1):
        ends = i + low + columns
        inside = (ends >= 1) & (ends <= len(text))
        letters = body[np.clip(ends - 1, 0, max(len(body) - 1, 0))] if len(body) else np.zeros(width, np.uint8)
        step = cost + np.where(inside & (letters == byte), 0, scale)
        up = np.append(cost[1:], far * scale) + scale
        best = np.where((ends >= 0) & (ends <= len(text)), np.minimum(np.where(inside, step, far * scale), up), far * scale)
        ramp = columns * scale
        cost = np.minimum.accumulate(best - ramp) + ramp
        cost = np.where((ends >= 0) & (ends <= len(text)), cost, far * scale)
        if cost.min() >= (limit + 1) * scale:
            return None
    k = int(np.argmin(cost // scale))
    edits, start = divmod(int(cost[k]), scale)
    return (edits, start, len(item) + low + k) if edits <= limit else None


def _candidates(index: _Index, buffer: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, item, first and last diagonal, first place) of each band that reaches its bound,
    places and diagonals in the document; a run of adjoining bands is one candidate."""
    for low, high, at, item, place in index.hits(buffer):
        if len(at):
            yield from _bands(index, starts, low, high, at, item, place)


def _bands(
    index: _Index, starts: np.ndarray, begin: float, end: float, at: np.ndarray, item: np.ndarray, place: np.ndarray
) -> Iterator[tuple[int, int, int, int, int]]:
    """:func:`_candidates` of the bands that begin from ``begin`` on and before ``end``."""
    doc = np.searchsorted(starts, at, side="right") - 1
    own = at - starts[doc]
    # a q-gram may not reach over the end of its document: the separator byte is in no item
    diagonal = own - place
    width = index.edits[item] + 1
    slot = np.floor_divide(diagonal, width)
    # counts by hashed slot are never too low: most hits are far from the bound and go here
    spot = ((doc * len(index.texts) + item) * 0x9E3779B1 + slot) & (_SPOTS - 1)
    counts = np.bincount(spot, minlength=_SPOTS)
    here = counts[spot]
    near = np.maximum(counts[(spot + 1) & (_SPOTS - 1)], counts[(spot - 1) & (_SPOTS - 1)])
    likely = np.flatnonzero(here + near >= index.bound[item])
    if not len(likely):
        return
    doc, item, place, slot = doc[likely], item[likely], place[likely], slot[likely]
    key = np.concatenate([slot, slot - 1])  # overlapping bands: slots s and s + 1
    doc2, item2, place2 = np.tile(doc, 2), np.tile(item, 2), np.tile(place, 2)
    order = np.lexsort((place2, key, item2, doc2))
    key, doc2, item2, place2 = key[order], doc2[order], item2[order], place2[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (item2[1:] != item2[:-1]) | (doc2[1:] != doc2[:-1])
    # a place of the item counts once in a band
    once = new.copy()
    once[1:] |= place2[1:] != place2[:-1]
    first = np.flatnonzero(new)
    count = np.add.reduceat(once.astype(np.int64), first)
    full = count >= index.bound[item2[first]]
    places = starts[doc2[first]] + key[first] * (index.edits[item2[first]] + 1)
    full &= (places >= begin) & (places < end)
    last = None
    for i in first[full].tolist():
        d, t, s = int(doc2[i]), int(item2[i]), int(key[i])
        w = int(index.edits[t]) + 1
        low, high = s * w, s * w + 2 * w - 1
        if last and last[0] == d and last[1] == t and low <= last[3] + 1:
            last = (d, t, last[2], high)
        else:
            if last:
                yield last
            last = (d, t, low, high)
    if last:
        yield last


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE,
) -> DataFrame:
    """(doc_id, item_id, start, end, edits, n_bytes): stretches of documents within the edit budget
    of a benchmark item, as byte places in the plain text; overlapping ones of an item are one row.

    Keys are whole numbers.  Null and empty texts and items, and items too short to tell, match nothing.  Repeated rows are
    reported alike; rows of ``docs`` that share a key are searched each.  An empty side gives no rows.
    """
    return _leaks(docs, benchmark, key, text, item_key, item_text, rate).drop("row")


def _leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE,
) -> DataFrame:
    """What ``find_leaks`` gives, and as ``row`` the hash of the text that holds the item."""
    schema = "doc_id long, row long, item_id long, start long, end long, edits long, n_bytes long"
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), row_key(text).alias("row"))
    out = None
    for block in item_blocks(benchmark, item_key, item_text, rate):
        found = rows.mapInArrow(_search(docs.sparkSession.sparkContext.broadcast(block)), schema)
        out = found if out is None else out.unionAll(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    return out


def item_blocks(benchmark: DataFrame, item_key: str, item_text: str, rate: float) -> Iterator[ItemBlock]:
    """The items in blocks of bounded size, one block in memory at a time; equal texts once."""
    items = benchmark.select(F.col(item_key).cast("long").alias("item"), F.col(item_text).alias("text"))
    items = items.filter("text IS NOT NULL AND item IS NOT NULL").distinct().orderBy("item", "text")
    ids: list[int] = []
    texts: list[bytes] = []
    size = 0
    for r in items.toLocalIterator():
        value = plain(r["text"])
        if len(value) < MIN_ITEM_BYTES:
            continue
        if size + len(value) > BLOCK_BYTES and texts:
            yield ItemBlock(ids, texts, rate)
            ids, texts, size = [], [], 0
        ids.append(r["item"])
        texts.append(value)
        size += len(value)
    if texts:
        yield ItemBlock(ids, texts, rate)


def _search(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value.index()
        for batch in slices(batches):
            ids, hashes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            texts = [plain(t) if t else b"" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts):
                found = [(ids[a + d], hashes[a + d], *rest) for d, *rest in leaks_in(index, texts[a:b])]
                if found:
                    names = ["doc_id", "row", "item_id", "start", "end", "edits", "n_bytes"]
                    columns = [pa.array(c, pa.int64()) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def leaks_in(index: _Index, texts: list[bytes]) -> list[tuple[int, int, int, int, int, int]]:
    """(place of the text, item id, start, end, edits, item bytes) of every leak in these texts."""
    buffer = np.frombuffer(b"\0".join(texts), dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]]).astype(np.int64)
    rows: list[tuple[int, int, int, int, int, int]] = []
    for d, t, low, high in _candidates(index, buffer, starts):
        item, limit, text = index.texts[t], int(index.edits[t]), texts[d]
        at = max(0, low - limit)
        part = text[at : high + len(item) + limit + 1]
        exact = part.find(item)
        if exact >= 0:
            found = (0, exact, exact + len(item))
        else:
            found = banded_distance(item, part, low - limit - at, high + limit - at, limit)
        if found:
            edits, start, end = found
            rows.append((d, index.ids[t], at + start, at + end, edits, len(item)))
    out: list[tuple[int, int, int, int, int, int]] = []
    for row in sorted(rows):
        if out and out[-1][:2] == row[:2] and row[2] < out[-1][3]:
            if row[4] < out[-1][4]:
                out[-1] = row
        else:
            out.append(row)
    return out


def remove_leaked(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; every row is judged by its own text, also
    where rows share a key or have none."""
    leaks = _leaks(docs, benchmark, key, text).select(F.col("doc_id").alias("leaked"), F.col("row").alias("leaked_text")).distinct()
    same = docs[key].cast("long").eqNullSafe(leaks["leaked"]) & (row_key(docs[text]) == leaks["leaked_text"])
    return docs.join(leaks, same, "left_anti")
