"""Byte-pair encoding by a deterministic automaton, and decoding by its arc labels.

The automaton reads tokens.  It starts as one state that every base symbol leads back to, so every
sequence of symbols is accepted.  Each merge ``a b -> c``, in order of rank, adds one gadget: the
arcs labelled ``a`` are led to a copy of their target that has lost its ``b`` arc, and every state
with an ``a`` arc gets a ``c`` arc to where ``a b`` used to end.  After all merges exactly one
accepted token sequence spells any given word: the one that applying the merges greedily yields.

All arcs with one label share their target, so the table of targets has one entry a token.  A state
is kept as the link to the state it was copied from, the arc it lost, and the rank at which that
happened; the copies form a tree, and intervals over its preorder answer "was this arc lost on the
way to this state" with one bisection.  A later token ``c`` is allowed wherever its left part was
allowed when ``c`` was made, so a lookup walks the few left parts of a token.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BinaryType, DataType, LongType, StringType, StructField, StructType,
)

from .common import slices

#: Words kept with their tokens in one Python worker, twice as many at most, and the longest word kept.
CACHE_WORDS = 120_000
#: Arcs kept in a worker, twice as many at most.
CACHE_ARCS = 60_000
CACHE_WORD_LENGTH = 48
#: Symbols that tell how long a token may be.
HEAD = 4


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    symbol = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [symbol[b] for b in range(256)]


class Automaton:
    """The compiled merges: tables of targets, lost arcs and labels."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], end: str = ""):
        self.ids, self.end = dict(vocab), end
        size = max(vocab.values(), default=-1) + 1
        self.labels = [""] * size
        for token, i in vocab.items():
            self.labels[i] = token
        self.left, self.born = [-1] * size, [0] * size
        self._compile([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges])
        #: the length of the longest token, without its end, that begins with these HEAD symbols
        self.reach: dict[str, int] = {}
        for token in self.ids:
            body = token.removesuffix(end)
            if len(body) >= HEAD:
                self.reach[body[:HEAD]] = max(len(body), self.reach.get(body[:HEAD], 0))
        #: symbols that any place of a word may hold
        self.base = {s for s in self.ids if len(s) == 1 and s + end in self.ids}
        #: the arcs asked for so far, by state and token
        self.arcs = _Known(lambda at: self.allows(*divmod(at, size)), CACHE_ARCS)

    def _compile(self, merges: list[tuple[int, int, int]]) -> None:
        target = [0] * len(self.labels)
        parent, lost, since = [-1], [-1], [0]
        never: set[int] = set()
        for rank, (a, b, c) in enumerate(merges, 1):
            spine, token, before = {}, b, rank
            while token >= 0:
                spine[token], before, token = before, self.born[token], self.left[token]
            state = target[a]
            while state and since[state] > spine.get(lost[state], -1):
                state = parent[state]
            if state or a in never or b in never:  # a and b never meet, so their merge never arises
                never.add(c)
                self.ids.pop(self.labels[c], None)
                continue
            parent.append(target[a])
            lost.append(b)
            since.append(rank)
            target[c], self.left[c], self.born[c] = target[b], a, rank
            target[a] = len(parent) - 1
        children: list[list[int]] = [[] for _ in parent]
        for state in range(1, len(parent)):
            children[parent[state]].append(state)
        first, last, clock, stack = [0] * len(parent), [0] * len(parent), 0, [0]
        while stack:
            state = stack.pop()
            if state < 0:
                last[~state] = clock
                continue
            first[state] = clock
            clock += 1
            stack.append(~state)
            stack.extend(children[state])
        spans: dict[int, list[tuple[int, int, int]]] = {}
        for state in range(1, len(parent)):
            spans.setdefault(lost[state], []).append((first[state], last[state], since[state]))
        #: for each label the disjoint subtrees that lost its arc: first, last + 1, since which rank
        self.lost = {label: tuple(zip(*sorted(found))) for label, found in spans.items()}
        #: for each label the state its arcs lead to, by its place in preorder
        self.target = [first[state] for state in target]

    def allows(self, state: int, token: int) -> bool:
        """Whether the state has an arc with this token."""
        before = len(self.target) + 1
        while token >= 0:
            if found := self.lost.get(token):
                k = bisect_right(found[0], state) - 1
                if k >= 0 and state < found[1][k] and found[2][k] <= before:
                    return False
            before, token = self.born[token], self.left[token]
        return True

    def encode(self, symbols: str) -> list[int]:
        """Token ids of one pre-split word: the only accepted path that spells it.

        Symbols outside the vocabulary yield nothing, and no token spans them.
        """
        n, ids, end = len(symbols), self.ids, self.end
        if self.base.issuperset(symbols):
            return self._path(symbols, end)
        if unknown := [i for i, s in enumerate(symbols) if (s + end if i == n - 1 else s) not in ids]:
            out, start = [], 0
            for i in [*unknown, n]:
                out += self._path(symbols[start:i], end if i == n else "")
                start = i + 1
            return out
        return self._path(symbols, end)

    def _path(self, symbols: str, end: str) -> list[int]:
        """The path that spells ``symbols``, longest arcs tried first.

        One accepted path only leads to a place, so a place that none leads on from is left for good.
        """
        n, ids, arcs, size, target = len(symbols), self.ids, self.arcs, len(self.labels), self.target
        reach, path, begun, left = self.reach, [], [], set()
        at, here = 0, 0
        j = reach.get(symbols[:HEAD], HEAD - 1)
        while at < n:
            if j >= n:
                j, token = n, ids.get(symbols[at:] + end, -1)
            else:
                token = ids.get(symbols[at:j], -1)
            if token >= 0 and j not in left and arcs[here + token]:
                path.append(token)
                begun.append(at)
                at, here = j, target[token] * size
                j += reach.get(symbols[j : j + HEAD], HEAD - 1)
                continue
            j -= 1
            while j == at:
                left.add(at)
                j, at = at - 1, begun.pop()
                path.pop()
                here = target[path[-1]] * size if path else 0
        return path


class WordTokenizer:
    """Splits texts into words as a tokenizer file says, and runs the automaton over each.

    Read from a ``tokenizers`` JSON file of this kind: special tokens matched in the raw text; NFC,
    white space, lower case; words by the file's pattern; byte-level symbols; an end-of-word suffix.
    """

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = list(self.automaton.labels)
        for token, i in self.special.items():
            self.labels += [""] * (i + 1 - len(self.labels))
            self.labels[i] = token
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split_special = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"]).findall
        self.symbols = byte_symbols()
        self.known = _Known(self._word, CACHE_WORDS)

    def _word(self, word: str) -> bytes:
        # letters of ASCII are their own symbols
        plain = word.isascii() and word.isalpha()
        symbols = word if plain else "".join([self.symbols[b] for b in word.encode("utf-8")])
        ids = self.automaton.encode(symbols)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            # final sigma is lowered like any other, letter by letter
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        return b"".join(map(self.known.__getitem__, self.words(text.lower())))

    def encode(self, text: str) -> bytes:
        """Token ids of a whole text, as little-endian unsigned 32-bit integers."""
        parts, at = [], 0
        for found in self.split_special.finditer(text):
            parts.append(self._plain(text[at : found.start()]))
            parts.append(struct.pack("<I", self.special[found.group()]))
            at = found.end()
        parts.append(self._plain(text[at:]))
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """Arc labels of the ids, separated by spaces (the file names no decoder)."""
        return " ".join(map(self.labels.__getitem__, memoryview(ids).cast("I")))


class _Known(dict):
    """Results by key, twice ``limit`` keys at most: when ``limit`` is reached, what was asked for since
    the last time is kept beside, and taken over again when it is asked for."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.before = make, limit, {}

    def __missing__(self, key):
        found = self.before.get(key)
        if found is None:
            found = self.make(key)
        if not isinstance(key, str) or len(key) <= CACHE_WORD_LENGTH:
            if len(self) >= self.limit:
                self.before = dict(self)
                self.clear()
            self[key] = found
        return found


@cache
def tokenizer(path: str) -> WordTokenizer:
    """The compiled tokenizer of a file, once per Python worker."""
    return WordTokenizer(path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with the token ids of the whole text in a new binary column (unsigned 32-bit,
    little-endian); a null text encodes like an empty one, to no ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in slices(batches):
            found = [coder.encode(t or "") for t in batch.column(text).to_pylist()]
            yield batch.append_column(ids, pa.array(found, pa.binary()))

    return _widened(docs, run, ids, BinaryType())


def decode(coded: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``coded`` with the text that its ids spell; null ids give a null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in batches:
            found = [None if x is None else coder.decode(x) for x in batch.column(ids).to_pylist()]
            yield batch.append_column(text, pa.array(found, pa.string()))

    return _widened(coded, run, text, StringType())


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of the whole text encoded
    and decoded again, in one pass that keeps no ids; columns of these names are replaced.

    Null texts count as empty; repeated rows stay; an empty table gives an empty table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in slices(batches):
            counts, coded, plain = [], [], []
            for value in batch.column(text).to_pylist():
                found = coder.encode(value or "")
                counts.append(len(found) // 4)
                coded.append(hashlib.sha256(found).hexdigest())
                plain.append(hashlib.sha256(coder.decode(found).encode("utf-8")).hexdigest())
            batch = batch.append_column("n_tokens", pa.array(counts, pa.int64()))
            batch = batch.append_column("ids_sha256", pa.array(coded, pa.string()))
            yield batch.append_column("decoded_sha256", pa.array(plain, pa.string()))

    docs = docs.drop("n_tokens", "ids_sha256", "decoded_sha256")
    schema = StructType(docs.schema.fields + [
        StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ])
    return docs.mapInArrow(run, schema)


def _widened(df: DataFrame, run, name: str, kind: DataType) -> DataFrame:
    df = df.drop(name)
    return df.mapInArrow(run, StructType(df.schema.fields + [StructField(name, kind)]))
