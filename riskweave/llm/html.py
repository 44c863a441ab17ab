"""Main text of web pages: differencing against the page with the nearest URL of the same host.

A page becomes lines, one a block of text.  Blocks in menus, footers, forms and the like are dropped
by their markup, and what stands outside the article of a page that has one.  The lines left over are
aligned, one by one, with the page of other lines on the same host whose URL path is nearest; lines
in their longest common subsequence belong to the site and are deleted.  A page with an article is
compared with all pages of its host, one without with their lines outside of articles.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from math import isqrt
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.running import numbered
from .common import stored

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|noscript|template|textarea|select|svg|iframe|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+(?=>|\Z)|(?:[^<>\"]++|\"[^\"]*+\")*+)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
# fixed values: elements that start a block, elements that hold no article, class names of the same
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = set("nav footer aside form button menu dialog".split())
# fixed values: elements whose end tag may be missing, and the opening tags that end them
ENDS = {
    "p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr", "tbody"},
    "th": {"td", "th", "tr", "tbody"}, "tr": {"tr", "tbody"}, "option": {"option", "optgroup"},
}
#: What an end tag may be missing inside of, without ending what stands around it.
FENCES = set("table ul ol dl menu td th article main section div body html".split())
# fixed values: parts of class names, ids and roles of what is no article, and parts that say nothing
NO_ARTICLE = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "footer header masthead menu modal nav navbar navigation newsletter notice notices popup promo related share sharing "
    "sidebar social sponsor sponsors sponsored subscribe toolbar widget widgets".split()
)
NEUTRAL = set(
    "area bar block bottom box container global group inner item items left links list main message page panel post posts "
    "primary right row secondary section signup site slot top unit wrap wrapper".split()
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+))", re.I)
_PIECE = re.compile(r"[a-z]+|[A-Z][a-z]*")


def named_outside(attributes: str) -> bool:
    """Whether a class, id or role says that an element holds no article: one of its words does, and
    the word's other parts say nothing (``site-header`` does, ``article-header`` does not)."""
    for found in _ATTRIBUTE.finditer(attributes):
        for word in (found[1] or found[2] or found[3] or "").split():
            parts = {p.lower() for p in _PIECE.findall(word)}
            if parts & NO_ARTICLE and parts <= NO_ARTICLE | NEUTRAL:
                return True
    return False


#: Paths of a host that are compared with all its others together.
PAIRED = 4096
#: Paths that are walked as one tree, so that a task holds no whole host.
WALKED = 4096

SITE, OPEN, ARTICLE = 0, 1, 2


def lines_of(page: str) -> list[tuple[str, int]]:
    """(text, SITE, OPEN or ARTICLE) of every block with text, in page order.

    Open elements are kept on a stack.  Site matter ends with its element: at its end tag, where a
    missing one is implied, or with an element around it.  An article that begins inside a menu, a
    page header or a form, whose end tag may be missing, is an article all the same.
    """
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[str] = []
    outside: list[tuple[int, bool]] = []  # stack places of site matter, and whether an article ends it
    articles: list[int] = []
    at = 0

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append((text, SITE if outside else ARTICLE if articles else OPEN))
        parts.clear()

    def cut(depth: int) -> None:
        del stack[depth:]
        while outside and outside[-1][0] >= depth:
            outside.pop()
        while articles and articles[-1] >= depth:
            articles.pop()

    def last(names: set[str], fences: set[str]) -> int:
        """The place of the innermost open element of these names that no fence hides, or -1."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k] in names:
                return k
            if stack[k] in fences:
                return -1
        return -1

    for found in _MARKUP.finditer(page):
        if found.start() > at:
            parts.append(entities.unescape(page[at : found.start()]))
        at = found.end()
        name = (found[3] or "").lower()
        if not name:
            if found[1]:
                parts.append(" ")
            continue
        if name in BLOCKS or name in OUTSIDE or name == "option":
            flush()
        elif name == "br":
            parts.append(" ")
        if name in VOID:
            continue
        if found[2]:
            # an inline end tag does not end the block around it
            k = last({name}, set() if name in BLOCKS or name in OUTSIDE else BLOCKS)
            if k >= 0:
                cut(k)
            continue
        ended = {open_ for open_, by in ENDS.items() if name in by}
        if ended and (k := last(ended, FENCES - ended)) >= 0:
            cut(k)
        own = found[4] or ""
        article = name in ("article", "main")
        if article and outside and all(may_end for _, may_end in outside) and not named_outside(own):
            outside.clear()
        stack.append(name)
        by_name = name in OUTSIDE or name == "header" and not articles
        if by_name or not article and name not in ("html", "body") and named_outside(own):
            outside.append((len(stack) - 1, by_name and name in ("nav", "header", "form", "menu")))
        elif article and not outside:
            articles.append(len(stack) - 1)
    if at < len(page):
        parts.append(entities.unescape(page[at:]))
    flush()
    return out


def place_of(url: str | None) -> tuple[str, str]:
    """(host, path) that spellings of one address share: no query, fragment, suffix or last slash."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return "", url or ""
    return host, re.sub(r"(/index)?(\.x?html?|\.php|\.aspx?)?/*$", "", parts.path.lower())


def common_lines(one: list[int], two: list[int]) -> set[int]:
    """Places in ``one`` of a longest common subsequence of both.

    A row of the table is one number: bit j is 0 where the length grows at line j of ``two``, and a
    row follows from the one before by a few operations on whole rows.  Every s-th row is kept, with
    s the root of their number, and the others are made again while the way is followed back.
    """
    where: dict[int, int] = {}
    for j, h in enumerate(two):
        where[h] = where.get(h, 0) | 1 << j
    full, n = (1 << len(two)) - 1, len(one)
    step = max(1, isqrt(n))

    def following(row: int, i: int) -> int:
        same = row & where.get(one[i], 0)
        return (row + same | row - same) & full

    kept, row = [full], full
    for i in range(n):
        row = following(row, i)
        if (i + 1) % step == 0:
            kept.append(row)
    out, j = set(), len(two)
    for block in range(n // step, -1, -1):
        first = block * step
        rows = [kept[block]]
        for i in range(first, min(first + step, n)):
            rows.append(following(rows[-1], i))
        i = len(rows) - 1
        while i and j:
            if rows[i] >> (j - 1) & 1:
                j -= 1
            elif rows[i - 1] >> (j - 1) & 1:
                out.add(first + i - 1)
                i, j = i - 1, j - 1
            else:
                i -= 1
    return out


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


class Asked:
    """Paths, each of which looks for the one with the fewest letters to change among others.

    The others are walked in order as a tree of their letters, for all asked paths at once: a column
    of the table of edits, kept as bits of its steps up and down, follows from that of the letter
    before by a few operations on whole numbers, 64 letters of the asked path at a time.  An asked
    path leaves a branch when no cell of its column is below the fewest letters found so far.
    """

    def __init__(self, paths: list[str], most: list[int]):
        """``paths`` of one number of words of 64 letters; ``most``: more letters than are looked for."""
        self.paths, self.best, self.near = paths, np.array(most), [None] * len(paths)
        size = np.array([len(p) for p in paths])
        self.words = max(1, -(-int(size.max()) // 64))
        place = 64 * np.arange(self.words)[:, None]
        held = np.clip(size - place, 0, 64).astype(np.uint64)
        self.mask = np.where(held > 0, ~np.uint64(0) >> (np.uint64(64) - np.maximum(held, 1)), 0).astype(np.uint64)
        owner = np.repeat(np.arange(len(paths)), size)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        letters = np.array([ord(c) for p in paths for c in p], dtype=np.int64)
        self.none, self.where = np.zeros((self.words, len(paths)), dtype=np.uint64), {}
        for letter in np.unique(letters).tolist():
            own = letters == letter
            bits = self.none.copy()
            np.bitwise_or.at(bits, (at[own] // 64, owner[own]), np.uint64(1) << (at[own] % 64).astype(np.uint64))
            self.where[chr(letter)] = bits

    def step(self, who: np.ndarray, up: np.ndarray, down: np.ndarray, letter: str) -> tuple[np.ndarray, np.ndarray]:
        """The columns after one more letter, from the steps ``up`` and ``down`` of those before."""
        one, top = np.uint64(1), np.uint64(63)
        same = self.where.get(letter, self.none)[:, who]
        new_up, new_down = np.empty_like(up), np.empty_like(down)
        more, less = one, np.uint64(0)  # the first row rises by one a letter
        for k in range(self.words):
            p, m, eq = up[k], down[k], same[k]
            either = eq | m
            eq = eq | less
            across = ((eq & p) + p ^ p) | eq
            rise, fall = m | ~(across | p), p & across
            rise, fall, more, less = rise << one | more, fall << one | less, rise >> top, fall >> top
            new_up[k], new_down[k] = fall | ~(either | rise), rise & either
        return new_up, new_down

    def counted(self, bits: np.ndarray, who: np.ndarray) -> np.ndarray:
        return np.bitwise_count(bits & self.mask[:, who]).sum(axis=0, dtype=np.int64)

    def walk(self, others: list[str]) -> None:
        """Look among ``others``, in order and later than all seen before, for nearer paths: the
        first of those with the fewest letters is kept."""
        common = [0] * (len(others) + 1)
        for i in range(1, len(others)):
            common[i] = common_start(others[i - 1], others[i])
        every = np.arange(len(self.paths))
        columns = [(0, every, np.full(self.none.shape, ~np.uint64(0)), self.none)]
        dead = None  # where all have left the branch
        for i, path in enumerate(others):
            if dead is not None and common[i] >= dead:
                continue
            dead = None
            while columns[-1][0] > common[i]:
                columns.pop()
            depth, who, up, down = columns[-1]
            while depth < len(path):
                up, down = self.step(who, up, down, path[depth])
                depth += 1
                # the column begins with depth and falls by one a step down, at most
                kept = depth - self.counted(down, who) < self.best[who]
                if not kept.all():
                    who, up, down = who[kept], up[:, kept], down[:, kept]
                    if not len(who):
                        dead = depth
                        break
                if depth == common[i + 1]:
                    columns.append((depth, who, up, down))
            else:
                letters = depth + self.counted(up, who) - self.counted(down, who)
                for j in np.flatnonzero(letters < self.best[who]).tolist():
                    if self.paths[who[j]] != path:
                        self.best[who[j]], self.near[who[j]] = letters[j], path


def common_start(one: str, two: str) -> int:
    """Letters that two paths begin with alike."""
    return next((k for k, (x, y) in enumerate(zip(one, two)) if x != y), min(len(one), len(two)))


def letters_at_most(one: str, two: str) -> int:
    """What lies between the equal starts and ends of two paths: no fewer than their edit distance."""
    start = common_start(one, two)
    one, two = one[start:], two[start:]
    return max(len(one), len(two)) - common_start(one[::-1], two[::-1])


def asked_groups(paths: list[str]) -> list[Asked]:
    """``paths``, which come in order, by their number of words; the two next to each bound its search."""
    steps = [letters_at_most(a, b) for a, b in zip(paths, paths[1:])]
    far = max((len(p) for p in paths), default=0) + (1 << 40)
    bound = [min(a, b) + 1 for a, b in zip([far, *steps], [*steps, far])]
    by: dict[int, tuple[list[str], list[int]]] = {}
    for path, most in zip(paths, bound):
        group = by.setdefault(max(1, -(-len(path) // 64)), ([], []))
        group[0].append(path)
        group[1].append(most)
    return [Asked(*group) for group in by.values()]


def nearest_paths(pairs: DataFrame) -> DataFrame:
    """(host, path, near): for the asked paths of each (host, group) the one of its other paths with
    the fewest letters to change, the smallest of them on a tie; none where there is no other.

    ``pairs`` has (host, group, asked, path): every asked path and, not as such, all paths of the
    host, each once.  They come in order, so a task holds the asked ones of a group and a few others.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, own, asked, others = None, [], [], []

        def walked() -> None:
            nonlocal own
            if own:
                asked.extend(asked_groups(own))
                own = []
            for group in asked:
                group.walk(others)
            others.clear()

        def result() -> pa.RecordBatch:
            walked()
            found = [(place[0], path, near) for group in asked for path, near in zip(group.paths, group.near) if near is not None]
            asked.clear()
            columns = zip(*found) if found else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["host", "path", "near"])

        for batch in batches:
            for host, group, first, path in zip(*(c.to_pylist() for c in batch.columns)):
                if (host, group) != place:
                    if place is not None:
                        yield result()
                    place = host, group
                if first:
                    own.append(path)
                else:
                    others.append(path)
                    if len(others) >= WALKED:
                        walked()
        if place is not None:
            yield result()

    rows = pairs.select("host", "group", "asked", "path")
    # few bytes, much work: the number of tasks is not left to their size
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "host", "group").sortWithinPartitions("host", "group", F.desc("asked"), "path")
    return rows.mapInArrow(run, "host string, path string, near string")


def nearest_pages(outlines: DataFrame) -> DataFrame:
    """(host, path, other): for each path of a host that is ``asked`` for the lines of the page with
    the nearest URL, the one of all other pages of the host whose path has the fewest letters to
    change (the smallest of them on a tie); a host with one page has none.

    Paths with the same lines are copies and count as one, that with the smallest path, so a
    neighbour always differs; pages without lines are nobody's neighbour.  The asked paths of a host
    are dealt in order, about PAIRED to a group, which meets every path of the host, so that a host with very
    many pages needs no task alone; lines are fetched for the chosen path only.
    """
    outlines = outlines.filter(F.size("lines") > 0)
    every = outlines.groupBy("host", "path").agg(F.min_by("lines", F.struct(F.size("lines"), "lines")).alias("lines"), F.max("asked").alias("asked"))
    every = stored(every.withColumn("copy", F.xxhash64("lines")))
    one = every.groupBy("host", "copy").agg(F.min("path").alias("path"), F.max("asked").alias("asked"))
    one = stored(one)
    ranks = numbered(one.filter("asked").select("host", "path"), ("host",), "path", "rank")
    x = ranks.select("host", F.floor(F.col("rank") / PAIRED).cast("int").alias("group"), F.lit(True).alias("asked"), "path")
    groups = x.groupBy("host").agg(F.max("group").alias("last"))
    y = one.join(groups, "host").select("host", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("group"), F.lit(False).alias("asked"), "path")
    nearest = nearest_paths(x.unionAll(y))
    lines = every.select("host", F.col("path").alias("near"), F.col("lines").alias("other"))
    nearest = one.select("host", "copy", "path").join(nearest, ["host", "path"]).join(lines, ["host", "near"]).select("host", "copy", "other")
    return every.filter("asked").select("host", "path", "copy").join(nearest, ["host", "copy"]).select("host", "path", "other")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``: the main text, blocks by line ends.

    Null and empty pages, and pages without text, have an empty text.  Pages with a null address are
    not aligned and keep all lines of their article, or else their open ones.  Repeated rows give repeated results.
    """
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    schema = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, host string, path string, own array<string>"

    def parsed(address: str | None, page: str | None) -> tuple[str | None, str | None, list[str], list[str]]:
        """(host, path) or nulls, and the lines inside and outside of articles."""
        lines = lines_of(page or "")
        place = place_of(address) if address else (None, None)
        return *place, [t for t, kind in lines if kind == ARTICLE], [t for t, kind in lines if kind == OPEN]

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for address, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                host, path, article, plain = parsed(address, page)
                if host is None:
                    continue
                if plain:
                    out.append((f"open {host}", path, [_hash(t) for t in plain], not article))
                if article or plain:
                    out.append((f"article {host}", path, [_hash(t) for t in article or plain], bool(article)))
            kinds = pa.string(), pa.string(), pa.list_(pa.int64()), pa.bool_()
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["host", "path", "lines", "asked"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, (address, page) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                host, path, article, plain = parsed(address, page)
                if host is None or not (article or plain):  # has no neighbour: spread by its place
                    out.append(("", str(i), article or plain))
                else:
                    out.append((f"{'article' if article else 'open'} {host}", path, article or plain))
            kinds = pa.string(), pa.string(), pa.list_(pa.string())
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, kinds))], ["page_id", "url", "host", "path", "own"])

    # pages are parsed twice, so that no text is written besides what the join below moves
    near = nearest_pages(rows.select("url", "html").mapInArrow(outline, "host string, path string, lines array<long>, asked boolean"))
    unsure = rows.mapInArrow(placed, schema).join(near, ["host", "path"], "left").select("page_id", "url", "own", "other")

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for lines, other in zip(*(batch.column(c).to_pylist() for c in ("own", "other"))):
                own = [_hash(t) for t in lines] if other else []
                # one of several versions of a path may still be the copy of its neighbour
                shared = common_lines(own, other) if other and other != own else set()
                texts.append("\n".join(t for i, t in enumerate(lines) if i not in shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    found = unsure.mapInArrow(difference, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
