"""Main text of web pages: markup zones, and differencing with the page of the nearest URL.

A page's markup is cut into blocks (lines of text).  Blocks inside menus,
headers, footers, sidebars, notices, adverts, forms and reader comments, told by
element, role, class or id, are left out, unless they hold the page's article.

Boilerplate without telling markup is found by differencing: pages of a host are
put in order of their URL paths, each is paired with the neighbour that shares
the longer beginning of its path, their lines are aligned by longest common
subsequence, and shared lines are deleted.  Neighbours of equal lines tell
nothing and are passed over to the nearest page whose lines differ.  Lines of a
marked article (``article``, ``main``, if it holds the bulk of the text) are never deleted, as two pages may rightly
carry the same article; where no page tells, only the marked article is kept.

Pages are ordered by one range-partitioned sort over (host, path), so a hot host
is spread; only line hashes are sorted, and texts stay where they were read.
Tasks go over the sorted files in order; of each file, the first and last two
pages that differ are collected, which gives its edge pages their neighbours.

Defined cases: a null or empty html gives ""; a null url belongs to a host of
its own; a page alone in its host has nothing to be compared with; of equal
neighbours the one before is taken; repeated rows are pages of their own; a page
that shares no line or every line with its neighbour is told nothing by it, and
stays as it is if the neighbour on the other side tells nothing either; an empty table gives an empty table; extra columns pass through.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import packed, stage

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# HTML's element names by what they mean here.
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
_BLOCK = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
                   "ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ZONES = frozenset("nav menu header footer aside form head template select button dialog svg object canvas audio video "
                   "search datalist fieldset".split())
_ARTICLE = frozenset("article main".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
#: Words in a class or id that tell a zone.
_NAMES = frozenset("nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement "
                   "sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay newsletter "
                   "subscribe subscription signup login search share sharing social related recommended breadcrumb breadcrumbs "
                   "pagination comment comments respond reply replies disqus widget".split())


#: Last words of a class or id whose first word tells the zone (``ad-slot``), and first words that tell a variant of the
#: page, not a zone (``has-sidebar``).
_HOLDERS = frozenset("area bar block box buttons container content form holder icons inner item items left links list menu "
                     "panel right section slot top unit widget widgets wrap wrapper".split())
_VARIANTS = frozenset("has have no with without not is hide show".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Zones that never hold the article.
_HARD = frozenset("head template select button svg object canvas audio video datalist".split())
#: Elements with optional end tags: what opening ends them, and the element around them, whose end is theirs.
_P_ENDS = _BLOCK - frozenset("br button option caption head html body legend li dd dt tbody td tfoot th thead tr".split())
_IMPLIED = {"p": (_P_ENDS, frozenset()), "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
            **dict.fromkeys(("dt", "dd"), (frozenset(["dt", "dd"]), frozenset(["dl"]))),
            **dict.fromkeys(("td", "th"), (frozenset(["td", "th", "tr", "tbody", "tfoot"]), frozenset(["table"]))),
            "tr": (frozenset(["tr", "tbody", "tfoot"]), frozenset(["table"]))}


def _tells_zone(token: str) -> bool:
    """Whether a class or id is a zone's name, ends in one, or begins with one and ends in a word for a holder."""
    parts = [w.lower() for w in _WORD.findall(token)]
    if not parts or token.lower() in _NAMES:
        return bool(parts)
    return parts[0] not in _VARIANTS and (parts[-1] in _NAMES or parts[0] in _NAMES and parts[-1] in _HOLDERS)


def _is_zone(name: str, attrs: str) -> bool:
    if name in _ZONES:
        return True
    if not attrs or name in ("html", "body"):
        return False
    for key, a, b, c in _ATTR.findall(attrs) if "=" in attrs else ():
        key, value = key.lower(), a or b or c
        if key == "role" and value.lower() in _ROLES:
            return True
        if key in ("class", "id") and name not in _HEADINGS and any(map(_tells_zone, value.split())):
            return True
    bare = re.sub(r"\"[^\"]*\"|'[^']*'", "", attrs)
    return bool(re.search(r"(?<![\w-])hidden\b(?!\s*=|-)", bare)) or "display:none" in attrs.replace(" ", "").lower()


class _Zone:
    """An open zone: its name, depth of equal names, depth of lists or tables inside, and its number."""

    def __init__(self, name: str, number: int, article: tuple[int, int]):
        self.name, self.number, self.depth, self.inner, self.article = name, number, 1, 0, article

    def ended_by(self, name: str, closing: bool) -> bool:
        """Whether a tag ends the zone's element; called for every tag while the zone is open."""
        if self.name in _IMPLIED:
            opens, around = _IMPLIED[self.name]
            if name in around:
                self.inner += -1 if closing else 1
                if self.inner < 0:
                    return True
            if self.inner == 0 and (name in opens and not closing
                                    or self.name == "p" and closing and name in _BLOCK and name not in ("p", "br")):
                return True
        if name == self.name and (self.inner == 0 or self.name not in _IMPLIED):
            self.depth += -1 if closing else 1
        return self.depth == 0


def blocks(page: str | None) -> list[tuple[str, bool]]:
    """Text blocks outside zones, in page order, and whether each lies in a marked article.

    An element that would be a zone is none if it holds the page's article, told by a marked one with more text
    than stands outside zones, or by more than three quarters of the text (around or beside a marked article with
    text of its own, such a part is a zone all the same: long reader comments).
    """
    if not page:
        return []
    lines: list[tuple[str, int, tuple[int, ...]]] = []      # text, number of the article around it, zones around it
    text: list[str] = []
    open_: list[_Zone] = []
    zones: tuple[int, ...] = ()
    inside: list[bool] = []                                 # of each zone: it lies in an article
    article, articles = (0, 0), 0                           # depth and number of the outermost article, articles so far

    def flush() -> None:
        if text:
            if line := " ".join(unescape("".join(text)).split()):
                lines.append((line, article[1] if article[0] else 0, zones))
            text.clear()
    at, n = 0, len(page)
    hard, hard_depth = "", 0                                # what never holds the article is skipped at once
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            if not hard:
                text.append(page[at:])
            break
        if not hard and m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        name, closing, attrs = m.group(2).lower(), bool(m.group(1)), m.group(3) or ""
        if name in _RAW and not closing:
            end = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            stop = page.find(">", end.start()) if end else -1
            at = stop + 1 if stop >= 0 else n
            continue
        single = name in _VOID or attrs.rstrip().endswith("/")
        if hard:
            if name == hard and not single:
                hard_depth += -1 if closing else 1
                if hard_depth == 0:
                    hard = ""
            continue
        if name in _BLOCK:
            flush()
        if open_ and not (single and name not in _BLOCK):
            for k, zone in enumerate(open_):
                if zone.ended_by(name, closing):
                    flush()
                    article = zone.article
                    del open_[k:]
                    zones = tuple(z.number for z in open_)
                    break
        if name in _ARTICLE:
            if closing:
                article = (max(0, article[0] - 1), article[1])
            else:
                articles += article[0] == 0
                article = (article[0] + 1, article[1] if article[0] else articles)
        elif not closing and not single and _is_zone(name, attrs):
            flush()
            if name in _HARD:
                hard, hard_depth = name, 1
                continue
            open_.append(_Zone(name, len(inside), article))
            inside.append(article[0] > 0)
            zones = tuple(z.number for z in open_)
    flush()
    sizes = [len(t) for t, _, _ in lines]
    total, free = sum(sizes), sum(k for k, (_, _, z) in zip(sizes, lines) if not z)
    free_marked = any(a and not z for _, a, z in lines)
    held, story, parts = Counter(), Counter(), {}           # text of each zone and article, zones around each article
    for k, (_, a, z) in zip(sizes, lines):
        held.update(dict.fromkeys(z, k))
        if a:
            story[a] += k
            parts[a] = parts[a] & set(z) if a in parts else set(z)
    void = {z for z, k in held.items() if 4 * k > 3 * total and (inside[z] or not free_marked)}
    if story:
        main = max(story, key=lambda a: (story[a], -a))
        if story[main] > free:
            void |= {z for z in parts[main] if not inside[z]}
    return [(t, a > 0) for t, a, z in lines if void.issuperset(z)]


def shared_lines(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b`` (matches as an increasing sequence of places)."""
    where: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        where.setdefault(int(b[j]), []).append(j)
    tops: list[int] = []
    piles: list[tuple[int, object]] = []
    for i, x in enumerate(a):
        for j in where.get(int(x), ()):         # from the last: one place of b is used once
            k = bisect_left(tops, j)
            link = (i, piles[k - 1] if k else None)
            if k == len(tops):
                tops.append(j)
                piles.append(link)
            else:
                tops[k], piles[k] = j, link
    out, link = [], piles[-1] if piles else None
    while link is not None:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def _place(url: str | None) -> tuple[str, str]:
    """Host and path (with the query) of a URL."""
    try:
        parts = urlsplit(url or "")
    except ValueError:
        return "", url or ""
    return parts.netloc.lower(), parts.path + ("?" + parts.query if parts.query else "")


def _marked(got: list[tuple[str, bool]]) -> bool:
    """Whether the page marks its article: the mark holds the bulk of the text."""
    return 2 * sum(len(t) for t, m in got if m) > sum(len(t) for t, _ in got)


def _lines(pages: DataFrame) -> DataFrame:
    """Of each page (uid, url, html): uid, host, path, lines (hashes), loose (places of lines that no mark guards)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [blocks(h.as_py()) for h in batch.column(2)]
            place = [_place(u.as_py()) for u in batch.column(1)]
            loose = [[i for i, (_, m) in enumerate(g) if not (m and guard)] for g, guard in zip(got, map(_marked, got))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([p[0] for p in place], pa.string()), pa.array([p[1] for p in place], pa.string()),
                pa.array([[xxhash.xxh64_intdigest(t.encode()) - (1 << 63) for t, _ in g] for g in got], pa.list_(pa.int64())),
                pa.array(loose, pa.list_(pa.int32()))], names=["uid", "host", "path", "lines", "loose"])
    return pages.mapInArrow(work, "uid long, host string, path string, lines array<long>, loose array<int>")


class _Page(NamedTuple):
    host: str
    path: str
    lines: bytes

    def like(self, other: _Page | None) -> bool:
        return other is not None and self.host == other.host and self.lines == other.lines


class _Run:
    """Pages in a row of one host and equal lines: the first, the last, and (uid, path) of those with loose lines."""

    def __init__(self, page: _Page, loose: list[int]):
        self.first, self.last, self.loose, self.rows = page, page, loose, []


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[_Run]]]:
    """Stretches of rows (idx, uid, host, path, lines, loose) without a gap in idx: the first idx, and their runs."""
    def rows():
        for batch in batches:
            lines, loose = batch.column(4), batch.column(5)
            for i, (idx, uid, host, path) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(4)))):
                yield idx, uid, _Page(host, path, lines[i].values.to_numpy().tobytes()), loose[i]
    source = rows()
    ahead = next(source, None)

    def runs():
        nonlocal ahead
        run = None
        while ahead is not None:
            idx, uid, page, loose = ahead
            if run is None or not page.like(run.first):
                if run is not None:
                    yield run
                run = _Run(page, loose.as_py())
            run.last = page
            if run.loose:
                run.rows.append((uid, page.path))
            ahead = next(source, None)
            if ahead is not None and ahead[0] != idx + 1:
                break
        if run is not None:
            yield run
    while ahead is not None:
        yield ahead[0], runs()


def _edges(laid: DataFrame) -> dict[int, tuple[_Page | None, _Page | None]]:
    """Of each segment, by its first idx: the last page before it that differs from its first run, and the first
    page after it that differs from its last run."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, runs in _segments(batches):
            ends: list[tuple] = []             # the first two runs' first pages, the last two runs' last pages
            tail: list[_Run] = []
            for run in runs:
                if len(ends) < 2:
                    ends.append((start, "head", *run.first))
                run.rows.clear()
                tail = [*tail[-1:], run]
            ends += [(start, "tail", *run.last) for run in tail]
            yield pa.RecordBatch.from_pydict(dict(zip(("start", "side", "host", "path", "lines"), map(list, zip(*ends)))))
    found: dict[int, dict[str, list[_Page]]] = {}
    # Four pages of each file's segments at most reach the driver.
    for r in laid.mapInArrow(work, "start long, side string, host string, path string, lines binary").collect():
        found.setdefault(r["start"], {"head": [], "tail": []})[r["side"]].append(
            _Page(r["host"], r["path"], bytes(r["lines"])))
    order = sorted(found)

    def differing(page: _Page, pages: Iterator[_Page]) -> _Page | None:
        return next((x for x in pages if not x.like(page)), None)
    before = lambda k: (x for s in reversed(order[:k]) for x in reversed(found[s]["tail"]))
    after = lambda k: (x for s in order[k + 1:] for x in found[s]["head"])
    return {s: (differing(found[s]["head"][0], before(k)), differing(found[s]["tail"][-1], after(k)))
            for k, s in enumerate(order)}


def deletions(lines: DataFrame) -> DataFrame:
    """(uid, gone): the places of loose lines that a page shares with its nearest page, where that tells something."""
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = stage(lines.repartitionByRange(n, "host", "path", "uid").sortWithinPartitions("host", "path", "uid")
                 .select(F.monotonically_increasing_id().alias("idx"), "uid", "host", "path", "lines", "loose"), "page-order")
    edges = lines.sparkSession.sparkContext.broadcast(_edges(laid))

    def agree(a: str, b: str) -> int:
        n = 0
        for x, y in zip(a, b):
            if x != y:
                break
            n += 1
        return n

    def decided(run: _Run, before: _Page | None, after: _Page | None) -> Iterator[tuple[int, list[int]]]:
        near = [x for x in (before, after) if x is not None and x.host == run.first.host] if run.rows else []
        own, loose, told = np.frombuffer(run.first.lines, np.int64), set(run.loose), []
        for other in near:
            at = shared_lines(own, np.frombuffer(other.lines, np.int64))
            if 0 < len(at) < len(own):
                told.append((other.path, [i for i in at if i in loose]))
        for uid, path in run.rows if told else ():
            yield uid, max(told, key=lambda x: agree(x[0], path))[1]        # the first of equals

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, runs in _segments(batches):
            before, after = edges.value[start]
            held = None
            for run in itertools.chain(runs, (None,)):
                if held is not None:
                    got = list(decided(held, before, run.first if run else after))
                    before = held.last
                    if got:
                        yield pa.RecordBatch.from_pydict({"uid": pa.array([u for u, _ in got], pa.int64()),
                                                          "gone": pa.array([g for _, g in got], pa.list_(pa.int32()))})
                held = run
    return laid.mapInArrow(work, "uid long, gone array<int>")


def _join_lines(pages: DataFrame, names: list[str], schema: T.StructType) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, gone in zip(batch.column(batch.schema.get_field_index("_html")),
                               batch.column(batch.schema.get_field_index("_gone"))):
                got, drop = blocks(h.as_py()), gone.as_py()
                # Without a page to tell, the mark decides alone, or all stays.
                alone = drop is None and _marked(got)
                out.append("\n".join(t for i, (t, m) in enumerate(got) if (m if alone else i not in (drop or ()))))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names),
                                              pa.array(out, pa.string())], names=[*names, "_main"])
    return pages.mapInArrow(work, schema)


def main_text(pages: DataFrame, *, url: str = "url", html: str = "html", column: str = "text") -> DataFrame:
    """``pages`` with ``column`` in place of the html: the main text, blocks joined by a line end."""
    rows = pages.select(packed(pages).alias("_row"), F.monotonically_increasing_id().alias("_uid"))
    lines = _lines(rows.select("_uid", F.col(f"_row.`{url}`"), F.col(f"_row.`{html}`")))
    gone = stage(deletions(lines), "page-deletions")
    others = [c for c in pages.columns if c not in (html, column)]
    wide = rows.select("_uid", F.struct(*[F.col(f"_row.`{c}`").alias(c) for c in others]).alias("_row"),
                       F.col(f"_row.`{html}`").alias("_html"))
    empty = gone.isEmpty()
    joined = (wide.withColumn("_gone", F.lit(None).cast("array<int>")) if empty else
              wide.join(gone.select(F.col("uid").alias("_uid"), F.col("gone").alias("_gone")), "_uid", "left"))
    schema = T.StructType([joined.schema["_row"], T.StructField("_main", T.StringType())])
    return _join_lines(joined, ["_row"], schema).select(*[F.col(f"_row.`{c}`").alias(c) for c in others],
                                                        F.col("_main").alias(column))
