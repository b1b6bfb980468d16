"""Operator 7: main text of web pages by nearest-URL page differencing.

Pages are ordered by host and URL path; each is paired with the neighbour of its host whose path
is most like its own.  The text lines (blocks) of both are aligned by a longest common subsequence, and shared
lines are the site's template and go.  What the markup itself names as no part of the article
(menus, forms, scripts, advert and comment boxes ...) goes as well.  Where the page marks its article, a line inside it
that one neighbour shares is as likely a quotation as a template: there it goes only if the neighbour on the
other side and most pages of the host have it too and it is no heading, and none goes where such lines are most of
the article (a copy).

Only line hashes and URLs are sorted and paired.  Pages that lose no line to their neighbour are read
where they are; only the others are shuffled, to meet their shared line numbers.  Neighbours across partitions come from the partitions' first and
last keys.
"""

from __future__ import annotations

import html
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, steps
from .linking import among, members

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_RAW = ("script", "style", "textarea", "title", "iframe", "noscript", "template", "svg", "canvas", "object", "select", "audio", "video")
_CLOSE = {name: re.compile(rf"</{name}\b[^>]*+(?:>|\Z)", re.I) for name in _RAW}
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_OUTSIDE = frozenset("nav footer aside form head button dialog menu fieldset".split())
#: Never the frame of a page's text, however much of it they hold.
_NO_FRAME = frozenset("nav footer aside head header menu".split())
_NAMED = re.compile(
    r"(?:^|[\s\"'=_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promos?|promotions?|banners?|cookies?|consent|gdpr|notices?|"
    r"alerts?|popups?|modals?|newsletters?|subscribe|subscription|signup|login|share|sharing|social|sidebars?|related|recommended|"
    r"recommendations|breadcrumbs?|pagination|pager|menus?|navbar|nav|navigation|footer|masthead|comments?|commentlist|disqus|respond|"
    r"replies|widgets?|toolbar|skip)(?=$|[\s\"'_-])", re.I)
#: Classes that say what a box has or is filed under, not what it is.
_ABOUT = re.compile(r"(?:has|with|without|no|category|tag|cat|type|format|status)-", re.I)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Bits of alignment table held at once; larger pairs are halved first.
TABLE_BITS = 1 << 28


def blocks_of(page: str) -> list[tuple[str, bool, bool]]:
    """(text, outside, article) of each block, see ``headed_blocks``."""
    return [block[:3] for block in headed_blocks(page)]


def headed_blocks(page: str) -> list[tuple[str, bool, bool, bool]]:
    """(text, outside, article, heading) of each block: whether the markup puts it outside the article,
    whether it lies in an article (or, without one, main) element, and whether in a heading.

    A box that holds most of the page's text and leaves less than a tenth of it is the page's own
    frame and puts nothing outside; an article (or main) element is outside by its name only where
    another is not."""
    found: list[tuple[str, frozenset, bool, bool]] = []
    headings: list[bool] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements, and the number of the box if they are no part of the article
    boxes: list[str] = [""]  # the elements of the boxes by number
    open_boxes: frozenset = frozenset()
    articles = mains = 0

    def flush():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append((text, open_boxes, articles > 0, mains > 0))
                headings.append(any(name in _HEADINGS for name, _ in stack))
            parts.clear()

    def leave(k: int):
        nonlocal open_boxes, articles, mains
        shut = {box for _, box in stack[k:] if box}
        if shut:
            open_boxes = open_boxes - shut
        for name, _ in stack[k:]:
            articles -= name == "article"
            mains -= name == "main"
        del stack[k:]

    at = 0
    while True:
        tag = _TAG.search(page, at)
        if tag is None:
            parts.append(page[at:])
            break
        parts.append(page[at : tag.start()])
        at = tag.end()
        closing, name, rest = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if name is None:
            continue
        name = name.lower()
        if name in _BLOCKS:
            flush()
        elif name in ("br", "td", "th"):
            parts.append(" ")
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    leave(k)
                    break
            continue
        if name in _RAW:
            end = _CLOSE[name].search(page, at) if not rest.rstrip().endswith("/") else None
            if end is None and not rest.rstrip().endswith("/"):
                break  # never closed: the rest is its
            at = end.end() if end else at
            continue
        if name in _EMPTY or rest.endswith("/"):
            continue
        if name in ("article", "main") and not articles and open_boxes and not _named(rest):
            leave(next(k for k, (_, box) in enumerate(stack) if box))  # a box that was never closed
        out = name in _OUTSIDE or (name == "header" and not articles and not mains) or (name not in ("html", "body") and _named(rest))
        stack.append((name, len(boxes) if out else 0))
        if out:
            open_boxes = open_boxes | {len(boxes)}
            boxes.append(name)
        articles += name == "article"
        mains += name == "main"
    flush()
    outside = _outside(found, boxes)
    marked = 2 if any(f[2] and not out for f, out in zip(found, outside)) else 3
    return [(f[0], out, f[marked], heading) for f, out, heading in zip(found, outside, headings)]


def _outside(found: list, boxes: list[str]) -> list[bool]:
    """Whether each block lies in a box that is no frame of the page's text."""
    total = sum(len(f[0]) for f in found)
    held = [0] * len(boxes)
    for text, inside, _, _ in found:
        for box in inside:
            held[box] += len(text)
    frames: set[int] = set()
    for box, name in enumerate(boxes):
        if name in ("article", "main"):
            rank = 2 if name == "article" else 3
            own = not any(f[rank] and f[1] <= frames for f in found)
        else:
            own = 2 * held[box] > total and name not in _NO_FRAME
            own = own and 10 * sum(len(f[0]) for f in found if f[1] <= frames) < total
        if own:
            frames.add(box)
    return [not inside <= frames for _, inside, _, _ in found]


def _named(attributes: str) -> bool:
    return bool(attributes) and any(
        _NAMED.search(token) for m in _ATTRIBUTE.finditer(attributes) for token in m[1].strip("\"'").split() if not _ABOUT.match(token))


def _row(a: list[int], b: list[int], kept: list[int] | None = None) -> int:
    """Bit-parallel longest common subsequence: bit j of the result is 0 where the length grows at b[j]."""
    places: dict[int, int] = {}
    for j, v in enumerate(b):
        places[v] = places.get(v, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for v in a:
        both = row & places.get(v, 0)
        row = ((row + both) | (row - both)) & full
        if kept is not None:
            kept.append(row)
    return row


def _lengths(row: int, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """The places in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    in_a, in_b = set(a), set(b)
    places = [k for k, v in enumerate(a) if v in in_b]
    a, b = [a[k] for k in places], [v for v in b if v in in_a]
    return [places[k] for k in _aligned(a, b)]


def _aligned(a: list[int], b: list[int]) -> list[int]:
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < min(len(a), len(b)) - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    head, tail = list(range(start)), list(range(len(a) - stop, len(a)))
    a, b = a[start : len(a) - stop], b[start : len(b) - stop]
    if not a or not b:
        return head + tail
    if len(a) > 1 and len(a) * len(b) > TABLE_BITS:  # halve: the best split of b for the halves of a
        half = len(a) // 2
        first = _lengths(_row(a[:half], b), len(b))
        second = _lengths(_row(a[half:][::-1], b[::-1]), len(b))[::-1]
        at = int(np.argmax(first + second))
        middle = _aligned(a[:half], b[:at]) + [half + k for k in _aligned(a[half:], b[at:])]
    else:
        kept: list[int] = []
        _row(a, b, kept)
        middle, j = [], len(b) - 1
        for k in range(len(a) - 1, -1, -1):
            while j >= 0 and kept[k] >> j & 1:  # no growth at b[j]
                j -= 1
            if j < 0:
                break
            if k == 0 or kept[k - 1] >> j & 1:  # the growth is a[k]'s
                middle.append(k)
                j -= 1
        middle.reverse()
    return head + [start + k for k in middle] + tail


def place_of(url: str | None) -> tuple[str, str]:
    """(host, path with its query) of a URL; empty where there is none."""
    try:
        parts = urlsplit((url or "").strip())
        return (parts.netloc.rpartition("@")[2].lower(), parts.path + ("?" + parts.query if parts.query else ""))
    except ValueError:
        return "", url or ""


KEY = ["host", "path", "page_id", "h"]
_KEY_SCHEMA = "host string, path string, page_id long, h long"


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def described(pages: DataFrame) -> DataFrame:
    """Each distinct page's key (host, path, page_id, hash of url and html), whether it marks an article
    that holds text, its lines' hashes, and the numbers of the lines that may be template: all, but of a marked
    article's page those inside it that are no headings."""

    def describe(batches):
        for batch in steps(batches, 2):
            columns: list[list] = [[], [], [], [], [], []]
            for url, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                host, path = place_of(url)
                blocks = headed_blocks(page or "")
                marked = any(article and not out for _, out, article, _ in blocks)
                asked = [k for k, (_, out, article, heading) in enumerate(blocks) if article and not out and not heading] if marked else list(range(len(blocks)))
                row = (host, path, _hash(f"{url}\n{page or ''}"), marked, [_hash(block[0]) for block in blocks], asked)
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), batch.column(0), pa.array(columns[2], pa.int64()),
                 pa.array(columns[3], pa.bool_()), *(pa.array(c, pa.list_(pa.int64())) for c in columns[4:])], [*KEY, "marked", "lines", "asked"])

    return pages.mapInArrow(describe, _KEY_SCHEMA + ", marked boolean, lines array<long>, asked array<long>").dropDuplicates(["page_id", "h"])


def partners(keys: DataFrame) -> DataFrame:
    """page_id, h and its partner's (other_page_id, other_h): the neighbour of the same host, in the
    order of paths, with the longer common path; the one before if both are alike.  A second row, its
    ``nearest`` False, for the neighbour on the other side, if there is one."""
    ordered = cut(keys.select(*KEY).repartitionByRange(*KEY).sortWithinPartitions(*KEY))

    def ends(batches):
        rows = [r for b in batches if b.num_rows for r in (b.slice(0, 1), b.slice(b.num_rows - 1, 1))]
        if rows:
            part = TaskContext.get().partitionId()
            for place, row in ((0, rows[0]), (1, rows[-1])):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([place], pa.int32()), *row.columns], ["part", "place", *KEY])

    edges = sorted(tuple(r) for r in ordered.mapInArrow(ends, "part int, place int, " + _KEY_SCHEMA).collect())  # two keys a partition

    def alike(a: str, b: str) -> int:
        n = min(len(a), len(b))
        return next((k for k in range(n) if a[k] != b[k]), n)

    def pair(batches):
        part = TaskContext.get().partitionId()
        before = next((e[2:] for e in reversed(edges) if e[0] < part), None)
        behind = next((e[2:] for e in edges if e[0] > part), None)
        held = None

        def rows(last, own, following):
            near = [x for x in (last, following) if x is not None and x[0] == own[0]]
            near.sort(key=lambda x: -alike(x[1], own[1]))
            return [(own[2], own[3], *x[2:], k == 0) for k, x in enumerate(near)]

        for batch in batches:
            out = []
            for own in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None:
                    out += rows(before, held, own)
                    before = held
                held = own
            if out:
                yield made(out)
        if held is not None and (last := rows(before, held, behind)):
            yield made(last)

    def made(found):
        *ids, nearest = zip(*found)
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in ids), pa.array(nearest, pa.bool_())],
                                          ["page_id", "h", "other_page_id", "other_h", "nearest"])

    return ordered.mapInArrow(pair, "page_id long, h long, other_page_id long, other_h long, nearest boolean")


def template_lines(pages: DataFrame) -> DataFrame:
    """page_id, h, and the numbers of the lines that a page shares with its partner; of a marked article's page those
    inside it, headings apart, that it shares with its neighbours on both sides and that most pages of the host have."""
    light = cut(described(pages))
    pairs = cut(partners(light))

    def align(batches):
        for batch in batches:
            found, hashes = [], []
            for a, asked, b in zip(*(c.to_pylist() for c in batch.columns[3:])):
                met = set(b).intersection(a[k] for k in asked)
                found.append(sorted(set(asked).intersection(shared_lines(a, b))) if met else [])
                hashes.append([a[k] for k in found[-1]])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(c, pa.list_(pa.int64())) for c in (found, hashes))],
                                             ["page_id", "h", "host", "shared", "line"])

    own = light.select(F.col("page_id").alias("p"), F.col("h").alias("q"), "host", "marked", "lines", "asked")
    other = light.select(F.col("page_id").alias("r"), F.col("h").alias("s"), F.col("lines").alias("other_lines"))

    def aligned(sides):
        return (
            sides.join(other, F.col("other_page_id").eqNullSafe(F.col("r")) & (F.col("other_h") == F.col("s")))
            .select("page_id", "h", "host", "lines", "asked", "other_lines")
            .mapInArrow(align, "page_id long, h long, host string, shared array<long>, line array<long>").where("size(shared) > 0"))

    sides = pairs.join(own, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("h") == F.col("q"))).where("nearest or marked")
    both = aligned(sides.where("marked")).groupBy("page_id", "h", "host").agg(F.collect_list(F.arrays_zip("shared", "line")).alias("sides"))  # two at most
    both = cut(both.where("size(sides) = 2").select("page_id", "h", "host", F.inline(F.array_intersect(F.col("sides")[0], F.col("sides")[1]))))
    common = host_lines(light, both).select(F.col("host").alias("on"), F.col("line").alias("common"))
    both = both.join(common, (F.col("host") == F.col("on")) & (F.col("line") == F.col("common"))).groupBy("page_id", "h")
    return aligned(sides.where("not marked")).select("page_id", "h", "shared").unionByName(both.agg(F.array_sort(F.collect_list("shared")).alias("shared")))


def host_lines(light: DataFrame, asked: DataFrame) -> DataFrame:
    """The distinct (host, line) of ``asked`` that more than half of the host's pages have."""
    lines = among(light.select("host", F.explode(F.array_distinct("lines")).alias("line")), "line", asked.select("line").distinct())
    held = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("held"))
    pages = light.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    return held.join(pages, "host").where("2 * held > pages").join(asked.select("host", "line").distinct(), ["host", "line"], "left_semi")


def main_text(page: str, shared: list[int]) -> str:
    """The blocks of the article, one a line: those of the article (or main) element that the page marks, without
    the shared ones that are no headings unless these are most of it; else all but the shared ones, or all if
    none is left.  Where the markup leaves nothing, the same of the blocks that it puts outside."""
    blocks = headed_blocks(page)
    template = set(shared)
    inside = [text for text, out, article, _ in blocks if article and not out]
    if inside:
        kept = [text for k, (text, out, article, heading) in enumerate(blocks) if article and not out and (heading or k not in template)]
        if 2 * sum(map(len, kept)) >= sum(map(len, inside)):
            inside = kept
    else:
        rest = [(k, block[0]) for k, block in enumerate(blocks) if not block[1]] or [(k, block[0]) for k, block in enumerate(blocks)]
        inside = [text for k, text in rest if k not in template] or [text for _, text in rest]
    return "\n".join(inside)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html).

    Null or empty html gives an empty text; a null url belongs to an empty host; a page alone on its
    host shares no line; repeated rows are extracted alike and are not paired with themselves; an
    empty table gives no row; other columns are not read."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    shared = cut(template_lines(pages).where("size(shared) > 0").select(F.col("page_id").alias("p"), F.col("h").alias("q"), "shared"))
    differing = pages.sparkSession.sparkContext.broadcast(members(shared.select("q")))  # of bounded size

    def identify(wanted: bool):
        def keep(batches):
            for batch in steps(batches, 2):
                h = np.array([_hash(f"{u}\n{p or ''}") for u, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())], np.int64)
                found = pa.RecordBatch.from_arrays([*batch.columns, pa.array(h)], ["page_id", "url", "html", "h"])
                yield found.filter(pa.array(differing.value(h) == wanted))

        return pages.mapInArrow(keep, "page_id long, url string, html string, h long")

    def read(batches):
        for batch in steps(batches, 2):
            texts = [main_text(p or "", s or []) for p, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    alone = identify(False).select("page_id", "url", "html", F.lit(None).cast("array<long>").alias("shared"))
    paired = identify(True).join(shared, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("h") == F.col("q")), "left")
    return alone.unionByName(paired.select("page_id", "url", "html", "shared")).mapInArrow(read, "page_id long, url string, text string, n_chars long")
