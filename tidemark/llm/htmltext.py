"""Main text of web pages by nearest-URL page differencing.

Each page becomes a list of text lines, one for each block element, in page
order.  Pages are ordered by host, URL path and id.  A page's neighbours are the
nearest pages of its host before and after it that have lines, and other lines
than its own; it is paired with the nearer of the two (the longer common path
prefix; the preceding page when equal).  The lines of both are aligned by
longest common subsequence, and lines that the two share are deleted.

Differencing alone would delete article lines that two pages have in common
(reprints, shared passages) and keep menus that differ, so markup decides
first where it speaks: lines inside elements that are menus, headers, footers,
sidebars, notices, adverts, forms or reader comments go; lines inside an
article or main element stay and are never deleted as shared; when a page has
such an element, text outside it goes.  Differencing decides the rest: the
lines of pages without that markup, and inside an article the blocks whose
class or id only resembles boilerplate (``share-price``, ``notice-text``):
these go where the neighbour has them too.

The order is cut into blocks at keys taken from the table itself (the keys of
least hash), so that a host of any size is spread over the cluster.  Hosts that
limits cut are read once more before: copies of the pages that are neighbours
across a limit go along with the block.  Results don't depend on the blocks.

Defined results: a null or empty html gives an empty text; a null url pairs
with nothing; pages with equal lines share their neighbours; repeated rows
each get their result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import groups_of

#: Pages of a block on average, most block limits held by a task, and pages drawn for each limit.
BLOCK_PAGES = 2048
MOST_BLOCKS = 16384
DRAWN = 32
#: Lines times lines aligned in one piece; beyond, the alignment is cut in two, as exactly.
EXACT_CELLS = 400_000_000
#: Bytes of html parsed from one Arrow batch at a time.
BATCH_BYTES = 8 << 20

#: Element names and name parts of HTML.
RAW = "script|style|noscript|template|iframe|object|svg|math|canvas|textarea|title"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
DROPPED = frozenset("head nav footer aside form select option button dialog menu search fieldset audio video map datalist".split())
KEPT = frozenset("article main".split())
CLOSES_ITSELF = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "option": ("select",)}
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
BAD_NAMES = re.compile(
    r"(?:^|[-_\s])(?:ads?|adv|advert\w*|adsense|adbox|banner\w*|promo\w*|sponsor\w*|cookie\w*|consent|gdpr|notices?|alert|newsletter\w*|subscri\w+|pop-?up|modal|overlay"
    r"|side-?bar\w*|menus?|nav\w*|breadcrumbs?|footer|header|masthead|top-?bar|comments?|commentlist|replies|reply|respond|disqus|related|recommended|share|sharing|social"
    r"|widgets?|login|sign-?(?:in|up)|search\w*|toolbar|pagination|pager|skip-?link|hidden|paywall)(?:$|[-_\s])",
    re.I,
)
#: Names that mean boilerplate even inside an article.
SURE_NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising sponsored cookie-notice cookie-banner cookie-consent newsletter newsletter-signup sidebar breadcrumb breadcrumbs pagination"
    " comments comment-list commentlist reader-comments replies disqus disqus_thread related-posts related-articles share-buttons social-share social-links paywall".split()
)
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^<>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


def _is_boilerplate(name: str, attrs: str, inside: bool) -> bool | None:
    """Whether an element is boilerplate; None inside an article if its name only resembles it."""
    if name in DROPPED or (name == "header" and not inside):
        return True
    if not attrs or attrs.isspace() or name in ("html", "body", "article", "main"):
        return False
    answer: bool | None = False
    for m in ATTRIBUTE.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in ("class", "id") and BAD_NAMES.search(value):
            if not inside or not SURE_NAMES.isdisjoint(value.lower().split()):
                return True
            answer = None
        if key == "role" and value.lower() in BAD_ROLES:
            return True
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            return True
    return answer


#: What markup says of a line: nothing, that it is of an article or main element, or of one there whose name resembles boilerplate.
OPEN, HELD, DOUBTED = 0, 1, 2


def lines_of(html: str | None) -> tuple[list[str], list[int]]:
    """Text lines outside boilerplate elements, and for each what markup says of it."""
    lines: list[str] = []
    kept: list[int] = []
    parts: list[str] = []
    stack: list[str] = []
    dropped_from: int | None = None  # depth of the outermost boilerplate element
    doubted_from: int | None = None  # and of the outermost one that resembles it
    inside = 0  # open article and main elements

    def flush() -> None:
        if parts:
            text = "".join(parts)
            parts.clear()
            if line := " ".join((unescape(text) if "&" in text else text).split()):
                lines.append(line)
                kept.append(OPEN if not inside else HELD if doubted_from is None else DOUBTED)

    def cut(depth: int) -> None:
        nonlocal dropped_from, doubted_from, inside
        inside -= sum(x in KEPT for x in stack[depth:])
        del stack[depth:]
        if doubted_from is not None and depth <= doubted_from:
            doubted_from = None
        if dropped_from is not None and depth <= dropped_from:
            dropped_from = None
            parts.clear()

    at = 0
    html = html or ""
    for m in TOKEN.finditer(html):
        if dropped_from is None and m.start() > at:
            parts.append(html[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        block = name in BLOCKS
        if m["end"]:
            if block:
                flush()
            if name in stack:
                cut(len(stack) - 1 - stack[::-1].index(name))
            continue
        if block:
            flush()
            if "p" in stack:
                depth = len(stack) - 1 - stack[::-1].index("p")
                if not any(x in BLOCKS for x in stack[depth + 1 :]):
                    cut(depth)
        if name in CLOSES_ITSELF and name in stack:
            depth = len(stack) - 1 - stack[::-1].index(name)
            if not any(x in CLOSES_ITSELF[name] for x in stack[depth + 1 :]):
                cut(depth)
        if name in ("br", "td", "th"):
            parts.append(" ")
        if name in VOID or m["attrs"].endswith("/") and name not in BLOCKS:
            continue
        if dropped_from is None and (said := _is_boilerplate(name, m["attrs"], inside > 0)) is not False:
            if said:
                dropped_from = len(stack)
            elif doubted_from is None:
                doubted_from = len(stack)
        stack.append(name)
        inside += name in KEPT
    if dropped_from is None and at < len(html):
        parts.append(html[at:])
    flush()
    return lines, kept


def shared_lines(own: list[str], other: list[str]) -> set[int]:
    """Places in own of the lines of a longest common subsequence with other."""
    if len(own) * len(other) > EXACT_CELLS:
        return _aligned_once(own, other)
    places: dict[str, int] = defaultdict(int)
    for j, line in enumerate(other):
        places[line] |= 1 << j
    full = (1 << len(other)) - 1
    row, rows = full, []
    for line in own:  # bit-parallel: a zero bit j says that the length grows at j
        match = row & places.get(line, 0)
        row = ((row + match) | (row - match)) & full
        rows.append(row)
    found, j = set(), len(other)
    for i in range(len(own) - 1, -1, -1):
        low = (1 << j) - 1  # zero bits below j count the length over own[: i + 1] and other[:j]
        grown = ~rows[i] & low
        if grown.bit_count() > (~(rows[i - 1] if i else full) & low).bit_count():
            found.add(i)
            j = grown.bit_length() - 1
    return found


def _longest(own: list[str], other: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequences of own with every beginning of other."""
    places: dict[str, bytearray] = {}
    size = len(other) // 8 + 1
    wanted = set(own)
    for j, line in enumerate(other):
        if line in wanted:
            places.setdefault(line, bytearray(size))[j >> 3] |= 1 << (j & 7)
    full = (1 << len(other)) - 1
    row = full
    for line in own:
        if line in places:
            match = row & int.from_bytes(places[line], "little")
            row = ((row + match) | (row - match)) & full
    grown = np.unpackbits(np.frombuffer((~row & full).to_bytes(size, "little"), np.uint8), bitorder="little")[: len(other)]
    return np.append(0, np.cumsum(grown, dtype=np.int64))


def _aligned_once(own: list[str], other: list[str]) -> set[int]:
    """As shared_lines for huge pages: cuts own once, and other where both halves share most."""
    if len(own) < 2:
        return {0} if own and own[0] in other else set()
    half = len(own) // 2
    both = _longest(own[:half], other) + _longest(own[half:][::-1], other[::-1])[::-1]
    j = int(both.argmax())
    return shared_lines(own[:half], other[:j]) | {half + i for i in shared_lines(own[half:], other[j:])}


def main_text(lines: list[str], kept: list[int], other: list[str] | None) -> str:
    """The text that stays of a page, given its neighbour's lines."""
    asked = DOUBTED if any(kept) else OPEN  # the lines that differencing decides
    gone = shared_lines(lines, other) if asked in kept and other and other != lines else set()
    return "\n".join(line for i, (line, k) in enumerate(zip(lines, kept)) if k == HELD or (k == asked and i not in gone))


def _address(url: str | None) -> tuple[str, str]:
    try:
        x = urlsplit(url or "")
        return (x.hostname or "").lower(), x.path
    except ValueError:
        return "", url or ""


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _hash(lines: list[str]) -> str:
    return hashlib.blake2b("\n".join(lines).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _halo(rows: DataFrame, limits: list[tuple]) -> dict[tuple, list[int]]:
    """The blocks that a page is a neighbour in from outside, by (host, path, page_id, url, hash of its lines)."""
    cut = {x[0] for x in limits} - {""}  # only a host of a limit lies in several blocks
    if not cut:
        return {}
    held = rows.sparkSession.sparkContext.broadcast((limits, cut))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hosts = held.value
        for batch in batches:
            found = []
            for i, (page_id, url) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                host, path = _address(url)
                if host in hosts and (lines := lines_of(batch.column(2)[i].as_py())[0]):
                    found.append((bisect_right(at, (host, path, -1 if page_id is None else page_id)), host, path, page_id, url, _hash(lines)))
            if found:
                kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["block", "host", "path", "page_id", "url", "h"])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each host in each block the first and last page, and the first and last of other lines than those."""
        found: list[list] = []
        for batch in batches:
            for block, host, *key in zip(*(c.to_pylist() for c in batch.columns)):
                key = tuple(key)
                if not found or found[-1][:2] != [block, host]:
                    found.append([block, host, key, None, key, None])
                    continue
                x = found[-1]
                if x[3] is None and key[3] != x[2][3]:
                    x[3] = key
                if key[3] != x[4][3]:
                    x[5] = x[4]
                x[4] = key
        for block, host, *pages in found:
            for place, key in enumerate(pages):
                if key is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((block, host, place, *key), (pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string()))], ["block", "host", "place", "path", "page_id", "url", "h"])

    pages = rows.mapInArrow(keys, "block int, host string, path string, page_id long, url string, h string")
    pages = pages.repartition("block").sortWithinPartitions("block", "host", "path", "page_id", "url")
    inner: dict[tuple, list] = {}
    for r in pages.mapInArrow(ends, "block int, host string, place int, path string, page_id long, url string, h string").collect():
        inner.setdefault((r.host, r.block), [None] * 4)[r.place] = tuple(r)[3:]
    by_host = defaultdict(list)
    for (host, block), found in sorted(inner.items()):
        by_host[host].append((block, *found))
    out = defaultdict(list)
    for host, parts in by_host.items():
        for i, (block, first, _, last, _) in enumerate(parts):
            after = (x[1] if x[1][3] != last[3] else x[2] for x in parts[i + 1 :])
            before = (x[3] if x[3][3] != first[3] else x[4] for x in reversed(parts[:i]))
            for side in (before, after):
                if (near := next((x for x in side if x is not None), None)) is not None:
                    out[host, *near].append(block)
    return dict(out)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    blocks = min(MOST_BLOCKS, rows.select("page_id").count() // BLOCK_PAGES)
    chosen = rows.select("page_id", "url").orderBy(F.xxhash64("url", "page_id"), "url", "page_id").limit(DRAWN * blocks).collect() if blocks else []
    limits = sorted((*_address(r.url), r.page_id if r.page_id is not None else -1) for r in chosen)[DRAWN - 1 :: DRAWN]
    held = spark.sparkContext.broadcast((limits, _halo(rows, limits)))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, halo = held.value
        near = {k[:4] for k in halo}
        for batch in batches:
            sizes = pc.binary_length(batch.column(2)).fill_null(0).to_pylist()
            for begin, end in groups_of(sizes, BATCH_BYTES):
                found = []
                for page_id, url, html in zip(*(c.to_pylist() for c in batch.slice(begin, end - begin).columns)):
                    host, path = _address(url)
                    lines, kept = lines_of(html)
                    row = (page_id, url, host, path, lines, kept)
                    found.append((bisect_right(at, (host, path, -1 if page_id is None else page_id)), *row, False))
                    if (host, path, page_id, url) in near:
                        found += [(block, *row, True) for block in halo.get((host, path, page_id, url, _hash(lines)), ())]
                kinds = (pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int8()), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["block", "page_id", "url", "host", "path", "lines", "kept", "halo"])

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []

        def out() -> pa.RecordBatch:
            ids, urls, texts = zip(*done)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

        def settle(run: list[tuple], before: tuple | None, after: tuple | None) -> None:
            """Adds the pages of a run of equal lines, given the pages before and after it."""
            for own in run:
                near = [x for x in (before, after) if x is not None]
                near.sort(key=lambda x: -_common(x[4], own[4]))  # stable: the preceding page first
                if not own[7]:
                    done.append((own[1], own[2], main_text(own[5], own[6], near[0][5] if near else None)))

        before, run = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if run and (row[0], row[3]) != (run[0][0], run[0][3]):
                    settle(run, before, None)
                    before, run = None, []
                if not row[3] or not row[5]:
                    settle([row], None, None)
                elif not run or row[5] == run[0][5]:
                    run.append((*row[:5], run[0][5] if run else row[5], *row[6:]))  # equal lines are held once
                else:
                    settle(run, before, row)
                    before, run = run[-1], [row]
            if done:
                yield out()
        settle(run, before, None)
        if done:
            yield out()

    parsed = rows.mapInArrow(parse, "block int, page_id long, url string, host string, path string, lines array<string>, kept array<tinyint>, halo boolean")
    order = ["block", "host", "path", "page_id", "url"]
    return parsed.repartition("block").sortWithinPartitions(*order).mapInArrow(differ, "page_id long, url string, text string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
