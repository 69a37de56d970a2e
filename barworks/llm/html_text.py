"""Main text of web pages by structure and nearest-URL page differencing.

1. Each page is read once into blocks of text (paragraphs, headings, list items, cells
   of a row ...).  Scripts, styles, markup, comments of the markup and elements that say
   what they are (menus, page headers and footers, sidebars, notices, adverts, forms,
   reader comments: by element, role, or a word of class or id) give none.  If a page
   names its main part (``article`` or ``main``), only that part counts, and its blocks
   are sure.  The blocks of other pages are open.
2. Within each host, pages that have lines are put in order of their URL's path; a page's
   neighbour is the one of the two beside it whose path shares the longer beginning (on
   ties the one before).  Every page is compared with its neighbour, and any page serves as
   one, with all its lines, also those outside its main part.  All lines of the two are aligned
   by longest common subsequence.  Open lines that both share are the site's own and deleted;
   a sure line is if the neighbour names its main part too and has the line outside of it only:
   if that is its partner, or, where other partners come between, by an alignment of what is left
   of such lines.  Lines inside the main parts of both stay, since near copies of
   an article are neighbours, and a main part's first line, since neighbours name it in links.

Order within a host is made by a range sort of light rows (host, path, key and hashes
of lines) and positions in it, so a host may hold any share of the pages.  Only
hashes of lines meet, never pages; pages that lose nothing are not moved.

Defined cases: null html counts as empty and gives the empty text; a null URL is an own
host with an empty path; a page without a neighbour loses nothing in step 2; pages that
repeat a URL are neighbours, ordered by their place in the input's blocks; rows with the
same or null page_id are separate pages; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import batch_of, chunks, cut, rows_of

#: Bits of the table that spares pages that lose nothing a move.
SPARE_BITS = 24
#: Lines that a page has more often have a bit set of their places at hand; the others' are made when needed.
OFTEN = 16

_PIECE = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z][-\w:]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)|([a-zA-Z][-\w:]*)")
_SPACES = re.compile(r"\s+")
_WORD = re.compile(r"[a-z0-9]+")

#: Elements whose content is raw text up to their end tag.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template"}
#: Elements that never hold content.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that are not main text.
SKIP = {"nav", "footer", "aside", "form", "head", "button", "select", "dialog", "menu", "svg", "object", "canvas",
        "audio", "video", "map", "datalist", "dir", "applet"}
#: Elements that begin and end a block.
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup",
          "hr", "html", "legend", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot",
          "thead", "tr", "ul", "br", "option"}
#: Words of class and id that say an element is not main text.
SIGNS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb",
         "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "masthead",
         "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification",
         "pager", "pagination", "popup", "promo", "promotion", "promoted", "related", "replies", "respond", "share",
         "sharing", "sidebar", "sidenav", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar",
         "widget", "widgets"}
ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "alert", "alertdialog", "dialog", "menu",
         "menubar", "toolbar", "form"}
MAIN = {"article", "main"}
#: Elements that an opening tag of the same kind, or a block, closes.
_CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}


def _attributes(text: str) -> dict[str, str]:
    out = {}
    for name, value, alone in _ATTRIBUTE.findall(text):
        out.setdefault((name or alone).lower(), html.unescape(value.strip("\"'")))
    return out


def _unwanted(name: str, raw: str, in_main: bool) -> bool:
    """Whether an element says that it is not main text."""
    if name in SKIP or name == "header" and not in_main:
        return True
    if name in ("html", "body") or name in MAIN or not raw.strip():
        return False
    a = _attributes(raw)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True
    return any(w in SIGNS for w in _WORD.findall(f"{a.get('class', '')} {a.get('id', '')}".lower().replace("_", " ")))


def main_blocks(found: list[tuple[str, bool]]) -> list[tuple[str, bool]]:
    """The sure blocks, or all of a page that has none."""
    return [b for b in found if b[1]] or found


def blocks_of(page: str | None) -> list[tuple[str, bool]]:
    """The blocks of a page that may be main text, in order, each with whether it is sure."""
    return main_blocks(all_blocks(page))


def all_blocks(page: str | None) -> list[tuple[str, bool]]:
    """The text blocks of a page in order, each with whether it is sure, also those outside the main part."""
    page = page or ""
    found: list[tuple[str, bool]] = []
    words: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # element, unwanted, main
    skipped = mains = 0

    def flush():
        text = _SPACES.sub(" ", html.unescape("".join(words))).strip()
        words.clear()
        if text:
            found.append((text, mains > 0))

    def close(down_to: int):
        nonlocal skipped, mains
        while len(stack) > down_to:
            name, bad, main = stack.pop()
            if name in BLOCKS or bad:
                flush()
            skipped -= bad
            mains -= main

    at, n = 0, len(page)
    while at < n:
        m = _PIECE.search(page, at)
        if not skipped:
            words.append(page[at:m.start() if m else n])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
            else:
                if name in BLOCKS:
                    flush()
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        shut = _CLOSES.get(name) or ({"p"} if name in BLOCKS - {"br"} else None)
        if shut:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in shut:
                    close(k)
                    break
                if stack[k][0] not in ("b", "i", "em", "strong", "span", "a", "u", "small", "font", "code"):
                    break
        bad = _unwanted(name, m[3], mains > 0)
        if name in BLOCKS or bad:
            flush()
        elif name in ("td", "th"):
            words.append(" ")
        if name not in VOID and not m[3].rstrip().endswith("/"):
            main = name in MAIN and not skipped
            stack.append((name, bad, main))
            skipped += bad
            mains += main
    close(0)
    flush()
    return found


def place_of(url: str | None) -> tuple[str, str]:
    """Host and path of a URL."""
    if url is None:
        return "", ""
    m = re.match(r"(?:[a-zA-Z][-+.\w]*:)?(?://)?([^/?#]*)([^?#]*)", url.strip())
    return m[1].rsplit("@", 1)[-1].lower(), m[2]


def aligned(mine: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The place among the neighbour's lines of each line's partner in their longest common subsequence, or -1."""
    partner = np.full(len(mine), -1)
    head = 0
    while head < min(len(mine), len(other)) and mine[head] == other[head]:
        partner[head] = head
        head += 1
    tail = 0
    while tail < min(len(mine), len(other)) - head and mine[-1 - tail] == other[-1 - tail]:
        partner[len(mine) - 1 - tail] = len(other) - 1 - tail
        tail += 1
    a, b = mine[head:len(mine) - tail], other[head:len(other) - tail]
    # only lines that both have can be aligned
    ia, ib = np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a))
    a, b = a[ia].tolist(), b[ib].tolist()
    if not a:
        return partner
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    # rows of the length table as bit sets: bit j of a row is 0 where the length grows at b[j]
    often = {x: sum(1 << j for j in at) for x, at in places.items() if len(at) > OFTEN}
    full = (1 << len(b)) - 1

    def after(row: int, x: int) -> int:
        u = row & (often[x] if x in often else sum(1 << j for j in places[x]))
        return (row + u | row - u) & full

    # every step-th row is kept, and those between two of them are made again when they are walked
    step, row, kept = math.isqrt(len(a)) + 1, full, [full]
    for i, x in enumerate(a, 1):
        row = after(row, x)
        if i % step == 0:
            kept.append(row)
    length = lambda i, j: j - (rows[i - first] & ((1 << j) - 1)).bit_count()
    i, j = len(a), len(b)
    rows, first = [], i
    while i and j:
        if i == first:
            first = (i - 1) // step * step
            rows = [kept[first // step]]
            for x in a[first:i]:
                rows.append(after(rows[-1], x))
        if length(i - 1, j) == length(i, j):
            i -= 1
        elif length(i, j - 1) == length(i, j):
            j -= 1
        else:
            i, j = i - 1, j - 1
            partner[head + ia[i]] = head + ib[j]
    return partner


def kept_lines(mine: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which lines are outside the longest common subsequence with the neighbour's lines."""
    return aligned(mine, other) < 0


def lost_lines(hashes: list[int], sure: list[bool], others: list[int], others_sure: list[bool]) -> list[int]:
    """Positions, among the lines that may be main text, of those that are the site's own by the neighbour's lines.

    All lines of both pages are aligned, whatever parts they are in.  What a partner says depends on its part."""
    mine, mark = np.array(hashes, np.int64), np.array(sure, bool)
    other, other_mark = np.array(others, np.int64), np.array(others_sure, bool)
    partner = aligned(mine, other)
    if not mark.any():
        return np.flatnonzero(partner >= 0).tolist()
    # a neighbour that doesn't name its main part can't tell an article's line from the site's
    outside = ~other_mark & ~np.isin(other, other[other_mark]) & other_mark.any()
    mark_later = mark.copy()
    mark_later[mark.argmax()] = False
    gone = np.zeros(len(mine), bool)
    met = np.flatnonzero(mark_later & (partner >= 0))
    gone[met] = outside[partner[met]]
    # lines that other partners come between are aligned by themselves
    rest, free = np.flatnonzero(mark_later & (partner < 0)), outside.copy()
    free[partner[gone]] = False
    gone[rest] = ~kept_lines(mine[rest], other[free])
    return np.flatnonzero(gone[mark]).tolist()


def nearest_lines(parsed: DataFrame) -> DataFrame:
    """key, hashes, sure, others, others_sure: of each page that has a page beside it, its lines and the nearest one's."""
    light = parsed.where("size(hashes) > 0").select("key", "host", "path", "hashes", "sure")
    parts = int(parsed.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def position(batches):
        schema = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("key", pa.int64()), ("host", pa.string()),
                            ("path", pa.string()), ("hashes", pa.list_(pa.int64())), ("sure", pa.list_(pa.bool_()))])
        n = 0
        for b in batches:
            rows = list(rows_of([b]))
            yield batch_of(schema, [(TaskContext.get().partitionId(), n + i, *r) for i, r in enumerate(rows)])
            n += len(rows)

    # positions in the order of hosts and paths: within a sorted range, plus the rows of the ranges before
    ordered = cut(light.repartitionByRange(parts, "host", "path", "key").sortWithinPartitions("host", "path", "key")
                  .select("key", "host", "path", "hashes", "sure").mapInArrow(
                      position, "part int, at long, key long, host string, path string, hashes array<long>, "
                                "sure array<boolean>"))
    sizes = ordered.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # a number for each range
    before, shift = 0, []
    for r in sizes:
        shift.append((r["part"], before))
        before += r["n"]
    shifts = parsed.sparkSession.createDataFrame(shift or [(0, 0)], "part int, before long")
    placed = ordered.join(F.broadcast(shifts), "part").select(
        (F.col("at") + F.col("before")).alias("at"), "key", "host", "path", "hashes", "sure")
    asking = placed.select(F.explode(F.array(F.col("at") - 1, F.col("at") + 1)).alias("at"), "key", "host", "path")
    met = asking.join(
        placed.select("at", F.col("host").alias("h"), F.col("path").alias("p"),
                      F.struct("hashes", "sure").alias("others")), "at").where("host = h")

    def shared_start(a: str, b: str) -> F.Column:
        same = F.transform(F.sequence(F.lit(1), F.least(F.length(a), F.length(b)) + 1),
                           lambda i: F.substring(F.col(a), F.lit(1), i) == F.substring(F.col(b), F.lit(1), i))
        return F.when(F.least(F.length(a), F.length(b)) == 0, 0).otherwise(F.size(F.filter(same, lambda x: x)))

    best = (met.withColumn("alike", shared_start("path", "p")).groupBy("key")
            .agg(F.max(F.struct("alike", -F.col("at"), "others"))["others"].alias("others")))
    return light.join(best, "key").select("key", "hashes", "sure", F.col("others.hashes").alias("others"),
                                          F.col("others.sure").alias("others_sure"))


def lost(nearest: DataFrame) -> DataFrame:
    """key, gone: the positions of the lines that a page loses, of each page that loses any."""

    def compare(batches):
        schema = pa.schema([("key", pa.int64()), ("gone", pa.list_(pa.int32()))])
        for b in batches:
            found = ((key, lost_lines(*rest)) for key, *rest in rows_of([b]))
            yield batch_of(schema, [(key, gone) for key, gone in found if gone])

    return nearest.mapInArrow(compare, "key long, gone array<int>")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_deleted per row of ``pages`` (page_id, url, html)."""

    def parse(batches):
        schema = pa.schema([("key", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()),
                            ("path", pa.string()), ("lines", pa.list_(pa.string())), ("hashes", pa.list_(pa.int64())),
                            ("sure", pa.list_(pa.bool_()))])
        part, n = TaskContext.get().partitionId() << 40, 0
        for rows in chunks(batches, text_at=2, limit=4 << 20):
            out = []
            for page_id, url, page in rows:
                blocks = all_blocks(page)
                lines = [t for t, _ in main_blocks(blocks)]
                hashes = [xxhash.xxh3_64_intdigest(t.encode()) - (1 << 63) for t, _ in blocks]
                out.append((part | n, page_id, url, *place_of(url), lines, hashes, [s for _, s in blocks]))
                n += 1
            yield batch_of(schema, out)

    parsed = cut(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        parse, "key long, page_id long, url string, host string, path string, lines array<string>, "
               "hashes array<long>, sure array<boolean>"))
    gone = cut(lost(nearest_lines(parsed)))
    cell = F.pmod(F.xxhash64("key"), F.lit(1 << SPARE_BITS)) + 1
    bits = np.zeros(1 << SPARE_BITS, bool)
    for r in (gone.select(cell.alias("cell")).groupBy(F.bitmap_bucket_number("cell").alias("slice"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).collect()):
        at = (r["slice"] - 1) << 15
        bits[at:at + (1 << 15)] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
    some = bool(bits.any())
    shared = pages.sparkSession.sparkContext.broadcast(np.packbits(bits))  # SPARE_BITS fix its size

    def of_kind(losing: bool):
        def pick(batches):
            for b in batches:
                at = b.column(b.num_columns - 1).to_numpy() - 1
                marked = (shared.value[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)
                yield b.filter(pa.array(marked == losing)).select(["key", "page_id", "url", "lines"])
        return pick

    def finish(batches):
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()),
                            ("n_chars", pa.int64()), ("n_deleted", pa.int64())])
        for b in batches:
            out = []
            for _, page_id, url, lines, *gone in rows_of([b]):
                away = set(gone[0] or ()) if gone else ()
                text = "\n".join(t for i, t in enumerate(lines) if i not in away)
                out.append((page_id, url, text, len(text), len(away)))
            yield batch_of(schema, out)

    result = "page_id long, url string, text string, n_chars long, n_deleted long"
    texts = parsed.select("key", "page_id", "url", "lines", cell.alias("cell"))
    stay = texts.mapInArrow(lambda batches: finish(of_kind(False)(batches)), result)
    if not some:
        return stay
    moved = texts.mapInArrow(of_kind(True), "key long, page_id long, url string, lines array<string>")
    return stay.unionByName(moved.join(gone, "key", "left").mapInArrow(finish, result))
