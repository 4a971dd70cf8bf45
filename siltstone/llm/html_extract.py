"""Main text of pages by nearest-URL differencing, with the markup where differencing can't tell.

A page is read into visible blocks with one pass over its tags; references are decoded, runs of white
space (as ``str.split`` knows it, so no-break spaces too) become one space. Pages of a host are ordered by
path, and the blocks of every page are aligned with those of its nearest pages, before and after, by
longest common subsequence. Neighbours that are nearly the same page tell nothing: pages in path order
each of which holds nearly all text of the next, or the other way round, are a run of copies, and the
pages beyond the run are asked.

An aligned block is deleted
* in a page whose markup names no main text: always;
* in a page with an article (or else a main element, or else a body of an article by its class): if in
  differencing TEMPLATE of the host's pages, of PAGES at least, it is aligned. Articles may share
  passages, and what only some pages share is not the template's.
Blocks that can't be aligned, as menus and adverts may turn from page to page, are judged by the markup alone: what is
in elements that are menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
comments or hidden, by tag, role, class or id, or outside of the main text if there is one, goes. A class or id counts
as a whole: beside a word of such things it may have words of shape and place alone. An element that is named
as the main text isn't it if it holds less than TEASER of the page's text.

Pages are ordered by a range partitioning, so a host may lie in many partitions. A partition needs two
pages of others, those beyond the runs at its ends; each gives its outermost four for that.

Defined cases: null or empty html has no text; a page whose host has no other page keeps its blocks;
a null url has the empty host; repeated rows are extracted each (a copy tells nothing); an empty
table gives no rows; long pages are read and aligned whole; other columns are not touched.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import far, near, parquet, ship, written
from .url_filter import host, path

TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?|<[!?/][^>]*>?", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|style|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>]|\Z)", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Fixed lists of tag names and of words of classes, ids and roles.
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript template".split())
NO_TEXT = set("nav footer aside form button select datalist dialog menu svg canvas object audio video map head label input applet".split())
NO_WORDS = set("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion sidebar aside menu nav navbar navigation breadcrumb breadcrumbs masthead topbar header footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup signin login comment comments disqus discussion replies reply respond social share sharing related recommended recommendations widget toolbar pagination pager copyright search paywall".split())
#: Words that say what shape or place an element has, and not what is in it.
SHAPES = set("area bar block body bottom box btn button buttons card cell center col column container content desktop feed global grid group icon icons id inner item items js label large layout left link links list main mobile module outer page panel placeholder position post posts primary right row secondary section site slot small story stories sticky tab title top unit view wrap wrapper zone".split())
NO_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NAMED = [{"article", "body"}, {"article", "content"}, {"article", "text"}, {"entry", "content"}, {"post", "content"}, {"post", "body"}, {"story", "body"}, {"main", "content"}]
# Elements that the end of an inline element doesn't end; elements that the next of their name ends.
WALLS = set("article main body table td th section aside nav header footer".split())
#: Elements of running text; in an article their class says little.
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre li".split())
IMPLIED = set("p li dd dt td th tr option".split())
ARTICLE, MAIN, NAME = 4, 2, 1  # bits: what an element is in may be named in several ways
#: A main text that the markup names has this share at least of the page's text that isn't left out; with less it is a teaser.
TEASER = 0.25
#: A page that is aligned with this share of the blocks of another that aren't left out is a copy of it.
COPY = 0.95
#: A block is the template's if it is aligned in this share of a host's pages, which are so many at least.
TEMPLATE, PAGES = 0.8, 10
#: Bits of an alignment that are held at once; a larger one is halved first.
HELD_BITS = 1 << 28


def _unwanted(one: str, words: set[str], in_article: bool, whole: bool) -> bool:
    """Whether a class or id is of what isn't main text: one of NO_WORDS, or (unless ``whole``) such words with words of shape and numbers alone, as in social-share-box; social-science isn't."""
    bad = words & NO_WORDS
    if not bad or in_article and bad == {"header"}:
        return False
    return one.lower() in NO_WORDS or not whole and all(w in NO_WORDS or w in SHAPES or w.isdigit() or len(w) == 1 for w in words)


def _kind(name: str, attributes: str, in_article: bool) -> tuple[bool, int]:
    """(left out, names of main text that it opens)."""
    level = ARTICLE if name == "article" else MAIN if name == "main" else 0
    out = name in NO_TEXT or name == "header" and not in_article
    if attributes and not attributes.isspace():
        for a, *values in ATTRIBUTE.findall(attributes):
            a, value = a.lower(), entities.unescape("".join(values))
            if a in ("class", "id"):
                for one in value.split():
                    words = {w.lower() for w in WORDS.findall(one)}
                    if name not in ("html", "body", "main") and _unwanted(one, words, in_article, in_article and name in PROSE):
                        out = True
                    if any(n <= words for n in NAMED):
                        level |= NAME
            elif a == "role":
                out |= value.lower() in NO_ROLES
                level |= ARTICLE if value.lower() == "article" else MAIN if value.lower() == "main" else 0
            elif a == "itemprop":
                level |= MAIN if value == "articleBody" else 0
            elif a == "style":
                out |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            elif a == "hidden" or value.lower() == "true":
                out = True
    return out, level


def _above(stack: list[tuple[str, bool, int]], name: str):
    """The open elements above the last one of this name."""
    for one in reversed(stack):
        if one[0] == name:
            return
        yield one


def blocks(page: str | None) -> list[tuple[str, bool, int]]:
    """(text, left out, names of main text around it) of each block with text, in order."""
    page = page or ""
    found: list[tuple[str, bool, int]] = []
    stack: list[tuple[str, bool, int]] = []
    open_: dict[str, int] = {}
    text: list[str] = []
    out, level, at = False, 0, 0

    def flush() -> None:
        if text:
            line = " ".join(entities.unescape("".join(text)).split())
            if line:
                found.append((line, out, level))
            text.clear()

    def pop(name: str) -> None:
        nonlocal out, level
        to, was = (out, level), ""
        while was != name:
            was, *to = stack.pop()
            open_[was] -= 1
        if tuple(to) != (out, level):
            flush()
        out, level = to

    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            break
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        if page[at - 1] != ">":  # a quote that is never closed
            at = page.find(">", at) + 1 or len(page)
        name = m[2].lower()
        if name in BLOCKS or name in NO_TEXT:
            flush()
        elif name == "br":
            text.append(" ")
        if m[1]:
            if open_.get(name) and (name in BLOCKS or all(was not in WALLS for was, _, _ in _above(stack, name))):
                pop(name)
        elif name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>]|\\Z)[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID:
            if stack and (stack[-1][0] == "p" and name in BLOCKS or stack[-1][0] == name and name in IMPLIED):
                pop(stack[-1][0])
            left, opens = _kind(name, m[3], bool(level & ARTICLE))
            # other inline elements change nothing; those of a name that is open must be counted
            if name in BLOCKS or left or opens or open_.get(name):
                if left > out or opens & ~level:
                    flush()
                stack.append((name, out, level))
                open_[name] = open_.get(name, 0) + 1
                out, level = out or left, level | opens
    if at < len(page):
        text.append(page[at:])
    flush()
    return found


def chosen(page: list[tuple[str, bool, int]]) -> tuple[list[int], bool]:
    """Which blocks are the main text, and whether the markup says so: the most certain name whose text isn't a teaser."""
    whole = sum(len(text) for text, out, _ in page if not out)
    for level in (ARTICLE, MAIN, NAME):
        named = [i for i, (_, out, at) in enumerate(page) if not out and at & level]
        if named and sum(len(page[i][0]) for i in named) >= TEASER * whole:
            return named, True
    return [i for i, (_, out, _) in enumerate(page) if not out], False


def _heights(a: list, b: list):
    """For each line of a, the lengths of the longest common subsequences up to it: a number whose bit j is 0 where line j of b makes one longer."""
    where: dict = {}
    for j, line in enumerate(b):
        where[line] = where.get(line, 0) | 1 << j
    full = now = (1 << len(b)) - 1
    for line in a:
        met = now & where.get(line, 0)
        now = (now + met | now - met) & full
        yield now


def _longer(a: list, b: list) -> np.ndarray:
    """The length of the longest common subsequence of a and the first j lines of b, for each j."""
    last = (1 << len(b)) - 1
    for last in _heights(a, b):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(last.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _common(a: list, b: list) -> list[int]:
    """Places in a of a longest common subsequence of a and b, bit-parallel over b."""
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > HELD_BITS:
        half = len(a) // 2
        cut = int((_longer(a[:half], b) + _longer(a[:half - 1 if half else None:-1], b[::-1])[::-1]).argmax())
        return _common(a[:half], b[:cut]) + [half + i for i in _common(a[half:], b[cut:])]
    rows, found, i, j = [(1 << len(b)) - 1, *_heights(a, b)], [], len(a), len(b)
    while i and j:
        if rows[i] >> j - 1 & 1:
            j -= 1
        else:
            i -= 1
            if rows[i] >> j - 1 & 1:
                found.append(i)
                j -= 1
    return found[::-1]


def aligned(a: list, b: list) -> list[int]:
    """Places in a of a longest common subsequence of a and b."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    inner, other = range(head, len(a) - tail), b[head : len(b) - tail]
    both = {a[i] for i in inner}.intersection(other)
    inner = [i for i in inner if a[i] in both]
    middle = _common([a[i] for i in inner], [x for x in other if x in both])
    return [*range(head), *(inner[i] for i in middle), *range(len(a) - tail, len(a))]


def shared(lines: list, kept: list[int], other: list) -> set[int] | None:
    """The kept blocks that are aligned with the other page's; none when that is a copy, or has no blocks."""
    if not other or lines == other:
        return None
    found = set(aligned(lines, other)).intersection(kept)
    return found if len(found) < COPY * len(kept) else None


def copies(a: tuple[str, list, list], b: tuple[str, list, list]) -> bool:
    """Whether two pages (host, lines, kept) of a host are in one run."""
    return a[0] == b[0] and (shared(a[1], a[2], b[1]) is None or shared(b[1], b[2], a[1]) is None)


def _digest(x: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(x) - (1 << 63)


def _read(batches):
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            texts, plain, kept, marks = [], [], [], []
            for page in batch.column(4).to_pylist():
                got = blocks(page)
                keep, sure = chosen(got)
                texts.append([got[i][0] for i in keep])
                plain.append(not sure)
                kept.append(keep)
                marks.append([_digest(t) for t, _, _ in got])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(texts, pa.list_(pa.string())), pa.array(plain), pa.array(kept, pa.list_(pa.int32())), pa.array(marks, pa.list_(pa.int64()))],
                                             names=["id", "url", "host", "path", "texts", "plain", "kept", "marks"])


def _in_order(pages: pa.Table) -> tuple[list[tuple], list[int]]:
    """(host, lines, kept) of the pages of a partition in order, and the run of each."""
    pages = pages.sort_by("at")
    rows = list(zip(*(pages[c].to_pylist() for c in ("host", "marks", "kept")), strict=True))
    runs = [0] * len(rows)
    for i in range(1, len(rows)):
        runs[i] = runs[i - 1] + (rows[i] != rows[i - 1] and not copies(rows[i - 1], rows[i]))
    return rows, runs


PAGE = [("host", pa.string()), ("marks", pa.list_(pa.int64())), ("kept", pa.list_(pa.int32()))]
ENDS = pa.schema([("part", pa.int32()), ("kind", pa.string()), ("runs", pa.int32()), *PAGE])
GONE = pa.schema([("row", pa.int64()), ("host", pa.string()), ("asked", pa.bool_()), ("places", pa.list_(pa.int32())), ("lines", pa.list_(pa.int64()))])
PAGE_SQL = "host string, marks array<bigint>, kept array<int>"


def _ends(pages: pa.Table) -> pa.Table:
    """The outermost pages of a partition, and those beyond its outermost runs."""
    part = pages["part"][0].as_py()
    rows, runs = _in_order(pages)
    at = {"first": 0, "last": len(rows) - 1}
    if runs[-1]:
        at |= {"after": runs.index(1), "before": len(rows) - 1 - runs[::-1].index(runs[-1] - 1)}
    return pa.Table.from_pylist([dict(zip(ENDS.names, (part, kind, runs[-1] + 1, *rows[i]), strict=True)) for kind, i in at.items()], schema=ENDS)


def _joined(batches):
    """(part, joined): whether the run at the end of a partition goes on in the next. Batches: part, and the two pages."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([copies(x[:3], x[3:]) for x in zip(*columns[1:], strict=True)], pa.bool_())], names=["part", "joined"])


def beyond(parts: dict[int, int], joined: dict[int, bool]) -> list[tuple[int, str, int, str]]:
    """(partition, side, partition and kind of the page beyond its outermost run on that side). parts: their numbers of runs."""
    order, found = sorted(parts), []
    for side, step, near_end, far_end in (("right", 1, "first", "after"), ("left", -1, "last", "before")):
        known: dict[int, tuple[int, str] | None] = {}
        for i in range(len(order))[::-step]:
            j = i + step
            if not 0 <= j < len(order):
                known[i] = None
            elif not joined.get(order[min(i, j)], False):
                known[i] = order[j], near_end
            else:
                known[i] = (order[j], far_end) if parts[order[j]] > 1 else known[j]
            if known[i]:
                found.append((order[i], side, *known[i]))
    return found


def _within(key, pages: pa.Table, outside: pa.Table) -> pa.Table:
    """The kept blocks of each page that are aligned with the pages beside its run."""
    rows, runs = _in_order(pages)
    ids = pages.sort_by("at")["row"].to_pylist()
    others = {r["side"]: (r["host"], r["marks"], r["kept"]) for r in outside.to_pylist()}
    first = {r: i for i, r in reversed(list(enumerate(runs)))}
    last = {r: i for i, r in enumerate(runs)}
    out, before, got = [], None, None
    for i, (host, lines, kept) in enumerate(rows):
        if (runs[i], rows[i]) != before:
            before = runs[i], rows[i]
            beside = (rows[last[runs[i] - 1]] if runs[i] else others.get("left"), rows[first[runs[i] + 1]] if runs[i] < runs[-1] else others.get("right"))
            found = [x for x in (shared(lines, kept, o[1]) for o in beside if o and o[0] == host) if x is not None]
            got = bool(found), sorted(set().union(*found))
        out.append((ids[i], host, got[0], got[1], [lines[k] for k in got[1]]))
    return pa.Table.from_pylist([dict(zip(GONE.names, r, strict=True)) for r in out], schema=GONE)


def differenced(read: DataFrame) -> DataFrame:
    """(row, host, asked, places, lines) of each page (row, host, path, id, url, marks, kept) with text: the kept blocks that are aligned with its nearest pages that aren't copies, and their hashes; asked: whether it has one."""
    order = ["host", "path", "id", "url", "marks"]
    pages = read.where("size(kept) > 0").select("row", *order, "kept")
    placed = written(pages.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}).drop("path", "id", "url"))
    ends = written(placed.groupBy("part").applyInArrow(_ends, f"part int, kind string, runs int, {PAGE_SQL}"))
    parts = {r.part: r.runs for r in ends.where("kind = 'first'").select("part", "runs").collect()}  # a number for each partition
    following = read.sparkSession.createDataFrame(list(zip(sorted(parts), sorted(parts)[1:], strict=False)), "part int, next int")
    page = ["host", "marks", "kept"]
    pair = ends.where("kind = 'last'").select("part", *page).join(following, "part").join(ends.where("kind = 'first'").select(F.col("part").alias("next"), *[F.col(c).alias(f"{c}2") for c in page]), "next")
    joined = {r.part: r.joined for r in pair.select("part", *page, *[f"{c}2" for c in page]).mapInArrow(_joined, "part int, joined boolean").collect()}
    where = read.sparkSession.createDataFrame(beyond(parts, joined), "to int, side string, part int, kind string")
    outside = where.join(ends, ["part", "kind"]).select(F.col("to").alias("part"), "side", *page)
    return written(placed.groupBy("part").cogroup(outside.groupBy("part")).applyInArrow(_within, "row bigint, host string, asked boolean, places array<int>, lines array<bigint>"))


def deleted(read: DataFrame, found: DataFrame, share: float = TEMPLATE, least: int = PAGES) -> DataFrame:
    """(row, places): the blocks that go."""
    asked = found.where("asked").groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least)
    each = found.where("size(places) > 0").select("row", "host", F.explode(F.arrays_zip("places", "lines")).alias("x")).select("row", "host", "x.places", "x.lines")
    votes = found.select("host", F.explode(F.array_distinct("lines")).alias("lines")).groupBy("host", "lines").agg(F.count(F.lit(1)).alias("n"))
    template = written(votes.join(asked, "host").where(F.col("n") >= share * F.col("pages")).select("host", "lines"))
    plain = read.where("plain and size(kept) > 0").select("row")
    gone = each.join(plain, "row", "left_semi").select("row", "places").unionByName(near(each, [F.col("host"), F.col("lines")], template, ["host", "lines"]).join(template, ["host", "lines"], "left_semi").select("row", "places"))
    return gone.groupBy("row").agg(F.collect_set("places").alias("gone"))  # of one page


def _texts(batches):
    for batch in batches:
        texts = []
        for lines, kept, gone in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
            out = set(gone or ())
            texts.append("\n".join(t for t, i in zip(lines, kept, strict=True) if i not in out))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text, n_chars."""
    ship(pages.sparkSession)
    raw = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"), F.col(html_col).alias("html"))
    read = raw.mapInArrow(_read, "id bigint, url string, host string, path string, texts array<string>, plain boolean, kept array<int>, marks array<bigint>")
    read = written(read.withColumn("row", F.monotonically_increasing_id()))
    gone = written(deleted(read, differenced(read)))
    page = read.select("id", "url", "texts", "kept", "row")
    # only pages that lose a block meet the list of blocks that go
    changed = near(page, [F.col("row")], gone, ["row"]).join(gone.hint("merge"), "row", "left")
    same = far(page, [F.col("row")], gone, ["row"]).withColumn("gone", F.lit(None).cast("array<int>"))
    text = changed.select("id", "url", "texts", "kept", "gone").unionByName(same.select("id", "url", "texts", "kept", "gone")).mapInArrow(_texts, "id bigint, url string, text string")
    return text.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("bigint").alias("n_chars"))


def op6_page_differencing(spark, sf_dir: str) -> DataFrame:
    return main_text(parquet(spark, sf_dir, "pages"))


#: Of pages like those of the tables: what is between the tags of their article, with the references that they use.
OP6_SQL = r"""
with a as (select page_id, url, split_part(split_part(substring(html, nullif(instr(html, '<article>'), 0) + 9), '</article>', 1), '<footer>', 1) as x from pages),
b as (select page_id, url, list_transform(regexp_split_to_array(replace(regexp_replace(coalesce(x, ''), '(?s)<!--.*?-->', '', 'g'), '<br>', ' '), '</?(?:p|h1)>'), lambda l: regexp_replace(l, '<[^>]*>', '', 'g')) as lines from a),
c as (select page_id, url, list_transform(lines, lambda l: replace(replace(replace(replace(l, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) as lines from b),
d as (select page_id, url, array_to_string(list_filter(list_transform(lines, lambda l: trim(regexp_replace(l, '[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))), lambda l: l <> ''), chr(10)) as text from c)
select page_id, url, text, length(text) as n_chars from d
"""
