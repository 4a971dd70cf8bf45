import html
import random
import re
import time
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from siltstone.llm import html_extract
from siltstone.llm.html_extract import aligned, beyond, blocks, chosen, differenced, main_text, op6_page_differencing


def text(page):
    got = blocks(page)
    return "\n".join(got[i][0] for i in chosen(got)[0])


def test_structure():
    page = """<!DOCTYPE html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="no-sidebar">
    <header><h1>Site</h1></header><nav><ul><li>A<li>B</ul></nav><div class="cookie-notice">We use <b>cookies</b></div>
    <div class=ad>Buy</div><article><header><h1>Head &amp; title</h1></header><p>One <b>two</b><br>three&nbsp;four<p>Five <span class="ad">ad <span>x</span> y</span>six
    <!-- no > --><form><input><label>Mail</label></form><aside>Side</aside><pre> a\n  b </pre><p class="share">S<p>1 < 2 &lt;b&gt; &copy x<ul><li>i<li>j</ul></article>
    <section id="comments"><article class="comment"><p>Reader</p></article></section><footer>End</footer>"""
    assert text(page) == "Head & title\nOne two three four\nFive\nsix\na b\n1 < 2 <b> © x\ni\nj"


def test_breaks_and_levels():
    assert text("<main><p>a</main><p>b") == "a"
    assert text("<div class='entry-content'>a<div class=related-posts>r</div></div>b") == "a"
    assert text("<p>a<p hidden>b<p style='display: none'>c<p aria-hidden=true>d") == "a"
    assert text("<b><article><p>a</b><p>b</article>c") == "a\nb"
    assert text("<article>cut in a <a href='x") == "cut in a"
    assert text(None) == text("") == text("<script>x") == ""
    assert text("x <!-- y") == "x"
    assert len(text("<article>" + "<p>word" * 20_000)) == 20_000 * 5 - 1


def test_classes_count_as_a_whole():
    inside = "<p class='social-science'>a</p><div class='ad-free-note'>b</div><p class='comment-on-law'>c</p><div class='no-sidebar'>d</div><h2 class='related-work'>e</h2>"
    assert text(f"<article>{inside}</article>") == "a\nb\nc\nd\ne"
    outside = "".join(f"<div class='{c}'>x</div>" for c in ("social-share", "share_buttons", "ad-300x250", "adSlot", "cookie-notice", "related-posts", "commentList"))
    assert text(f"<div>kept<div class='site-header'>x</div>{outside}</div>") == "kept" and text(f"<article>kept{outside}</article>") == "kept"


def test_teasers_are_not_the_text():
    long = "<p>" + "the whole story " * 30 + "</p>"
    assert text(f"<div class='content'>{long}</div><article><p>Read also</p></article>").startswith("the whole story")
    assert text(f"<main>{long}</main><article><p>Read also</p></article>") == ("the whole story " * 30).strip()
    assert text(f"<article>{long}</article><p>outside</p>") == ("the whole story " * 30).strip()


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("held", [1 << 28, 4])
def test_alignment_is_longest(monkeypatch, held):
    monkeypatch.setattr(html_extract, "HELD_BITS", held)
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        got = aligned(a, b)
        assert got == sorted(set(got)) and len(got) == lcs(a, b)
        rest = iter(b)
        assert all(any(a[i] == y for y in rest) for i in got)


def test_alignment_of_repeated_lines_is_quick():
    rng = random.Random(2)
    a, b = ([rng.randrange(2) for _ in range(n)] for n in (8000, 12000))
    start = time.monotonic()
    assert len(aligned(a, b)) > 6500 and time.monotonic() - start < 5


def test_pages_beyond_runs():
    """Partitions 1 to 5; 2 to 4 are one run, which 1 ends with and 5 begins with."""
    got = {(a, side): (b, kind) for a, side, b, kind in beyond({1: 3, 2: 1, 3: 1, 4: 1, 5: 2}, {1: True, 2: True, 3: True, 4: True})}
    assert got == {**{(k, "right"): (5, "after") for k in (1, 2, 3, 4)}, **{(k, "left"): (1, "before") for k in (2, 3, 4, 5)}}
    got = {(a, side): (b, kind) for a, side, b, kind in beyond({1: 1, 4: 1, 9: 1}, {1: True})}
    assert got == {(1, "right"): (9, "first"), (4, "right"): (9, "first"), (9, "left"): (4, "last")}
    assert beyond({}, {}) == []


def test_template_inside_of_articles(spark):
    """What nearly all pages of a host have in their articles goes; passages that some articles share stay."""
    def page(i, extra=""):
        return f"<nav>m{i}</nav><article><p>Read more of us</p><p>own {i}</p>{extra}<p>further {i}</p></article>"

    rows = [(i, f"http://h.com/{i:03d}", page(i, "<p>a passage</p>" * (i // 4 % 2))) for i in range(40)]
    rows += [(100 + i, f"http://few.com/{i}", page(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in main_text(df).collect()}
    assert all(got[i] == f"own {i}\n" + "a passage\n" * (i // 4 % 2) + f"further {i}" for i in range(40))
    assert all(got[100 + i] == f"Read more of us\nown {i}\nfurther {i}" for i in range(5))


def test_every_page_is_differenced(spark):
    d = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{d}/pages.parquet")
    raw = pages.selectExpr("page_id as id", "url", "html").withColumns({"host": html_extract.host(F.col("url")), "path": html_extract.path(F.col("url"))})
    read = html_extract.written(raw.select("id", "url", "host", "path", "html").mapInArrow(html_extract._read, "id bigint, url string, host string, path string, texts array<string>, plain boolean, kept array<int>, marks array<bigint>").withColumn("row", F.monotonically_increasing_id()))
    got = {r.row: r for r in differenced(read).collect()}
    rows = sorted((r.asDict() for r in read.collect()), key=lambda r: (r["host"], r["path"], r["id"]))
    alone = Counter(r["host"] for r in rows)
    runs = [0]
    for a, b in zip(rows, rows[1:]):
        same = a["host"] == b["host"] and any(len(set(aligned(x["marks"], y["marks"])) & set(x["kept"])) >= 0.95 * len(x["kept"]) for x, y in ((a, b), (b, a)))
        runs.append(runs[-1] + (not same))
    for i, r in enumerate(rows):
        beside = [next((rows[j] for j in order if runs[j] != runs[i]), None) for order in (range(i, -1, -1), range(i, len(rows)))]
        want = set()
        for other in beside:
            if other and other["host"] == r["host"]:
                found = set(aligned(r["marks"], other["marks"])) & set(r["kept"])
                want |= found if len(found) < 0.95 * len(r["kept"]) else set()
        assert set(got[r["row"]].places) == want
        assert got[r["row"]].asked or alone[r["host"]] == 1 or len({runs[k] for k, x in enumerate(rows) if x["host"] == r["host"]}) == 1


def plain(n, body, host="h.com", path=None):
    return n, f"http://{host}/{path or f'{n:03d}'}", f"<div>Welcome</div><p>Top</p>{body}<p>Bottom line</p>"


def test_differencing(spark):
    rows = [plain(i, "".join(f"<p>own {i} {k}</p>" for k in range(4))) for i in range(40)]
    rows += [plain(50, "<p>alone</p>", "other.com"), plain(60, "<p>c</p>" * 20, "two.com", "a"), plain(61, "<p>c</p>" * 20, "two.com", "b"), (70, None, None), (71, None, "<p>x</p>"), (72, "http://h.com/", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4).selectExpr("*", "1 as text", "2 as host")
    got = {r.page_id: r for r in main_text(df).collect()}
    assert len(got) == len(rows)
    for i in range(40):
        assert got[i].text == "\n".join(f"own {i} {k}" for k in range(4)), i
    assert got[50].text == "Welcome\nTop\nalone\nBottom line"
    assert got[60].text.count("c\n") == 20 and got[60].url == "http://two.com/a"  # copies tell nothing
    assert (got[70].text, got[71].text, got[72].text) == ("", "x", "")
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert main_text(df.limit(0)).count() == 0


def test_menus_and_runs_of_copies(spark):
    menu = "<nav>" + "".join(f"<li>menu {k}</li>" for k in range(60)) + "</nav>"
    rows = []
    for i in range(40):
        n, url, page = plain(i, "".join(f"<p>own {i} {k}</p>" for k in range(6)))
        rows.append((n, url, menu + page))
    for i in range(100, 130):  # one run of copies, longer than a partition
        rows.append((i, f"http://runs.com/b{i}", plain(i, "<p>same</p><p>text</p>")[2]))
    rows += [(99, "http://runs.com/a", plain(99, "<p>first</p>")[2]), (131, "http://runs.com/c", plain(131, "<p>last</p>")[2])]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.page_id: r.text for r in main_text(df).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(rows)
    assert all(got[i] == "\n".join(f"own {i} {k}" for k in range(6)) for i in range(40))
    assert {got[i] for i in range(100, 130)} == {"same\ntext"} and (got[99], got[131]) == ("first", "last")


def test_query_differences_unmarked_pages(spark, tmp_path):
    """A table whose boilerplate no markup names, through the query: what a page's nearest others have in the same order goes, by a plain longest common subsequence."""
    rng = random.Random(5)
    words = [f"word{i}" for i in range(400)]
    rows = []
    for i in range(120):
        host, k = f"host{i % 3}.com", i // 3
        own = [" ".join(rng.choices(words, k=8)) for _ in range(rng.randrange(3, 9))]
        frame = [f"Welcome to {host}", "All topics and more", *[f"Topic {t}" for t in range(rng.randrange(2, 5))]], ["Terms of use", f"Contact {host}"]
        rows.append((i, f"http://{host}/a/{k:04d}", "".join(f"<div>{x}</div>" for x in [*frame[0], *own, *frame[1]]), own))
    spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string").repartition(3).write.parquet(f"file://{tmp_path}/pages.parquet")
    got = {r.page_id: r.text for r in op6_page_differencing(spark, f"file://{tmp_path}").collect()}
    assert len(got) == len(rows)
    lost = 0
    for host in range(3):
        pages = [r for r in rows if r[0] % 3 == host]
        lines = [re.findall("<div>(.*?)</div>", r[2]) for r in pages]
        for n, (r, mine) in enumerate(zip(pages, lines, strict=True)):
            gone = {x for m in (n - 1, n + 1) if 0 <= m < len(pages) for x in common_lines(mine, lines[m])}
            assert got[r[0]] == "\n".join(x for x in mine if x not in gone) == "\n".join(r[3] if not any(x.startswith("Topic") and x not in gone for x in mine) else [x for x in mine if x not in gone])
            lost += len(gone)
    assert lost > 500


def common_lines(a, b):
    """A longest common subsequence, by the table of lengths; lines of a page differ from one another here, so it is one of lines."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    out = []
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append(a[i])
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def brute(page):
    """Of pages like those of the test tables: what is between the tags of their article."""
    inside = page.partition("<article>")[2].partition("</article>")[0].partition("<footer>")[0]
    lines = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", re.sub("(?s)<!--.*?-->", "", inside))]
    return "\n".join(x for x in lines if x)


def test_query_brute(spark):
    d = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in op6_page_differencing(spark, d).collect()}
    pages = pq.read_table(f"{d}/pages.parquet").to_pylist()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p["page_id"]].text == brute(p["html"])
