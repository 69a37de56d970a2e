"""Main-text extraction: structure, differencing, alignment."""

import random
import tracemalloc

import numpy as np
import pytest

from barworks.llm import html_text as H
from barworks.llm import queries as Q

from helpers import CLASHES, SF
from pyspark.sql import functions as F


def lines(page):
    return [t for t, _ in H.blocks_of(page)]


@pytest.mark.parametrize("page,want", [
    (None, []), ("", []), ("plain  text\n here", ["plain text here"]), ("<p>a<p>b", ["a", "b"]),
    ("<article><h1>T &amp; t</h1><p>one <b>two</b>\n three</p></article><footer>f</footer>", ["T & t", "one two three"]),
    ("<nav><p>x</nav><div class='ad'>buy</div><p>kept</p><aside>s</aside>", ["kept"]),
    ("<header>site</header><main><header><h1>Title</h1></header><p>x</p><form>no<input></form></main><p>out</p>", ["Title", "x"]),
    ("<script>var t='</p>';</script><style>p{}</style><p>x</p><!-- c <p>y</p> -->", ["x"]),
    ("<p>a<br>b</p>", ["a", "b"]), ("<ul><li>a<li>b</ul>", ["a", "b"]), ("<p>&eacute;&#233;&#x1F600;&nbsp;z</p>", ["éé\U0001F600 z"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a b", "c"]), ("<div id='comments'><p>c</p></div><p>x", ["x"]),
    ("<div role=navigation>n</div><div hidden>h</div><div style='display: none'>d</div>x", ["x"]),
    ("<article>a<div class='cookie-notice'>c</div><div class='adventure'>ok</div></article>", ["a", "ok"]),
    ("a < b and 1<2", ["a < b and 1<2"]), ("<p title='a>b'>x</p>", ["x"]), ("<p>open <script>never closed", ["open"]),
    ("<title>t</title><body>x</body>", ["x"]), ("<nav>never closed<p>x", []), ("x</div></p>y", ["x", "y"]),
])
def test_blocks(page, want):
    assert lines(page) == want


def test_lcs_keeps_as_few_lines_as_a_table():
    random.seed(2)
    for _ in range(300):
        a = [random.randint(0, 6) for _ in range(random.randint(0, 12))]
        b = [random.randint(0, 6) for _ in range(random.randint(0, 12))]
        keep = H.kept_lines(np.array(a, np.int64), np.array(b, np.int64))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert (~keep).sum() == t[-1][-1]
        gone = iter(b)
        assert all(x in gone for x, k in zip(a, keep) if not k)  # what goes is a subsequence of the neighbour


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.select("*", *(F.lit(None).cast("string").alias(c) for c in CLASHES))


def test_differencing(spark):
    shell = "<div>Home</div><div>About us</div><p>{}</p><div>Contact</div>"
    rows = [(i, f"http://a.example/x/{i:03d}", shell.format(f"story {i}")) for i in range(60)]
    rows += [(100, "http://b.example/only", shell.format("alone")), (101, None, "<p>no url</p>"), (None, "http://c.example/", None),
             (102, "http://d.example/1", "<article><p>same</p></article>"), (103, "http://d.example/2", "<article><p>same</p></article>"),
             (104, "http://e.example/n?x=1", shell.format("dup")), (104, "http://e.example/n?x=2", shell.format("dup"))]
    got = {(r["page_id"], r["url"]): r for r in H.extracted(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[i, f"http://a.example/x/{i:03d}"]["text"] == f"story {i}" for i in range(60))
    assert got[0, "http://a.example/x/000"]["n_deleted"] == 3
    assert got[100, "http://b.example/only"]["text"] == "Home\nAbout us\nalone\nContact"
    assert got[101, None]["text"] == "no url" and got[None, "http://c.example/"]["n_chars"] == 0
    assert got[102, "http://d.example/1"]["text"] == "same"  # a named main part is never cut
    assert got[104, "http://e.example/n?x=1"]["text"] == ""  # the same page twice: all is shared


def test_table_and_empty(spark):
    got = Q.op4_html_extraction(spark, SF).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got) and sum(r["n_chars"] > 0 for r in got) > 0.9 * len(got)
    assert all("track(" not in r["text"] and "&copy;" not in r["text"] and "©" not in r["text"] for r in got)
    assert H.extracted(pages(spark, [])).collect() == []


def test_very_long_page(spark):
    page = "<article>" + "".join(f"<p>line {i}</p>" for i in range(30_000)) + "</article>"
    r = H.extracted(pages(spark, [(1, "http://a.example/", page)])).collect()[0]
    assert r["text"].count("\n") == 29_999


@pytest.mark.parametrize("open_page", [1, 0, 2])
def test_pages_of_both_kinds_on_a_host(spark, open_page):
    """An open page loses the lines that it shares with the lines of a page that names its main part."""
    shell = "<div>Home</div><div>About us</div>{}<div>Contact</div>"
    rows = [(i, f"http://a.example/x/{i}", shell.format(f"<article><p>story {i}</p></article>")) for i in range(3)]
    rows[open_page] = (open_page, f"http://a.example/x/{open_page}", shell.format(f"<p>story {open_page}</p>"))
    # pages without lines come between
    rows += [(10 + i, f"http://a.example/x/{i}/", "<nav>Home</nav>") for i in range(2)]
    got = {r["page_id"]: r for r in H.extracted(pages(spark, rows)).collect()}
    assert [got[i]["text"] for i in range(3)] == ["story 0", "story 1", "story 2"]
    assert [got[i]["n_deleted"] for i in range(3)] == [3 * (i == open_page) for i in range(3)]
    assert got[10]["text"] == got[11]["text"] == ""


def test_neighbours_decide_about_named_main_parts(spark):
    """A line of a named main part that the nearest page has outside its own is the site's; one in both is kept."""
    own = "<article><p>story {0}</p><p>same words</p><p>Read the {0} terms</p><p>Our terms</p></article>"
    rows = [(0, "http://a.example/x/0", own.format(0)),
            (1, "http://a.example/x/1", "<article><p>story 1</p><p>same words</p></article><div>Our terms</div>"),
            (2, "http://b.example/x/0", own.format(2)),
            (3, "http://b.example/x/1", "<article><p>story 3</p><p>Our terms</p></article><div>Our terms</div><div>story 2</div>"),
            (4, "http://c.example/x/0", own.format(4)), (5, "http://c.example/x/1", "<p>story 5</p><div>Our terms</div>")]
    got = {r["page_id"]: (r["text"], r["n_deleted"]) for r in H.extracted(pages(spark, rows)).collect()}
    assert got == {0: ("story 0\nsame words\nRead the 0 terms", 1), 1: ("story 1\nsame words", 0),
                   2: ("story 2\nsame words\nRead the 2 terms\nOur terms", 0), 3: ("story 3\nOur terms", 0),
                   4: ("story 4\nsame words\nRead the 4 terms\nOur terms", 0), 5: ("story 5", 1)}


def test_all_lines_of_both_pages_are_aligned():
    """The lines of both main parts tell which of two equal lines is the site's; what they cross is aligned after."""
    mine, neighbour = [1, 7, 5, 7], [2, 5, 7]  # title, more, story, more; title, story and outside of it: more
    assert H.lost_lines(mine, [True] * 4, neighbour, [True, True, False]) == [3]
    assert H.lost_lines([1, 5, 6, 7], [True] * 4, [7, 2, 5, 6], [False, True, True, True]) == [3]
    assert H.lost_lines([9, 1, 9, 5], [False, True, True, True], [9, 2, 5], [False, True, True]) == [1]
    assert H.lost_lines([1, 7, 5], [True] * 3, [2, 7, 5], [False] * 3) == []
    assert H.lost_lines([1, 7, 5], [True] * 3, [1, 7, 5], [True] * 3) == []


def test_lost_lines_by_the_rule():
    """Open lines go by a longest alignment; of a main part's, only lines that the neighbour has outside its own go."""
    random.seed(5)
    for _ in range(300):
        (a, sa), (b, sb) = (([random.randint(0, 5) for _ in range(n)], [random.random() < p for _ in range(n)])
                            for n, p in ((random.randint(0, 9), random.choice([0, 0.7])) for _ in range(2)))
        got = H.lost_lines(a, sa, b, sb)
        if not any(sa):
            assert got == np.flatnonzero(~H.kept_lines(np.array(a, np.int64), np.array(b, np.int64))).tolist()
            continue
        text = [x for x, s in zip(a, sa) if s]
        only = [x for x, s in zip(b, sb) if not s and x not in {y for y, t in zip(b, sb) if t}] if any(sb) else []
        assert 0 not in got and all(text[i] in only for i in got)
        assert all(sum(text[i] == x for i in got) <= only.count(x) for x in set(only))
        assert bool(got) == any(x in only for x in text[1:])


def test_alignment_of_long_pages_is_small():
    """12,000 lines in another order, and the same line many times, take a few rows of the table at a time."""
    random.seed(6)
    a, b = np.arange(12_000), np.arange(12_000)
    np.random.default_rng(1).shuffle(b)
    tracemalloc.start()
    partner = H.aligned(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    met = partner[partner >= 0]
    assert peak < 8 << 20 and len(met) > 150 and (np.diff(met) > 0).all() and (b[met] == a[partner >= 0]).all()
    assert (H.aligned(np.array([1, 2] * 2_000), np.array([2, 2, 1] * 1_000)) >= 0).sum() >= 2_000
