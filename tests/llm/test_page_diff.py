import os
import random
import time
from urllib.parse import urlsplit

import pytest

from chainloom.llm.page_diff import COMMON_PAGES, COMMON_SHARE, COPY_SHARE, REACH, extract, lines, main_text, mark, shared


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def is_subsequence(xs, ys):
    it = iter(ys)
    return all(x in it for x in xs)


@pytest.mark.parametrize("seed", range(5))
def test_shared_is_a_longest_common_subsequence(seed):
    rng = random.Random(seed)
    for _ in range(200):
        a, b = ([rng.choice("abcdef"[: rng.randrange(1, 7)]) for _ in range(rng.randrange(0, 18))] for _ in range(2))
        got = shared(a, b)
        assert len(got) == lcs_length(a, b)
        assert is_subsequence([a[i] for i in sorted(got)], b)


def test_article_of_marked_up_page():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";x<1;</script></head><body>
    <nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad --><div class="ad">Buy!</div><header>Site</header>
    <article><h1>Ti&amp;tle</h1><p><b>One &lt;two&gt;<br><p>Three\n   four</p><div class="comments"><p>reader</p></div>
    <form><input name=q>Search</form><p>caf&eacute; &#8212; &amp</p></article><aside>side</aside><footer>&copy; x</footer>"""
    assert main_text(lines(page), []) == "Ti&tle\nOne <two>\nThree four\ncafé — &"


def test_inline_elements_close_in_order():
    assert main_text(lines('<main><p>a <span class="ad">b <span>c</span> d</span> e</p></main>'), []) == "a\ne"


def page(k, body):
    return f"<html><body><div>Site name</div><div>Menu of the site</div>{body}<div>All rights</div></body></html>", f"http://h.example/en/{k}"


def test_template_lines_without_markup_go(spark):
    rows = []
    for k in range(60):
        html, url = page(k, f"<p>Body {k} first.</p><p>Body {k} second.</p>")
        rows.append((k, url, html, 1))
    rows += [(100, None, None, 1), (101, "not a url", "", 1), (102, "http://alone.example/", "<p>only &amp; page", 1), (None, "http://alone.example/x?y", "<p>no id" + " z" * 70000, 1), (5, *rows[5][1:])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    for parts in (1, 5):
        got = {}
        for r in extract(pages.repartition(parts)).collect():
            assert r["n_chars"] == len(r["text"])
            got.setdefault(r["page_id"], []).append((r["text"], r["url"]))
        assert sum(map(len, got.values())) == len(rows)
        for k in range(60):
            assert {t for t, _ in got[k]} == {f"Body {k} first.\nBody {k} second."}
        assert got[100] == [("", None)] and got[101][0][0] == "" and got[102][0][0] == "only & page" and len(got[None][0][0]) == 140005
    assert extract(pages.limit(0)).count() == 0


def test_copies_of_an_article_keep_their_text(spark):
    html, _ = page(1, "<article><p>Same words.</p><p>More words.</p></article>")
    pages = spark.createDataFrame([(k, f"http://h.example/{k}", html) for k in range(20)], "page_id long, url string, html string")
    assert {r["text"] for r in extract(pages).collect()} == {"Same words.\nMore words."}


def test_shared_lines_inside_the_article_go_and_others_outside_it_stay(spark):
    rows = []
    for k in range(12):
        html, url = page(k, f"<article><p>Body {k} first.</p><p>Read more on this site.</p><p>Body {k} second.</p></article><div><p>Body {k} outside.</p></div>")
        rows.append((k, url, html))
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Body {k} first.\nBody {k} second.\nBody {k} outside." for k in range(12)}


def test_copy_in_another_template_keeps_its_article():
    own = [("Menu", -1), ("One.", 1), ("Two.", 1), ("Foot", -1)]
    assert main_text(own, [[("Other menu", -1), ("One.", 1), ("Two.", 1), ("Other foot", -1)], [], [("Foot", -1)], [("Two.", 1), ("Three.", 1)]]) == "One.\nTwo."


def test_a_line_of_the_article_goes_where_two_different_neighbours_and_the_host_have_it():
    own = [("Menu", 0), ("One.", 1), ("Read on.", 1), ("Two.", 1)]
    first, second = [("Menu", 0), ("Three.", 1), ("Read on.", 1), ("Four.", 1)], [("Five.", 1), ("Read on.", 1), ("Six.", 1)]
    assert main_text(own, [first]) == "One.\nRead on.\nTwo."
    assert main_text(own, [first, first]) == "One.\nRead on.\nTwo."  # a copy of the first shows nothing more
    assert main_text(own, [first, second]) == "One.\nRead on.\nTwo."  # two articles may share prose
    common = frozenset([mark("Read on.")])
    assert main_text(own, [first, second], common) == "One.\nTwo."
    assert main_text(own, [second, first], common) == "Menu\nOne.\nTwo."  # outside the nearest page decides
    assert main_text(own, [first], common) == "One.\nRead on.\nTwo."


def texts(spark, rows, parts):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
    found = [(r["page_id"], r["text"]) for r in extract(pages).collect()]
    assert len(found) == len(rows)
    return dict(found)


def test_short_articles_on_a_heavy_template(spark):
    template = "".join(f"<div>Template {k}</div>" for k in range(20))
    rows = [(k, f"http://h.example/{k:03}", f"{template}<p>Article {k}.</p>") for k in range(50)]
    assert texts(spark, rows, 3) == {k: f"Article {k}." for k in range(50)}


@pytest.mark.parametrize("parts", [1, 6])
def test_long_runs_of_copies_meet_the_pages_beyond(spark, parts):
    rows = [(k, f"http://h.example/{k:03}", page(k if not 20 <= k < 60 else 20, f"<p>Body {k if not 20 <= k < 60 else 20}.</p><p>Other {k if not 20 <= k < 60 else 20}.</p>")[0]) for k in range(80)]
    assert texts(spark, rows, parts) == {k: f"Body {k if not 20 <= k < 60 else 20}.\nOther {k if not 20 <= k < 60 else 20}." for k in range(80)}


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><header><h1>Title</h1></header><p>body</p></article>", "Title\nbody"),
        ('<article><div class="entry-header"><h1>Title</h1></div><p>body</p></article><div class="site-header">Site</div>', "Title\nbody"),
        ('<article><p class="market-share">Share rose</p><p class="share-buttons">Tell others</p></article>', "Share rose"),
        ("<main><p>Let <math><mi>x</mi></math> be</p><label>A label</label><form><label>Your name</label></form></main>", "Let x be\nA label"),
        ('<main><p>a <a title="foo>b</a> c</p><p class="x">d</p></main>', "a b c\nd"),
        ('<main><p>a <a title="x > y">b</a></p></main>', "a b"),
        ("<main><p>1 < 2 and 3 > 2</p></main>", "1 < 2 and 3 > 2"),
        ('<main><p>a</p><svg width="1"/><p>b</p><svg><text>no</text></svg><p>c</p></main>', "a\nb\nc"),
        ('<article><p class="share">Share price rose</p><blockquote class="reply">He said</blockquote><p class="ad">Buy</p><div class="share">Tell</div></article>', "Share price rose\nHe said"),
        ("<main><p>a</b></i></p></span><p>b <b>c</p></b> d</main>", "a\nb c\nd"),
    ],
)
def test_what_belongs_to_an_article(html, text):
    got = main_text(lines(html), [])
    assert got == text or got.replace("\n", " ") == text.replace("\n", " ")


def test_articles_keep_their_lines_on_the_given_pages(spark):
    path = "/root/testdata/sf0.01/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("no given pages")
    pages = spark.read.parquet(path)
    got = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    for r in pages.collect():
        own = [t for t, k in lines(r["html"]) if k == 1]
        assert is_subsequence(own, got[r["page_id"]].split("\n"))


def test_tags_that_match_nothing_take_no_time():
    for html in ("<div>" * 20_000 + "</b>" * 20_000, "<div><b>" * 10_000 + "</i>" * 20_000, "<b>" * 40_000, "<p>" * 40_000 + "</div>" * 20_000):
        began = time.monotonic()
        lines(html + "text")
        assert time.monotonic() - began < 1


def test_many_copies_that_are_not_equal(spark):
    """More near copies on each side than are looked at: the host's common lines go, the article stays."""
    rows = []
    for k in range(60):
        own = f"<p>Variant {k}.</p>" + "".join(f"<p>Same line {j}.</p>" for j in range(15)) if k < 12 else f"<p>Body {k}.</p>"
        rows.append((k, f"http://h.example/{k:03}", page(k, own)[0]))
    got = texts(spark, rows, 4)
    same = "\n".join(f"Same line {j}." for j in range(15))
    assert all(got[k] == f"Variant {k}.\n{same}" for k in range(9)) and all(got[k] == f"Body {k}." for k in range(15, 60))


def by_brute_force(rows):
    """Every page against the runs around it on its host, in one list."""
    hosts = {}
    for k, url, html in rows:
        parts = urlsplit(url or "")
        hosts.setdefault(parts.netloc.lower(), []).append((parts.path, k, tuple(lines(html))))
    out = {}
    for pages in hosts.values():
        own = {tuple(sorted({t for t, kind in p[2] if kind >= 0})) for p in pages} - {()}
        often = [t for x in own for t in x]
        common = {t for t in often if often.count(t) >= max(COMMON_PAGES, COMMON_SHARE * len(own))}
        telling = lambda ls, c=common: [t for t, kind in ls if kind >= 0 and t not in c]
        runs = []
        for p in sorted(pages, key=lambda p: p[:2]):
            key = sorted(set(telling(p[2])))
            if not runs or runs[-1][0] != key:
                runs.append((key, []))
            runs[-1][1].append(p)
        for n, (_, run) in enumerate(runs):
            for path, k, ls in run:
                near = [(m, runs[m][1][-1 if m < n else 0]) for m in range(max(0, n - REACH), min(len(runs), n + REACH + 1)) if m != n]
                near.sort(key=lambda x: (-len(os.path.commonprefix([path, x[1][0]])), abs(x[0] - n), x[0]))
                left, shows, before, met = telling(ls), [], None, False
                copies = lambda x, y: lcs_length(x, y) > COPY_SHARE * max(1, min(len(x), len(y)))
                for _, (_, _, other) in near if left else []:
                    met = True
                    theirs = telling(other)
                    if any(kind >= 0 for _, kind in other) and not copies(left, theirs) and len(shows) < 2 and not (shows and copies(before, theirs)):
                        shows.append(shared([t for t, _ in ls], [t for t, _ in other]))
                        before = theirs
                marked = any(kind == 1 for _, kind in ls)
                if shows:
                    twice = shows[0] & shows[1] if len(shows) == 2 else set()
                    out[k] = [t for i, (t, kind) in enumerate(ls) if kind == 0 and i not in shows[0] or kind == 1 and not (i in twice and t in common)]
                else:
                    out[k] = [t for t, kind in ls if (kind == 1 or kind == 0 and not marked) and not (met and t in common)]
    return {k: "\n".join(v) for k, v in out.items()}


@pytest.mark.parametrize("parts", [1, 7])
def test_extract_equals_brute_force(spark, parts):
    rng = random.Random(parts)
    rows = []
    for k in range(150):
        host = rng.choice(["a.example", "b.example", "B.example", "c.example"])
        body = "".join(f"<p>Line {rng.randrange(40)}</p>" for _ in range(rng.randrange(6)))
        if rng.random() < 0.3 and rows:
            body = rng.choice(rows)[2]
        mark = rng.random()
        html = f"<div>{host} top</div><nav>n</nav>" + (f"<article>{body}</article>" if mark < 0.5 else body) + f"<div>{host} end</div>"
        rows.append((k, f"http://{host}/{rng.choice('xyz')}/{rng.randrange(30)}", html))
    assert texts(spark, rows, parts) == by_brute_force(rows)
