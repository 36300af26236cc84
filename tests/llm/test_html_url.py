"""HTML extraction and URL rules."""

from __future__ import annotations

import random
import time
from collections import Counter

import pytest

from brute import SF_DIR
from tabaudit.llm import html_template, url_rules

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body><nav><ul><li><a href=x>Home</a></li></ul></nav><div class="ad">Buy &amp; go</div>
<article><h1>Title &lt;1&gt;</h1><p><b>First&nbsp;line<br>goes on<p>Second &eacute;<!-- no --> part
<aside>side</aside><div id="comments"><p>reader</p></div><ul><li>one<li>two</ul><form>name<input></form></article>
<footer>&copy; site</footer></body></html>"""


def test_parse_main_text():
    assert html_template.parse(PAGE).texts == ["Title <1>", "First line goes on", "Second é part", "one", "two"]


@pytest.mark.parametrize(
    "html, want",
    [
        ("", []),
        ("plain  text", ["plain text"]),
        ("a < b &amp; c &unknown; d", ["a < b & c &unknown; d"]),
        ("<p>one<p>two<div>three", ["one", "two", "three"]),
        ("<div><p>x <span class='share'>tweet</span> y</p></div>", ["x y"]),
        ("<main><p>in</p></main><p>out</p>", ["in"]),
        ("<p>open <script>never closed <p>x", ["open"]),
        ("<p title='a>b'>q</p></div></p>z", ["q", "z"]),
        ("<pre>a\n  b</pre><table><tr><td>c<td>d</table>", ["a b", "c", "d"]),
    ],
)
def test_parse_pieces(html, want):
    assert html_template.parse(html).texts == want


def test_templates_are_found_per_host(spark):
    rows = []
    for i in range(40):
        # No marked main content: only recurrence tells the template.
        body = f"<div><p>Story {i} of this host.</p></div><div><p>All rights of host A.</p></div>"
        rows.append((i, f"https://A.example.com/{i}", body))
    rows.append((50, "http://b.example.com/", "<div><p>All rights of host A.</p></div>"))
    rows += [(51, None, None), (52, "no scheme", ""), (53, "http://c.org", "<article></article>")]
    rows += [(0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int")
    out = sorted((r.page_id, r.text, r.n_blocks_deleted) for r in html_template.main_text(pages).collect())
    assert out[0] == out[1] == (0, "Story 0 of this host.", 1)
    assert out[41:] == [(50, "All rights of host A.", 0), (51, "", 0), (52, "", 0), (53, "", 0)]
    assert html_template.main_text(pages.limit(0)).count() == 0


def test_marked_content_survives_recurrence(spark):
    page = "<article><p>The same quotation.</p><p>Story {}</p><div>Share this</div></article>"
    rows = [(i, f"http://q.net/{i}", page.format(i)) for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html_template.main_text(pages).collect()}
    assert texts[7] == "The same quotation.\n\nStory 7"


@pytest.mark.parametrize(
    "html, want",
    [
        ("<div style='overflow:hidden'>a</div><div title=\"hidden gems\">b</div><p data-id=share-7>c</p>", ["a", "b", "c"]),
        ("<div data-x='class=\"ad\"'>a</div><div hidden>b</div><div ID='Share'>c</div><div class='x ad'>d</div>", ["a"]),
        ("<div class='layout no-sidebar'><p>a</p></div><div class='content has-comments'>b</div>", ["a", "b"]),
        ("<div class='site-footer'>a</div><div class='share-links'>b</div><div class='page__sidebar--left'>c</div>d", ["d"]),
        ("<div class='box--ad'>a</div><div class='my-ad-hoc notes'>b</div>", ["a", "b"]),
        ("<div class='sidebar-right'><p>x</p><article class='post category-social'><p>a</p></article></div>", ["a"]),
        ("<main class='sidebar-left'>a</main>", ["a"]),
        ("<article>a</article><div class=comments><article>b</article></div>", ["a"]),
        ("<div class=comments><article class=comment>b</article></div><p>a</p>", ["a"]),
        ("<div hidden><div class=related><article>b</article></div></div><p>a</p>", ["a"]),
        ("<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds, <math/>or not</p>", ["So x=1 holds, or not"]),
        ("<p>a <svg viewBox='0 0 1 1' d=\"a>b\"/>b</p><p>c <svg/>d <svg a=/x><text>e</text></svg>f</p>", ["a b", "c d f"]),
        ("<script data-a='>var a</script>a", ["a"]),
        ("<object-list>a</object-list><iframe srcdoc='<p>x</iframe>'>b</iframe>c", ["ac"]),
    ],
)
def test_names_drop_nothing_else(html, want):
    assert html_template.parse(html).texts == want


@pytest.mark.parametrize("page", [
    "<html><body><div class=text><h2>Only story</h2><p>All of it.</p></div></body></html>",
    "<html><body><section><article><h2>Only story</h2><p>All of it.</p></article></section></body></html>",
])
def test_copies_of_a_page_keep_their_text(spark, page):
    rows = [(i % 10, f"http{'s' * (i % 2)}://copies.net/a?utm={i}", page) for i in range(30)]
    # Copies differ in what is left out; other pages share a notice with each other.
    rows += [(30 + i, "http://copies.net/b", page.replace("<body>", f"<body><nav>{i}</nav>")) for i in range(10)]
    rows += [(100 + i, f"http://copies.net/{i}", f"<div><p>Story {i}</p></div><div><p>Note.</p></div>") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = html_template.main_text(pages).collect()
    assert {r.text for r in out if r.page_id < 100} == {"Only story\n\nAll of it."}
    assert {r.text for r in out if r.page_id >= 100} == {f"Story {i}" for i in range(20)}


def test_elements_around_marked_content_are_no_template():
    inner = "<div><section><article><p>x</p></article></section></div>"
    parsed = html_template.parse(f"<html><body>{inner}</body></html>")
    assert set(parsed.hashes) == {None} and parsed.texts == ["x"]


@pytest.mark.parametrize(
    "html, want",
    [
        ('<article><h2 id="related-work">Related</h2><p>a</p><h2 id="social-structure">b</h2></article>', ["Related", "a", "b"]),
        ('<article><section id="advertising-history"><p>a</p></section></article>', ["a"]),
        ('<article><p>an <span class="ad-hoc">ad hoc</span> <a class="nav-link">chapter two</a></p></article>', ["an ad hoc chapter two"]),
        ('<article><table><tr class="skip"><td>a</td></tr></table><p class="notice">b</p><ol class="related-steps"><li>c</ol></article>', ["a", "b", "c"]),
        ('<form id="aspnetForm"><div><article><p>Whole story.</p><input value=x><label>l</label></article></div></form>', ["Whole story."]),
        ('<body><form><input type=hidden><p>A page without marks, in a form.</p></form></body>', ["A page without marks, in a form."]),
        ('<p>A story that is longer.</p><form><p>Sign up</p><button>go</button></form>', ["A story that is longer."]),
        ('<article><p>Teaser</p></article><div><p>The long body of the page, outside of any mark.</p></div>',
         ["Teaser", "The long body of the page, outside of any mark."]),
        ('<div class="related"><article>Teaser</article></div><div><p>The long body of the page, without a mark.</p></div>',
         ["The long body of the page, without a mark."]),
        ("<p>a<!-- c --!>b</p>", ["ab"]),
    ],
)
def test_article_text_is_kept(html, want):
    assert html_template.parse(html).texts == want


def test_deep_nesting_takes_linear_time():
    for page in ("<div>x" * 100_000, "<ul><li>x" * 50_000, "<b>x" * 100_000, "</p>" * 100_000 + "<p>x" * 50_000):
        started = time.process_time()
        parsed = html_template.parse(page)
        assert time.process_time() - started < 30
        assert "".join(parsed.texts).replace(" ", "") == "x" * page.count("x")
        assert len(parsed.gone(set())) == len(parsed.texts)


def plain_text(pages):
    """Text per page as one reads the rule: every block, its chain of elements, and their counts per host."""
    parsed = {i: (html_template.parse(h or ""), host) for i, host, h in pages}
    distinct = {}
    for p, host in parsed.values():
        distinct.setdefault(host, {}).setdefault(tuple(p.texts), {h for h in p.hashes if h is not None})
    out = {}
    for i, (p, host) in parsed.items():
        counts = Counter(h for own in distinct[host].values() for h in own)
        bar = max(html_template.MIN_PAGES, html_template.GROWTH * len(distinct[host]) ** 0.5)
        kept = []
        for text, e in zip(p.texts, p.within):
            chain = []
            while e >= 0:
                chain.append(p.hashes[e])
                e = p.parents[e]
            if not any(h is not None and counts[h] >= bar for h in chain):
                kept.append(text)
        out[i] = "\n\n".join(kept)
    return out


def test_whole_table_matches_plain_version(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    rows = [(r.page_id, (r.url or "").split("://")[-1].split("/")[0].lower(), r.html) for r in pages.collect()]
    assert {r.page_id: r.text for r in html_template.main_text(pages).collect()} == plain_text(rows)


@pytest.mark.parametrize("limit", [html_template.BROADCAST_SUBTREES, 0])
def test_rotating_template_blocks_of_a_large_host(spark, monkeypatch, limit):
    monkeypatch.setattr(html_template, "BROADCAST_SUBTREES", limit)
    rows = []
    for i in range(1000):
        # One notice is on 10% of the pages, one on 1% of them, and no name tells either.
        notices = f"<div class=x><p>Often {i % 10}</p></div><div><p>Seldom {i % 100}</p></div>"
        rows.append((i, f"http://large.org/{i}", f"<body>{notices}<div><p>Story {i}</p><p>Twice {i % 500}</p></div></body>"))
    rows += [(1000 + i, f"http://small.org/{i}", "<p>Often 1</p>" + f"<p>{i}</p>") for i in range(4)] + rows[:2]
    rows += [(2000, None, None), (2001, "http://large.org/e", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = sorted((r.page_id, r.text, r.n_blocks_deleted) for r in html_template.main_text(pages).collect())
    story = [(i, f"Story {i}\n\nTwice {i % 500}", 2) for i in range(1000)]
    other = [(1000 + i, f"Often 1\n\n{i}", 0) for i in range(4)] + [(2000, "", 0), (2001, "", 0)]
    assert out == sorted(story + story[:2] + other)


def plain_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    best = max(
        (
            (len(h) + len(p), v, h + p)
            for h, p, v in rules
            if ("." + host).endswith("." + h) and path.startswith(p)
        ),
        default=(0, default, None),
    )
    return host, path, best[2], best[1]


def test_url_rules_match_plain_version(spark):
    rng = random.Random(5)
    labels = ["a", "b", "example", "net", "com", "x-y"]
    hosts = [".".join(rng.choices(labels, k=rng.randint(1, 4))) for _ in range(60)]
    paths = ["/" + "".join(rng.choices("ab/é", k=rng.randint(0, 5))) for _ in range(60)]
    rules = [(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(80)]
    rules += [("net", "/", "block"), ("example.net", "/a", "allow"), ("net", "/\U0010ffff", "block")]
    unique = {(h, p): max(v for a, b, v in rules if (a, b) == (h, p)) for h, p, _ in rules}
    rules_used = [(h, p, v) for (h, p), v in unique.items()]
    urls = [f"http://{rng.choice(['', 'www.', 'N.'])}{rng.choice(hosts)}{rng.choice(paths)}{t}" for t in ["", "?q=/a", "#f", "/\U0010ffffz"] for _ in range(150)]
    urls += [None, "", "no scheme/a", "http://", "HTTP://EXAMPLE.net/A", "x://net", "x://net?b", "x://É.net/\U0010ffff\U0010ffff"]
    rows = [(i % 97, u, "v") for i, u in enumerate(urls)] + [(1, "x://net/", "v")] * 3
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted((r.page_id, r.url or "", r.host, r.path, r.rule or "", r.verdict) for r in url_rules.judge(pages, frame).collect())
    want = []
    for id_, url, _ in rows:
        host, path, rule, verdict = plain_verdict(url, rules_used)
        want.append((id_, url or "", host, path, rule or "", verdict))
    assert got == sorted(want)
    none = url_rules.judge(pages, frame.limit(0))
    assert {r.verdict for r in none.collect()} == {"allow"} and none.count() == len(rows)
    assert url_rules.judge(pages.limit(0), frame).count() == 0
