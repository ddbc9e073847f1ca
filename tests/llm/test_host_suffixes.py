import html as escapes
import random
import re
from collections import Counter

import pytest

from gradeloom.llm import host_suffixes as hs

CHROME = (
    '<header><a href="/">Site</a></header><nav><ul><li>Home<li>About</ul></nav>'
    '<div class="cookie-notice">We use cookies</div>'
)
END = (
    '<aside>Side</aside><form>Name <input></form><div id="comments"><article class="comment"><p>Nice!</p></article></div>'
    "<script>var a = '<p>no</p>';</script><style>p{}</style><footer>&copy; us</footer>"
)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<html></html>", ""), ("plain &amp; text", "plain & text"),
        ("<article><h1>A&nbsp;b</h1><p>One\n two<br>three<p>Four &lt;x&gt;</article>", "A b\nOne two three\nFour <x>"),
        (f"<body>{CHROME}<article><p>Text <b>bold</b>er.</p></article>{END}", "Text bolder."),
        (f"<body>{CHROME}<main><h2>T</h2><div>x<div>y</div>z</div></main>{END}", "T\nx\ny\nz"),
        (f'<body>{CHROME}<div class="post-content"><p>In.<p>Out</div>{END}', "In.\nOut"),
        ('<article><p>a<div class="ad">buy</div><p>b<aside>c</aside><ul><li>d<li>e</ul></article>', "a\nb\nd\ne"),
        ("<article><header><h1>Title</h1></header><p>x</article>", "Title\nx"),
        ("<article><p>a<!-- <p>b</p> --><p title='>'>c</article>", "a\nc"),
        ("<article>" + "<p>long text</p>" * 20000 + "</article>", "\n".join(["long text"] * 20000)),
        ("<article><p>a < b and c</p></article>", "a < b and c"),
        ('<article><h1>T</h1><svg width="1"/><p>One two.</p></article>', "T\nOne two."),
        ("<article><h1>T</h1><svg><title>no</title><path/></svg><p>One two.</p></article>", "T\nOne two."),
        ("<article><title-card><p>In a card.</p></title-card><p>After.</p></article>", "In a card.\nAfter."),
        ("<article><p>a<select><option>x<option>y<p>b</p></article>", "a\nb"),
        ("<article><p>a<select><option>x</select><p>b</p></article>", "a\nb"),
        ("<article><p>a<template><p>b</p></article>", "a\nb"),
        ('<article><div class="content-with-sidebar"><p>x</p></div><div class="form-group">y</div></article>', "x\ny"),
        ('<body><div class="content-with-sidebar"><p>main text</p></div></body>', "main text"),
        ('<article><div class="side-by-side">a</div><div class="tags-in-c">b</div><div class="related-posts">c</div></article>', "a\nb"),
        ('<body><div id="sidebar"><p>all there is</p></div><form>Name</form></body>', "all there is"),
        ('<article><div class="comments"><p>Only a reader.</p></div></article>', ""),
    ],
)
def test_pages(page, text):
    settled, unsettled, _ = hs.split_page(page)
    assert ("\n".join(unsettled) if settled is None else settled) == text


def test_repeats_of_a_host_are_removed(spark):
    boiler = "<div>All the news of the town every single day of the week</div><div>Call us now</div>"
    rows = [(i, "http://a.org/x", f"<body>{boiler}<div>Story {i} has its own words {i}</div></body>") for i in range(4)]
    rows += [(9, "http://b.org/x", f"<body>{boiler}<div>Story</div></body>")]
    rows += [(20 + i, "http://c.org/", "<body><div>The same copy of one page with enough words to count</div>") for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in hs.extract_main_text(df).collect()}
    for i in range(4):
        assert texts[i] == f"Call us now\nStory {i} has its own words {i}" or texts[i] == f"Story {i} has its own words {i}"
    assert texts[9].count("\n") == 2
    assert texts[20].startswith("The same copy")


def run(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in hs.extract_main_text(df).collect()}


TEMPLATE = "All the news of the town every single day of the week"


def test_articles_under_one_template_are_distinct_pages(spark):
    rows = [
        (i, "http://a.org/x", f"<div>{TEMPLATE}</div><article><p>Article {i}</p></article>") for i in range(3)
    ]
    rows += [(9, "http://a.org/y", f"<div>{TEMPLATE}</div><div>Only here stands this one story of the day</div>")]
    rows += [(20 + i, "http://b.org/x", f"<div>{TEMPLATE}</div><p>One copy</p>") for i in range(3)]
    texts = run(spark, rows)
    assert texts[9] == "Only here stands this one story of the day"
    assert texts[1] == "Article 1"
    assert texts[20] == f"{TEMPLATE}\nOne copy"


def test_short_blocks_between_own_text_are_repeats(spark):
    own = lambda i, part: " ".join(f"w{i}{part}{n}" for n in range(12))
    rows = [
        (i, "http://a.org/x", f"<p>{own(i, 'a')}</p><p>Share this story</p><p>{own(i, 'b')} Share this story</p>")
        for i in range(3)
    ]
    rows += [(5, "http://b.org/x", "<p>Share this story</p>"), (6, "http://b.org/x", "<p>Share this story now</p>")]
    texts = run(spark, rows)
    for i in range(3):
        assert texts[i] == f"{own(i, 'a')}\n{own(i, 'b')} Share this story"
    assert texts[5] == "Share this story" and texts[6] == "Share this story now"


def test_two_distinct_pages_make_a_repeat(spark):
    rows = [(i, "http://a.org/x", f"<div>{TEMPLATE}</div><p>Own story {i}</p>") for i in range(2)]
    assert run(spark, rows) == {0: "Own story 0", 1: "Own story 1"}


def test_odd_rows(spark):
    rows = [(1, None, None, 3), (1, None, None, 3), (None, "no url", "<p>x</p>", 4), (2, "http://x", "", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = hs.extract_main_text(df).collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("", 0), ("", 0), ("x", 1)]
    assert hs.extract_main_text(df.limit(0)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = {p.page_id: p.html for p in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = hs.op1_host_suffix_array(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.DOTALL)[1]
        parts = re.split(r"<(?:p|h1)>|</(?:p|h1)>", article)
        parts = [re.sub(r"\s+", " ", escapes.unescape(re.sub(r"</?(?:b|br)>", lambda m: " " if "br" in m[0] else "", p))).strip() for p in parts]
        assert r.text == "\n".join(p for p in parts if p)
        assert r.n_chars == len(r.text)


def test_many_elements_without_an_end():
    page = "<article>" + "<p>x<select><svg><template>" * 20_000 + "</article>"
    assert hs.split_page(page)[0] == "\n".join(["x"] * 20_000)
    deep = "<article>" + "<div>x</b></p>" * 20_000
    assert hs.split_page(deep)[0] == "\n".join(["x"] * 20_000)


def words(i, part, n=20):
    return " ".join(f"w{i}{part}{k}" for k in range(n))


NEWS = "Sign up for our letter and get the best stories every day"


def test_a_template_inside_articles_goes(spark):
    rows = [
        (i, "http://a.org/x", f"<article><p>{words(i, 'a')}</p><p>{NEWS}</p><p>{words(i, 'b')}</p><p>Share this</p></article>")
        for i in range(5)
    ]
    rows += [(5, "http://a.org/y", f"<nav>Home</nav><p>{words(5, 'a')} {NEWS}</p><p>{NEWS}</p>")]
    rows += [(6, "http://a.org/z", f"<article><p>{words(6, 'a')}</p></article>")] * 20
    rows += [(7, "http://b.org/z", f"<article><p>{words(7, 'a')}</p><p>{NEWS}</p></article>")]
    texts = run(spark, rows)
    for i in range(5):
        assert texts[i] == f"{words(i, 'a')}\n{words(i, 'b')}"
    assert texts[5] == f"{words(5, 'a')} {NEWS}"
    assert texts[6] == words(6, "a")
    assert texts[7] == f"{words(7, 'a')}\n{NEWS}"


def test_keys_of_streams_together():
    streams = [[words(1, "a"), "Share this"], [], ["Share this", words(1, "a", 8)], ["one"], [words(1, "a")]]
    together = [list(keys) for keys in hs.suffix_keys(streams)]
    assert together == [list(hs.suffix_keys([stream])[0]) for stream in streams]
    assert [len(keys) for keys in together] == [16, 0, 4, 1, 13]
    assert together[0][0] == together[2][2] == together[4][0] and together[0][15] == together[2][3]
    assert hs.suffix_keys([]) == []


def test_article_text_on_some_pages_stays(spark):
    page = lambda i, more: f"<article><p>{words(i, 'a')}</p>{more}</article>"
    some = [(i, "http://a.org/x", page(i, f"<p>{NEWS}</p>" if i % 2 else "")) for i in range(10)]
    few = [(i, "http://b.org/x", page(i, f"<p>{NEWS}</p>")) for i in range(20, 23)]
    versions = [(i, "http://c.org/x", f"<article><p>Day {i}</p><p>{words('v', 'a')}</p></article>") for i in range(30, 40)]
    texts = run(spark, [*some, *few, *versions])
    for i in (1, 3, 5, 7, 9, 20, 21, 22):
        assert texts[i] == f"{words(i, 'a')}\n{NEWS}"
    for i in range(30, 40):
        assert texts[i] == f"Day {i}\n{words('v', 'a')}"


def test_templates_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hs, "SLICE", 60)
    rng = random.Random(5)
    lines = [words("t", k, rng.choice((3, 7, 8, 9, 15))) for k in "abcdefgh"]
    rows = []
    for i in range(160):
        held = [line for k, line in enumerate(lines) if rng.random() < 0.2 + 0.09 * k]
        held = rng.sample([*held, words(i, "p", 70), words(i, "q", 9)], len(held) + 2)
        rows.append((i, f"http://{rng.choice('abbbccccccc')}.org/", "<article>" + "".join(f"<p>{b}" for b in held)))
    rows += [rows[rng.randrange(20)] for _ in range(90)]
    rng.shuffle(rows)
    streams = {(url, tuple(hs.split_page(page)[2])) for _, url, page in rows}
    hosts = {host: [s for url, s in streams if url == host] for host, _ in streams}

    def grams(stream):
        tokens = " ".join(stream).split()
        return {" ".join(tokens[k : k + 8]) for k in range(len(tokens) - 7)} | {(b,) for b in stream if len(b.split()) < 8}

    on = {host: Counter(g for s in pages for g in grams(s)) for host, pages in hosts.items()}

    def template(host, stream, n):
        frequent = lambda g: on[host][g] >= 4 and 2 * on[host][g] > len(hosts[host])
        tokens, start = " ".join(stream).split(), len(" ".join(stream[:n]).split())
        places = range(start, start + len(stream[n].split()))
        at = [k for k in range(len(tokens) - 7) if frequent(" ".join(tokens[k : k + 8]))]
        return frequent((stream[n],)) or all(any(k <= p < k + 8 for k in at) for p in places)

    got, changed = run(spark, rows), 0
    for i, host, page in rows:
        stream = hs.split_page(page)[2]
        out = [template(host, stream, n) for n in range(len(stream))]
        sizes = [len(b.split()) for b in stream]
        if 2 * sum(n for n, gone in zip(sizes, out) if gone) > sum(sizes):
            out = [False] * len(stream)
        changed += any(out)
        assert got[i] == "\n".join(b for b, gone in zip(stream, out) if not gone)
    assert changed > 50
