"""Main text of pages, and WARC revisits."""

import random
import re
from collections import Counter
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from vintagecast.llm import captures, style_tree, warc
from vintagecast.llm.dom import blocks, read_page


def text_of(source, noisy=frozenset()):
    return style_tree.main_text(read_page(source), noisy)


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("", ""),
        ("plain < text > & more &lt;b&gt;", "plain < text > & more <b>"),
        ("<p>a<p>b<div>c</div>d", "a\n\nb\n\nc\n\nd"),
        ("<p>one  <b>two\n</b><i>th</i>ree<br>four&nbsp;&eacute;&#233;</p>", "one two three four éé"),
        ("<p><b>x.<br><p>y<ul><li>1<li>2</ul></b>z", "x.\n\ny\n\n1\n\n2\n\nz"),
        ("<table><tr><td>1<td>2<tr><th>3</table>", "1\n\n2\n\n3"),
        ("<script>var t='</p><p>no';</script><style>p{}</style><p>a<!-- <p>no</p> --><noscript>no</noscript>", "a"),
        ("<p title='a>b' data-x=\"</p>\">a</p><p class=x>b</p>", "a\n\nb"),
        ("<script>never closed <p>x", ""),
        ("a<!-- never closed <p>x", "a"),
        ("<nav>no</nav><header>no</header><article><header><h1>T</h1></header><p>a</p><aside>no</aside><footer>no</footer></article><footer>no</footer>", "T\n\na"),
        ("<body class='no-sidebar'><div id=siteHeader>no</div><main><p>a</p><form>no</form><div class='comments'>no</div></main><div class='sidebar'>no</div>", "a"),
        ("<div class='cookie-notice'>no</div><p>a</p><div hidden>no</div><p style='display:none'>no</p><div class='adBox'>no</div><div class='address'>b</div>", "a\n\nb"),
        ("<article><p>a</p><section id='respond'><p>no</p></section></article><article class='comment'><p>no</p></article>", "a"),
        ("<article>a</article><article>b</article>out", "a\n\nb"),
        ("</p></div>x</span>", "x"),
        ("<svg><text>no</text></svg><textarea><p>no</textarea><title>no</title>a", "a"),
    ],
)
def test_main_text_by_name(source, want):
    assert text_of(source) == want


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<article><h1 id='share-prices'>T</h1><section id='related-work'><h2 id='social-impact'>S</h2><p>a</p></section><div class='ad-hoc'>b</div></article>", "T\n\nS\n\na\n\nb"),
        ("<article><p>a <math><mi>x</mi></math></p><p class='notice'>b</p><div id='search'>c</div><object>d</object></article>", "a\n\nx\n\nb\n\nc\n\nd"),
        ("<h1 class='heading'>T</h1><div class='head'>a</div><h2 class='header'>S</h2><section id='related-work'>b</section><div class='site-header'>no</div><div id='footer-links'>no</div>", "T\n\na\n\nS\n\nb"),
        ("<article><p>a</p><div role='navigation'>no</div><ul class='commentlist'><li>no</ul><div class='nav' hidden>no</div></article>", "a"),
    ],
)
def test_names_of_real_text(source, want):
    assert text_of(source) == want


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<body><form id='aspnetForm'><div class='content'><h1>T</h1><p>real text</p></div></form>", "T\n\nreal text"),
        ("<section class='share'><p>Market share text</p></section>", "Market share text"),
        ("<div id='search'><p>How to search</p></div><div class='sidebar'>x</div>", "How to search"),
        ("<p>the text of the page</p><form><input>mail</form><div class='share'>share</div>", "the text of the page"),
        ("<article><p>a</p><blockquote>b<footer>who</footer></blockquote><footer>no</footer></article>", "a\n\nb\n\nwho"),
        ("<p>a</p><div class='comments'><p>many more readers' words than the page</p></div>", "a"),
    ],
)
def test_parts_that_hold_the_text(source, want):
    assert text_of(source) == want


@pytest.mark.parametrize("source", ["<div>" * 90_000 + "</p>" * 90_000 + "x", "<a " * 330_000, "<b>" * 110_000 + "x " * 100_000, "<p><button>" + "<div>" * 150_000, "<p>" + "<b>x" * 200_000])
def test_long_pages_take_time_in_proportion(source):
    import time

    began = time.process_time()
    page = style_tree.read_page(source)
    list(style_tree.page_features(page))
    style_tree.main_text(page, frozenset([1]), frozenset([2]))
    assert time.process_time() - began < 8


CARDS = "<main><h1>T{i}</h1><p>{body}</p><div class='cards'><article class='card'>teaser</article></div></main><article class='entry'>more {body}</article>"


def test_outermost_root_is_the_whole_text(spark):
    assert text_of(CARDS.format(i=1, body="b")) == "T1\n\nb\n\nteaser\n\nmore b"
    assert text_of("<div class='post-content'>a<article>b</article>c</div>out") == "a\n\nb\n\nc"
    rows = [(i, "http://h.example.com/", CARDS.format(i=i, body=f"body {i}")) for i in range(40)]
    got = style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: f"T{i}\n\nbody {i}\n\nmore body {i}" for i in range(40)}


def test_names_in_an_article_raise_the_bar():
    page = read_page("<article><p>a</p><div class='share'>no</div><div class='fact'>b</div></article>")
    named, other = (style_tree._chain(page)[page.words.index(w)] for w in ("share", "fact"))
    both = frozenset([named, other])
    assert style_tree.main_text(page, frozenset(), both) == "a\n\nb"
    assert style_tree.main_text(page, both) == "a"
    assert style_tree.main_text(page, frozenset(), frozenset([other])) == "a\n\nno\n\nb"


def test_any_bytes_are_read():
    rng = random.Random(0)
    bits = ["<", ">", "</", "p", "div", " ", "=", '"', "'", "<!--", "-->", "&", "&amp;", "<p>", "</p>", "<script>", "x", "<li", "/>", "<!", "article"]
    for _ in range(800):
        source = "".join(rng.choice(bits) for _ in range(rng.randrange(30)))
        page = read_page(source)
        assert len(page.tag) == len(page.parent) and all(p < i for i, p in enumerate(page.parent))
        blocks(page, [True] * len(page.tag))
        text_of(source)
    text_of("<div>" * 5000 + "x")
    text_of('<a b="' * 3000)


def test_importance_of_nodes():
    row = {"parent": 0, "host": "h", "m": 100.0, "styles": 0, "style_pages": 0.0, "style_log": 0.0}
    import math

    same = row | {"node": 1, "texts": 1, "text_log": math.log(100)}  # one text in all pages
    apart = row | {"node": 2, "texts": 100, "text_log": 0.0}  # another in each
    got = style_tree.importance(pd.DataFrame([same, apart])).set_index("node")["imp"]
    assert got[1] == pytest.approx(0) and got[2] == pytest.approx(1)
    top = row | {"node": 3, "styles": 1, "style_pages": 100.0, "style_log": 100 * math.log(100), "texts": 0, "text_log": 0.0}
    got = style_tree.importance(pd.DataFrame([same | {"parent": 3}, top])).set_index("node")["imp"]
    assert got[3] == pytest.approx(0)  # always the same child with the same text


def test_site_noise_is_found_by_its_entropy(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(6))
    rows, want = [], {}
    for i in range(120):
        body = [" ".join(word() for _ in range(12)) for _ in range(rng.randrange(1, 5))]
        strip = f"<div class='strip'><span>Offer {i % 2}</span></div>"
        tail = "<div class='boxed'><p>Read us every day</p></div>"
        host = "one.example.com" if i % 3 else f"h{i}.example.com"
        rows.append((i, f"http://{host}/{i}", f"<body>{strip}<div class='story'>{''.join(f'<p>{b}</p>' for b in body)}</div>{tail}"))
        want[i] = "\n\n".join(body)
    rows += [(500, None, None), (501, "not a url", ""), (502, "http://one.example.com/x", "<article><p>Read us every day</p></article>"), (0, rows[0][1], rows[0][2])]
    want |= {500: "", 501: "", 502: "Read us every day"}
    frame = spark.createDataFrame([(*r, "n") for r in rows], "page_id long, url string, html string, nodes string")
    got = style_tree.extract(frame).collect()
    assert Counter((r["page_id"], r["url"]) for r in got) == Counter(r[:2] for r in rows)
    for r in got:
        assert r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"])
    assert style_tree.extract(frame.limit(0)).count() == 0


def test_repeated_articles_stay(spark):
    rows = [(i, "http://h.example.com/", "<article><h1>Same</h1><p>text</p></article><div class='x'>Same foot</div>") for i in range(60)]
    got = style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {"Same\n\ntext"}


@pytest.mark.parametrize("mark", ["<article><h1>T{a}</h1><div class='body'>text {a}</div></article>", "<h1>T{a}</h1><div class='body'><p>text {a}</p></div>"])
@pytest.mark.parametrize("articles", [1, 10])
def test_copies_of_a_page_count_once(spark, mark, articles):
    foot = "<div class='x'>Same foot</div><script>sid={i}</script><a href='?sid={i}'></a>"
    rows = [(i, f"http://h{i % 2 if articles == 1 else ''}.example.com/?sid={i}", (mark + foot).format(a=i % articles, i=i)) for i in range(300 * articles)]
    rows += [(10000 + i, f"http://o{i}.example.com/", (mark + foot).format(a=f"other {i}", i=i)) for i in range(20)]
    got = style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = Counter(r["text"] for r in got)
    assert texts == Counter([f"T{i % articles}\n\ntext {i % articles}" for i in range(300 * articles)] + [f"Tother {i}\n\ntext other {i}" for i in range(20)])


def some_pages(rng):
    rows = []
    for i in range(150):
        word = lambda: "".join(rng.choice("abcdefg") for _ in range(6))
        body = "".join(f"<p>{word()} {word()}</p>" for _ in range(rng.randrange(1, 4)))
        cards = "".join(f"<li><a href='x'>{rng.choice('abc')}</a>" for _ in range(rng.randrange(4)))
        rows.append((i, f"http://h{i % 4}.example.com/", f"<div class='strip'>Offer {i % 2}</div><div class='s'><div>{body}</div><ul class='m'>{cards}</ul></div><p class='f'>Foot</p>"))
    return rows


def test_importances_by_level_are_those_of_the_tree(spark):
    features = spark.createDataFrame(some_pages(random.Random(3)), "page_id long, url string, html string").select(style_tree.host_of(F.col("url")).alias("host"), F.lit(0).cast("long").alias("key"), "html").mapInArrow(style_tree._features, style_tree.FEATURES)
    sums = style_tree.staged(style_tree.node_sums(style_tree.feature_counts(features)).fillna(0.0), "nodes")
    got = {(r["host"], r["node"]): (r["m"], r["imp"]) for r in style_tree.importances(sums).collect()}
    want = {}
    for _, tree in sums.toPandas().groupby("host"):
        want |= {(r.host, r.node): (r.m, r.imp) for r in style_tree.importance(tree).itertuples()}
    assert set(got) == set(want) and len({round(v[1], 3) for v in got.values()}) > 5
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_no_host_is_one_group(spark):
    frame = spark.createDataFrame(some_pages(random.Random(4)), "page_id long, url string, html string")
    out = style_tree.extract(frame)
    assert "InPandas" not in Path(style_tree.__file__).read_text()
    few = {r["page_id"]: r["text"] for r in out.collect()}
    assert {r["page_id"]: r["text"] for r in style_tree.extract(frame, most_noisy=0).collect()} == few
    assert not any("Offer" in t or "Foot" in t for t in few.values())


def test_names_of_nodes():
    a, b = (style_tree._chain(read_page(f"<div id={x} class=k{x}1><p id={x}{x}>t</p></div>".replace(f"k{x}", "k"))) for x in "ab")
    assert a == b
    deep = style_tree._chain(read_page("<div>" * 500 + "x"))
    assert len(set(deep)) == style_tree.MOST_DEPTH + 1


CANONICAL = {
    "http://www.Example.com:80/a/?b=2&a=1#x": "example.com/a?a=1&b=2",
    "https://example.com/a?a=1&utm_source=q&b=2": "example.com/a?a=1&b=2",
    "https://u:p@example.com:8443": "example.com:8443/",
    "HTTP://example.com/A//": "example.com/A",
    "https://example.com/?ref=x&PHPSESSID=1": "example.com/",
    "not a url#x": "not a url",
}


def test_canonical(spark):
    frame = spark.createDataFrame([(u,) for u in CANONICAL] + [(None,)], "u string")
    got = {r[0]: r[1] for r in frame.select("u", warc.canonical(frame["u"])).collect()}
    assert got == CANONICAL | {None: None}


def a_record(kind, n, uri, date, http, more=""):
    body = http.encode()
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{n}>\r\nWARC-Target-URI: {uri}\r\nWARC-Date: {date}\r\n{more}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def test_parse_and_resolve(spark):
    full = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: 3\r\nETag: \"1\"\r\nCache-Control: a\r\nX: s\r\n\r\né!"
    data = b"".join([
        a_record("warcinfo", 0, "", "2024-01-01T00:00:00Z", "software: x"),
        a_record("response", 1, "http://e.com/p", "2024-01-01T00:00:00Z", full),
        a_record("response", 2, "http://e.com/p/", "2024-01-02T00:00:00Z", full.replace('"1"', '"2"')),
        a_record("response", 9, "http://e.com/p", "2024-01-02T12:00:00Z", full.replace("200 OK", "404 Not Found")),
        a_record("revisit", 3, "https://www.e.com/p#z", "2024-01-01T00:00:30Z", "HTTP/1.1 304 Not Modified\r\nETag: W/\"1\"\r\ncache-control: b\r\nCache-Control: c\r\nContent-Length: 0\r\nConnection: close\r\n\r\n"),
        a_record("revisit", 4, "http://e.com/p", "2024-01-05T00:00:00Z", "HTTP/1.1 304 Not Modified\r\nETag: \"1\"\r\n\r\n"),
        a_record("revisit", 5, "http://e.com/p", "2024-01-01T00:00:00Z", "HTTP/1.1 304 Not Modified\r\n\r\n"),
        a_record("revisit", 6, "http://e.com/p", "2024-01-05T00:00:00Z", "HTTP/1.1 304 Not Modified\r\nDate: d\r\n\r\n"),
        a_record("revisit", 7, "http://e.com/p", "2024-01-05T00:00:00Z", "HTTP/1.1 304 Not Modified\r\n\r\n", "WARC-Payload-Digest: sha1:NO\r\n"),
        a_record("revisit", 8, "http://e.com/p", "2024-01-05T00:00:00Z", "", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
    ])
    files = spark.createDataFrame([(bytearray(data), 1), (None, 2), (bytearray(b""), 3)], "content binary, status int")
    parsed = warc.parse(files, with_payload=True)
    assert parsed.count() == 9
    found = warc.resolve(parsed)
    got = {r["record_id"]: r for r in found.collect()}
    assert {k: (r["outcome"], r["original_id"]) for k, r in got.items()} == {
        "urn:3": ("resolved", "urn:1"), "urn:4": ("validator differs", None), "urn:5": ("no earlier response", None),
        "urn:6": ("resolved by date only", "urn:2"), "urn:7": ("validator differs", None),
    }
    assert [(h["name"], h["value"]) for h in got["urn:3"]["headers"]] == [("Content-Type", "text/html"), ("Content-Length", "3"), ("X", "s"), ("ETag", 'W/"1"'), ("cache-control", "b"), ("Cache-Control", "c")]
    assert bytes(warc.with_payloads(found, parsed).where("record_id = 'urn:3'").first()["payload"]) == "é!".encode()
    assert warc.resolve(warc.parse(files.limit(0))).count() == 0


@pytest.mark.parametrize("cut", [10, 120, -3])
def test_broken_warc(cut):
    data = a_record("response", 1, "http://e.com/", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\n\r\nbody")
    with pytest.raises(ValueError):
        list(warc.records(data[:cut]))


def test_resolve_against_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        kind = rng.choice(["response", "revisit"])
        url = rng.choice(["http://a.com/", "http://a.com/", "http://b.com/x", None])
        date = f"2024-01-{rng.randrange(1, 4):02d}T{rng.randrange(0, 24):02d}:{rng.randrange(0, 3):02d}:00Z" if rng.random() > 0.03 else None
        etag = rng.choice(['"1"', '"2"', None])
        headers = [("ETag", etag)] if etag else []
        rows.append((f"r{i:03d}", kind, url, date, None, None, 200 if kind == "response" and rng.random() > 0.1 else 304, headers, i))
    rows += rows[:5]
    schema = "record_id string, kind string, uri string, date string, profile string, payload_digest string, status int, headers array<struct<name:string,value:string>>, payload_bytes long"
    got = Counter((r["record_id"], r["outcome"], r["original_id"]) for r in warc.resolve(spark.createDataFrame(rows, schema)).collect())
    want = Counter()
    for r in rows:
        if r[1] != "revisit":
            continue
        earlier = [x for x in rows if x[1] == "response" and x[6] == 200 and r[2] and x[2] == r[2] and x[3] and r[3] and x[3] < r[3]]
        best = max(earlier, key=lambda x: (x[3], x[0]), default=None)
        tags = [dict(x[7]).get("ETag") for x in (r, best)] if best else []
        outcome = "no earlier response" if not best else "resolved by date only" if None in tags else "resolved" if tags[0] == tags[1] else "validator differs"
        want[(r[0], outcome, best[0] if best and outcome.startswith("resolved") else None)] += 1
    assert got == want


def test_crawl_of_pages(spark):
    pages = spark.createDataFrame([(i, f"http://h.com/{i}", "<p>é</p>" * i if i else None) for i in range(60)] + [(None, "u", "x"), (70, None, "x")], "page_id long, url string, html string")
    found = warc.resolve(warc.parse(captures.crawl(pages))).collect()
    outcomes = Counter(r["outcome"] for r in found)
    assert outcomes == {"resolved": 30, "validator differs": 12, "no earlier response": 6}
    for r in found:
        if r["outcome"] == "resolved":
            page = int(r["original_id"].split(":")[2])
            assert r["record_id"] == f"urn:page:{page}:1" and r["payload_bytes"] == len("<p>é</p>".encode()) * page
            assert re.search("max-age=600", str(r["headers"]))
