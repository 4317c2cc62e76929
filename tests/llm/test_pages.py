"""Archives, main text and URL rules."""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetwatch.llm import html, urls, warc
from fleetwatch.llm.queries import QUERIES, RULES

SF = "/root/testdata/sf0.001"
PAGES = [
    (1, "http://a.example.com/en/x", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (3, None, None), (4, "http://c", ""),
    (None, "http://d\r\nX: y", "<p>ünïcode 漢</p>"), (5, "http://e", "x" * 300_000), (5, "http://e", "x" * 300_000),
    (2, "http://b/", "<p>same</p>"), (6, "http://f", "WARC/1.1\r\n\r\nnot a record\r\n\r\n"),
]
SCHEMA = "page_id long, url string, html string"


def digest(body):
    return base64.b32encode(hashlib.sha1((body or "").encode()).digest()).decode()


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, SCHEMA).withColumns({c: F.lit(1) for c in ("key", "payload", "shard", "digest", "_key")})


@pytest.mark.parametrize("shard, roll", [(64 << 20, 16 << 20), (10, 200)])
def test_archive_round_trip(spark, pages, tmp_path, shard, roll):
    manifest = warc.write_warc(pages, str(tmp_path / "a"), shard_bytes=shard, roll_bytes=roll)
    assert manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    out = warc.read_warc(spark, str(tmp_path / "a")).collect()
    first = {}
    for i, _, body in PAGES:
        first[digest(body)] = max(first.get(digest(body), -1), -1 if i is None else i)
    want = Counter()
    for i, _, body in PAGES:
        top = first[digest(body)]
        again = top != (-1 if i is None else i)
        want[i, len((body or "").encode()), digest(body), "revisit" if again else "response", top if again else None] += 1
    assert Counter((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
    whole = {(r.key, bytes(r.payload)) for r in out if r.payload is not None}
    assert (None, PAGES[4][2].encode()) in whole and (6, PAGES[8][2].encode()) in whole
    assert not [p for p in (tmp_path / "a").iterdir() if p.name.startswith("_temporary")]


def test_archive_is_deterministic(spark, pages, tmp_path):
    warc.write_warc(pages, str(tmp_path / "a"), shard_bytes=100, roll_bytes=300)
    warc.write_warc(pages.repartition(5), str(tmp_path / "b"), shard_bytes=100, roll_bytes=300)
    files = lambda d: {p.name: p.read_bytes() for p in Path(tmp_path / d).glob("*.warc.gz")}
    assert files("a") == files("b") and len(files("a")) > 2
    name, data = sorted(files("a").items())[0]
    assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and name.startswith("shard-00000000")


def test_small_payloads_are_responses(spark, pages, tmp_path):
    warc.write_warc(pages, str(tmp_path / "a"), min_revisit_bytes=100)
    kinds = Counter(r.record_type for r in warc.read_warc(spark, str(tmp_path / "a")).collect())
    assert kinds == {"response": len(PAGES)}


def test_damage_is_found(spark, pages, tmp_path):
    warc.write_warc(pages, str(tmp_path / "a"))
    victim = sorted((tmp_path / "a").glob("*.warc.gz"))[0]
    victim.write_bytes(victim.read_bytes()[:-40])
    with pytest.raises(Exception, match="ends inside|error|Error"):
        warc.read_warc(spark, str(tmp_path / "a")).collect()


def test_empty_archive(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.write_warc(empty, str(tmp_path / "a")).count() == 0
    assert warc.read_warc(spark, str(tmp_path / "a")).count() == 0


# Main text

ARTICLE = "<h1>Title</h1><p>First paragraph, with <b>bold</b> words and a comma.</p><p>Second &amp; last one; it ends.</p>"
TEXT = "Title\n\nFirst paragraph, with bold words and a comma.\n\nSecond & last one; it ends."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<html><body></body></html>", ""), ("  \n ", ""), ("plain text only", "plain text only"),
        (f"<body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article>{ARTICLE}</article><footer>&copy; x</footer></body>", TEXT),
        (f"<body><div class='ad'>Buy now.</div><div id='main-text'>{ARTICLE}</div><div class='sidebar'>Other news.</div></body>", TEXT),
        (f"<article>{ARTICLE}<section class='comments'><p>{'Nice text, really. ' * 30}</p></section></article>", TEXT),
        (f"<article>{ARTICLE}<form><p>Name, please.</p></form><aside>More.</aside></article><script>var t='</p>';</script>", TEXT),
        (f"<div class='cookie-notice'><p>{'We use cookies, as you know. ' * 20}</p></div><main>{ARTICLE}</main>", TEXT),
        ("<article><p>a < b and\n\n c &lt; d<br>next<p>unclosed <b>bold<p>last</article>", "a < b and c < d next\n\nunclosed bold\n\nlast"),
        ("<article><ul><li>one<li>two</ul><!-- <p>no</p> --><p>three</p></article>", "one\n\ntwo\n\nthree"),
        ("<article><p>Only.</p></article><div class='ad'>A much longer advert, with commas, and more.</div>", "Only."),
        ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>Body text.</p></article>", "Title\n\nBody text."),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page",
    [
        f"<article style='overflow:hidden' title='hidden' aria-hidden='false' data-role='banner'>{ARTICLE}</article>",
        *(f"<body><div class='{c}'><article>{ARTICLE}</article></div></body>" for c in ("page has-sidebar", "no-sidebar", "header-fixed")),
        *(f"<body><div class='{c}'><div>{ARTICLE}</div></div></body>" for c in ("post category-social", "page sidebar", "x' role='form")),
        f"<body><form action='/x'><div class='ad'>Buy.</div><div>{ARTICLE}</div></form></body>",
        f"<body><form id='f'><article>{ARTICLE}</article><form class='search'><p>Find.</p></form></form></body>",
        f"<body><select><article>{ARTICLE}</article></body>",
        f"<body><article>{ARTICLE}</article><p hidden>Some words, hidden.</p><style>p {{}}<p>More.</p></body>",
    ],
)
def test_labels_of_wrappers_lose_no_article(page):
    assert html.main_text(page) == TEXT


BODY = "".join(f"<p>Paragraph {i} of the story, which has some words, and ends here.</p>" for i in range(9))
STORY = "\n\n".join(f"Paragraph {i} of the story, which has some words, and ends here." for i in range(9))
CARDS = "".join(f"<article><h3><a href='/{i}'>Teaser {i}</a></h3><p>A short teaser, of one line.</p></article>" for i in range(3))
LINKS = "".join(f"<li><a href='/{i}'>Another page {i}</a></li>" for i in range(12))


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div class='post'>{BODY}</div><div class='more'>{CARDS}</div></body>",
        f"<body><div class='more'>{CARDS}</div><div class='wrap'><div class='post'>{BODY}</div>{CARDS}</div></body>",
        f"<body><article>{BODY}<ul>{LINKS}</ul></article></body>",
        f"<body><div class='x'><p>A line outside.</p></div><main>{BODY}</main></body>",
    ],
)
def test_weight_of_text_picks_the_content(page):
    assert html.main_text(page) == STORY


def test_main_text_without_article_element():
    body = "".join(f"<p>Paragraph {i}, which has some words, and ends here.</p>" for i in range(8))
    links = "".join(f"<li><a href='/{i}'>Entry {i}</a></li>" for i in range(20))
    page = f"<body><div class='top'><ul>{links}</ul></div><div class='body'><h2>Head</h2>{body}</div><div class='low'><a href='x'>Contact</a></div></body>"
    out = html.main_text(page).split("\n\n")
    assert out[0] == "Head" and len(out) == 9 and "Entry" not in " ".join(out)


@pytest.mark.parametrize(
    "inner",
    [
        '<img alt="a > b {}">', "<img alt='a > b {}'>", '<img data-x = "{} > c" hidden>', '<span class="ad">BUY {}</span>', "<span hidden>x<span>y</span>{}</span>",
        '<b id="cookie-notice">We use {}</b>', '<i role="alert">{}</i>',
    ],
)
def test_values_and_labelled_inline_elements_are_no_text(inner):
    page = f"<article><p>One sentence here, and more.</p><p>Two {inner.format('y' * 10_000)}words.</p></article>"
    assert html.main_text(page) == "One sentence here, and more.\n\nTwo words."


def test_quotes_that_nothing_closes():
    page = "<p title=it's>It's <a href=x title=\"open>fine</a> and good" + "<i title='>x</i>" * 3
    assert html.main_text(page) == "It's fine and goodxx"  # the second value runs from the first quote to the next


def test_deep_pages_take_linear_time():
    import time

    start = time.process_time()
    assert len(html.main_text("<div>x" * 50_000)) == 3 * 50_000 - 2
    assert html.main_text("<div>" * 50_000 + "</x>" * 50_000 + "words") == "words"
    assert html.main_text("<p title=" * 50_000).startswith("<p title=")  # no tag ends
    assert time.process_time() - start < 6


def test_main_text_survives_odd_markup():
    for page in ("<" * 5000, "<p " * 2000, "<a href=\"" * 500, "<div>" * 3000 + "deep" + "</div>" * 3000, "&" * 1000, "<script>" + "x" * 9999):
        assert isinstance(html.main_text(page), str)


def test_extract_column(spark):
    df = spark.createDataFrame([(1, f"<article>{ARTICLE}</article>"), (2, None)], "text int, html string")
    assert sorted(tuple(r) for r in df.select("text", html.extract(F.col("html")).alias("t")).collect()) == [(1, TEXT), (2, "")]
    assert df.limit(0).select(html.extract(F.col("html"))).count() == 0


def test_articles_of_pages(spark):
    rows = QUERIES["op5_main_text"](spark, SF).collect()
    assert rows and all(r.n_chars == len(r.text) > 0 for r in rows)


# URL rules


def brute(url, rules):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:n].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), rest[n:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


URLS = [
    None, "", "no scheme", "http://EXAMPLE.com/en/", "https://www.example.com/en/x?y#z", "ftp://a.b.example.com/en", "http://net/fr/a",
    "http://notnet/fr/a", "http://x.net/fr/://y", "http://com", "http://com/", "http://É.Com/?q", "http://", "http:///p", "a://b://c/d",
    "http://example.com/EN/", "http://example.com:80/en/", "http://a..net/es/", "http://line\nbreak.net/es/\nq", "http://example.com/english",
] * 2
MORE = (*RULES, ("example.com", "/en", "block"), ("example.com", "/en", "allow"), ("b.example.com", "", "block"), ("", "/", "block"))


@pytest.mark.parametrize("rules", [RULES, MORE, ()])
def test_url_rules(spark, rules):
    table = spark.createDataFrame([(i, u) for i, u in enumerate(URLS[:20])] * 2 + [(None, "http://com/")], "page_id long, url string")
    table = table.withColumns({c: F.lit(0) for c in ("host", "path", "rule", "verdict", "_key", "_url", "best")})
    out = urls.judge_urls(table, spark.createDataFrame(list(rules), "host string, path string, verdict string"))
    usable = [r for r in rules if r[0]]
    want = Counter({(i, *brute(u, usable)): 2 for i, u in enumerate(URLS[:20])}) + Counter([(None, *brute("http://com/", usable))])
    assert Counter(tuple(r) for r in out.collect()) == want
    assert urls.judge_urls(table.limit(0), spark.createDataFrame(list(RULES), "host string, path string, verdict string")).count() == 0
