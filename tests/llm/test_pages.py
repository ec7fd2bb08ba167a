"""URL verdicts against a plain model, and rendered pages."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from math import log

import pytest

from tillstar.llm import html_text, url_filter

PAGES = [
    "https://www.example.com/en/1",
    "https://a.www.example.com/en/1",
    "https://b.example.com/en/x?q#f",
    "HTTP://EXAMPLE.COM/de/",
    "http://x.net/es/1",
    "http://x.net/fr/1",
    "http://x.net/de/1",
    "http://net/es/",
    "http://example.com",
    "http://example.com?a=/en/",
    "no scheme",
    "",
    None,
    "://",
    "http://y.org/a://b/c",
]


def parts(url):
    after = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", after).group()
    path = re.match(r"[^?#]*", after[len(host) :]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def decided(host, path):
    best = None
    for verdict, own, start in url_filter.RULES:
        fits = (host == own or host.endswith("." + own)) and path.startswith(start)
        if fits and (best is None or len(own + start) > len(best[0])):
            best = (own + start, verdict)
    return best or (None, None)


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(4)
    urls = [f"https://{h}.{d}/{p}/{rng.randrange(999)}" for _ in range(40)
            for h in ("shop", "spam") for d in ("example.com", "site.net", "site.org")
            for p in ("en", "es")]
    return spark.createDataFrame(list(enumerate(PAGES + urls)), "page_id long, url string")


def test_urls_against_a_plain_model(pages):
    order = url_filter.ORDER
    rows = pages.collect()
    known = [(r.url, decided(*parts(r.url))[1]) for r in rows]
    known = [(u, v) for u, v in known if v]
    aside = [(u, v) for u, v in known if zlib.crc32(u.encode()) % 5 == 0]
    models = {}
    for verdict in ("allow", "block"):
        follow: dict = {}
        total = 0
        for u, v in known:
            if v == verdict and (u, v) not in aside:
                padded = url_filter.START * order + u
                for at in range(order, len(padded)):
                    total += 1
                    for k in range(order + 1):
                        follow.setdefault(padded[at - k : at], Counter())[padded[at]] += 1
        least = max(total / url_filter.CONTEXT_SHARE, 2)
        models[verdict] = {c: f for c, f in follow.items() if not c or f.total() >= least}

    def chance(model, context, char):
        shorter = chance(model, context[1:], char) if context else 1 / url_filter.ALPHABET
        if context not in model:
            return shorter
        f = model[context]
        return (f[char] + len(f) * shorter) / (f.total() + len(f))

    def ratio(u):
        padded = url_filter.START * order + (u or "")
        sums = {v: sum(log(chance(m, padded[k - order : k], padded[k])) for k in range(order, len(padded)))
                for v, m in models.items()}
        return (sums["block"] - sums["allow"]) / len(u) if u else 0.0

    found = {r.page_id: r for r in url_filter.judged(pages).collect()}
    step = url_filter.STEP
    scores = [(int(ratio(u) // step), v) for u, v in aside]
    share = {v: sum(x == v for _, x in scores) for v in ("allow", "block")}
    gains = {}
    for cut in {s for s, _ in scores}:
        left = sum(s <= cut and v == "allow" for s, v in scores) / share["allow"]
        right = sum(s > cut and v == "block" for s, v in scores) / share["block"]
        gains[(cut + 1) * step] = left + right
    threshold = max(gains, key=lambda t: (gains[t], t))
    assert len(found) == len(rows)
    for r in rows:
        got, (host, path) = found[r.page_id], parts(r.url)
        rule, verdict = decided(host, path)
        assert (got.host, got.path, got.rule) == (host, path, rule)
        assert got.score == pytest.approx(ratio(r.url), abs=1e-9)
        told = "block" if ratio(r.url) > threshold else "allow"
        if verdict or abs(ratio(r.url) - threshold) > 1e-6:
            assert got.verdict == (verdict or told)


def test_urls_without_training_rows(spark):
    few = spark.createDataFrame([(1, None), (2, "http://x.org/")], "page_id long, url string")
    assert {r.verdict for r in url_filter.judged(few).collect()} == {"allow"}
    assert url_filter.judged(few.limit(0)).count() == 0


def test_contexts_count_alike_at_every_size(spark):
    rng = random.Random(14)
    urls = [f"https://{h}/{rng.randrange(10**9)}" for _ in range(2500)
            for h in ("www.example.com/en", "b.example.com/en", "x.org")]
    order, models = url_filter.ORDER, {"allow": {}, "block": {}}
    for u in urls:
        verdict = decided(*parts(u))[1]
        if verdict and zlib.crc32(u.encode()) % 5:
            padded = url_filter.START * order + u
            for at in range(order, len(padded)):
                for k in range(order + 1):
                    models[verdict].setdefault(padded[at - k : at], Counter())[padded[at]] += 1
    # Beyond 40,000 characters, contexts of few occurrences count as they do below.
    assert min(m[""].total() for m in models.values()) > 60_000

    def chance(model, context, char):
        shorter = chance(model, context[1:], char) if context else 1 / url_filter.ALPHABET
        f = model.get(context, Counter())
        if context and f.total() < 2:
            return shorter
        return (f[char] + len(f) * shorter) / (f.total() + len(f))

    def ratio(u):
        padded = url_filter.START * order + u
        both = [[chance(models[v], padded[k - order : k], padded[k]) for k in range(order, len(padded))]
                for v in ("allow", "block")]
        return sum(log(b) - log(a) for a, b in zip(*both, strict=True)) / len(u)

    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: r.score for r in url_filter.judged(df).collect()}
    assert len(found) == len(urls)
    for k in range(0, len(urls), 25):
        assert found[k] == pytest.approx(ratio(urls[k]), abs=1e-9)


FIXTURES = [
    (None, ""),
    ("", ""),
    ("plain  text", "plain text"),
    ("a < b & c", "a < b & c"),
    ("<p>One<p>two <b>bold</b>er", "One\n\ntwo bolder"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>", "* a\n* b\n\n  3. c\n  4. d"),
    ("x<div hidden>no</div><i style='display:none'>no</i><script>if(a<b)</p></script>y", "xy"),
    ("<head><title>t</title><meta x></head><body>shown", "shown"),
    ("<pre>\n a\n   b</pre>", "a\n   b"),
    (
        "<table><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td>b<td>22</table>",
        "Name   N\nalpha  1\nb      22",
    ),
    ("<table><tr><td colspan=2>wide one<tr><td>a<td>b</table>", "wide one\na  b"),
    ("one<br>two</b></p>three", "one\ntwo\n\nthree"),
    ("&lt;tag&gt; &copy; &#x41;", "<tag> © A"),
    ("<!-- never ends <p>x", ""),
    ("<p title='a>b' class=x>in", "in"),
    ("<p don't>in</p>out", "in\n\nout"),
    ("<dl><dt>T<dd>D</dl><blockquote>q</blockquote>z", "T\n    D\n\n    q\n\nz"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000 + " end", "deep\nend"),
]


@pytest.mark.parametrize("html, text", FIXTURES)
def test_visible_text(html, text):
    expected = text.strip() if html and "<pre>" in html else text
    assert html_text.visible_text(html).strip() == expected


def test_pages_keep_their_columns(spark):
    rows = [(k, h, "old") for k, (h, _) in enumerate(FIXTURES)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_text.with_text(df)
    assert got.columns == ["page_id", "html", "text"]
    assert {r.page_id: r.text for r in got.collect()} == {
        k: html_text.visible_text(h) for k, (h, _) in enumerate(FIXTURES)
    }
    assert html_text.with_text(df.limit(0)).count() == 0


def test_deep_elements_are_laid_out_like_others():
    def deep(inner, levels=400):
        return "<div>" * levels + inner + "</div>" * levels

    assert html_text.visible_text(deep("a<p hidden>no</p><i style='display:none'>no</i>b")) == "ab"
    assert html_text.visible_text(deep("<ul><li>a<li>b</ul>")) == "* a\n* b"
    assert html_text.visible_text(deep("<table><tr><td>aa<td>b<tr><td>c<td>d</table>")) == "aa  b\nc   d"
    # The end tags of deep elements do not end a hidden ancestor of the same name.
    hidden = "<div>" * 120 + "<div hidden>" + deep("no") + "no</div>yes"
    assert html_text.visible_text(hidden) == "yes"
    assert html_text.visible_text("<b>" * 50_000 + "x") == "x"
    assert html_text.visible_text("<div>" * 50_000 + "x") == "x"
