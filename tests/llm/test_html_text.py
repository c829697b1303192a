"""HTML extraction: fixed pages, known articles, and pairs against a brute-force version."""

import os
import random
import time
from collections import Counter

import pytest

from lodestone.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p><article>x</article>";</script></head><body class="no-comments">
<header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav><!-- ad <p>no</p> --><div class="ad">Buy<div>more</div> now</div><div class=cookie-notice>We use cookies</div>
<article><header><h1>Title&nbsp;here</h1></header><p>One <b>two</b>three.<br>four<p class="ad">advert para<p>five &lt;six&gt; &eacute;<aside>side</aside><form><input type=text> form</form>
<table><tr><td>a<td>b</tr></table><section id="comments"><article><p>comment one</p></article></section> tail</article><div class="sidebar">S</div><footer>&copy; f</footer></body></html>"""


def main_text(lines, marked, gone=()):
    return " ".join(lines[k].text for k in H.main_lines(lines, marked) if k not in gone)


def text(page, pair=None):
    """Of a page whose host has one other page."""
    lines, marked = H.parse(page)
    same = H.shared([x.text for x in lines], [x.text for x in H.parse(pair)[0]]) if pair else [False] * len(lines)
    same = {k for k, s in enumerate(same) if s}
    return main_text(lines, marked, H.deleted(H.weak(lines, marked), H.prose(lines, marked), same, same, marked))


def test_article_without_its_surroundings():
    assert text(PAGE) == "Title here One twothree. four five <six> é a b tail"


@pytest.mark.parametrize(
    "page, want",
    [
        ('<body><div class="layout has-sidebar"><main class="with-sidebar"><h1>T</h1><p>a<div class="related"><article><p>rel</p></article></div><p>b</main><div id="comments"><article>c1</article></div></div><footer>f</footer>', "T a b"),
        ('<div class="post has-comments"><h1>T</h1><p>real article text</p></div>', "T real article text"),
        ('<div class="related-story"><article><p>x y</p></article></div>', "x y"),
        ('<article><p>a</p><div class="share-price">1.20</div><div class="notice-board">n</div><div class="search-result">r</div><div class="share-links">tweet</div></article>', "a 1.20 n r"),
        ('<div class="sidebar"><h1>T</h1><p>all there is</p></div><footer>f</footer>', "T all there is"),
        ('<article><p>a <a href=/x/>link</a> b</p><div/>c</div><p>d</p></article><div class="commentList"><p>c1</p></div>', "a link b c d"),
        ("<article><p title=it's>one</p><p data-x=\"a>b\">two</p><p>5 < 6 & x</p></article>", "one two 5 < 6 & x"),
        ("<p>a<script>var x = '<p>no</p>'", "a"),
        ("<p>open <b", "open <b"),
        ("", ""),
    ],
)
def test_pages(page, want):
    assert text(page) == want


def test_shared_lines_go_from_unmarked_pages():
    a = '<body><div class="menu"><a href=x>m</a></div><h1>Own</h1><p>para one</p><p>Shared foot</p></body>'
    b = "<body><h1>Other</h1><p>para two</p><p>Shared foot</p></body>"
    assert text(a, b) == "Own para one" and text(a) == "Own para one Shared foot" and text(a, a) == "Own para one Shared foot"
    c = "<body><article><p>own</p><p><a href=1>read more</a></p><p>quoted line</p></article></body>"
    d = "<body><article><p><a href=1>read more</a></p><p>quoted line</p></article></body>"
    assert text(c, d) == "own"
    e = "<body><article><p>own</p><p>two</p><p>three</p><p>quoted line</p></article></body>"
    assert text(e, d) == "own two three" and text(d, e) == "read more quoted line"  # d: all its prose


def test_longest_common_subsequence():
    rnd = random.Random(1)
    for _ in range(1500):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        kept = [x for x, s in zip(a, H.shared(a, b), strict=True) if s]
        rest = iter(b)
        assert len(kept) == best[-1][-1] and all(x in rest for x in kept)


@pytest.mark.parametrize("unit", ["<a '", "<a b='", '<p x=">', "<a href=\"'", "</script", "<!--", "<p a=", "&", "<", '<div class="menu">', "<nav>", '<div class="menu"><p>', '<div class=ad><div class="menu">'])
@pytest.mark.parametrize("tail", ["", "</div></section></span>", "</body>"])
def test_malformed_pages_are_parsed_in_linear_time(unit, tail):
    t, n = time.time(), (1 << 20) // len(unit)
    H.parse("<p>a</p>" + unit * n + tail * (n if len(tail) > 10 else 1) + "<p>z</p>")
    assert time.time() - t < 8


def test_elements_inside_named_ones_end_with_them():
    assert text('<div class="menu"><div class="nav">x</div>y</div><p>z</p>') == "z"
    assert text('<div class="menu"><div class="comments">x</div><div>w</div>y</div><p>z</p>') == "z"
    assert text('<article>a<div class="share"><div class="social">s</div></div><p>b</p></article><p>c</p>') == "a b"
    assert text('<div class="menu">x<section><div class="nav">y</section>v</div><p>z</p>') == "z"
    assert text("<body><div class=menu>" * 3000 + "</body>" + "<p>z") == "z"


def test_template_lines_inside_marked_articles_go_and_quotations_stay(spark):
    rows = []
    for k in range(12):
        own = "".join(f"<p>own line {k} {j}</p>" for j in range(4))
        quote = "<p>A passage that two articles quote</p>" if k in (4, 5) else ""
        rows.append((k, f"http://h/{k:02d}", f"<body><article>{own}{quote}<p>Subscribe to our letter today</p></article></body>"))
    rows += [(20 + k, f"http://two/{k}", f"<article><p>a {k}</p><p>b {k}</p><p>Subscribe to our letter today</p></article>") for k in range(2)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert not any("Subscribe" in t for t in got.values()) and all("A passage" in got[k] for k in (4, 5)) and got[20] == "a 0 b 0"


def test_lcs_of_long_pages_is_bounded():
    rnd = random.Random(2)
    a, b = ([rnd.randrange(5000) for _ in range(20_000)] for _ in range(2))
    t = time.time()
    H.shared(a, b)
    assert time.time() - t < 20


def known_pages(n=240, hosts=3):
    """(page_id, url, html, article): template lines are the host's; some articles quote the same passage."""
    rnd = random.Random(9)
    words = lambda k: " ".join("".join(rnd.choices("abcdefghij", k=rnd.randint(2, 7))) for _ in range(k))
    quote, out = words(25), []
    template = {h: (words(6), words(9), words(12), words(5)) for h in range(hosts)}
    for k in range(n):
        h = k % hosts
        menu, notice, foot, more = template[h]
        paras = [words(rnd.randint(8, 60)) for _ in range(rnd.randint(2, 8))] + ([quote] if k % 5 == 0 else [])
        title = words(6)
        article = " ".join([title, *paras])
        body = "<h1>" + title + "</h1>" + "".join(f"<p>{p}</p>" for p in paras)
        if h == 0:  # a marked article
            page = f"<nav>{menu}</nav><div class=ad>{words(5)}</div><article>{body}<p><a href=/m>{more}</a></p></article><div id=comments><p>{words(20)}</p></div><footer>{foot}</footer>"
        elif h == 1:  # names only
            page = f"<div class='site-menu'>{menu}</div><div class='cookie-notice'>{notice}</div><div class='post has-sidebar'>{body}</div><div class='post-comments'><p>{words(9)}</p></div><div class='page-footer'>{foot}</div>"
        else:  # no marks at all: differencing decides
            page = f"<div>{menu}</div><div>{notice}</div><div>{body}</div><p>{more}</p><div>{foot}</div>"
        out.append((k, f"http://host{h}.example/{rnd.choice('abc')}/{k}", f"<html><body>{page}</body></html>", article))
    return out


def test_words_of_known_articles(spark):
    rows = known_pages()
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"] for r in H.extract(df).collect()}
    right = kept = there = 0
    for i, _, _, article in rows:
        a, b = Counter(article.split()), Counter(got[i].split())
        right, kept, there = right + (a & b).total(), kept + b.total(), there + a.total()
    assert right / kept > 0.99 and right / there > 0.97, (right / kept, right / there)


def brute(rows):
    """The texts by the rule of the docstring, a host at a time."""
    out, hosts = [], {}
    parsed = {}
    for i, url, page in rows:
        lines, marked = H.parse(page or "")
        host, path = ("", url or "") if not (url or "").startswith("http://") else ((url[7:].split("/", 1) + [""])[0], "/" + url[7:].split("/", 1)[1])
        key = tuple(x.text for x in lines)
        parsed[id(page), i, url] = (host, key, lines, marked)
        least = hosts.setdefault(host, {})
        least[key] = min(least.get(key, (path, i)), (path, i))
    pairs, held = {}, Counter()
    for host, least in hosts.items():
        order = sorted(least, key=lambda k: least[k])
        for at, key in enumerate(order):
            near = [order[k] for k in (at - 1, at + 1) if 0 <= k < len(order)]
            like = lambda k: len(os.path.commonprefix([least[key][0], least[k][0]]))  # noqa: B023, E731
            pair = max(near, key=like) if near else ()  # the first of equals: the one ahead
            pairs[host, key] = {k for k, s in enumerate(H.shared(list(key), list(pair))) if s}
            held.update({(host, key[k]) for k in pairs[host, key]})
    for i, url, page in rows:
        host, key, lines, marked = parsed[id(page), i, url]
        same = pairs[host, key]
        common = {k for k in same if 2 * held[host, key[k]] > len(hosts[host])}
        w, p, gone = H.weak(lines, marked), H.prose(lines, marked), set()
        if marked or not same.issuperset(w):
            gone |= same & set(w)
        if 2 * len(common & set(p)) <= len(p):
            gone |= common & set(p)
        out.append((i, url, main_text(lines, marked, gone)))
    return Counter(out)


def test_pairs_don_t_depend_on_partitions(spark):
    rows = [r[:3] for r in known_pages(150)]
    rows += [(1000 + k, f"http://host2.example/b/x{k}", rows[2][2]) for k in range(40)]  # copies under other paths
    want = brute(rows)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    try:
        for parts, shuffle in ((1, 1), (8, 4), (40, 23)):
            spark.conf.set("spark.sql.shuffle.partitions", shuffle)
            assert Counter(map(tuple, H.extract(df.repartition(parts)).select("page_id", "url", "text").collect())) == want
        assert Counter(map(tuple, H.extract(df, broadcast_lines=0).select("page_id", "url", "text").collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_extract(spark):
    long = "<body><article>" + "<p>word word</p>" * 20000 + "</article>"
    rows = [(1, "http://h/a", PAGE, "n"), (2, "http://h/b", PAGE, "n"), (2, "http://h/b", PAGE, "n"), (3, None, None, "n"), (4, "not a url", "", "n"), (5, "http://h/c", long, None), (None, "http://x/", "<p>a&nbsp;&amp; b", "n"), (6, "http://h/d", "<nav>only</nav>", "n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = H.extract(df).collect()
    want = Counter((i, u, text(h or "", PAGE if h == long else long if h == PAGE else None)) for i, u, h, _ in rows)
    assert Counter((r["page_id"], r["url"], r["text"]) for r in got) == want == brute([r[:3] for r in rows])
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert H.extract(df.limit(0)).count() == 0
