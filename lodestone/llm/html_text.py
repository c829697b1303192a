"""HTML main text by nearest-URL page differencing.

Every page is cut to text lines. The different pages of a host are ordered by URL path, and each is paired with the one
of its two neighbours whose path has more in common with its own (the one ahead on a tie). Lines of the two are aligned
by longest common subsequence, and what both share is taken for the template's.

Differencing alone deletes right text (articles quote whole lines of one another) and leaves wrong text (menus and
adverts drawn anew for each page). So a shared line goes, but prose inside an element marked as the article only if it is
shared on more than half of the host's different pages: a quotation isn't. Markup is the second evidence: a line of its
own stays unless it lies in an element of menus, headers, footers, notices, adverts, forms, hidden parts or reader
comments, or outside the article of a page that marks one.

A page is parsed once, and its html is never shuffled: line hashes and the lines of the article are written, pairs meet
in a table of hashes ordered by (host, path), and line numbers are deleted. The text of a page doesn't depend on how rows
are partitioned.

Defined cases: null or empty html has no text; a null or malformed URL belongs to the host ''; pages of a host with
equal lines are one page, at the least of their paths; a host with one different page has no pair; a page without a
marked article all of whose lines are shared keeps them, and an article most of whose prose would go keeps it; very long pages are parsed whole, in linear time; repeated rows
have equal texts; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import html
import math
import re
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_texts, join_hot, map_arrow, stored

BOILER, ASIDE, BODY, ARTICLE = 0, 1, 2, 3

# Elements, roles and names that mark what isn't the article.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
DROPPED = {"nav", "footer", "aside", "form", "head", "svg", "canvas", "button", "select", "dialog", "menu", "object", "video", "audio", "map"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
#: Names of what is no layout of an article's wrapper either.
NEVER_AROUND = {"comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "related", "recommended", "ad", "ads", "adv", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion"}
#: Names that may also be those of a wrapper around the article.
MAYBE_AROUND = {
    "banner", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "masthead", "topbar", "footer", "sidebar", "aside", "widget", "share", "sharing",
    "social", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "search",
    "pagination", "pager", "alert", "toolbar", "skip",
}
#: Words around a name that leave its meaning as it is, and words ahead of it that turn it into a flag of the layout.
PLAIN_WORDS = {"list", "box", "bar", "area", "section", "block", "container", "wrapper", "wrap", "links", "posts", "articles", "items", "inner", "panel", "slot", "unit", "content", "left", "right", "top", "bottom", "primary", "secondary", "thread", "form", "row"}
FLAG_WORDS = {"has", "with", "no", "without", "is", "not", "hide", "show", "enable", "disable"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav",
    "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SELF_CLOSED = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r">|=\s*[\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[a-z]+|[0-9]+")
_HUMPS = re.compile(r"(?<=[a-z])(?=[A-Z])")
_MAIN = re.compile(r"role\s*=\s*[\"']?main\b|itemprop\s*=\s*[\"']?articleBody\b")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Line(NamedTuple):
    text: str
    zone: int
    links: float  # share of the characters inside links


def named(value: str) -> set[str]:
    """The names of NEVER_AROUND, MAYBE_AROUND and 'header' that a class or id has, as a word of its own or as the last
    telling word of a compound: ``comment-list`` is comment, ``share-price`` and ``has-comments`` are nothing."""
    out = set()
    for token in value.split():
        words = _WORDS.findall(_HUMPS.sub("-", token).lower())
        if words and words[0] not in FLAG_WORDS:
            while len(words) > 1 and (words[-1] in PLAIN_WORDS or words[-1].isdigit()):
                words.pop()
            out.add(words[-1])
    return out & (NEVER_AROUND | MAYBE_AROUND | {"header"})


class _Parser:
    def __init__(self, page: str) -> None:
        self.lines: list[Line] = []
        self.marked = False
        # (element, zone ahead of it, whether an article may lie inside) of the elements that change the zone, and the
        # elements open inside each of them.
        self._open: list[tuple[str, int, bool]] = []
        self._depths: list[dict[str, int]] = []
        # Open elements by name, those that change the zone and those inside them; and how many of _open end all articles.
        self._there: dict[str, int] = {}
        self._never = 0
        self._zone, self._parts, self._linked, self._in_link = BODY, [], 0, 0
        self._parse(page)

    def _parse(self, page: str) -> None:
        at, end, last, quotes = 0, len(page), page.rfind(">"), True
        ends = {q: page.rfind(q) for q in "\"'"}
        while at < end:
            k = page.find("<", at)
            if k < 0 or k > last:  # no tag ends behind here
                break
            if k > at:
                self._text(page[at:k])
            m = _NAME.match(page, k + 1 + (page[k + 1] == "/"))
            if page.startswith("<!--", k):
                stop = page.find("-->", k + 4)
                at = end if stop < 0 else stop + 3
                continue
            if page[k + 1] in "!?":
                at = page.find(">", k) + 1
                continue
            if m is None:
                self._text("<")
                at = k + 1
                continue
            stop = m.end()
            while True:  # the end of the tag: the first > outside a quoted value
                s = _STOP.search(page, stop) if quotes else None
                if s is None:  # quotes that don't pair: they count for nothing from here on
                    quotes, stop = False, page.find(">", m.end())
                    break
                if s[0] == ">":
                    stop = s.start()
                    break
                q = s[0][-1]
                stop = page.find(q, s.end()) + 1 if s.end() <= ends[q] else s.end()
            tag, at = m[0].lower(), stop + 1
            if page[k + 1] == "/":
                self._end(tag)
            elif tag in RAW:
                close = re.compile(f"</{tag}\\b", re.IGNORECASE).search(page, at)
                at = page.find(">", close.end()) + 1 if close else end
                at = at or end
                if tag in BLOCKS:
                    self._flush()
            else:
                self._start(tag, page[m.end() : stop])
        if at < end:
            self._text(page[at:])
        self._flush()

    def _text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self._parts.append(text)
        if self._in_link:
            self._linked += len(text)

    def _flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.lines.append(Line(text, self._zone, min(1.0, self._linked / len(text))))
        self._parts, self._linked = [], 0

    def _drops(self, tag: str, attributes: str) -> tuple[int | None, bool]:
        """The zone of a dropped element (None: not dropped), and whether it may be a wrapper of the article."""
        if tag in DROPPED or (tag == "header" and self._zone != ARTICLE):
            return BOILER, False
        if "=" not in attributes and "hidden" not in attributes:
            return None, False
        names: set[str] = set()
        for name, *values in _ATTRIBUTE.findall(attributes):
            value, name = "".join(values), name.lower()
            low = value.lower()
            if (name == "hidden" and low != "until-found") or (name == "role" and low in DROPPED_ROLES) or (name == "aria-hidden" and low == "true") or (name == "style" and _HIDDEN.search(value)):
                return BOILER, False
            if name in ("class", "id") and tag not in ("html", "body"):
                found = named(value)
                if self._zone == ARTICLE or tag in ("article", "main"):
                    found.discard("header")
                names |= found & NEVER_AROUND if tag in ("article", "main") else found
        if not names:
            return None, False
        return (BOILER, False) if names & NEVER_AROUND else (ASIDE, True)

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self._flush()
            while self._open and self._open[-1][0] in SELF_CLOSED and (tag == self._open[-1][0] or self._open[-1][0] == "p"):
                self._close()
        if tag in VOID or (tag in ("svg", "math") and attributes.rstrip().endswith("/")):
            return
        if tag == "a":
            self._in_link += 1
        zone, around = self._drops(tag, attributes) if not self._never else (None, False)
        if zone is not None:
            self._enter(tag, min(zone, self._zone), around)
        elif not self._never and (tag in ("article", "main") or _MAIN.search(attributes)):
            self._enter(tag, ARTICLE, True)
            self.marked = True
        elif self._depths:
            self._depths[-1][tag] = self._depths[-1].get(tag, 0) + 1
            self._there[tag] = self._there.get(tag, 0) + 1

    def _enter(self, tag: str, zone: int, around: bool) -> None:
        self._flush()
        self._open.append((tag, self._zone, around))
        self._zone = zone
        self._depths.append({tag: 1})
        self._there[tag] = self._there.get(tag, 0) + 1
        self._never += not around

    def _close(self) -> None:
        self._flush()
        _, self._zone, around = self._open.pop()
        self._never -= not around
        for tag, n in self._depths.pop().items():
            self._there[tag] -= n

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        if tag == "a":
            self._in_link = max(0, self._in_link - 1)
        while self._open:
            inside = self._depths[-1]
            if inside.get(tag, 0) > 0:
                inside[tag] -= 1
                self._there[tag] -= 1
                if tag == self._open[-1][0] and inside[tag] == 0:
                    self._close()
                return
            # The end of an element opened further out: what is open inside it ends with it.
            if tag not in ("body", "html") and not (self._there.get(tag, 0) > 0 and (tag in BLOCKS or tag in DROPPED)):
                return
            self._close()


def parse(page: str) -> tuple[list[Line], bool]:
    """The text lines of a page in order, and whether it marks its article. A page with nothing outside elements that
    are only named like a sidebar or a notice has its body there."""
    p = _Parser(page)
    if not any(x.zone > ASIDE for x in p.lines):
        return [x._replace(zone=BODY) if x.zone == ASIDE else x for x in p.lines], False
    return p.lines, p.marked and any(x.zone == ARTICLE for x in p.lines)


def weak(lines: list[Line], marked: bool) -> list[int]:
    """Numbers of the lines that go if the pair shares them: a marked article's mostly linked ones, or any of a body."""
    return [k for k, x in enumerate(lines) if (x.zone == ARTICLE and x.links > 0.5 if marked else x.zone == BODY)]


def prose(lines: list[Line], marked: bool) -> list[int]:
    """Numbers of the lines of a marked article that go if the pair shares them and most pages of the host do so."""
    return [k for k, x in enumerate(lines) if marked and x.zone == ARTICLE and x.links <= 0.5]


def main_lines(lines: list[Line], marked: bool) -> list[int]:
    """Numbers of the article's lines, by markup alone."""
    zone = ARTICLE if marked else BODY
    return [k for k, x in enumerate(lines) if x.zone == zone]


def deleted(weak: list[int], prose: list[int], shared: set[int], common: set[int], marked: bool) -> set[int]:
    """The lines that go: ``shared`` with the pair; of these ``common``, on most pages of the host. Where more than half of an
    article's prose is common the pages are versions of one article, and where a body without an article is shared whole
    nothing is left: neither is a template."""
    gone, lines = shared.intersection(weak), common.intersection(prose)
    if not marked and len(gone) == len(weak):
        return set()
    return gone | lines if 2 * len(lines) <= len(prose) else gone


def shared(a: list, b: list) -> list[bool]:
    """Which lines of ``a`` are in a longest common subsequence with ``b``.

    Rows of the table are bits of one integer; every sqrt(n)-th is kept and those between are made again on the way back.
    """
    low, high = 0, 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    return [True] * low + _shared(a[low : len(a) - high], b[low : len(b) - high]) + [True] * high


def _shared(a: list, b: list) -> list[bool]:
    out = [False] * len(a)
    known, places = set(a), {}
    for k, x in enumerate(x for x in b if x in known):
        places[x] = places.get(x, 0) | 1 << k
    n = sum(1 for x in b if x in known)
    lines = [(i, x) for i, x in enumerate(a) if x in places]  # the others are in no common subsequence
    if not lines:
        return out
    full, step = (1 << n) - 1, math.isqrt(len(lines)) + 1

    def rows_from(row: int, start: int) -> list[int]:
        rows = [row]
        for _, x in lines[start : start + step]:
            hit = row & places[x]
            row = ((row + hit) | (row - hit)) & full
            rows.append(row)
        return rows

    kept = [full]
    for start in range(0, len(lines), step):
        kept.append(rows_from(kept[-1], start)[-1])
    j = n
    for block in range((len(lines) - 1) // step, -1, -1):
        rows = rows_from(kept[block], block * step)
        for k in range(len(rows) - 2, -1, -1):
            mask = (1 << j) - 1
            row, before = rows[k + 1], rows[k]
            if (row & mask).bit_count() < (before & mask).bit_count():  # the length up to b[:j] grows with this line
                out[lines[block * step + k][0]] = True
                grown = j - (row & mask).bit_count() - 1  # length ahead of this match
                lo, hi = 0, j
                while lo < hi:  # the shortest b[:mid] in which this line makes it longer than that
                    mid = (lo + hi) // 2
                    have = mid - (before & ((1 << mid) - 1)).bit_count()
                    gets = mid - (row & ((1 << mid) - 1)).bit_count()
                    if gets > grown and gets > have:
                        hi = mid
                    else:
                        lo = mid + 1
                j = lo - 1
    return out


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def pages_of(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Rows page_id, url, _html, _host, _path, _key (the md5 of the html)."""
    page = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), page.alias("_html"))
    host = F.coalesce(F.lower(F.try_parse_url("url", F.lit("HOST"))), F.lit(""))
    path = F.coalesce(F.try_parse_url("url", F.lit("PATH")), F.col("url"), F.lit(""))
    return rows.withColumn("_host", host).withColumn("_path", path).withColumn("_key", F.unhex(F.md5("_html")))


def lines_of(pages: DataFrame) -> DataFrame:
    """The pages' lines, written once: hashes of all, numbers of those that differencing may delete, the article's text."""
    schema = (
        f"_host string, _path string, page_id {dict(pages.dtypes)['page_id']}, url string, _key binary, print binary, hashes array<long>, "
        "weak array<int>, prose array<int>, marked boolean, main array<int>, texts array<string>"
    )

    def cut(batch: pa.RecordBatch) -> dict:
        out: dict = {n: [] for n in ("hashes", "weak", "prose", "marked", "print", "main", "texts")}
        for raw in byte_texts(batch.column(5)):
            lines, marked = parse(raw.decode("utf-8", "replace"))
            main = main_lines(lines, marked)
            text = [x.text.encode("utf-8", "replace") for x in lines]
            values = ([xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in text], weak(lines, marked), prose(lines, marked), marked, xxhash.xxh3_128_digest(b"\n".join(text)), main, [lines[k].text for k in main])
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        return out | {n: batch.column(k) for k, n in enumerate(("_host", "_path", "page_id", "url", "_key"))}

    return stored(map_arrow(pages.select("_host", "_path", "page_id", "url", "_key", "_html"), schema, cut), "page-lines")


def shared_lines(lined: DataFrame, parts: int) -> DataFrame:
    """Rows (_host, _key, gone): numbers of the lines of ``lines_of`` that go; pages that lose none have no row."""
    # One row a different text of a host, in the order of its least place, over ranges of that order.
    order = ["_host", "_path", "page_id", "print"]
    texts = lined.groupBy("_host", "print").agg(F.min(F.struct("_path", "page_id")).alias("_at"), F.first("hashes").alias("hashes"))
    texts = texts.select("_host", "print", "_at.*", "hashes").repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id())
    texts = stored(texts, "page-order")
    inside = Window.partitionBy("range").orderBy(*order)
    page = F.struct("_host", "_path", "hashes")
    near = texts.select("*", F.lag(page).over(inside).alias("ahead"), F.lead(page).over(inside).alias("behind"))
    # The neighbours over the borders of ranges: a row a range, so as many rows as there are partitions.
    ends = texts.groupBy("range").agg(F.min(F.struct(*order, "hashes")).alias("_first"), F.max(F.struct(*order, "hashes")).alias("_last"))
    over = Window.partitionBy(F.lit(0)).orderBy("range")
    border = lambda c: F.struct(*(F.col(f"{c}.{n}") for n in ("_host", "_path", "hashes")))
    ends = ends.select("range", F.lag(border("_last")).over(over).alias("_before"), F.lead(border("_first")).over(over).alias("_after"))
    near = near.join(F.broadcast(ends), "range").withColumn("ahead", F.coalesce("ahead", "_before")).withColumn("behind", F.coalesce("behind", "_after"))
    own = lambda c: F.when(F.col(f"{c}._host") == F.col("_host"), F.col(c))
    near = near.select("_host", "print", "_path", "hashes", own("ahead").alias("ahead"), own("behind").alias("behind")).where("ahead is not null or behind is not null")

    def aligned(batch: pa.RecordBatch) -> dict:
        found = []
        for path, mine, ahead, behind in zip(*(batch.column(n).to_pylist() for n in ("_path", "hashes", "ahead", "behind")), strict=True):
            pair = ahead or behind
            if ahead and behind and _common(path, behind["_path"]) > _common(path, ahead["_path"]):
                pair = behind
            found.append([{"line": k, "hash": mine[k]} for k, s in enumerate(shared(mine, pair["hashes"])) if s])
        return {"_host": batch.column(0), "print": batch.column(1), "shared": found}

    aligned_rows = map_arrow(near.select("_host", "print", "_path", "hashes", "ahead", "behind"), "_host string, print binary, shared array<struct<line: int, hash: long>>", aligned)
    same = stored(aligned_rows.where(F.size("shared") > 0), "page-shared")
    # A host's common lines are shared on more than half of its different pages, so they are at most twice what a page shares.
    held = same.select("_host", F.explode(F.array_distinct("shared.hash")).alias("hash")).groupBy("_host", "hash").agg(F.count("*").alias("_n"))
    hosts = texts.groupBy("_host").agg(F.count("*").alias("_pages"))
    common = held.join(hosts, "_host").where("2 * _n > _pages").groupBy("_host").agg(F.collect_set("hash").alias("common"))
    same = join_hot(same, stored(common, "page-common"), "_host", F.col("print"), "left")
    often = F.when(F.col("common").isNotNull(), F.filter("shared", lambda x: F.array_contains("common", x["hash"]))["line"])
    same = same.select("_host", "print", F.col("shared.line").alias("shared"), F.coalesce(often, F.array().cast("array<int>")).alias("often"))
    # Many pages may have one text: its row meets them in 16 parts.
    salt = F.pmod(F.xxhash64("_key"), F.lit(16))
    mine = lined.where((F.size("weak") > 0) | (F.size("prose") > 0)).select("_host", "print", "_key", "weak", "prose", "marked", salt.alias("salt")).dropDuplicates(["_host", "_key"])
    met = mine.join(same.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(15).cast("long")))), ["_host", "print", "salt"])

    none, gone, lines = F.array().cast("array<int>"), F.array_intersect("weak", "shared"), F.array_intersect("prose", "often")  # as deleted() has it
    body = F.when(~F.col("marked") & (F.size(gone) == F.size("weak")), none).otherwise(gone)
    met = met.select("_host", "_key", F.concat(body, F.when(2 * F.size(lines) <= F.size("prose"), lines).otherwise(none)).alias("gone"))
    return stored(met.where(F.size("gone") > 0), "page-gone")


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_lines: int = 2_000_000) -> DataFrame:
    """Rows page_id, url, text, n_chars."""
    lined = lines_of(pages_of(pages, id_col, url_col, html_col))
    parts = max(8, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    gone = shared_lines(lined, parts)
    total = gone.agg(F.coalesce(F.sum(F.size("gone") + 8), F.lit(0))).first()[0]
    rows = lined.select("_host", "_key", "page_id", "url", "main", "texts")
    if total <= broadcast_lines:
        joined = rows.join(F.broadcast(gone), ["_host", "_key"], "left")
    else:  # copies of one page spread over 16 parts
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(16)))
        spread = gone.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(15).cast("long"))))
        joined = rows.join(spread, ["_host", "_key", "_salt"], "left")
    left = F.filter("texts", lambda x, k: ~F.array_contains("gone", F.get("main", k)))
    text = F.array_join(F.when(F.col("gone").isNull(), F.col("texts")).otherwise(left), " ")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
