"""File parsers: bytes or text to sections. Formats that need a state machine run in Arrow batches, the rest as Columns."""

from __future__ import annotations

import html as _html
import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from typing import Any
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionary
from ..functions.text import token_count
from ..operators.chunkers import delimiter_split, token_merge

SECTIONS = "doc_id string, position int, kind string, content string"


def sections(docs: DataFrame, id_col: str, body_col: str, parse: Callable[[Any], list[tuple[str, str]]]) -> DataFrame:
    """Apply a parser of one body to (kind, content) pairs, a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, positions, kinds, contents = [], [], [], []
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for n, (kind, content) in enumerate(parse(body) if body else []):
                    ids.append(i)
                    positions.append(n)
                    kinds.append(kind)
                    contents.append(content)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(positions, pa.int32()), pa.array(kinds, pa.string()), pa.array(contents, pa.string())], names=["doc_id", "position", "kind", "content"])

    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(body_col).alias("body")).mapInArrow(run, SECTIONS)


# --- plain text -------------------------------------------------------------------------------------------------------


def delimiters_of(spec: str) -> list[str]:
    """Single characters, and longer delimiters between backticks."""
    long = re.findall(r"`([^`]+)`", spec)
    return [*long, *dict.fromkeys(re.sub(r"`[^`]+`", "", spec))]


def text_chunks(c: Column, size: int = 128, spec: str = "\n!?;。；！？") -> Column:
    """Pieces at the delimiters, merged until over ``size`` tokens."""
    return token_merge(F.transform(delimiter_split(c, delimiters_of(spec)), lambda x: F.trim(x)), size)


# --- HTML -------------------------------------------------------------------------------------------------------------

_BLOCK = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "div", "article", "section", "aside", "ul", "ol", "li", "table", "pre", "code", "blockquote", "figure", "figcaption"}
_TITLES = {f"h{k}": "#" * k for k in range(1, 7)}


class _Html(HTMLParser):
    """Blocks in page order, tables whole."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str]] = []
        self.parts: list[str] = []
        self.skip, self.table, self.title, self.raw = 0, 0, "", []

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(("text", f"{self.title} {text}" if self.title else text))
        self.parts = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style", "noscript", "template"):
            self.skip += 1
        elif tag == "table":
            if not self.table:
                self.flush()
                self.raw = []
            self.table += 1
        if self.table:
            self.raw.append(f"<{tag}>")
        elif tag in _BLOCK:
            self.flush()
            self.title = _TITLES.get(tag, "")
        elif tag == "br":
            self.parts.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "noscript", "template"):
            self.skip = max(0, self.skip - 1)
        if self.table:
            self.raw.append(f"</{tag}>")
            if tag == "table":
                self.table -= 1
                if not self.table:
                    self.blocks.append(("table", "".join(self.raw)))
        elif tag in _BLOCK:
            self.flush()
            self.title = ""

    def handle_data(self, data: str) -> None:
        if not self.skip:
            (self.raw if self.table else self.parts).append(_html.escape(data, quote=False) if self.table else data)


def html_blocks(page: str) -> list[tuple[str, str]]:
    """Text blocks (headings with # marks), then tables."""
    p = _Html()
    p.feed(page)
    p.close()
    p.flush()
    return [b for b in p.blocks if b[0] == "text"] + [b for b in p.blocks if b[0] == "table"]


def html_sections(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    return sections(pages, id_col, html_col, html_blocks)


def hard_split(c: Column, size: int) -> Column:
    """A text of more than ``size`` words in pieces of that many."""
    words = F.filter(F.split(c, "\\s+"), lambda w: w != "")
    return F.when(F.size(words) <= size, F.array(c)).otherwise(F.transform(F.sequence(F.lit(1), F.size(words), F.lit(size)), lambda i: F.array_join(F.slice(words, i, size), " ")))


def block_chunks(blocks: DataFrame, size: int = 512) -> DataFrame:
    """Blocks of a document packed to at most ``size`` words; larger ones are cut hard."""
    packed = blocks.where("kind = 'text'").groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "content"))), lambda x: x["content"]).alias("_b"))
    pieces = F.flatten(F.transform("_b", lambda b: hard_split(b, size)))
    empty = F.array().cast("array<struct<n:int,c:string>>")

    def step(done: Column, x: Column) -> Column:
        last, n = F.try_element_at(done, F.lit(-1)), token_count(x).cast("int")
        joined = F.struct((last["n"] + n).cast("int").alias("n"), F.concat_ws("\n", last["c"], x).alias("c"))
        fits = (F.size(done) > 0) & (last["n"] + n <= size)
        return F.when(fits, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(F.struct(n.alias("n"), x.alias("c")))))

    out = packed.select("doc_id", F.posexplode(F.aggregate(pieces, empty, step)).alias("position", "x"))
    return out.select("doc_id", "position", F.col("x.c").alias("content"), F.col("x.n").alias("tokens"))


def split_table(table: str, budget: int) -> list[str]:
    """An HTML table in tables of whole rows with at most ``budget`` words each."""
    rows = re.findall(r"(?is)<tr\b.*?</tr>", table)
    out, run, n = [], [], 0
    for row in rows:
        words = len(re.sub(r"<[^>]+>", " ", row).split())
        if run and n + words > budget:
            out.append("<table>" + "".join(run) + "</table>")
            run, n = [], 0
        run.append(row)
        n += words
    return out + (["<table>" + "".join(run) + "</table>"] if run else [])


# --- JSON -------------------------------------------------------------------------------------------------------------


def is_json_lines(text: str) -> bool:
    """At least 80 % of the first ten lines parse."""
    lines = [x for x in text.splitlines() if x.strip()][:10]

    def good(x: str) -> bool:
        try:
            json.loads(x)
            return True
        except ValueError:
            return False

    return len(lines) > 1 and sum(map(good, lines)) >= 0.8 * len(lines)


def split_json(value: Any, size: int = 512) -> list[str]:
    """Nested values as JSON texts of at most about 2 x size characters, each with its full path; lists become index keys."""
    keyed = lambda v: {str(k): keyed(x) for k, x in (v.items() if isinstance(v, dict) else enumerate(v))} if isinstance(v, (dict, list)) else v
    room, out = 2 * size, []
    run: dict = {}

    def width(v: Any) -> int:
        return len(json.dumps(v, ensure_ascii=False))

    def put(path: list[str], v: Any) -> None:
        at = run
        for k in path[:-1]:
            at = at.setdefault(k, {})
        at[path[-1]] = v

    def walk(path: list[str], v: Any) -> None:
        nonlocal run
        if width(run) + width(v) < room or not isinstance(v, dict) or not v:
            if run and width(run) + width(v) >= room:
                out.append(run)
                run = {}
            put(path or ["value"], v)
            return
        for k, x in v.items():
            walk([*path, k], x)

    whole = keyed(value)
    if isinstance(whole, dict):
        for k, v in whole.items():
            walk([k], v)
    else:
        run = {"value": whole}
    return [json.dumps(x, ensure_ascii=False) for x in [*out, *([run] if run else [])]]


def json_blocks(text: str) -> list[tuple[str, str]]:
    values = []
    for part in text.splitlines() if is_json_lines(text) else [text]:
        try:
            values.append(json.loads(part))
        except ValueError:
            continue
    return [("json", x) for v in values for x in split_json(v)]


# --- Markdown ---------------------------------------------------------------------------------------------------------

_PIPE_TABLE = re.compile(r"(?m)^(?:[ \t]*\|.*\|[ \t]*\n)[ \t]*\|?(?:[ \t]*:?-+:?[ \t]*\|)+[ \t]*:?-*:?[ \t]*\n(?:[ \t]*\|.*\|[ \t]*(?:\n|$))*")
_HTML_TABLE = re.compile(r"(?is)<table\b.*?</table>")


def markdown_tables(text: str) -> tuple[list[str], str]:
    """Pipe and HTML tables, and the text without them."""
    found = [m[0].strip() for m in _PIPE_TABLE.finditer(text)] + [m[0] for m in _HTML_TABLE.finditer(text)]
    return found, _HTML_TABLE.sub("\n", _PIPE_TABLE.sub("\n", text))


def markdown_elements(text: str) -> list[tuple[str, str]]:
    """Header, code, list, quote and text blocks in order; a fence is one block whatever it holds."""
    out: list[tuple[str, str]] = []
    lines, k = text.split("\n"), 0

    def kind_of(line: str) -> str:
        if re.match(r"\s{0,3}#{1,6}\s", line):
            return "header"
        if re.match(r"\s*([-*+]|\d+[.)])\s", line):
            return "list"
        return "quote" if re.match(r"\s*>", line) else "text" if line.strip() else ""

    while k < len(lines):
        fence = re.match(r"\s*(```+|~~~+)", lines[k])
        start = k
        if fence:
            k += 1
            while k < len(lines) and not lines[k].strip().startswith(fence[1]):
                k += 1
            k = min(len(lines), k + 1)
            out.append(("code", "\n".join(lines[start:k])))
            continue
        kind = kind_of(lines[k])
        k += 1
        if not kind:
            continue
        while kind != "header" and k < len(lines) and not re.match(r"\s*(```+|~~~+)", lines[k]):
            after = kind_of(lines[k])
            if after == kind or (kind in ("list", "quote") and after == "text"):
                k += 1
            else:
                break
        out.append((kind, "\n".join(lines[start:k]).strip()))
    return out


def markdown_blocks(text: str) -> list[tuple[str, str]]:
    tables, rest = markdown_tables(text)
    return markdown_elements(rest) + [("table", t) for t in tables]


# --- Office and book formats (zipped XML) --------------------------------------------------------------------------------


def _tag(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


def docx_blocks(data: bytes) -> list[tuple[str, str]]:
    """Paragraphs and tables of a .docx in order."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml"))
    text = lambda e: "".join(t.text or "" if _tag(t) == "t" else "\n" if _tag(t) == "br" else "" for t in e.iter())
    out = []
    for e in next(x for x in body if _tag(x) == "body"):
        if _tag(e) == "p" and text(e).strip():
            out.append(("text", text(e).strip()))
        elif _tag(e) == "tbl":
            rows = [[text(c).strip() for c in r if _tag(c) == "tc"] for r in e if _tag(r) == "tr"]
            out.append(("table", "<table>" + "".join("<tr>" + "".join(f"<td>{_html.escape(c, quote=False)}</td>" for c in r) + "</tr>" for r in rows) + "</table>"))
    return out


def docx_links(data: bytes) -> list[tuple[str, str]]:
    """Hyperlink targets of a .docx."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        name = "word/_rels/document.xml.rels"
        rels = ElementTree.fromstring(z.read(name)) if name in z.namelist() else []
    return [("link", r.get("Target", "")) for r in rels if r.get("Type", "").endswith("/hyperlink")]


def embedded_files(data: bytes) -> list[tuple[str, str]]:
    """Names of the files embedded in an Office document."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return [("file", n) for n in z.namelist() if re.search(r"/(embeddings|media)/", n)]


def pptx_blocks(data: bytes) -> list[tuple[str, str]]:
    """A section a slide; shapes from top to bottom, then left to right."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
        slides = [ElementTree.fromstring(z.read(n)) for n in names]
    out = []
    for slide in slides:
        shapes = []
        for sp in (e for e in slide.iter() if _tag(e) == "sp"):
            off = next((e for e in sp.iter() if _tag(e) == "off"), None)
            lines = ["".join(t.text or "" for t in p.iter() if _tag(t) == "t") for p in sp.iter() if _tag(p) == "p"]
            at = (int(off.get("y", 0)), int(off.get("x", 0))) if off is not None else (0, 0)
            shapes.append((*at, "\n".join(x for x in lines if x.strip())))
        out.append(("slide", "\n".join(t for *_, t in sorted(shapes) if t)))
    return out


def epub_blocks(data: bytes) -> list[tuple[str, str]]:
    """Chapters in spine order."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("META-INF/container.xml"))
        opf = next(e.get("full-path") for e in root.iter() if _tag(e) == "rootfile")
        package = ElementTree.fromstring(z.read(opf))
        items = {e.get("id"): e.get("href") for e in package.iter() if _tag(e) == "item"}
        base = opf.rpartition("/")[0]
        out = []
        for ref in (e.get("idref") for e in package.iter() if _tag(e) == "itemref"):
            name = f"{base}/{items[ref]}" if base else items[ref]
            if ref in items and name in z.namelist():
                out += html_blocks(z.read(name).decode("utf-8", "replace"))
    return out


def xlsx_rows(data: bytes) -> dict[str, list[list[str]]]:
    """Sheets of a .xlsx as rows of texts."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        text = lambda e: "".join(t.text or "" for t in e.iter() if _tag(t) == "t")
        shared = [text(e) for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        titles = [e.get("name") for e in book.iter() if _tag(e) == "sheet"]
        files = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n[len("xl/worksheets/") :])[0]))
        out = {}
        for title, name in zip(titles, files, strict=False):
            rows = []
            for r in (e for e in ElementTree.fromstring(z.read(name)).iter() if _tag(e) == "row"):
                cells: list[str] = []
                for c in r:
                    at = 0
                    for ch in re.match(r"[A-Z]+", c.get("r", "") or "A")[0]:
                        at = at * 26 + ord(ch) - 64
                    value = next((v.text or "" for v in c if _tag(v) == "v"), text(c))
                    cells += [""] * (at - 1 - len(cells)) + [shared[int(value)] if c.get("t") == "s" and value else value]
                rows.append(cells)
            out[title] = rows
    return out


def excel_blocks(data: bytes, form: str = "rows", rows_per_table: int = 256) -> list[tuple[str, str]]:
    """Rows as ``header: value; ...``, or HTML tables of at most 256 rows, or one Markdown table a sheet."""
    out = []
    for title, rows in xlsx_rows(data).items():
        if not rows:
            continue
        head, body = rows[0], rows[1:]
        if form == "rows":
            suffix = "" if title.lower().startswith("sheet") else f" ——{title}"
            out += [("row", "; ".join(f"{h}: {v}" if h else v for h, v in zip(head, r, strict=False) if v) + suffix) for r in body if any(r)]
        elif form == "html":
            cell = lambda tag, r: "<tr>" + "".join(f"<{tag}>{_html.escape(x, quote=False)}</{tag}>" for x in r) + "</tr>"
            for k in range(0, max(1, len(body)), rows_per_table):
                out.append(("table", f"<table><caption>{_html.escape(title)}</caption>" + cell("th", head) + "".join(cell("td", r) for r in body[k : k + rows_per_table]) + "</table>"))
        else:
            line = lambda r: "| " + " | ".join(r) + " |"
            out.append(("table", "\n".join([line(head), "|" + " --- |" * len(head), *map(line, body)])))
    return out


#: Parser of each extension; models (figures, layout, OCR, remote PDF parsers) are plugged in by ``register``.
PARSERS: dict[str, Callable[[Any], list[tuple[str, str]]]] = {
    "html": html_blocks, "htm": html_blocks, "json": json_blocks, "jsonl": json_blocks, "md": markdown_blocks, "docx": docx_blocks, "pptx": pptx_blocks,
    "epub": epub_blocks, "xlsx": excel_blocks, "txt": lambda t: [("text", x.strip()) for x in t.split("\n") if x.strip()],
}
_BINARY = {"docx", "pptx", "epub", "xlsx"}


def register(extension: str, parser: Callable[[bytes], list[tuple[str, str]]], binary: bool = True) -> None:
    PARSERS[extension] = parser
    if binary:
        _BINARY.add(extension)


def parse_files(files: DataFrame, id_col: str = "path", content: str = "content") -> DataFrame:
    """Sections of binaryFile rows by extension; a file that no parser knows or that is broken gives one ``error`` row."""
    parsers, binary = dict(PARSERS), set(_BINARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, positions, kinds, contents = [], [], [], []
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ext = (i or "").rpartition(".")[2].lower()
                try:
                    found = parsers[ext](body if ext in binary else (body or b"").decode("utf-8", "replace"))
                except Exception as e:  # one bad file must not end the job
                    found = [("error", f"{type(e).__name__}: {e}")]
                for n, (kind, text) in enumerate(found):
                    ids.append(i)
                    positions.append(n)
                    kinds.append(kind)
                    contents.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(positions, pa.int32()), pa.array(kinds, pa.string()), pa.array(contents, pa.string())], names=["doc_id", "position", "kind", "content"])

    return files.select(F.col(id_col).cast("string").alias("doc_id"), F.col(content).alias("body")).mapInArrow(run, SECTIONS)


# --- résumés ----------------------------------------------------------------------------------------------------------


def resume_fields(docs: DataFrame, id_col: str, text_col: str, dictionaries: dict[str, list[str]]) -> DataFrame:
    """E-mail, phone and years by pattern; degree, school, region and industry as the dictionary words that occur, found by one
    automaton of each dictionary: words of their own, the longest where they overlap, each once and in lower case."""
    c = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.select(
        F.col(id_col).alias("doc_id"),
        F.regexp_extract(c, "[\\w.+-]+@[\\w-]+\\.[\\w.]+", 0).alias("email"),
        F.regexp_extract(c, "\\+?\\d[\\d ()-]{7,}\\d", 0).alias("phone"),
        F.regexp_extract(c, "(\\d{1,2})\\+? years", 1).try_cast("int").alias("years"),
        c.alias("_text"),
    )
    for name, words in sorted(dictionaries.items()):
        out = out.withColumn(name, dictionary.terms_in(F.col("_text"), words, docs.sparkSession))
    return out.drop("_text")
