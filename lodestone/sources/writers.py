"""Files as the sink of a job: spreadsheets, tables in Markdown, HTML or CSV, and documents, written by all tasks.

``df.write.format("files")`` with the options path (a folder: a local or shared path, or a URI of a store that Arrow
knows), kind (xlsx, md, html, csv, or text), and for text the columns name and body: a file a row. The other kinds make a
file a task, ``part-00000.xlsx``. Files are written aside first. When all tasks have ended well they are moved to their
places and ``_SUCCESS`` is written; if one fails, nothing is left. With mode overwrite, what the folder had goes only then.
"""

from __future__ import annotations

import csv
import html
import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: A sheet's rows and a cell's characters, by the format.
SHEET_ROWS, CELL = 1_048_576, 32_767
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _plain(v: Any) -> str:
    return "" if v is None else str(v)


def column_name(n: int) -> str:
    out = ""
    while n >= 0:
        out, n = chr(65 + n % 26) + out, n // 26 - 1
    return out


def _cell(v: Any, at: str) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{at}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)) and v == v and abs(v) < 1e15:
        return f'<c r="{at}"><v>{v!r}</v></c>'
    text = html.escape(_CONTROL.sub("�", str(v))[:CELL], quote=False)
    return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def workbook(names: list[str], rows: Iterator[tuple], sheet_rows: int = SHEET_ROWS) -> Iterator[bytes]:
    """An xlsx file of the rows, on as many sheets as they need, each under the names; the file as one piece."""
    out = io.BytesIO()
    width = [column_name(k) for k in range(len(names))]
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        sheets, more = 0, True
        row = next(rows, None)
        while more:
            sheets += 1
            with z.open(f"xl/worksheets/sheet{sheets}.xml", "w") as f:
                f.write(b'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
                at, line = 1, tuple(names)
                while True:
                    f.write(f'<row r="{at}">{"".join(_cell(v, f"{c}{at}") for v, c in zip(line, width, strict=True))}</row>'.encode())
                    if row is None or at == sheet_rows:
                        break
                    at, line, row = at + 1, row, next(rows, None)
                f.write(b"</sheetData></worksheet>")
            more = row is not None
        many = range(1, sheets + 1)
        z.writestr("xl/workbook.xml", '<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="Sheet{k}" sheetId="{k}" r:id="rId{k}"/>' for k in many) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{k}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in many) + "</Relationships>")
        z.writestr("_rels/.rels", '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        sheet = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in many)
        z.writestr("[Content_Types].xml", f'<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{sheet}</Types>')
    yield out.getvalue()


def markdown(names: list[str], rows: Iterator[tuple]) -> Iterator[bytes]:
    line = lambda values: ("| " + " | ".join(re.sub(r"\s*\n\s*", "<br>", _plain(v)).replace("|", "\\|") for v in values) + " |\n").encode()
    yield line(names)
    yield line(["---"] * len(names))
    yield from map(line, rows)


def html_table(names: list[str], rows: Iterator[tuple]) -> Iterator[bytes]:
    line = lambda values, tag: ("<tr>" + "".join(f"<{tag}>{html.escape(_plain(v))}</{tag}>" for v in values) + "</tr>\n").encode()
    yield b"<table>\n" + line(names, "th")
    for r in rows:
        yield line(r, "td")
    yield b"</table>\n"


def comma_separated(names: list[str], rows: Iterator[tuple]) -> Iterator[bytes]:
    yield _csv_line(names)
    yield from map(_csv_line, rows)


def _csv_line(values: Any) -> bytes:
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerow([_plain(v) for v in values])
    return out.getvalue().encode()


KINDS = {"xlsx": workbook, "md": markdown, "html": html_table, "csv": comma_separated}


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]  # where a file is, and its place


class _Writer(DataSourceWriter):
    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool) -> None:
        self.kind, self.names, self.overwrite = options.get("kind", "csv"), list(schema.names), overwrite
        if self.kind != "text" and self.kind not in KINDS:
            raise ValueError(f"kind is one of text, {', '.join(KINDS)}")
        self.path, self.job = options["path"].rstrip("/"), uuid.uuid4().hex
        self.name, self.body = options.get("name", "name"), options.get("body", "body")
        self.aside = f"_writing-{self.job}"

    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def _put(self, fs, path: str, pieces: Iterator[bytes]) -> None:
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(path) as out:
            for piece in pieces:
                out.write(piece)

    def write(self, iterator: Iterator[Any]) -> _Written:
        from pyspark import TaskContext

        (fs, root), task = self._fs(), TaskContext.get()
        mine = f"{root}/{self.aside}/{task.partitionId():05d}-{task.taskAttemptId()}"
        if self.kind != "text":
            rows = map(tuple, iterator)
            first = next(rows, None)
            if first is None:
                return _Written([])
            chained = (r for part in ((first,), rows) for r in part)
            self._put(fs, f"{mine}/file", KINDS[self.kind](self.names, chained))
            return _Written([(f"{mine}/file", f"part-{task.partitionId():05d}.{self.kind}")])
        files = []
        for k, row in enumerate(iterator):
            name = _plain(row[self.name])
            if not name or name.startswith("/") or ".." in name.split("/"):
                raise ValueError(f"not the name of a file in the folder: {name!r}")
            self._put(fs, f"{mine}/{k}", iter([_plain(row[self.body]).encode()]))
            files.append((f"{mine}/{k}", name))
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        fs, root = self._fs()
        files = [f for m in messages if m is not None for f in m.files]
        names = [name for _, name in files]
        if len(set(names)) < len(names):
            fs.delete_dir(f"{root}/{self.aside}")
            raise ValueError("two rows have the name of one file")
        from pyarrow.fs import FileSelector

        fs.create_dir(root, recursive=True)
        if self.overwrite:
            for old in fs.get_file_info(FileSelector(root)):
                if old.base_name != self.aside:
                    fs.delete_dir(old.path) if old.is_file is False else fs.delete_file(old.path)
        for at, name in files:
            fs.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
            fs.move(at, f"{root}/{name}")
        if fs.get_file_info(f"{root}/{self.aside}").type.name == "Directory":
            fs.delete_dir(f"{root}/{self.aside}")
        self._put(fs, f"{root}/_SUCCESS", iter([b""]))

    def abort(self, messages: list[_Written | None]) -> None:
        fs, root = self._fs()
        if fs.get_file_info(f"{root}/{self.aside}").type.name == "Directory":
            fs.delete_dir(f"{root}/{self.aside}")


def in_mailbox(message: Column) -> Column:
    """A message as an entry of a mailbox (mbox): ``df.select(in_mailbox(...)).write.text(path)`` makes a mailbox a task."""
    quoted = F.regexp_replace(message, "(?md)^(>*From )", ">$1")
    return F.concat(F.lit("From - Mon Jan  1 00:00:00 2024\n"), quoted, F.lit("\n")).alias("value")


class Files(DataSource):
    @classmethod
    def name(cls) -> str:
        return "files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options), schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Files)
