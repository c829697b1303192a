"""Connectors as Spark sources.

Five reader contracts come down to one shape: a lister of items and a fetcher of pages, behind the Python Data Source API.
``load`` reads all, ``poll`` a window (start, end], ``slim`` ids only, ``checkpoint`` is the stream reader's offset, and
``fingerprint`` a column to compare. Services differ in their ``Endpoint``: address, paging, items' path and field names;
the client that does the requests is passed in, so that tests and private networks use their own.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta, timezone
from email.utils import parsedate_to_datetime
from math import ceil
from typing import Any
from urllib.parse import urlencode
from urllib.request import Request, urlopen
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, SimpleDataSourceStreamReader

ITEM_SCHEMA = "id string, title string, content string, link string, updated_at timestamp, fingerprint string, metadata map<string,string>"


@dataclass(frozen=True)
class Endpoint:
    """How a service lists its items."""

    url: str
    items: str = ""  # path of the list in the response, by dots
    id: str = "id"
    title: str = "title"
    content: tuple[str, ...] = ("content",)
    updated: str = "updated_at"
    link: str = "url"
    paging: str = "none"  # none, page, offset or cursor
    page_param: str = "page"
    size_param: str = "per_page"
    size: int = 100
    cursor_path: str = "next_cursor"
    first_page: int = 1
    headers: tuple[tuple[str, str], ...] = ()
    params: tuple[tuple[str, str], ...] = ()
    metadata: tuple[str, ...] = ()
    format: str = "json"
    body: tuple[tuple[str, str], ...] | None = None  # fields of a JSON body: the request is then a POST, and paging goes there
    next_url: str = ""  # path of the next page's address in the response, which is then called as it is
    next_call: str = ""  # where the pages after the first are asked for, if elsewhere; only the cursor is sent there
    since: str = ""  # parameters of the listing that bound the update time, where it has them
    until: str = ""
    epoch: bool = False  # whether these are seconds since 1970 rather than ISO text
    splits: tuple[str, ...] = ("",)  # one partition each: spaces, repositories, channels; fills {split} in the url


#: Shapes of the services' public listing APIs; account-specific parts are braces to fill in.
SERVICES: dict[str, Endpoint] = {
    "airtable": Endpoint("https://api.airtable.com/v0/{split}", "records", "id", "fields.Name", ("fields",), "createdTime", paging="cursor", page_param="offset", size_param="pageSize", cursor_path="offset"),
    "asana": Endpoint("https://app.asana.com/api/1.0/projects/{split}/tasks", "data", "gid", "name", ("notes",), "modified_at", "permalink_url", "cursor", "offset", "limit", cursor_path="next_page.offset"),
    "bitbucket": Endpoint("https://api.bitbucket.org/2.0/repositories/{split}/pullrequests", "values", "id", "title", ("description",), "updated_on", "links.html.href", "page", "page", "pagelen"),
    "box": Endpoint("https://api.box.com/2.0/folders/{split}/items", "entries", "id", "name", ("description",), "modified_at", paging="offset", page_param="offset", size_param="limit"),
    "confluence": Endpoint("https://{split}/wiki/rest/api/content", "results", "id", "title", ("body.storage.value",), "version.when", "_links.webui", "offset", "start", "limit"),
    "dingtalk": Endpoint("https://api.dingtalk.com/v1.0/notable/bases/{split}/records", "records", "id", "fields.title", ("fields",), "lastModifiedTime", paging="cursor", page_param="nextToken", size_param="maxResults", cursor_path="nextToken"),
    "discord": Endpoint("https://discord.com/api/v10/channels/{split}/messages", "", "id", "author.username", ("content",), "timestamp", paging="last", page_param="before", size_param="limit"),
    "dropbox": Endpoint("https://api.dropboxapi.com/2/files/list_folder", "entries", "id", "name", ("path_display",), "server_modified", paging="cursor", page_param="cursor", size_param="limit", cursor_path="cursor", body=(("path", "{split}"), ("recursive", "true")), next_call="https://api.dropboxapi.com/2/files/list_folder/continue"),
    "github": Endpoint("https://api.github.com/repos/{split}/issues", "", "id", "title", ("body",), "updated_at", "html_url", "page"),
    "gitlab": Endpoint("https://gitlab.com/api/v4/projects/{split}/issues", "", "id", "title", ("description",), "updated_at", "web_url", "page"),
    "gmail": Endpoint("https://gmail.googleapis.com/gmail/v1/users/{split}/messages", "messages", "id", "snippet", ("snippet",), "internalDate", paging="cursor", page_param="pageToken", size_param="maxResults", cursor_path="nextPageToken"),
    "google_drive": Endpoint("https://www.googleapis.com/drive/v3/files", "files", "id", "name", ("description",), "modifiedTime", "webViewLink", "cursor", "pageToken", "pageSize", cursor_path="nextPageToken"),
    "jira": Endpoint("https://{split}/rest/api/2/search", "issues", "key", "fields.summary", ("fields.description",), "fields.updated", "self", "offset", "startAt", "maxResults", first_page=0),
    "moodle": Endpoint("https://{split}/webservice/rest/server.php", "courses", "id", "fullname", ("summary",), "timemodified", params=(("wsfunction", "core_course_get_courses_by_field"), ("moodlewsrestformat", "json"), ("wstoken", "{token}"))),
    "notion": Endpoint("https://api.notion.com/v1/databases/{split}/query", "results", "id", "properties.Name", ("properties",), "last_edited_time", "url", "cursor", "start_cursor", "page_size", headers=(("Notion-Version", "2022-06-28"),), body=()),
    "onedrive": Endpoint("https://graph.microsoft.com/v1.0/users/{split}/drive/root/children", "value", "id", "name", ("description",), "lastModifiedDateTime", "webUrl", size_param="$top", next_url="@odata.nextLink"),
    "outlook": Endpoint("https://graph.microsoft.com/v1.0/users/{split}/messages", "value", "id", "subject", ("body.content",), "lastModifiedDateTime", "webLink", size_param="$top", next_url="@odata.nextLink"),
    "salesforce": Endpoint("https://{split}/services/data/v60.0/query", "records", "Id", "Name", ("Description",), "LastModifiedDate", params=(("q", "SELECT Id, Name, Description, LastModifiedDate FROM Account ORDER BY Id"),), next_url="nextRecordsUrl"),
    "seafile": Endpoint("https://{split}/api2/repos/", "", "id", "name", ("desc",), "mtime"),
    "sharepoint": Endpoint("https://graph.microsoft.com/v1.0/sites/{split}/drive/root/children", "value", "id", "name", ("description",), "lastModifiedDateTime", "webUrl", size_param="$top", next_url="@odata.nextLink"),
    "slack": Endpoint("https://slack.com/api/conversations.history?channel={split}", "messages", "ts", "user", ("text",), "ts", paging="cursor", page_param="cursor", size_param="limit", cursor_path="response_metadata.next_cursor"),
    "teams": Endpoint("https://graph.microsoft.com/v1.0/teams/{split}/messages", "value", "id", "subject", ("body.content",), "lastModifiedDateTime", "webUrl", size_param="$top", next_url="@odata.nextLink"),
    "zendesk": Endpoint("https://{split}/api/v2/help_center/articles.json", "articles", "id", "title", ("body",), "updated_at", "html_url", next_url="next_page"),
}


def at_path(value: Any, path: str) -> Any:
    """``a.b.0`` in nested dicts and lists; a key with dots wins over its parts."""
    if not path:
        return value
    if isinstance(value, dict) and path in value:
        return value[path]
    head, _, rest = path.partition(".")
    if isinstance(value, dict):
        return at_path(value.get(head), rest)
    if isinstance(value, list) and head.isdigit():
        return at_path(value[int(head)] if int(head) < len(value) else None, rest)
    return None


def http_client(url: str, headers: dict[str, str], data: bytes | None = None) -> str:
    with urlopen(Request(url, data, headers), timeout=60) as r:
        return r.read().decode("utf-8", "replace")


def to_time(v: Any) -> datetime | None:
    """ISO text, e-mail dates, or seconds (milliseconds) since the epoch, in UTC."""
    if v in (None, ""):
        return None
    try:
        number = float(v)
        return datetime.fromtimestamp(number / 1000 if number > 1e11 else number, timezone.utc)
    except (TypeError, ValueError):
        pass
    try:
        t = datetime.fromisoformat(str(v).replace("Z", "+00:00"))
    except ValueError:
        try:
            t = parsedate_to_datetime(str(v))
        except (TypeError, ValueError):
            return None
    return t if t.tzinfo else t.replace(tzinfo=timezone.utc)


def plain(v: Any) -> str:
    text = v if isinstance(v, str) else "" if v is None else json.dumps(v, ensure_ascii=False, sort_keys=True)
    return re.sub(r"\s+", " ", re.sub(r"<[^>]*>", " ", text)).strip() if "<" in text else text


def _typed(v: str) -> Any:
    return {"true": True, "false": False}.get(v, v)


def _bounds(e: Endpoint, start: datetime | None, end: datetime | None) -> dict[str, str]:
    """The parameters that ask the service for a window; what it sends beside it is left out afterwards."""
    shown = lambda t: str(int(t.timestamp())) if e.epoch else t.astimezone(timezone.utc).isoformat().replace("+00:00", "Z")
    up = lambda t: t + timedelta(seconds=1) if e.epoch and t.microsecond else t
    return {n: v for n, v in ((e.since, start and shown(start)), (e.until, end and shown(up(end)))) if n and v}


def pages_of(e: Endpoint, split: str, client: Callable[..., str], start: datetime | None = None, end: datetime | None = None) -> Iterator[Any]:
    """The items of a listing, page after page until one is empty or names no next. Pages go by number, offset, cursor, the
    last item's id, or an address in the response; of a POST, size and cursor are in the body."""
    number, cursor, following, seen = (0 if e.paging == "offset" else e.first_page), None, "", set()
    token = next((v.removeprefix("Bearer ") for k, v in e.headers if k == "Authorization"), "")
    fill = lambda v: v.replace("{split}", split).replace("{token}", token)
    while True:
        paged = e.paging != "none" or bool(e.next_url)
        params = {k: fill(v) for k, v in e.params} | _bounds(e, start, end)
        fields = params if e.body is None else {k: _typed(fill(v)) for k, v in e.body}
        if paged and e.size_param:
            fields[e.size_param] = str(e.size) if e.body is None else e.size
        if e.paging in ("page", "offset"):
            fields[e.page_param] = str(number)
        elif cursor:
            if e.next_call:
                fields.clear()
            fields[e.page_param] = str(cursor)
        url = following or (e.next_call if cursor and e.next_call else fill(e.url))
        query = {} if following else params if e.body is None else {k: fill(v) for k, v in e.params}
        url += ("&" if "?" in url else "?") + urlencode(query) if query else ""
        headers = dict(e.headers)
        got = client(url, headers) if e.body is None else client(url, headers | {"Content-Type": "application/json"}, json.dumps(fields).encode())
        body = json.loads(got)
        items = at_path(body, e.items) or []
        yield from items
        cursor = at_path(body, e.cursor_path) if e.paging == "cursor" and at_path(body, "has_more") is not False else at_path(items[-1], e.id) if e.paging == "last" and len(items) >= e.size else None
        following = at_path(body, e.next_url) or "" if e.next_url else ""
        if following.startswith("/"):
            following = "/".join(fill(e.url).split("/")[:3]) + following
        more = following or cursor or (e.paging in ("page", "offset") and len(items) >= e.size)
        if not items or not more:
            return
        if more in seen and more is not True:  # a service that names the same page again
            raise RuntimeError(f"{url}: the listing goes in circles at {more}")
        seen.add(more)
        number += e.size if e.paging == "offset" else 1


def item_row(e: Endpoint, item: Any) -> tuple:
    import hashlib

    content = "\n".join(x for x in (plain(at_path(item, p)) for p in e.content) if x)
    raw = json.dumps(item, ensure_ascii=False, sort_keys=True)
    meta = {m: plain(at_path(item, m)) for m in e.metadata}
    return (str(at_path(item, e.id)), plain(at_path(item, e.title)), content, plain(at_path(item, e.link)), to_time(at_path(item, e.updated)), hashlib.md5(raw.encode()).hexdigest(), meta)


def _as_typed(kind: str, text: str) -> str | None:
    """An Atom content whose type says that it is no markup, as it is: text, or base64 of other media; None for the others."""
    if kind == "text" or (kind.startswith("text/") and kind not in ("text/html", "text/xml")):
        return text
    if "/" in kind and not kind.startswith("text/") and not kind.endswith(("/xml", "+xml")):
        return base64.b64decode(text).decode("utf-8", "replace")
    return None


def feed_rows(xml: str) -> list[tuple]:
    """Entries of an RSS or Atom feed. One without any content has a null; Atom content with a type other than markup is
    taken to the letter."""
    import hashlib

    name = lambda e: e.tag.rpartition("}")[2]
    out = []
    for e in (x for x in ElementTree.fromstring(xml).iter() if name(x) in ("item", "entry")):
        got = {name(c): (c.text or c.get("href") or "").strip() for c in e}
        exact = next((_as_typed(c.get("type", ""), c.text or "") for c in e if name(c) == "content"), None)
        body = got.get("encoded") or got.get("content") or got.get("description") or got.get("summary") or ""
        body = body if exact is None else exact
        content = exact if exact is not None else plain(body) if got.keys() & {"encoded", "content", "description", "summary"} else None
        ident = got.get("guid") or got.get("id") or got.get("link") or hashlib.md5(body.encode()).hexdigest()
        out.append((ident, got.get("title", ""), content, got.get("link", ""), to_time(got.get("pubDate") or got.get("updated") or got.get("published")), hashlib.md5(body.encode()).hexdigest(), {}))
    return out


def in_window(t: datetime | None, start: datetime | None, end: datetime | None) -> bool:
    """(start, end]; items without a time are always in."""
    return t is None or ((start is None or t > start) and (end is None or t <= end))


class _Split(InputPartition):
    def __init__(self, value: str, start: datetime | None = None, end: datetime | None = None) -> None:
        self.value, self.start, self.end = value, start, end


def rows_of(e: Endpoint, split: str, client: Callable[..., str], start: datetime | None, end: datetime | None) -> Iterator[tuple]:
    found = feed_rows(client(e.url.format(split=split), dict(e.headers))) if e.format == "rss" else (item_row(e, x) for x in pages_of(e, split, client, start, end))
    return (r for r in found if in_window(r[4], start, end))


_TICK = timedelta(microseconds=1)


class _Reader(DataSourceReader):
    """One task a split and window, so that repositories, channels or feeds, and long spans of time, load side by side."""

    def __init__(self, e: Endpoint, client: Callable, start: datetime | None, end: datetime | None, days: float | None = None) -> None:
        self.e, self.client, self.start, self.end, self.days = e, client, start, end, days
        self.timed, self.ids = False, None

    def partitions(self) -> list[InputPartition]:
        if self.ids is not None and not self.ids or (self.start and self.end and self.start >= self.end):
            return []
        windows = [(self.start, self.end)]
        if self.days and self.start and self.end:
            step = timedelta(days=self.days)
            n = max(1, ceil((self.end - self.start) / step))
            edges = [self.start + k * step for k in range(n)] + [self.end]
            windows = list(zip(edges, edges[1:], strict=False))
        return [_Split(s, a, b) for s in self.e.splits for a, b in windows]

    def read(self, partition: _Split | None) -> Iterator[tuple]:
        if partition is None:  # Spark's one task where there are no partitions
            return
        first = partition.start == self.start  # items without a time are in every window: the first one has them
        for row in rows_of(self.e, partition.value, self.client, partition.start, partition.end):
            if (row[4] is not None or (first and not self.timed)) and (self.ids is None or row[0] in self.ids):
                yield row


class _Pushed(_Reader):
    """A reader that takes filters: those on ``updated_at`` become the window that the service is asked for, those on ``id``
    leave rows out before they reach Spark; the others stay with Spark. Which filters are taken shows in EXPLAIN. Spark
    refuses to run it in a session without spark.sql.python.filterPushdown.enabled."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if not self._take(f):
                yield f

    def _take(self, f: Filter) -> bool:
        if getattr(f, "attribute", None) == ("id",):
            if isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.ids = values if self.ids is None else self.ids & values
                return True
            return isinstance(f, IsNotNull)  # every item has one
        if getattr(f, "attribute", None) != ("updated_at",):
            return False
        if isinstance(f, IsNotNull):
            self.timed = True
            return True
        value = getattr(f, "value", None)
        if not isinstance(value, datetime):
            return False
        value = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
        later = lambda t: max(t, self.start) if self.start else t
        sooner = lambda t: min(t, self.end) if self.end else t
        if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
            self.start = later(value if isinstance(f, GreaterThan) else value - _TICK)
        if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
            self.end = sooner(value - _TICK if isinstance(f, LessThan) else value)
        self.timed = self.timed or isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, EqualTo))
        return isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, EqualTo))


class _Stream(SimpleDataSourceStreamReader):
    """The offset is the latest update time read: the checkpoint of the poll window."""

    def __init__(self, e: Endpoint, client: Callable) -> None:
        self.e, self.client = e, client

    def initialOffset(self) -> dict:  # noqa: N802
        return {"since": 0.0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        since = datetime.fromtimestamp(start["since"], timezone.utc)
        rows = [r for s in self.e.splits for r in rows_of(self.e, s, self.client, since, None)]
        latest = max((r[4].timestamp() for r in rows if r[4]), default=start["since"])
        return iter(rows), {"since": max(latest, start["since"])}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        a, b = (datetime.fromtimestamp(x["since"], timezone.utc) for x in (start, end))
        return iter([r for s in self.e.splits for r in rows_of(self.e, s, self.client, a, b)])


def data_source(name: str, endpoint: Endpoint, client: Callable[..., str] = http_client, pushes: bool | None = None) -> type[DataSource]:
    """A Data Source class to register: ``spark.dataSource.register(data_source(...))``. Options: start, end (ISO), window (days
    that one task reads, where both are known), splits (comma-separated), token. Filters are pushed (``pushes``) where the
    session has spark.sql.python.filterPushdown.enabled by now, as ``session`` sets it; elsewhere Spark filters."""
    if pushes is None:
        now = SparkSession.getActiveSession()
        pushes = now is not None and now.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower() == "true"
    made = _Pushed if pushes else _Reader

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ITEM_SCHEMA

        def _endpoint(self) -> Endpoint:
            e = endpoint
            if self.options.get("splits"):
                e = replace(e, splits=tuple(self.options["splits"].split(",")))
            if self.options.get("url"):
                e = replace(e, url=self.options["url"])
            if self.options.get("token"):
                e = replace(e, headers=(*e.headers, ("Authorization", f"Bearer {self.options['token']}")))
            return e

        def reader(self, schema: Any) -> DataSourceReader:
            days = self.options.get("window")
            return made(self._endpoint(), client, to_time(self.options.get("start")), to_time(self.options.get("end")), float(days) if days else None)

        def simpleStreamReader(self, schema: Any) -> SimpleDataSourceStreamReader:  # noqa: N802
            return _Stream(self._endpoint(), client)

    return Source


for _name, _since, _until, _epoch in (("github", "since", "", False), ("gitlab", "updated_after", "updated_before", False), ("slack", "oldest", "latest", True)):
    if _name in SERVICES:
        SERVICES[_name] = replace(SERVICES[_name], since=_since, until=_until, epoch=_epoch)


def register_services(spark: SparkSession, client: Callable[..., str] = http_client) -> list[str]:
    """Register every known service, ``rest`` and ``rss``; returns the format names."""
    known = SERVICES | {"rest": Endpoint("{split}"), "rss": Endpoint("{split}", format="rss")}
    for name, e in known.items():
        spark.dataSource.register(data_source(name, e, client))
    return sorted(known)


# --- files ------------------------------------------------------------------------------------------------------------


def blobs(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Objects of a store (any Hadoop file system: s3a, gs, abfss, oci, webdav mounts) as documents; the fingerprint is
    size and time, so unchanged objects need no reading: content is a column that pruning drops."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return df.select(
        F.md5("path").alias("id"), F.lit("blob").alias("source"), F.col("path"), name.alias("name"), F.lower(F.regexp_extract(name, "\\.([^.]+)$", 1)).alias("extension"),
        F.col("content").alias("blob"), F.col("length").alias("size"), F.col("modificationTime").alias("updated_at"), F.md5(F.concat_ws("|", "length", "modificationTime")).alias("fingerprint"),
    )


def _message(data: bytes) -> tuple:
    """(Message-ID, subject, sender, time, body) of a message."""
    from email import message_from_bytes, policy

    m = message_from_bytes(data, policy=policy.default)
    body = m.get_body(preferencelist=("plain", "html"))
    return str(m["message-id"] or ""), str(m["subject"] or ""), str(m["from"] or ""), to_time(m["date"]), plain(body.get_content()) if body else ""


_MAIL = "id string, title string, sender string, updated_at timestamp, content string"


def mail(spark: SparkSession, path: str) -> DataFrame:
    """Messages of .eml files: subject, sender, time, body. The driver lists the files: of many messages, have mailboxes."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = [(p, *_message(bytes(data))[1:]) for p, data in zip(pdf["path"], pdf["content"], strict=True)]
            yield pd.DataFrame(rows, columns=["id", "title", "sender", "updated_at", "content"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.eml").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInPandas(run, _MAIL)


def mailboxes(spark: SparkSession, path: str) -> DataFrame:
    """Messages of mailboxes (mbox, what mail services and IMAP clients export), as of ``mail``; the id is the Message-ID, or the
    message's md5. A mailbox is read by as many tasks as its length needs. Line ends after a message aren't kept by the format."""

    def run(batches):
        import hashlib

        import pandas as pd

        for pdf in batches:
            rows = []
            for data in pdf["value"]:
                data = bytes(data).rstrip(b"\r\n").partition(b"\n")[2]  # the first line is the envelope
                if data:
                    ident, *rest = _message(re.sub(rb"(?m)^>(>*From )", rb"\1", data))
                    rows.append((ident or hashlib.md5(data).hexdigest(), *rest))
            yield pd.DataFrame(rows, columns=["id", "title", "sender", "updated_at", "content"])

    return spark.read.option("lineSep", "\nFrom ").option("recursiveFileLookup", "true").text(path).select(F.col("value").cast("binary").alias("value")).mapInPandas(run, _MAIL)


# --- databases --------------------------------------------------------------------------------------------------------


@dataclass
class Rdbms:
    """A table or query of a database, read by JDBC; the window is a predicate of the derived table, so the database does
    the filtering, and ``partition`` splits the read by ranges of a number."""

    url: str
    table: str | None = None
    query: str | None = None
    content: list[str] = field(default_factory=list)
    metadata: list[str] = field(default_factory=list)
    id_column: str | None = None
    cursor: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    partition: tuple[str, int, int, int] | None = None  # column, lower, upper, parts

    def derived(self, start: str | None = None, end: str | None = None) -> str:
        """The derived table of a read; a trailing ORDER BY goes, where databases refuse it."""
        base = self.table if self.table else "(" + re.sub(r"(?is)\s+order\s+by\s+[^()]*$", "", self.query.strip().rstrip(";")) + ")"
        quoted = lambda v: "'" + str(v).replace("'", "''") + "'"
        parts = [f"q.{self.cursor} > {quoted(start)}"] if self.cursor and start else []
        parts += [f"q.{self.cursor} <= {quoted(end)}"] if self.cursor and end else []
        return f"(SELECT * FROM {base} q" + (" WHERE " + " AND ".join(parts) if parts else "") + ") src"

    def read(self, spark: SparkSession, start: str | None = None, end: str | None = None) -> DataFrame:
        reader = spark.read.format("jdbc").options(url=self.url, dbtable=self.derived(start, end), **self.options)
        if self.partition:
            column, low, high, parts = self.partition
            reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
        return reader.load()

    def documents(self, spark: SparkSession, start: str | None = None, end: str | None = None) -> DataFrame:
        return row_documents(self.read(spark, start, end), self.content, self.metadata, self.id_column)

    def slim(self, spark: SparkSession) -> DataFrame:
        return self.documents(spark).select("id")

    def max_cursor(self, spark: SparkSession) -> Any:
        return self.read(spark).agg(F.max(self.cursor)).first()[0]


def row_documents(df: DataFrame, content: list[str], metadata: list[str] | None = None, id_column: str | None = None) -> DataFrame:
    """Rows as documents: ``【column】:\\nvalue`` blocks, metadata map, id column or the content's md5."""
    text = F.concat_ws("\n", *(F.when(F.col(c).isNotNull(), F.concat(F.lit(f"【{c}】:\n"), F.col(c).cast("string"))) for c in content))
    meta = F.create_map(*(x for c in metadata for x in (F.lit(c), F.col(c).cast("string")))) if metadata else F.create_map().cast("map<string,string>")
    ident: Column = F.col(id_column).cast("string") if id_column else F.md5(text)
    return df.select(ident.alias("id"), text.alias("content"), F.map_filter(meta, lambda k, v: v.isNotNull()).alias("metadata"))


def poll_window(df: DataFrame, ts: str, start: Any, end: Any) -> DataFrame:
    """Rows in (start, end]."""
    return df.where((F.col(ts) > F.lit(start).cast("timestamp")) & (F.col(ts) <= F.lit(end).cast("timestamp")))


def slim_diff(stored: DataFrame, listed: DataFrame, key: str = "id") -> DataFrame:
    """Stored ids that a full listing no longer has."""
    return stored.select(key).join(listed.select(key), key, "left_anti")
