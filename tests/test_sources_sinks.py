"""Filter push-down of readers, file writers, schedules with timers, stored sketches."""

import json
import os
import re
from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestone.operators import relational
from lodestone.sources import connectors, parsers, writers
from lodestone.streaming import timers

DATA = "/root/testdata/sf0.01"


# --- push-down -------------------------------------------------------------------------------------------------------


def listing(log):
    """A service of 40 items, an hour apart, that understands since and until and notes what it is asked for."""

    def client(url, headers, data=None):
        with open(log, "a") as f:
            f.write(url + "\n")
        ask = dict(re.findall(r"[?&](\w+)=([^&]*)", url.replace("%3A", ":")))
        items = [{"id": str(k), "title": f"t{k}", "content": "c", "updated_at": (datetime(2024, 1, 1) + timedelta(hours=k)).isoformat() + "Z"} for k in range(40)] + [{"id": "x", "title": "untimed"}]
        items = [i for i in items if "updated_at" not in i or (i["updated_at"] >= ask.get("since", "") and i["updated_at"] <= ask.get("until", "9"))]
        return json.dumps({"data": items})

    return client


@pytest.fixture
def service(spark, tmp_path):
    log = str(tmp_path / "asked")
    e = connectors.Endpoint("http://x/{split}", "data", since="since", until="until", splits=("a",))
    spark.dataSource.register(connectors.data_source("pushed", e, listing(log)))
    asked = lambda: open(log).read().split() if os.path.exists(log) else []  # noqa: E731, SIM115
    return lambda: spark.read.format("pushed"), asked


def test_filters_reach_the_requests(service):
    read, asked = service
    rows = read().load().where("updated_at > timestamp'2024-01-01 10:00:00' and updated_at <= timestamp'2024-01-01 13:00:00'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan.replace("PushedFilters", ""), plan
    assert sorted(int(r["id"]) for r in rows.collect()) == [11, 12, 13]
    assert asked() and all("since=2024-01-01T10" in u and "until=2024-01-01T13" in u for u in asked())


@pytest.mark.parametrize(
    "condition, want",
    [
        ("updated_at >= timestamp'2024-01-02 14:00:00'", {"38", "39"}),
        ("updated_at < timestamp'2024-01-01 01:00:00'", {"0"}),
        ("updated_at = timestamp'2024-01-01 05:00:00'", {"5"}),
        ("id in ('3', 'x', 'no')", {"3", "x"}),
        ("id = '7' and title like 't%'", {"7"}),
        ("id = '7' and updated_at > timestamp'2024-01-01 09:00:00'", set()),
        ("length(title) > 3", {"x"}),
        ("updated_at is null", {"x"}),
        ("updated_at > timestamp'2024-01-01 03:00:00' and updated_at > timestamp'2024-01-02 13:30:00'", {"38", "39"}),
    ],
)
def test_pushed_filters_change_no_result(service, condition, want):
    read, _ = service
    assert {r["id"] for r in read().load().where(condition).collect()} == want


def test_windows_are_tasks_of_their_own(service):
    read, asked = service
    rows = read().option("start", "2024-01-01T00:00:00Z").option("end", "2024-01-02T12:00:00Z").option("window", "0.5").load()
    assert rows.rdd.getNumPartitions() == 3
    assert sorted(r["id"] for r in rows.collect()) == sorted([str(k) for k in range(1, 37)] + ["x"])


def test_cursor_values_are_literals():
    q = connectors.Rdbms("jdbc:x", table="t", cursor="ts").derived("2024' OR '1'='1", "b")
    assert "q.ts > '2024'' OR ''1''=''1'" in q


# --- writers ---------------------------------------------------------------------------------------------------------


@pytest.fixture
def rows(spark):
    data = [(k, f"name {k} <b> & \"q\" | pipe,\ncomma", k / 4, k % 2 == 0) if k % 7 else (k, None, None, None) for k in range(50)]
    writers.register(spark)
    return spark.createDataFrame(data, "id long, text string, x double, flag boolean").repartition(3), data


def parts(path):
    return sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-"))


def test_spreadsheets_read_back_equal(rows, tmp_path):
    df, data = rows
    df.write.format("files").mode("append").option("path", str(tmp_path / "out")).option("kind", "xlsx").save()
    assert sorted(os.listdir(tmp_path / "out"))[0] == "_SUCCESS" and not [f for f in os.listdir(tmp_path / "out") if f.startswith("_writing")]
    got = pd.concat([cells(f) for f in parts(tmp_path / "out")])
    want = {(str(i), t or "", "" if x is None else repr(x), "" if b is None else str(int(b))) for i, t, x, b in data}
    assert set(map(tuple, got.values.tolist())) == want
    found = [x for f in parts(tmp_path / "out") for x in parsers.PARSERS["xlsx"](open(f, "rb").read())]  # noqa: SIM115
    assert any("name 1 " in content for _, content in found)


def cells(path):
    """The rows below the names, without the library."""
    import html
    import zipfile

    out = []
    with zipfile.ZipFile(path) as z:
        for sheet in sorted(n for n in z.namelist() if "/sheet" in n):
            for row in re.findall(r"<row [^>]*>(.*?)</row>", z.read(sheet).decode(), re.S)[1:]:
                got = {m[0]: html.unescape(m[1]) for m in re.findall(r'<c r="([A-Z]+)\d+"[^>]*>(?:<v>|<is><t[^>]*>)(.*?)(?:</v>|</t>)', row, re.S)}
                out.append([got.get(c, "") for c in "ABCD"])
    return pd.DataFrame(out)


def test_more_rows_than_a_sheet_has():
    import io
    import zipfile

    data = next(writers.workbook(["a"], iter([(k,) for k in range(10)]), sheet_rows=4))
    z = zipfile.ZipFile(io.BytesIO(data))
    sheets = [z.read(n).decode() for n in sorted(z.namelist()) if "/sheet" in n]
    assert len(sheets) == 4 and [re.findall(r"<v>(\d+)</v>", s) for s in sheets] == [["0", "1", "2"], ["3", "4", "5"], ["6", "7", "8"], ["9"]]
    assert writers.column_name(27) == "AB" and len(next(writers.workbook(["a"], iter([])))) > 0


def test_csv_reads_back_equal(spark, rows, tmp_path):
    df, data = rows
    df.write.format("files").mode("append").option("path", str(tmp_path / "out")).option("kind", "csv").save()
    got = spark.read.csv([f"file://{f}" for f in parts(tmp_path / "out")], header=True, multiLine=True, escape='"').collect()
    assert {(r["id"], r["text"]) for r in got} == {(str(i), t) for i, t, *_ in data}


@pytest.mark.parametrize("kind", ["md", "html"])
def test_tables_have_every_row(rows, tmp_path, kind):
    df, data = rows
    df.write.format("files").mode("append").option("path", str(tmp_path / "out")).option("kind", kind).save()
    text = "".join(open(f).read() for f in parts(tmp_path / "out"))  # noqa: SIM115
    assert text.count("\n| " if kind == "md" else "<tr>") >= 50 and ("\\| pipe" in text if kind == "md" else "&lt;b&gt; &amp;" in text)


def test_documents_and_overwriting(spark, rows, tmp_path):
    docs = spark.createDataFrame([(f"d{k % 3}/{k}.md", f"# {k}\nbody") for k in range(20)], "name string, body string").repartition(4)
    save = lambda df, mode: df.write.format("files").mode(mode).option("path", str(tmp_path / "out")).option("kind", "text").save()
    save(docs, "append")
    assert open(tmp_path / "out/d1/4.md").read() == "# 4\nbody"  # noqa: SIM115
    save(docs.limit(1).withColumn("name", F.lit("only.md")), "overwrite")
    assert sorted(os.listdir(tmp_path / "out")) == ["_SUCCESS", "only.md"]


@pytest.mark.parametrize("fault", ["task", "name", "outside"])
def test_a_failure_leaves_nothing(spark, rows, tmp_path, fault):
    docs = spark.range(40).repartition(4).select(F.concat("id", F.lit(".md")).alias("name"), F.lit("x").alias("body"))
    if fault == "task":
        docs = docs.withColumn("body", F.when(F.col("name") == "33.md", F.raise_error(F.lit("broken"))).otherwise(F.col("body")))
    else:
        docs = docs.withColumn("name", F.when(F.col("name") == "33.md", F.lit("1.md" if fault == "name" else "../1.md")).otherwise(F.col("name")))
    with pytest.raises(Exception):  # noqa: B017
        docs.write.format("files").mode("append").option("path", str(tmp_path / "out")).option("kind", "text").save()
    left = [os.path.join(d, f) for d, _, files in os.walk(tmp_path) for f in files]
    assert left == []


# --- schedules -------------------------------------------------------------------------------------------------------

T0 = datetime(2024, 1, 1)


def simulated(batches, late, keep):
    """What comes out, by a plain loop: after each batch the watermark, then the timers up to it."""
    state, out, mark = {}, [], None
    for batch in batches:
        for c, kind, at, every, cursor in sorted(batch, key=lambda n: (n[2], n[1])):
            if mark is not None and at < mark:
                continue
            s = state.setdefault(c, {"every": 0, "due": None, "dead": None, "cursor": None})
            if s["dead"]:
                continue
            if kind == "delete":
                s["dead"], s["due"] = at + timedelta(seconds=keep), None
            elif kind == "schedule":
                s["every"], s["due"] = every, at + timedelta(seconds=every)
            elif kind == "done":
                s["cursor"] = max(filter(None, (s["cursor"], cursor)), default=None)
                if s["every"] and at + timedelta(seconds=s["every"]) > (s["due"] or T0):
                    s["due"] = at + timedelta(seconds=s["every"])
        mark = max([n[2] for n in batch] + ([mark + late] if mark else [])) - late
        for c, s in list(state.items()):
            if s["dead"] and s["dead"] <= mark:
                out.append((c, "expired", s["dead"], s["cursor"]))
                del state[c]
            while not s["dead"] and s["due"] and s["due"] <= mark:
                out.append((c, "due", s["due"], s["cursor"]))
                s["due"] += timedelta(seconds=s["every"])
    return sorted(out, key=str)


def test_schedules_across_restarts(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", timers.ROCKS)
    minute = lambda m: T0 + timedelta(minutes=m)
    batches = [
        [("a", "schedule", minute(0), 600, None), ("b", "schedule", minute(1), 3600, None)],
        [("a", "done", minute(12), None, "c1"), ("clock", "done", minute(45), None, None)],
        [("a", "done", minute(50), None, "c0"), ("b", "delete", minute(52), None, None), ("clock", "done", minute(75), None, None)],
        [("b", "schedule", minute(76), 60, None), ("a", "schedule", minute(80), 1800, None), ("clock", "done", minute(200), None, None)],
        [("clock", "done", minute(2000), None, None)],
        [("clock", "done", minute(2001), None, None)],
    ]
    schema = "connector string, kind string, at timestamp, every int, cursor string"
    try:
        os.makedirs(tmp_path / "in")
        for k, batch in enumerate(batches):
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
            notices = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
            out = timers.schedules(notices, "5 minutes", keep=3600)
            # A query of its own for every batch: what came before is in the checkpoint alone.
            out.writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/check").option("path", f"file://{tmp_path}/out").trigger(availableNow=True).start().awaitTermination()
        got = sorted(((r["connector"], r["kind"], r["at"], r["cursor"]) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()), key=str)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    want = simulated(batches, timedelta(minutes=5), 3600)
    assert got == want and len({g[:3] for g in got}) == len(got) and ("b", "expired", minute(112), None) in got


# --- sketches --------------------------------------------------------------------------------------------------------


def test_merged_sketches_are_near_the_exact_figures(spark):
    e = spark.read.parquet(f"{DATA}/events.parquet").withColumn("day", F.to_date("ts"))
    daily = relational.sketches(e, ["day", "event_type"], "user_id", "value")
    merged = relational.sketch_estimates(relational.merged_sketches(daily, ["event_type"])).orderBy("event_type").collect()
    exact = e.groupBy("event_type").agg(F.count("*").alias("rows"), F.count_distinct("user_id").alias("n"), F.collect_list("value").alias("v")).orderBy("event_type").collect()
    for m, x in zip(merged, exact, strict=True):
        values = sorted(x["v"])
        rank = lambda v: sum(y <= v for y in values) / len(values)  # noqa: B023, E731
        assert m["rows"] == x["rows"] and abs(m["distinct"] / x["n"] - 1) < 0.05 and abs(m["members"] / x["n"] - 1) < 0.05
        assert abs(rank(m["q50"]) - 0.5) < 0.03 and abs(rank(m["q90"]) - 0.9) < 0.03
    both = relational.sketches(e, ["event_type"], "user_id").select("event_type", "members").collect()
    two = spark.createDataFrame([(both[0]["members"], both[1]["members"])], "a binary, b binary").select(relational.sketch_overlap(F.col("a"), F.col("b"))).first()[0]
    users = [{r["user_id"] for r in e.where(F.col("event_type") == b["event_type"]).select("user_id").distinct().collect()} for b in both[:2]]
    assert abs(two / len(users[0] & users[1]) - 1) < 0.1


# --- databases -------------------------------------------------------------------------------------------------------


def test_tables_of_a_database(spark):
    url = "jdbc:derby:memory:lodestone;create=true"
    rows = [(k, f"name {k}", datetime(2024, 1, 1) + timedelta(hours=k)) for k in range(40)]
    spark.createDataFrame(rows, "ID int, NAME string, TS timestamp").write.format("jdbc").options(url=url, dbtable="items", driver="org.apache.derby.jdbc.EmbeddedDriver").mode("overwrite").save()
    db = connectors.Rdbms(url, table="items", content=["NAME"], metadata=["TS"], id_column="ID", cursor="TS", options={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    window = db.read(spark, "2024-01-01 10:00:00", "2024-01-01 13:00:00")
    assert sorted(r["ID"] for r in window.collect()) == [11, 12, 13]
    assert db.max_cursor(spark) == datetime(2024, 1, 2, 15)
    assert {r["id"] for r in db.slim(spark).collect()} == {str(k) for k in range(40)}
    doc = next(r for r in db.documents(spark).collect() if r["id"] == "7")
    assert doc["content"] == "【NAME】:\nname 7" and doc["metadata"]["TS"].startswith("2024-01-01 07:00")
    parts = connectors.Rdbms(url, table="items", options={"driver": "org.apache.derby.jdbc.EmbeddedDriver"}, partition=("ID", 0, 40, 4)).read(spark)
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 40


@pytest.mark.parametrize("name", ["rest_window", "rss_items"])
def test_without_push_down(spark, name):
    """Sessions that leave Spark's default on, no push-down for Python sources, get the same rows."""
    from lodestone import queries as Q

    rows = lambda: sorted(map(str, Q.queries()[name](spark, "/root/testdata/sf0.001").collect()))
    want = rows()
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    try:
        assert rows() == want and want
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def test_passages_in_feeds_to_the_letter(spark, tmp_path):
    """Null passages and ids, white space at the edges, markup, CR and characters that XML has no way to write."""
    from hashlib import md5

    from lodestone import queries as Q

    texts = ["a b", None, "", "  a \n", "   ", "a\r\nb\rc", "a <b>bold</b> & c &amp; d", "]]> <![CDATA[x", "a\x01b\x0bc", "a\ufffe\U0001f600"]
    rows = [(k * 20, x) for k, x in enumerate(texts)] + [(20, "twice"), (None, "q")]
    spark.createDataFrame(rows, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [(r["id"], r["title"], r["content_md5"], r["updated_at"] is None) for r in Q.queries()["rss_items"](spark, str(tmp_path)).collect()]
    name = lambda head, k: None if k is None else f"{head}{k}"
    want = [(name("item-", k), name("Passage ", k), None if x is None else md5(x.encode()).hexdigest(), k is None) for k, x in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert Q.queries()["rss_items"](spark, f"{tmp_path}/none").collect() == []


def test_messages_in_mailboxes(spark, tmp_path):
    """Messages of a mailbox are those of files of a message each: lines that begin with From, at the edges of splits, and bytes
    that aren't UTF-8. Turns are written to a file a task, not a message."""
    from lodestone import queries as Q
    from lodestone.operators.scratch import folder

    bodies = ["plain", "From here\n>From there\n>>From\nTo: x", "", "\n\nFrom\n\nFrom  a", "é\u2028From b\r\nFrom c", "x" * 3000] + [f"From {k}\n" * (k % 7) + "." for k in range(200)]
    rows = spark.createDataFrame([(k, f"Subject: s{k}\nFrom: a@b\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n{x}") for k, x in enumerate(bodies)], "k int, m string").repartition(3)
    rows.select(writers.in_mailbox(F.col("m"))).write.text(f"{tmp_path}/box")
    writers.register(spark)
    rows.selectExpr("k || '.eml' AS name", "m AS body").write.format("files").mode("append").option("path", f"{tmp_path}/eml").option("kind", "text").save()
    ends = lambda df: sorted((r["title"], r["sender"], r["content"].rstrip()) for r in df.collect())
    want = ends(connectors.mail(spark, f"{tmp_path}/eml"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("64", "1000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert ends(connectors.mailboxes(spark, f"{tmp_path}/box")) == want and len(want) == len(bodies)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "a.mbox").write_bytes(b"From a\nSubject: one\nMessage-ID: <1@x>\nContent-Type: text/plain; charset=latin-1\nContent-Transfer-Encoding: 8bit\n\n\xe9t\xe9\n\nFrom b\nSubject: two\n\nbody\n")
    assert [(r["id"] == "<1@x>", r["title"], r["content"].strip()) for r in connectors.mailboxes(spark, f"{tmp_path}/old").collect()] == [(True, "one", "été"), (False, "two", "body")]
    at = Path(folder(spark).removeprefix("file:"))
    there = set(at.iterdir())
    turns = Q.queries()["mail_messages"](spark, "/root/testdata/sf0.001").count()
    files = [f for p in set(at.iterdir()) - there for f in p.rglob("*") if f.is_file() and f.name[0] not in "._"]
    assert turns > 50 and len(files) < 10
