"""Operators on hand-made rows: expected values are facts of the semantics."""

import datetime as dt
import io
import itertools
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions import terms as T
from lodestone.functions import text as X
from lodestone.functions import values as V
from lodestone.functions.registry import embed, embedded, publish, transform_with
from lodestone.operators import chunkers, dml, enrich, evals, filters, graph, memory, records, relational, search, templates, tree
from lodestone.plans import chunking, sql
from lodestone.plans.canvas import Canvas
from lodestone.plans.expressions import compile_expression, parse
from lodestone.schema import chunk_schema, message_schema, type_of
from lodestone.sources import connectors, parsers
from lodestone.sources.docstore import DocStore, Search
from lodestone.streaming import channels, pregel, sinks, windows


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def meta(spark, buckets):
    return spark.createDataFrame([(k, v, d) for k, vs in buckets.items() for v, ds in vs.items() for d in ds], "key string, value string, doc_id string")


@pytest.mark.parametrize(
    "buckets, op, value, want",
    [
        ({"version": {"hello earth": ["doc1"], "hello mars": ["doc2"]}}, "contains", "earth", {"doc1"}),
        ({"version": {"hello earth": ["doc1"], "hello mars": ["doc2"]}}, "not contains", "earth", {"doc2"}),
        ({"status": {"active": ["doc1"], "pending": ["doc2"], "done": ["doc3"]}}, "in", "active,pending", {"doc1", "doc2"}),
        ({"status": {"active": ["doc1"], "pending": ["doc2"], "done": ["doc3"]}}, "not in", "active,pending", {"doc3"}),
        ({"product": {"F2": ["doc1"], "F11": ["doc2"], "G1": ["doc3"]}}, "in", ["f2", "f11"], {"doc1", "doc2"}),
        ({"name": {"prefix_value": ["doc1"], "other": ["doc2"]}}, "start with", "pre", {"doc1"}),
        ({"tag": {"a": ["d1"], "b": ["d1", "d2"]}}, "≠", "a", {"d1", "d2"}),
        ({"n": {"9": ["d1"], "10": ["d2"], "x": ["d3"]}}, "<", "10", {"d1"}),
        ({"day": {"2024-01-05": ["d1"], "soon": ["d2"], "2024-02-01": ["d3"]}}, "≥", "2024-01-31", {"d3"}),
        ({"day": {"2024-01-05": ["d1"], "soon": ["d2"]}}, "≠", "2024-01-31", {"d1"}),
        ({"k": {"": ["d1"], "v": ["d2"]}}, "empty", None, {"d1"}),
        ({"k": {"": ["d1"], "v": ["d2"]}}, "not empty", None, {"d2"}),
    ],
)
def test_metadata_filter(spark, buckets, op, value, want):
    m = meta(spark, buckets)
    key = next(iter(buckets))
    assert {r["doc_id"] for r in filters.meta_filter(m, [{"key": key, "op": op, "value": value}]).collect()} == want


def test_metadata_logic_and_missing_keys(spark):
    m = meta(spark, {"a": {"1": ["x", "y"]}, "b": {"2": ["y", "z"]}})
    both = [{"key": "a", "op": "=", "value": "1"}, {"key": "b", "op": "=", "value": "2"}]
    assert {r[0] for r in filters.meta_filter(m, both).collect()} == {"y"}
    assert {r[0] for r in filters.meta_filter(m, both, "or").collect()} == {"x", "y", "z"}
    assert filters.meta_filter(m, [{"key": "none", "op": "≠", "value": "1"}]).count() == 0
    assert [r[0] for r in filters.manual_filter(m, [{"key": "none", "op": "=", "value": "1"}]).collect()] == ["-999"]


def test_conditions(spark):
    df = spark.createDataFrame([(1, 1, ["a"], "x"), (2, 0, ["b"], None), (3, None, ["a", "c"], "y")], "id int, available_int int, tags array<string>, s string")
    ids = lambda w: [r["id"] for r in df.where(filters.condition(df, w)).orderBy("id").collect()]
    assert ids({"available_int": 0}) == [2] and ids({"available_int": 1}) == [1, 3] and ids({"tags": ["a"]}) == [1, 3]
    assert ids({"s": ""}) == [1, 2, 3] and ids({"exists": "s"}) == [1, 3] and ids({"must_not": {"exists": "s"}}) == [2]
    assert filters.infinity_predicate({"a": "o'x", "b": [1, 2], "available_int": 0}) == "a = 'o''x' AND b IN (1, 2) AND available_int < 1"


def test_switch(spark):
    rules = [
        {"logical_operator": "and", "items": [{"cpn_id": "", "operator": "=", "value": "x"}], "to": "blank"},
        {"logical_operator": "or", "items": [{"cpn_id": "s", "operator": "contains", "value": "LO"}, {"cpn_id": "n", "operator": ">", "value": "9"}], "to": "hit"},
        {"logical_operator": "and", "items": [{"cpn_id": "s", "operator": "empty"}], "to": "none"},
    ]
    df = spark.createDataFrame([("hello", 1.0), ("x", 10.0), ("", 1.0), ("x", 1.0)], "s string, n double")
    got = [r[0] for r in df.select(filters.switch(rules, "else", {"s": F.col("s"), "n": F.col("n")})).collect()]
    assert got == ["hit", "hit", "none", "else"]


def test_rank_features(spark):
    rows = [("{'apple': 2.0}",), ('{"apple": 2.0}',), ("not a dict",), ("__import__('os')",)]
    df = spark.createDataFrame(rows, "t string").withColumn("m", V.tag_features(F.col("t")))
    assert [round(r[0] * 10, 6) for r in df.select(V.tag_cosine({"apple": 1.0}, F.col("m"))).collect()] == [10.0, 10.0, 0.0, 0.0]
    assert df.select(V.tag_cosine({"pagerank_fea": 10}, F.col("m"))).first()[0] == 0.0


@pytest.mark.parametrize("size, top", list(itertools.product([1, 7, 30, 64], [0, 5, 64, 100, 1024])))
def test_pages_lose_nothing(size, top):
    pool = list(range(min(top, 250)))
    seen = []
    for n in range(1, len(pool) // size + 2):
        offset, block, begin = search.block_of_page(n, size)
        assert block % size == 0
        seen += pool[offset : offset + block][begin : begin + size]
    assert seen == pool


def test_page_seven(spark):
    df = spark.range(250).withColumn("s", -F.col("id").cast("double"))
    assert [r["id"] for r in search.page(df, "s", 7, 10).collect()] == list(range(60, 70))


@pytest.mark.parametrize("scores, want", [([0.2, 0.9], [0.2, 0.9]), ([-1.0, 3.0, 1.0], [0.0, 1.0, 0.5]), ([5.0, 5.0001], [1.0, 1.0])])
def test_rerank_normalisation(spark, scores, want):
    df = spark.createDataFrame([(k, s) for k, s in enumerate(scores)], "id int, s double")
    assert [r["score"] for r in search.normalised_scores(df, "s").orderBy("id").collect()] == pytest.approx(want)


def test_term_weights_sum_to_one_and_similarity_is_asymmetric(spark):
    r = one(spark, T.weights(F.array(*map(F.lit, ["alpha", "12", "of"]))).alias("w"))
    w = {x["term"]: x["w"] for x in r["w"]}
    assert sum(w.values()) == pytest.approx(1) and w["12"] > w["alpha"] > w["of"]
    a, b = one(spark, T.token_similarity(F.lit("alpha beta"), F.lit("alpha beta gamma")), T.token_similarity(F.lit("alpha beta gamma"), F.lit("alpha beta")))
    assert a == pytest.approx(1) and b < 1
    assert one(spark, T.merged_short(F.array(*map(F.lit, ["a", "b", "long", "c"])))) [0] == ["a b", "long", "c"]
    assert one(spark, T.glued_words(F.lit("big data 12 x"))) [0] == ["big data", "12", "x"]


def test_text_functions(spark):
    assert one(spark, X.half_width(F.lit("ＡＢ　１")))[0] == "AB 1"
    assert one(spark, X.is_chinese(F.lit("one two three four five")), X.is_chinese(F.lit("one two"))) [:] == (False, True)
    assert one(spark, X.without_question_words(F.lit("what is the weather")), X.query_text(F.lit("What is the weather?")))[:] == (" the weather", "weather")
    assert one(spark, X.spaced_scripts(F.lit("abc中文def")))[0] == "abc 中文 def"
    assert one(spark, X.escaped(F.lit("a:b(c)'d")))[0] == "a\\:b\\(c\\)d"
    assert one(spark, X.ascii_digits(F.lit("٣۴")))[0] == "34"
    assert one(spark, X.without_fence(F.lit("```markdown\n# x\n```")))[0] == "# x"
    assert one(spark, X.language(F.lit("中文中文 ab")), X.language(F.lit("plain")))[:] == ("zh", "en")
    assert one(spark, X.highlight(F.lit("The cat sat. A dog ran! The cathedral."), ["cat"]))[0] == "The <em>cat</em> sat."
    assert one(spark, X.merge_template("{a}-{b}", {"a": F.lit("x"), "b": F.lit(None)}))[0] == "x-"
    assert spark.createDataFrame([("ﬁ",)], "s string").select(X.compatibility_form("s")).first()[0] == "fi"
    assert one(spark, X.truncate_tokens(F.lit("a b  c d"), 3))[0] == "a b c"


def test_value_functions(spark):
    a = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    r = one(spark, V.nth(a, 0).alias("z"), V.nth(a, -3).alias("f"), V.nth(a, 4).alias("o"), V.head(a, 2).alias("h"), V.tail(a, 2).alias("t"), V.head(a, 0).alias("n"))
    assert r[:] == ([], ["a"], [], ["a", "b"], ["b", "c"], [])
    with pytest.raises(Exception, match="strict mode"):
        one(spark, V.strict("head", a, 9))
    assert one(spark, V.remove_first(a), V.remove_last(a), V.first_non_empty(F.lit(""), F.lit("x")))[:] == (["b", "c"], ["a", "b"], "x")
    assert one(spark, V.to_float(F.lit("x")), V.arithmetic("/=", F.lit(1.0), F.lit(0.0)), V.clamp(F.lit(120.0)))[:] == (float("-inf"), None, 100.0)
    assert one(spark, V.ymd_hms(F.lit("2024-01-02T03:04:05Z")), V.from_epoch_ms(F.lit(0)))[:] == ("2024-01-02 03:04:05", "1970-01-01 00:00:00")
    assert one(spark, V.json_path(F.lit('{"a":{"b":[1,{"c":7}]}}'), "a.b.1.c"))[0] == "7"
    assert one(spark, V.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(0.0))))[0] == 0.0


def test_records(spark):
    df = spark.createDataFrame([(1, "a", "[1, 2]"), (2, "b", "{'k': True}")], "o int, x string, lit string")
    assert records.rename_keys(df, [("x", "lit"), ("", "q")]).columns == ["o", "lit"]
    assert {r["key"]: r["values"] for r in records.combine(df, "o").collect()}["x"] == ["a", "b"]
    assert [r[0] for r in df.select(F.to_json(records.literal_eval(F.col("lit")))).collect()] == ["[1,2]", '{"k":true}']
    assert records.filter_values(df, [{"key": "x", "operator": "equals", "value": "a"}]).count() == 0
    assert records.filter_values(df, [{"key": "x", "operator": "=", "value": "a"}]).count() == 1


def test_chunk_plan(spark):
    dsl = {
        "preprocess": {"normalize_newlines": True, "strip_whitespace": True, "remove_empty_lines": True},
        "split": {"strategy": "sentence", "params": {"boundaries": [".", "\n"], "keep_separators": True}},
        "postprocess": {"merge": {"target_size": 12}, "overlap": {"unit": "char", "conditions": [{"name": "u", "if": "has_url", "then": {"size": 0}}], "default": {"size": 3}}, "add_metadata": {"include_index": True, "custom_fields": {"k": "v"}}},
    }
    plan = chunking.compile_plan(json.dumps(dsl))
    rows = plan.execute(spark.createDataFrame([("d", "  Aaaa.\r\n\r\nBb. Cc.\nhttp://x.y/z now ")], "doc_id string, text string")).orderBy("index").collect()
    assert [r["content"] for r in rows][0].startswith("Aaaa.") and rows[0]["metadata"] == {"language": "en", "index": "0", "k": "v"}
    for a, b in zip(rows, rows[1:], strict=False):
        assert "http" in b["content"] or b["content"].startswith(a["content"][-3:])
    assert "merge target_size=12" in plan.explain()
    with pytest.raises(ValueError):
        chunking.compile_plan({"postprocess": {"overlap": {"conditions": [{"if": "a AND", "then": {"size": 1}}]}}})
    with pytest.raises(ValueError):
        chunking.compile_plan({"preprocess": {"strip_whitespace": "yes"}})


def test_expressions(spark):
    assert parse("a AND NOT b OR c = 'x'")[0] == "or"
    got = one(spark, *(compile_expression(e, F.lit("see https://a.b/c.png")).alias(f"c{k}") for k, e in enumerate(["has_image_url", "length > 100", "NOT (has_video_url OR length < 3)", "language == 'en'"])))
    assert got[:] == (True, False, True, True)


def test_greedy_merge_matches_plain_python(spark):
    pieces = ["aa", "bbbb", "c" * 12, "d", "e", "ffff", "g" * 9]
    want, buf = [], ""
    for p in pieces:
        if len(p) >= 10:
            want, buf = want + ([buf] if buf else []) + [p], ""
        elif buf and len(buf) + len(p) + 1 <= 10:
            buf += " " + p
        else:
            want, buf = want + ([buf] if buf else []), p
    want += [buf] if buf else []
    assert one(spark, chunking.greedy_merge(F.array(*map(F.lit, pieces)), 10))[0] == want


def test_titles(spark):
    lines = spark.createDataFrame([("d", k, x) for k, x in enumerate(["# One", "text a", "## Two", "text b", "# Three", "text c"])], "doc_id string, position int, line string")
    leveled = lines.withColumn("level", chunkers.heading_level(F.col("line"), "markdown"))
    got = chunkers.hierarchy_chunks(leveled, "doc_id", "position", "line", "level").orderBy("position").collect()
    assert [(r["path"], r["content"]) for r in got] == [(["# One"], "text a"), (["# One", "## Two"], "text b"), (["# Three"], "text c")]
    assert chunkers.family_vote(lines, "doc_id", "line").first()["family"] == "markdown"
    assert chunkers.common_level(leveled, "doc_id", "level").first()["level"] == 1
    qa = templates.qa_markdown(lines, "doc_id", "position", "line").orderBy("position").collect()
    assert qa[1]["question"] == "One\nTwo" and qa[1]["answer"] == "text b"
    tabs = spark.createDataFrame([("d", 0, "q1\ta1"), ("d", 1, "more"), ("d", 2, "q2\ta2")], "doc_id string, position int, line string")
    assert [(r["question"], r["answer"]) for r in templates.qa_pairs(tabs, "doc_id", "position", "line").orderBy("pair").collect()] == [("q1", "a1\nmore"), ("q2", "a2")]


def test_media_context(spark):
    rows = [("d", 0, "text", "one two three"), ("d", 1, "image", "IMG"), ("d", 2, "text", "four five six"), ("d", 3, "table", "TAB")]
    got = chunkers.media_context(spark.createDataFrame(rows, "doc_id string, position int, kind string, content string"), 2).orderBy("position").collect()
    assert [r["content"] for r in got] == ["one two three", "two three IMG four five", "four five six", "five six TAB"]


def test_templates(spark):
    docs = spark.createDataFrame([("d", "# T\nAbstract: short one.\n\nIntroduction here\n# B\nbody")], "id string, text string")
    for name in ("naive", "one", "book", "laws", "manual", "paper", "presentation", "email"):
        assert templates.template(name)(docs, "id", "text").count() >= 1
    with pytest.raises(NotImplementedError):
        templates.template("picture")(docs, "id", "text")
    t = spark.createDataFrame([("France", "Paris", "x"), (None, "Rome", "y")], "country string, title string, index string")
    got = templates.table_chunks(t.withColumn("row_id", F.col("title")), "row_id", ["country", "title", "index"], {"country": "metadata"}).orderBy("doc_id").collect()
    assert got[0]["content"] == "- title: Paris" and got[0]["chunk_data"] == {"country": "France", "title": "Paris"} and got[1]["chunk_data"] == {"title": "Rome"}
    kinds = spark.createDataFrame([("1", "yes", "2024-01-02", "012", "1.5"), ("2", "no", "2024/3/4", "013", "2"), ("x", "yes", "soon", "014", "9")], "a string, b string, c string, d string, e string")
    assert {r["column"]: r["kind"] for r in templates.column_types(kinds, list("abcde")).collect()} == {"a": "int", "b": "bool", "c": "datetime", "d": "text", "e": "int"}
    assert [tuple(r) for r in templates.coerced(kinds.limit(1), {"a": "int", "b": "bool", "e": "float"}).select("a", "b", "e").collect()] == [(1, "yes", 1.5)]
    tags = templates.tag_rows(spark.createDataFrame([("apples are red", "fruit, food"), ("cars drive", "motor")], "c string, t string"), "c", "t")
    assert templates.content_tags(spark.createDataFrame([(1, "red apples")], "id int, x string"), tags, "id", "x").orderBy("tag").first()["tag"] == "food"


def test_search_store(spark):
    rows = [("1", "k1", "red apple pie", [1.0, 0.0]), ("2", "k1", "green apple", [0.0, 1.0]), ("3", "k2", "blue sky", [1.0, 0.1])]
    chunks = spark.createDataFrame(rows, "id string, kb_id string, text string, vec array<double>")
    store = DocStore(spark, chunks=chunks)
    assert store.get("2").first()["text"] == "green apple"
    got = store.search(Search(select=["id"], text=("text", ["apple"]), dense=("vec", [1.0, 0.0], 10, -1.0), highlight="text")).collect()
    assert [r["id"] for r in got] == ["1", "2"] and "<em>apple</em>" in got[0]["highlight"]
    assert store.total(Search(where={"kb_id": ["k2"]})) == 1
    out = search.retrieve(chunks, "apple pie", [1.0, 0.0], similarity_threshold=0.0, knn_threshold=-1.0)
    assert out.orderBy(F.desc("sim")).first()["id"] == "1"
    assert search.retrieve_relaxed(chunks, "apple", [1.0, 0.0]).count() >= 1
    assert one(spark, search.phrase(F.lit("a b x c"), ["b", "c"]), search.phrase(F.lit("a b x c"), ["b", "c"], 1))[:] == (False, True)
    assert one(spark, search.max_similarity(F.array(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(2.0))), [[1.0, 0.0], [0.0, 1.0]]))[0] == 3.0


def test_graph(spark):
    v = spark.createDataFrame([("A", "first", ["s1"], "x"), ("A", "second", ["s2"], "x"), ("B", "b", ["s1"], "y")], "id string, description string, source_id array<string>, entity_type string")
    e = spark.createDataFrame([("A", "B", 1.0, "d1", ["k"], ["s1"]), ("B", "A", 2.0, "d2", ["k"], ["s2"])], "src string, dst string, weight double, description string, keywords array<string>, source_id array<string>")
    a = graph.merge_vertices(v).where("id = 'A'").first()
    assert a["description"] == "first<SEP>second" and a["source_id"] == ["s1", "s2"]
    assert graph.merge_edges(e).first()["weight"] == 3.0
    cv, ce = graph.contract(v, e, spark.createDataFrame([("B", "A")], "id string, component string"))
    assert cv.count() == 1 and ce.count() == 0
    assert graph.compose((v, e), (v, e))[0].where("id = 'B'").first()["rank"] == 1
    chain = spark.createDataFrame([(str(k).zfill(3), str(k + 1).zfill(3), 1.0) for k in range(60)] + [("x", "y", 1.0)], "src string, dst string, weight double")
    comp = {r["id"]: r["component"] for r in graph.components(chain).collect()}
    assert comp["060"] == "000" and comp["y"] == "x" and len(comp) == 63
    star = spark.createDataFrame([("h", str(k), 1.0) for k in range(5)], "src string, dst string, weight double")
    pr = {r["id"]: r["pagerank"] for r in graph.pagerank(star, iterations=40).collect()}
    assert sum(pr.values()) == pytest.approx(1) and pr["h"] > 3 * pr["0"]
    assert graph.pagerank(star, iterations=100, tolerance=1e-6).count() == 6
    ents = spark.createDataFrame([("A", 1.0, [(["A", "B", "C"], [2.0, 3.0])]), ("B", 0.5, [(["B", "C"], [1.0])])], "id string, similarity double, paths array<struct<path:array<string>,weights:array<double>>>")
    s = {(r["src"], r["dst"]): (r["sim"], r["weight"]) for r in graph.nhop_scores(ents).collect()}
    assert s[("A", "B")] == (0.5, 2.0) and s[("B", "C")] == pytest.approx((1 / 3 + 0.25, 3.0))
    rel = spark.createDataFrame([("A", "B", 1.0, 2.0)], "src string, dst string, sim double, pagerank double")
    f = {(r["src"], r["dst"]): r["sim"] for r in graph.fused_relations(rel, graph.nhop_scores(ents), spark.createDataFrame([("A",)], "id string")).collect()}
    assert f[("A", "B")] == pytest.approx(1.0 * (0.5 + 1 + 1)) and f[("B", "C")] == pytest.approx(1 / 3 + 0.25)
    assert one(spark, graph.similar_names(F.lit("computer"), F.lit("computers")), graph.similar_names(F.lit("v1"), F.lit("v2")))[:] == (True, False)
    assert graph.walks(star, length=4, per_node=1).where("size(walk) = 4").count() == 6
    assert graph.label_propagation(star, rounds=3).select("label").distinct().count() <= 2


def test_trees(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 0.05, (6, 4)) + [1, 0, 0, 0], rng.normal(0, 0.05, (5, 4)) + [0, 1, 0, 0]])
    assert len(set(tree.ward_labels(x)[:6])) == 1 and len(set(tree.ward_labels(x))) == 2
    assert set(tree.mixture_labels(x)) <= set(range(11))
    for data, bucket in ((x, 512), (x, 4), (x[:1], 512), (np.zeros((4, 3)), 512)):
        t = tree.psi_tree(data, bucket)
        nodes = [v for v, _ in t]
        assert len(nodes) == len(set(nodes)) and {v for v in nodes if v < len(data)} == set(range(len(data))) and sum(p == -1 for _, p in t) == 1
    top = max(np.bincount([p for _, p in tree.psi_parents(x, 4) if p >= 0]))
    assert top <= 4
    scaled = tree.psi_parents(x * np.arange(1, 12)[:, None])
    assert scaled == tree.psi_parents(x)  # cosine, not magnitude
    df = spark.createDataFrame([("g", k, f"s{k}. t", v.tolist()) for k, v in enumerate(x)], "g string, id int, text string, vec array<double>")
    r = tree.raptor(df, "id", "text", "vec", group="g", layers=2).groupBy("layer").count().collect()
    assert {q["layer"]: q["count"] for q in r}[1] == 2


def test_memory(spark):
    m = spark.createDataFrame([("m", k, "user" if k % 2 else "raw", 10, None if k else "t", [1.0, 0.0], f"word{k} common") for k in range(6)], "mem string, id int, kind string, size int, forget string, vec array<double>, text string")
    assert [r["id"] for r in memory.to_forget(m, "mem", "size", 25, "id", "id", "forget").orderBy("id").collect()] == [0, 1, 2]
    assert [r["id"] for r in memory.recent_messages(m, "mem", "id", 2, "id").orderBy("id").collect()] == [4, 5]
    assert memory.search(m, "id", "text", "vec", ["common"], [1.0, 0.0]).count() == 6
    assert memory.next_message_id(m, "mem", "id").first()["max_id"] == 5 and memory.sizes(m, "mem", "text").first()["bytes"] == 72
    c = spark.createDataFrame([("user",), ("assistant",), ("user",)], "value string")
    done = spark.createDataFrame([("user", 5)], "value string, count int")
    assert {r["value"]: r["count"] for r in relational.merged_counts(c, done).collect()} == {"user": 7, "assistant": 1}
    assert one(spark, memory.has_kind(F.lit(5), memory.EPISODIC), memory.has_kind(F.lit(5), memory.SEMANTIC))[:] == (True, False)


def test_dml(spark, tmp_path):
    table = dml.Table(spark, f"file://{tmp_path}/t", ["kb"])
    table.upsert(spark.createDataFrame([("1", "a", ["x"], 1.0), ("2", "a", ["y"], 2.0)], "id string, kb string, tags array<string>, pagerank_fea double"))
    table.upsert(spark.createDataFrame([("2", "a", ["z"], 9.0, "new"), ("3", "b", ["q"], None, None)], "id string, kb string, tags array<string>, pagerank_fea double, extra string"))
    assert {r["id"]: r["tags"] for r in table.read().collect()} == {"1": ["x"], "2": ["z"], "3": ["q"]}
    table.update({"id": "1"}, {"extra": "set", "add": {"tags": "w"}, "remove": "pagerank_fea"})
    r = table.read().where("id = '1'").first()
    assert r["extra"] == "set" and r["tags"] == ["x", "w"] and r["pagerank_fea"] is None
    table.update({"id": "1"}, {"remove": {"tags": "x"}})
    table.delete({"id": ["3"]})
    assert {q["id"]: q["tags"] for q in table.read().collect()} == {"1": ["w"], "2": ["z"]}
    got = dml.adjusted_pagerank(table.read(), spark.createDataFrame([("2", -50.0), ("1", 7.0), ("1", 200.0)], "id string, delta double"))
    assert {q["id"]: q["pagerank_fea"] for q in got.collect()} == {"1": 100.0, "2": None}
    m = one(spark, dml.metadata_delete(dml.metadata_set(F.create_map(F.lit("a"), F.array(F.lit("1"))), {"b": ["2"], "a": ["3"]}), ["b"]))[0]
    assert m == {"a": ["3"]}
    table.drop()
    assert not table.exists()


def test_metrics(spark):
    m = evals.set_metrics(F.array(*map(F.lit, "abcd")), F.array(*map(F.lit, "cx")))
    assert one(spark, *(m[k].alias(k) for k in ("precision", "recall", "f1", "hit_rate", "mrr")))[:] == pytest.approx((0.25, 0.5, 1 / 3, 1.0, 1 / 3))
    run = spark.createDataFrame([("q", "a", 3.0), ("q", "b", 2.0), ("q", "c", 1.0)], "query string, chunk_id string, score double")
    rel = spark.createDataFrame([("q", "b", 1), ("q", "z", 1)], "query string, chunk_id string, rel int")
    r = evals.rank_metrics(run, rel).first()
    assert (r["ndcg"], r["ap"], r["rr"]) == pytest.approx(((1 / np.log2(3)) / (1 + 1 / np.log2(3)), 0.25, 0.5))
    ms = spark.createDataFrame([("q", ([0, 1], ["p", "r"]))], "query string, passages struct<is_selected:array<int>,passage_text:array<string>>")
    assert [(x["text"], x["rel"]) for x in evals.passages(ms).orderBy("text").collect()] == [("p", 0), ("r", 1)]


def _zip(files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for n, t in files.items():
            z.writestr(n, t)
    return b.getvalue()


def test_parsers(spark, tmp_path):
    page = "<html><head><style>x{}</style></head><body><h2>T</h2><p>a <b>b</b><br>c</p><table><tr><td>1</td></tr><tr><td>2</td></tr></table><script>var x</script></body></html>"
    assert parsers.html_blocks(page) == [("text", "## T"), ("text", "a b c"), ("table", "<table><tr><td>1</td></tr><tr><td>2</td></tr></table>")]
    assert len(parsers.split_table(parsers.html_blocks(page)[2][1], 1)) == 2
    assert parsers.is_json_lines('{"a":1}\n{"b":2}') and len(parsers.json_blocks('{"a":1}\n{"b":2}')) == 2
    big = {"k": {str(i): "v" * 50 for i in range(40)}}
    parts = [json.loads(x) for x in parsers.split_json(big, 256)]
    assert len(parts) > 2 and {k for p in parts for k in p["k"]} == set(big["k"])
    md = "# H\n\ntext\nmore\n\n- a\n- b\n\n```py\n# not a header\n```\n\n| a | b |\n|---|---|\n| 1 | 2 |\n> quote"
    kinds = [k for k, _ in parsers.markdown_blocks(md)]
    assert kinds == ["header", "text", "list", "code", "quote", "table"]
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    docx = _zip({"word/document.xml": f"<w:document {w}><w:body><w:p><w:r><w:t>Hello</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>x</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>"})
    assert parsers.docx_blocks(docx) == [("text", "Hello"), ("table", "<table><tr><td>x</td></tr></table>")]
    xlsx = _zip({"xl/workbook.xml": '<workbook><sheets><sheet name="S"/></sheets></workbook>', "xl/sharedStrings.xml": "<sst><si><t>h</t></si><si><t>v</t></si></sst>", "xl/worksheets/sheet1.xml": '<worksheet><sheetData><row><c r="A1" t="s"><v>0</v></c></row><row><c r="A2" t="s"><v>1</v></c><c r="C2"><v>5</v></c></row></sheetData></worksheet>'})
    assert parsers.xlsx_rows(xlsx) == {"S": [["h"], ["v", "", "5"]]} and parsers.excel_blocks(xlsx)[0][1].startswith("h: v")
    epub = _zip({"META-INF/container.xml": '<container><rootfile full-path="o/c.opf"/></container>', "o/c.opf": '<package><item id="a" href="1.html"/><item id="b" href="2.html"/><itemref idref="b"/><itemref idref="a"/></package>', "o/1.html": "<p>one</p>", "o/2.html": "<p>two</p>"})
    assert [t for _, t in parsers.epub_blocks(epub)] == ["two", "one"]
    a = 'xmlns:a="x" xmlns:p="y"'
    pptx = _zip({"ppt/slides/slide1.xml": f'<p:sld {a}><p:sp><a:off x="0" y="9"/><a:p><a:t>low</a:t></a:p></p:sp><p:sp><a:off x="0" y="1"/><a:p><a:t>high</a:t></a:p></p:sp></p:sld>'})
    assert parsers.pptx_blocks(pptx) == [("slide", "high\nlow")]
    for name, data in (("a.docx", docx), ("b.html", page.encode()), ("c.bin", b"?")):
        (tmp_path / name).write_bytes(data)
    blobs = connectors.blobs(spark, f"file://{tmp_path}")
    got = parsers.parse_files(blobs, "path", "blob").collect()
    assert {r["kind"] for r in got if r["doc_id"].endswith("c.bin")} == {"error"} and sum(r["doc_id"].endswith("a.docx") for r in got) == 2


def fake_client():
    """Two pages of a listing, for each split; a function in a function, so that it travels to the workers by value."""
    import json

    def client(url, headers):
        if "feed" in url:
            return "<rss><channel><item><guid>g1</guid><title>t</title><description>&lt;p&gt;hi&lt;/p&gt;</description><pubDate>Tue, 02 Jan 2024 00:00:00 GMT</pubDate></item></channel></rss>"
        first = "page=1&" in url + "&"
        items = [{"id": f"{url.split('?')[0].split('/')[3]}-{k}", "title": "T", "content": "<b>c</b>", "updated_at": f"2024-01-0{k}T00:00:00Z"} for k in ((1, 2) if first else (3,))]
        return json.dumps({"data": items})

    return client


def test_connectors(spark, tmp_path):
    e = connectors.Endpoint("http://x/{split}", "data", paging="page", size=2, size_param="n", splits=("r1", "r2"))
    spark.dataSource.register(connectors.data_source("fake_rest", e, fake_client()))
    rows = spark.read.format("fake_rest").load()
    assert rows.count() == 6 and rows.first()["content"] == "c"
    window = spark.read.format("fake_rest").option("start", "2024-01-01T00:00:00Z").option("end", "2024-01-02T00:00:00Z").load()
    assert {r["id"] for r in window.collect()} == {"r1-2", "r2-2"}
    spark.dataSource.register(connectors.data_source("fake_rss", connectors.Endpoint("http://feed/{split}", format="rss"), fake_client()))
    assert spark.read.format("fake_rss").load().first()["content"] == "hi"
    assert {"github", "jira", "rss", "rest"} <= set(connectors.register_services(spark))
    q = connectors.Rdbms("jdbc:x", query="SELECT * FROM t ORDER BY a;", cursor="ts")
    assert q.derived("1", "2") == "(SELECT * FROM (SELECT * FROM t) q WHERE q.ts > '1' AND q.ts <= '2') src"
    (tmp_path / "m.eml").write_text("From: a@b.c\nSubject: Hi\nDate: Tue, 02 Jan 2024 00:00:00 +0000\n\nBody text\n")
    assert connectors.mail(spark, f"file://{tmp_path}").first()["title"] == "Hi"


def test_streams(spark, tmp_path):
    src, out = f"{tmp_path}/in", dml.Table(spark, f"file://{tmp_path}/out")
    t0 = dt.datetime(2024, 1, 1)
    mk = lambda rows: spark.createDataFrame([(k, v, t0 + dt.timedelta(minutes=m)) for k, v, m in rows], "k string, v double, ts timestamp").coalesce(1)
    mk([("a", 1.0, 0), ("b", 2.0, 1)]).write.mode("append").parquet(src)
    stream = lambda: sinks.file_stream(spark, src, mk([("a", 1.0, 0)]).schema)
    sinks.upsert_into(stream(), out, "k", "ts", "v", f"{tmp_path}/c1").awaitTermination()
    mk([("a", 5.0, 9), ("b", 0.0, 0)]).write.mode("append").parquet(src)
    sinks.upsert_into(stream(), out, "k", "ts", "v", f"{tmp_path}/c1").awaitTermination()
    assert {r["k"]: r["v"] for r in out.read().collect()} == {"a": 5.0, "b": 2.0}
    win = windows.windowed(stream(), "ts", "5 minutes", ["k"], [F.count("*").alias("n")])
    q = win.writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c2").start()
    q.awaitTermination()
    assert spark.table("w").agg(F.sum("n")).first()[0] == 4
    q = windows.running_totals(stream(), "k", "v").writeStream.format("memory").queryName("r").outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c3").start()
    q.awaitTermination()
    assert spark.table("r").groupBy("k").agg(F.max("n")).orderBy("k").collect()[0][1] == 2
    write, gone = sinks.changes(spark.createDataFrame([("1", "f"), ("2", "f")], "id string, fp string"), spark.createDataFrame([("2", "g"), ("3", "f")], "id string, fp string"), "id", "fp")
    assert {r["id"] for r in write.collect()} == {"2", "3"} and [r["id"] for r in gone.collect()] == ["1"]


def test_channels(spark):
    w = spark.createDataFrame([("c", 1, "a", 1), ("c", 2, "b", 5), ("d", 1, "a", 2), ("d", 1, "b", 3)], "channel string, step int, writer string, value int")
    assert channels.last_value(w.where("channel = 'c'")).first()["value"] == 5
    with pytest.raises(Exception, match="more than one value"):
        channels.last_value(w).collect()
    assert {r["channel"]: r["value"] for r in channels.topic(w).collect()} == {"c": [1, 5], "d": [2, 3]}
    assert {r["channel"]: r["value"] for r in channels.topic(w, False).collect()} == {"c": [5], "d": [2, 3]}
    assert {r["channel"]: r["value"] for r in channels.folded(w, "concat").collect()} == {"c": "15", "d": "23"}
    assert {r["channel"]: r["value"] for r in channels.folded(w.withColumn("o", F.col("step") == 2), "sum", "o").collect()} == {"c": 5, "d": 5}
    assert {r["channel"]: r["ready"] for r in channels.barrier(w, ["a", "b"]).collect()} == {"c": True, "d": True}


def test_pregel():
    g = pregel.StateGraph(reducers={"log": lambda a, b: (a or []) + b})
    g.node("a", lambda s: {"log": ["a"], "n": s.get("n", 0) + 1}).node("b", lambda s: {"log": ["b"]}).node("c", lambda s: {"log": ["c"]}).node("j", lambda s: {"log": ["j"]})
    g.edge(pregel.START, "a").edge("a", "b").edge("a", "c").edge(["b", "c"], "j").branch("j", lambda s: "a" if s["n"] < 2 else pregel.END)
    assert g.run({})["log"] == ["a", "b", "c", "j", "a", "b", "c", "j"]
    loop = pregel.StateGraph().node("x", lambda s: {}).edge(pregel.START, "x").edge("x", "x")
    with pytest.raises(pregel.RecursionLimitError):
        loop.run({}, limit=5)
    clash = pregel.StateGraph().node("x", lambda s: {"v": 1}).node("y", lambda s: {"v": 2}).edge(pregel.START, "x").edge(pregel.START, "y")
    with pytest.raises(ValueError, match="two values"):
        clash.run({})
    assert clash.run({}, interrupt_before=("y",))["__interrupted__"] == ["y"]


def test_canvas(spark):
    items = spark.createDataFrame([(1, ["b", "a", "b"]), (2, [])], "k int, items array<string>")
    dsl = {
        "components": {
            "begin": {"obj": {"component_name": "Begin", "params": {}}, "downstream": ["uniq", "vars"]},
            "uniq": {"obj": {"component_name": "ListOperations", "params": {"query": "sys.t", "operations": "drop_duplicates"}}, "downstream": []},
            "vars": {"obj": {"component_name": "VariableAssigner", "params": {"variables": [{"variable": "env.n", "operator": "+=", "parameter": "sys.one"}, {"variable": "env.l", "operator": "append", "parameter": "sys.one"}, {"variable": "env.n2", "operator": "/=", "parameter": 0}]}}, "downstream": ["text"]},
            "text": {"obj": {"component_name": "StringTransform", "params": {"method": "merge", "script": "n={env.n} l={env.l}", "delimiters": ["+"]}}, "downstream": ["agg"]},
            "agg": {"obj": {"component_name": "VariableAggregator", "params": {"groups": [{"group_name": "g", "variables": ["{nothing@x}", "{text@result}"]}]}}, "downstream": []},
        }
    }
    c = Canvas(spark, dsl, {"sys.t": items, "sys.one": 1, "env.n": 2, "env.l": [7], "env.n2": 3})
    out = c.run()
    assert [r["result"] for r in out["uniq"]["result"].orderBy("k").collect()] == [["b", "a"], []]
    assert out["text"]["result"] == "n=3 l=7+1" and out["agg"]["g"] == "n=3 l=7+1" and c.globals["env.n2"] == "ERROR:DIVIDE_BY_ZERO"


def test_sql_and_user_code(spark):
    assert sql.statements("```sql\nselect ';' as a; select 2 -- x\n```") == ["select ';' as a", "select 2"]
    assert "array_contains(split(content_ltks, ' '), 'red')" in sql.text_predicates("SELECT * FROM t WHERE content_ltks LIKE '%Red%'")
    df = spark.createDataFrame([(1, float("nan"))], "a int, b double")
    assert next(sql.execute(spark, "select b from t1", {"t1": df})).first()["b"] is None
    publish(spark, "plus_one", lambda s: s + 1, "long")
    assert spark.sql("select plus_one(41L)").first()[0] == 42
    assert transform_with(df, lambda p: p.assign(a=p.a * 2), "a int, b double").first()["a"] == 2
    v = one(spark, embed(F.lit("alpha beta")), embed(F.lit("alpha beta")), embed(F.lit("")))
    assert v[0] == v[1] and sum(x * x for x in v[0]) == pytest.approx(1) and sum(map(abs, v[2])) == 0
    assert embedded(spark.createDataFrame([("x",)], "t string"), "t", lambda xs: np.ones((len(xs), 3))).first()["vec"] == [1, 1, 1]


def test_schemas(spark):
    assert "tag_feas" in chunk_schema().names and "forget_at" in message_schema().names
    assert (type_of("a_kwd"), type_of("docnm_kwd"), type_of("x_sm_tks"), type_of("n_long"), type_of("q_768_vec")) == ("array<string>", "string", "string", "bigint", "array<float>")


def _crash(table, monkeypatch, step):
    def fail(*_):
        raise OSError(step)

    monkeypatch.setattr(table, step, fail)


@pytest.mark.parametrize("step", ["_add", "_commit"])
def test_a_change_that_breaks_off_leaves_the_table(spark, tmp_path, monkeypatch, step):
    rows = spark.createDataFrame([("1", "a", 1.0), ("2", "b c", 2.0)], "id string, kb string, x double")
    dml.Table(spark, f"file://{tmp_path}/t", ["kb"]).upsert(rows)
    broken = dml.Table(spark, f"file://{tmp_path}/t", ["kb"])
    _crash(broken, monkeypatch, step)
    for change in (lambda: broken.upsert(rows.withColumn("x", F.lit(9.0))), lambda: broken.delete({"id": ["1"]}), lambda: broken.update({"id": "1"}, {"x": 5.0})):
        with pytest.raises(OSError, match=step):
            change()
    table = dml.Table(spark, f"file://{tmp_path}/t", ["kb"])
    assert {r["id"]: r["x"] for r in table.read().collect()} == {"1": 1.0, "2": 2.0} and table.version() == 1
    table.upsert(spark.createDataFrame([("3", "a", 3.0)], "id string, kb string, x double"))
    assert {r["id"]: r["x"] for r in table.read().collect()} == {"1": 1.0, "2": 2.0, "3": 3.0}


def test_versions_partitions_and_other_writers(spark, tmp_path):
    schema = "id string, kb string, x double"
    table = dml.Table(spark, f"file://{tmp_path}/t", ["kb"], keep=3)
    table.upsert(spark.createDataFrame([("1", "a", 1.0), ("2", "b c", 2.0), ("4", None, 4.0)], schema))
    first, before = table.read(), table._contents(1)[0]
    table.upsert(spark.createDataFrame([("1", "a", 7.0)], schema))
    assert len(set(table._contents(2)[0]) & set(before)) == 2  # the other partitions' folders stay
    assert {r["id"]: r["x"] for r in first.collect()} == {"1": 1.0, "2": 2.0, "4": 4.0}  # a reader of the version before
    table.upsert(spark.createDataFrame([("2", "a", 8.0), ("4", None, 5.0)], schema))  # a row moves to another partition
    assert {r["id"]: (r["kb"], r["x"]) for r in table.read().collect()} == {"1": ("a", 7.0), "2": ("a", 8.0), "4": (None, 5.0)}
    assert {r["id"]: r["x"] for r in table.read(1).collect()} == {"1": 1.0, "2": 2.0, "4": 4.0}
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(2, *table._contents(3))
    for _ in range(3):
        table.update({"id": "1"}, {"x": 0.5})
    assert table.versions() == [4, 5, 6]
    table.delete({"id": ["1", "2"]})
    table.delete({"id": ["4"]})
    assert table.read().count() == 0 and set(table.read().columns) == {"id", "kb", "x"}
    table.upsert(spark.createDataFrame([("9", "z", 1.5)], schema))
    assert [tuple(r) for r in table.read().select("id", "kb", "x").collect()] == [("9", "z", 1.5)]


DSL = {"name": "n", "pipeline": [{"operator": "preprocess", "normalize_newlines": True}, {"operator": "split", "strategy": "sentence", "params": {"boundaries": [". "], "keep_separators": True}}, {"operator": "postprocess", "merge": {"target_size": 30, "strategy": "greedy"}, "overlap": {"enabled": True, "unit": "char", "conditions": [{"name": "c", "if": "length > 12", "then": {"size": 1, "unit": "sentence"}}], "default": {"size": 2}}, "filter": {"min_length": 1}}]}


def test_chunk_dsl_as_a_pipeline(spark):
    plan = chunking.compile_plan(DSL)
    assert plan.operators == ["preprocess", "split", "postprocess"] and plan.name == "n" and plan.version == "1.0"
    flat = {"preprocess": {"normalize_newlines": True}, "split": DSL["pipeline"][1] | {}, "postprocess": DSL["pipeline"][2] | {}}
    flat = {k: {x: y for x, y in v.items() if x != "operator"} for k, v in flat.items()}
    docs = spark.createDataFrame([(1, "Aa bb. Cc dd. A longer sentence here. End")], "doc_id long, text string")
    got = [r["content"] for r in plan.execute(docs).orderBy("index").collect()]
    assert got == [r["content"] for r in chunking.compile_plan(flat).execute(docs).orderBy("index").collect()]
    assert got == ["Aa bb.  Cc dd. ", "Cc dd.A longer sentence here.  End"]
    assert chunking.compile_plan({"pipeline": []}).execute(docs).count() == 0 == chunking.compile_plan({"version": "1.0"}).execute(docs).count()


@pytest.mark.parametrize(
    "dsl, message",
    [
        ("{bad json}", "Expecting"),
        ({"pipeline": [{"operator": "unknown_operator"}]}, "unknown_operator"),
        ({"pipeline": ["split"]}, "expected object"),
        ({"pipeline": [{"operator": "split", "strategi": "char"}]}, "strategi"),
        ({"pipeline": [{"operator": "split", "strategy": "nope"}]}, "nope"),
        ({"pipelines": []}, "pipelines"),
        ({"postprocess": {"merge": {"strategy": "other"}}}, "other"),
        ({"postprocess": {"overlap": {"conditions": [{"if": "length > 1", "then": {"size": 1, "unit": "word"}}]}}}, "word"),
        ({"pipeline": [{"operator": "split"}, {"operator": "preprocess"}]}, "order"),
    ],
)
def test_chunk_dsl_mistakes_show(dsl, message):
    with pytest.raises(ValueError, match=message):
        chunking.compile_plan(dsl)


def test_apportion_without_weights(spark):
    rows = spark.createDataFrame([(1, 0.0, "a"), (2, 0.0, "a"), (3, 0.0, "a"), (4, 2.0, "b"), (5, 1.0, "b")], "id long, w double, g string")
    got = {r["id"]: r["share"] for r in relational.apportion(rows, "w", 8, "id", ["g"]).collect()}
    assert got == {1: 3, 2: 3, 3: 2, 4: 5, 5: 3}


def test_similar_names_rule(spark):
    rows = [("Apple Inc", "The Apple Inc", True), ("ab1c", "a1bc", False), ("APPLE", "apple", False), ("item 7", "item 7", True), ("张三丰", "张三", True), ("一二三四五", "一二三四六", True), ("一二三四五", "一二三七六", False), ("a", "b", False), (None, "x", False)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean")
    assert [r["got"] for r in df.select(graph.similar_names(F.col("a"), F.col("b")).alias("got")).collect()] == [r[2] for r in rows]


def test_resolution_loses_no_pair(spark):
    import itertools
    import random

    rnd = random.Random(4)
    names = ["".join(rnd.choices("abcde 12", k=rnd.randint(1, 9))) for _ in range(60)] + ["张三", "张三丰", "李四"]
    rows = [(n, rnd.choice(["x", "y", None])) for n in names] * 2
    df = spark.createDataFrame(rows, "n string, k string")
    links = {(r["a"], r["b"], r["kind"]) for r in graph.resolution_links(df, "n", "k", block=7).collect()}
    every = spark.createDataFrame([(a, b, k) for k in ("x", "y", None) for a, b in itertools.combinations(sorted({n for n, j in rows if j == k}), 2)], "a string, b string, k string")
    assert links == {tuple(r) for r in every.where(graph.similar_names(F.col("a"), F.col("b"))).collect()}
    got = {(r["name"], r["kind"]): (r["links"], r["component"]) for r in graph.resolution(df, "n", "k", block=7).collect()}
    assert set(got) == set(rows) and all(got[n, k][0] == sum(n in p[:2] and p[2] == k for p in links) for n, k in got)
    assert all(got[a, k][1] == got[b, k][1] <= a for a, b, k in links)


def test_column_kinds(spark):
    cells = {"12": "int", "-3": "int", "007": "text", "0": "text", "1.5": "float", "0.5": "text", "12%%": "int", "9223372036854775808": "big", "✔": "bool", "No": "bool", "on": "text", "1": "int", "2024-05-06": "datetime", "2024/5/6 7:08:09": "datetime", "5/6/2024": "datetime", "May 6, 2024": "datetime", "word": "text"}
    df = spark.createDataFrame([(k,) for k in cells], "c string")
    assert {r["c"]: r["k"] for r in df.select("c", templates.value_kind(F.col("c")).alias("k")).collect()} == cells
    kinds = {r["column"]: r["kind"] for r in templates.column_types(df.select("c", F.when(F.col("c").rlike("^[0-9]+$") & ~F.col("c").startswith("0"), F.col("c")).alias("n")), ["c", "n"]).collect()}
    assert kinds["n"] == "float"
    assert [r[0] for r in spark.createDataFrame([("☑",), ("⍻",), ("1",), (" YES",)], "c string").select(templates.as_bool(F.col("c"))).collect()] == ["yes", "no", None, "yes"]


def _server(endpoint, calls):
    """A service that lists three items on two pages, by the paging that its endpoint describes; it remembers its calls."""
    from urllib.parse import parse_qs, urlparse

    def put(into, path, value):
        *heads, last = [path] if path.startswith("@") else path.split(".")
        for h in heads:
            into = into.setdefault(h, {})
        into[last] = value

    def item(k):
        out = {}
        for path, value in ((endpoint.title, f"t{k}"), (endpoint.content[0], f"c{k}"), (endpoint.updated, "2024-01-02T03:04:05Z"), (endpoint.id, f"i{k}")):
            put(out, path, value)
        return out

    def client(url, headers, data=None):
        query = {k: v[0] for k, v in parse_qs(urlparse(url).query).items()}
        sent = json.loads(data) if data else query
        calls.append((url, sent, data))
        second = sent.get(endpoint.page_param) == "CUR" if endpoint.paging == "cursor" else sent.get(endpoint.page_param) == "i1" if endpoint.paging == "last" else "page2" in url if endpoint.next_url else False
        if endpoint.paging == "page":
            second = sent[endpoint.page_param] == str(endpoint.first_page + 1)
        if endpoint.paging == "offset":
            second = sent[endpoint.page_param] == "2"
        items = [item(2)] if second else [item(0), item(1)]
        if not endpoint.items:
            return json.dumps(items)
        body = {}
        put(body, endpoint.items, items)
        if not second and endpoint.paging == "cursor":
            put(body, endpoint.cursor_path, "CUR")
        if not second and endpoint.next_url:
            put(body, endpoint.next_url, "/services/page2" if endpoint.next_url == "nextRecordsUrl" else "https://next/page2")
        return json.dumps(body)

    return client


@pytest.mark.parametrize("name", sorted(connectors.SERVICES))
def test_services_are_listed_to_the_end(name):
    import dataclasses

    e = dataclasses.replace(connectors.SERVICES[name], size=2, headers=(*connectors.SERVICES[name].headers, ("Authorization", "Bearer KEY")))
    calls = []
    rows = list(connectors.rows_of(e, "sub.example", _server(e, calls), None, None))
    paged = e.paging != "none" or e.next_url
    assert [r[0] for r in rows] == (["i0", "i1", "i2"] if paged else ["i0", "i1"]) and len(calls) == (2 if paged else 1)
    assert all((data is not None) == (e.body is not None) for *_, data in calls) and "{" not in calls[0][0].replace("%7B", "{")
    if name == "dropbox":
        assert calls[0][1] == {"path": "sub.example", "recursive": True, "limit": 2} and calls[1][:2] == ("https://api.dropboxapi.com/2/files/list_folder/continue", {"cursor": "CUR"})
    if name == "notion":
        assert calls[1][1] == {"page_size": 2, "start_cursor": "CUR"}
    if name == "moodle":
        assert calls[0][1]["wstoken"] == "KEY" and calls[0][1]["wsfunction"].startswith("core_course")
    if name == "salesforce":
        assert calls[0][1]["q"].startswith("SELECT Id") and calls[1][0] == "https://sub.example/services/page2"


def test_enrichment_asks_once_for_a_text(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Red apples fall. Then rest."), (2, "Red apples fall. Then rest."), (3, None)], "id long, text string")
    cache, asked = dml.Table(spark, f"file://{tmp_path}/cache"), spark.sparkContext.accumulator(0)

    def model(c):
        @F.pandas_udf("string")
        def answer(s):
            asked.add(len(s))
            return s.fillna("").str.upper()

        return answer(c)

    out = enrich.enriched(rows, "summary", model=model, cache=cache)
    assert {r["id"]: r["summary"] for r in out.collect()} == {1: "RED APPLES FALL. THEN REST.", 2: "RED APPLES FALL. THEN REST.", 3: ""}
    first = asked.value
    again = enrich.enriched(rows.unionByName(spark.createDataFrame([(4, "new")], "id long, text string")), "summary", model=model, cache=cache)
    assert {r["id"]: r["summary"] for r in again.collect()}[4] == "NEW" and first <= 4 and asked.value - first <= 2
    assert {r["id"]: r["summary"] for r in enrich.enriched(rows, "summary").collect()} == {1: "Red apples fall.", 2: "Red apples fall.", 3: None}


def test_metadata_as_json_schema():
    want = {"type": "object", "properties": {"a": {"description": "x", "enum": ["1"], "type": "string"}, "b": {"description": ""}}, "additionalProperties": False}
    assert enrich.json_schema([{"key": "a", "descriptions": "x", "enum": ["1"]}, {"key": "b", "description": None}]) == want
    assert enrich.json_schema(want) == want and enrich.json_schema([{"key": ""}]) == {} == enrich.json_schema([]) == enrich.json_schema({"a": 1}) == enrich.json_schema([{"key": "a", "enum": "x"}])


def test_model_tokens(spark):
    P = pytest.importorskip("public_tokenizers")
    import base64

    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=X.CUTS, mergeable_ranks=ranks, special_tokens={})
    texts = ["Hello world, it's 12345 o'clock.\n\n", "日本語 é <|endoftext|>", "", None, "a" * 5000]
    got = [r["n"] for r in spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", X.model_token_count(F.col("t"), path).alias("n")).orderBy("i").collect()]
    assert got == [len(plain.encode_ordinary(t or "")) for t in texts]


def test_pairwise_sum_of_long_arrays(spark):
    got = one(spark, V.pairwise_sum(F.array_repeat(F.lit(0.1), 1000)), V.pairwise_sum(F.array().cast("array<double>")))
    assert abs(got[0] - 100) < 1e-11 and got[1] == 0


def test_ward_merges_are_nearest_pairs():
    rng = np.random.default_rng(3)
    for n in (2, 3, 9, 25):
        x = rng.normal(size=(n, 3))
        groups, heights = {k: [k] for k in range(n)}, []
        for step in range(n - 1):  # by definition: the pair whose union adds least variance
            cost = lambda a, b: len(a) * len(b) / (len(a) + len(b)) * 2 * ((x[a].mean(0) - x[b].mean(0)) ** 2).sum()
            a, b = min(itertools.combinations(groups, 2), key=lambda p: cost(groups[p[0]], groups[p[1]]))
            heights.append(cost(groups[a], groups[b]) ** 0.5)
            groups[n + step] = groups.pop(a) + groups.pop(b)
        assert np.allclose([h for *_, h in tree.ward_merges(x)], heights)


def test_ward_clusters_of_few_rows_and_at_most_so_many():
    rng = np.random.default_rng(6)
    assert [tree.ward_labels(rng.normal(size=(n, 3))).tolist() for n in (0, 1, 2)] == [[], [0], [0, 1]]
    three = np.array([[0.0, 0], [0.1, 0], [9, 9]])
    assert tree.ward_labels(three)[0] == tree.ward_labels(three)[1] != tree.ward_labels(three)[2]
    even = np.concatenate([np.arange(40.0), [100.0, 101.0]])[:, None] * 10  # many equal merges, the gap is early
    assert len(set(tree.ward_labels(even, most=5, refinements=0))) <= 5

    def plain(x, most):  # by definition, with the cut of the docstring
        groups, heights, kept = {k: [k] for k in range(len(x))}, [], []
        while len(groups) > 1:
            kept.append([sorted(g) for g in groups.values()])
            cost = lambda a, b: len(a) * len(b) / (len(a) + len(b)) * 2 * ((x[a].mean(0) - x[b].mean(0)) ** 2).sum()
            a, b = min(itertools.combinations(groups, 2), key=lambda p: cost(groups[p[0]], groups[p[1]]))
            heights.append(cost(groups[a], groups[b]) ** 0.5)
            groups[len(x) + len(heights)] = groups.pop(a) + groups.pop(b)
        n = max(1, min(len(x) - int(np.argmax(np.diff(heights))) - 1, most))
        return sorted(kept[len(x) - n]) if n > 1 else [list(range(len(x)))]

    for n, most in ((3, 64), (12, 64), (25, 4), (30, 64)):
        x = rng.normal(size=(n, 3))
        got = tree.ward_labels(x, most=most, refinements=0)
        assert sorted(np.flatnonzero(got == c).tolist() for c in set(got)) == plain(x, most)


def test_mixtures_with_full_covariances():
    rng = np.random.default_rng(8)
    long = rng.normal(size=(150, 2)) * [6, 0.2] @ np.array([[0.8, 0.6], [-0.6, 0.8]])
    z = np.concatenate([long, long @ np.array([[0, 1], [-1, 0]]) + [0, 14]])
    bics = tree.mixture_bics(z, 4, 1)
    assert int(np.argmin(bics)) == 1  # two long clouds, which round ones would need more for
    assert len(set(tree.mixture_labels(z, most=4, layout=False)[:150])) == 1
    one = z[:150]
    cov = np.cov(one.T, bias=True) + 1e-6 * np.eye(2)
    likelihood = -0.5 * (len(one) * np.log(np.linalg.det(2 * np.pi * cov)) + np.einsum("ij,jk,ik->", one - one.mean(0), np.linalg.inv(cov), one - one.mean(0)))
    assert abs(tree.mixture_bics(one, 1, 1)[0] - (5 * np.log(150) - 2 * likelihood)) < 1e-3


def test_spanning_trees_in_blocks(spark):
    rng = np.random.default_rng(5)
    data = {"a": rng.normal(size=(130, 5)), "b": np.round(rng.normal(size=(60, 2))) + 0.0, "c": np.ones((40, 3)), "one": rng.normal(size=(1, 5))}
    rows = [(g, 1000 - k if g == "a" else k, v.tolist()) for g, x in data.items() for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g string, i long, v array<double>").repartition(3)
    got = {}
    for r in tree.spanning_trees(df, "g", "i", "v", block=32, keep=3).collect():
        got.setdefault(r["g"], []).append((r["a_id"], r["b_id"], round(r["cosine"], 8)))
    for g, x in data.items():
        ids = sorted(i for h, i, _ in rows if h == g)
        by = {i: np.array(v) for h, i, v in rows if h == g}
        u = tree.unit(np.stack([by[i] for i in ids]))
        cosine = np.round(u @ u.T, tree.DIGITS)
        pairs = sorted(itertools.combinations(range(len(ids)), 2), key=lambda p: (-cosine[p], p))
        root, want = list(range(len(ids))), []
        for a, b in pairs:  # Kruskal
            if root[a] != root[b]:
                want.append((ids[a], ids[b], round(float(cosine[a, b]), 8)))
                root = [root[a] if r == root[b] else r for r in root]
        assert sorted(got.get(g, [])) == sorted(want)
    order = lambda df: sorted((r["g"], r["node"], r["parent"], r["i"] is None, r["i"] or 0) for r in df.collect())
    assert order(tree.psi(df, "g", "i", "v", small=50)) == order(tree.psi(df, "g", "i", "v"))


def test_large_groups_are_clustered_in_buckets(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 4)) * 9
    rows = [("big", k, (centres[k % 6] + rng.normal(size=4) * 0.1).tolist()) for k in range(240)] + [("big", 1000 + k, [1.0] * 4) for k in range(60)] + [("small", k, [float(k), 1.0]) for k in range(5)]
    df = spark.createDataFrame(rows, "g string, i long, v array<double>")
    sizes = {(r["g"], r["_bucket"]): r["count"] for r in tree.in_buckets(df, "g", "i", "v", 50).groupBy("g", "_bucket").count().collect()}
    assert max(sizes.values()) <= 50 + 40 and sizes["small", ""] == 5 and sum(sizes.values()) == 305
    got = {(r["g"], r["i"]): r["cluster"] for r in tree.clusters(df, "g", "i", "v", size=50).collect()}
    assert len(got) == 305
    for c in {c for (g, _), c in got.items() if g == "big"}:
        kinds = {k % 6 for (g, k), x in got.items() if g == "big" and x == c and k < 1000}
        assert len(kinds) <= 6
    assert sorted({c for (g, _), c in got.items() if g == "big"}) == list(range(len({c for (g, _), c in got.items() if g == "big"})))
