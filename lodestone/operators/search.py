"""Search: full text (BM25 over postings), dense and sparse vectors, fusion, reranking, the retrieval pipeline, paging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import terms as T
from ..functions import text as X
from ..functions import values as V
from .scratch import stored

BOOSTS = {"title_tks": 10.0, "title_sm_tks": 5.0, "important_kwd": 30.0, "important_tks": 20.0, "question_tks": 20.0, "content_ltks": 2.0, "content_sm_ltks": 1.0}
K1, B = 1.2, 0.75
#: First-stage fusion weights (text, vector), rerank weight of the vector, and thresholds by stage.
FIRST_STAGE = (0.05, 0.95)
VECTOR_WEIGHT, KNN_THRESHOLD, RETRY_THRESHOLD, MIN_MATCH, RETRY_MATCH, FINAL_THRESHOLD, TOP = 0.3, 0.1, 0.17, 0.3, 0.1, 0.2, 1024


# --- text -------------------------------------------------------------------------------------------------------------


def postings(chunks: DataFrame, id_col: str, text: Column) -> DataFrame:
    """The inverted index (token, id, tf, len): store it bucketed by token where many queries run."""
    rows = chunks.select(F.col(id_col).alias("id"), X.tokens(text).alias("_t"))
    return rows.select("id", F.size("_t").alias("len"), F.explode("_t").alias("token")).groupBy("token", "id", "len").agg(F.count("*").alias("tf"))


_EDGE = "[\\p{L}\\p{N}]"


def spaced(text: Column) -> Column:
    """The tokens of a text, each between two blanks of its own, so that counting is a search for plain strings."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"[^{_EDGE[1:-1]}]+", "  ")), F.lit(" "))


def _count(tokens: Column, term: str) -> Column:
    found = " " + "  ".join(term.lower().split()) + " "
    return ((F.octet_length(tokens) - F.octet_length(F.replace(tokens, F.lit(found), F.lit("")))) / len(found.encode())).cast("int")


def _size(tokens: Column) -> Column:
    return F.when(tokens == "  ", 0).otherwise(((F.octet_length(tokens) - F.octet_length(F.replace(tokens, F.lit("  "), F.lit("")))) / 2 + 1).cast("int"))


def occurrences(text: Column, term: str) -> Column:
    """How often a term, or the words of a phrase one behind the other, occur among the tokens of a text."""
    return _count(spaced(text), term)


def length(text: Column) -> Column:
    return _size(spaced(text))


def bm25_columns(base: DataFrame, fields: dict[str, Column], terms: dict[str, float], extra: dict[str, float] | None = None, boosts: dict[str, float] | None = None) -> DataFrame:
    """``base`` with ``text_score`` (BM25 of the weighted terms, and of the ``extra`` phrases and synonyms, summed over the
    fields times their boosts) and ``matched`` (how many of the terms are in any field).

    Two scans and no join but of the one-row statistics: counts are taken inside the row, so that the score is a column of
    the row. What no row has gives nothing.
    """
    wanted = {**{t: w for t, w in terms.items()}, **{t: w for t, w in (extra or {}).items() if t not in terms}}
    names, columns = list(wanted), []
    for f in range(len(fields)):
        text = F.col(f"_text{f}")
        columns += [_size(text).cast("double").alias(f"_len{f}"), *(_count(text, t).cast("double").alias(f"_tf{f}_{k}") for k, t in enumerate(names))]
    texts = [spaced(c.cast("string")).alias(f"_text{f}") for f, c in enumerate(fields.values())]
    stats = base.select(*texts).select(*columns).agg(
        F.count("*").alias("_n"), *(F.avg(f"_len{f}").alias(f"_avg{f}") for f in range(len(fields))), *(F.count_if(F.col(f"_tf{f}_{k}") > 0).alias(f"_df{f}_{k}") for f in range(len(fields)) for k in range(len(names)))
    )
    counted = base.select("*", *texts).select("*", *columns).crossJoin(F.broadcast(stats))  # one row on the right
    score, matched = F.lit(0.0), F.lit(0)
    for k, t in enumerate(names):
        for f, name in enumerate(fields):
            tf, df, boost = F.col(f"_tf{f}_{k}"), F.col(f"_df{f}_{k}"), (boosts or {}).get(name, 1.0)
            idf = F.log(1 + (F.col("_n") - df + 0.5) / (df + 0.5))
            part = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col(f"_len{f}") / F.nullif(F.col(f"_avg{f}"), F.lit(0.0))))
            score = score + F.coalesce(part, F.lit(0.0)) * (boost * wanted[t])
        if t in terms:
            matched = matched + F.greatest(*(F.col(f"_tf{f}_{k}") for f in range(len(fields))), F.lit(0.0)).cast("boolean").cast("int")
    # With the statistics in it, a condition on ``matched`` stays where the counts are: at the scan they would be made again.
    matched = F.when(F.col("_n") > 0, matched).otherwise(0)
    return counted.select(*(F.col(f"`{c}`") for c in base.columns), score.alias("text_score"), matched.alias("matched"))


def least_matches(terms: int, share: float) -> int:
    """How many of the terms a row must have: the share of them, rounded down, and one at least."""
    return max(1, int(share * terms + 1e-9))


def bm25(chunks: DataFrame, id_col: str, text: Column, query: list[str], *, boost: float = 1.0, min_match: float = 0.0) -> DataFrame:
    """Rows (id, score, matched) of the chunks that hold a query term, at least ``min_match`` of them."""
    wanted = dict.fromkeys((t for q in query for t in q.lower().split()), 1.0)
    if not wanted:
        return chunks.select(F.col(id_col).alias("id"), F.lit(0.0).alias("score"), F.lit(0).alias("matched")).limit(0)
    rows = bm25_columns(chunks.select(F.col(id_col).alias("id"), text.alias("_t")), {"_t": F.col("_t")}, wanted, None, {"_t": boost})
    return rows.where(F.col("matched") >= least_matches(len(wanted), min_match)).select("id", F.col("text_score").alias("score"), "matched")


def bm25_fields(chunks: DataFrame, id_col: str, fields: dict[str, Column], query: list[str], boosts: dict[str, float] | None = None) -> DataFrame:
    """BM25 over several fields with boosts, summed: rows (id, score, matched) that have a term."""
    wanted = dict.fromkeys((t for q in query for t in q.lower().split()), 1.0)
    rows = bm25_columns(chunks.select(F.col(id_col).alias("id"), *(c.alias(n) for n, c in fields.items())), {n: F.col(n) for n in fields}, wanted, None, boosts or BOOSTS)
    return rows.where("matched > 0").select("id", F.col("text_score").alias("score"), "matched")


def phrase(text: Column, words: list[str], slop: int = 0) -> Column:
    """Whether the words occur in order, each within ``slop`` further places of the one before."""
    gap = f"[^\\p{{L}}\\p{{N}}]+(?:{_EDGE}+[^\\p{{L}}\\p{{N}}]+){{0,{slop}}}" if slop else "[^\\p{L}\\p{N}]+"
    any_of = gap.join("\\Q" + w.lower() + "\\E" for w in words)
    return F.lower(text).rlike(f"(?<!{_EDGE}){any_of}(?!{_EDGE})")


def question_terms(spark: SparkSession, question: str, synonyms: dict[str, list[str]] | None = None) -> tuple[dict[str, float], dict[str, float]]:
    """A question as weighted terms, and as weighted phrases and synonyms: the few rows of ``question_query``."""
    rows = question_query(spark.range(1).select(F.lit(question).alias("q")), "q", synonyms).collect()
    terms: dict[str, float] = {}
    more: dict[str, float] = {}
    for r in sorted(rows, key=lambda r: (r["kind"], r["pos"], r["term"])):
        into = terms if r["kind"] == "term" else more
        into[r["term"]] = max(into.get(r["term"], 0.0), r["weight"])
    return terms, more


def question_query(df: DataFrame, text: str, synonyms: dict[str, list[str]] | None = None) -> DataFrame:
    """A question as weighted terms: rows (kind, term, weight) of terms, synonyms (w / 4), and neighbours as phrases (2 max)."""
    terms = T.weights(X.tokens(X.query_text(F.col(text))))
    rows = df.select(F.col(text).alias("question"), F.slice(terms, 1, 256).alias("_w"))
    one = rows.select("question", F.posexplode("_w").alias("pos", "t")).select("question", "pos", F.lit("term").alias("kind"), F.col("t.term").alias("term"), F.col("t.w").alias("weight"))
    ahead, behind = F.slice("_w", F.lit(1), F.size("_w") - 1), F.slice("_w", F.lit(2), F.size("_w") - 1)
    pair = F.zip_with(ahead, behind, lambda x, y: F.struct(F.concat_ws(" ", x["term"], y["term"]).alias("term"), (2 * F.greatest(x["w"], y["w"])).alias("w")))
    two = rows.where(F.size("_w") > 1).select("question", F.posexplode(pair).alias("pos", "t")).select("question", "pos", F.lit("phrase").alias("kind"), F.col("t.term").alias("term"), F.col("t.w").alias("weight"))
    out = one.unionByName(two)
    if synonyms:
        s = one.select("question", "pos", F.explode(T.synonyms(F.array("term"), synonyms)[0]["synonyms"]).alias("term"), (F.col("weight") / 4).alias("weight"))
        out = out.unionByName(s.select("question", "pos", F.lit("synonym").alias("kind"), "term", "weight"))
    return out


def paragraph_query(df: DataFrame, text: str, top: int = 30) -> DataFrame:
    """The ``top`` heaviest terms of a paragraph, as rows (text, term, weight)."""
    w = F.transform(T.weights(X.tokens(F.col(text))), lambda x: F.struct((-x["w"]).alias("w"), x["term"].alias("term")))
    return df.select(F.col(text), F.explode(F.slice(F.array_sort(F.array_distinct(w)), 1, top)).alias("x")).select(text, "x.term", (-F.col("x.w")).alias("weight"))


# --- vectors ----------------------------------------------------------------------------------------------------------


def literal_vector(v: list[float]) -> Column:
    return F.array(*(F.lit(float(x)) for x in v))


def knn(df: DataFrame, vec: str, query: list[float], k: int, threshold: float | None = None, id_col: str = "id") -> DataFrame:
    """The k rows nearest by cosine; the plan is a scan and a top-k, no sort of all rows."""
    out = df.withColumn("_score", V.cosine(F.col(vec), literal_vector(query)))
    if threshold is not None:
        out = out.where(F.col("_score") >= threshold)
    return out.orderBy(F.desc("_score"), id_col).limit(k)


def sparse_score(indices: Column, values: Column, query: dict[int, float]) -> Column:
    """Dot product of a sparse vector (index and value arrays) and a query."""
    table = F.create_map(*(F.lit(x) for kv in query.items() for x in (int(kv[0]), float(kv[1]))))
    return F.aggregate(F.zip_with(indices, values, lambda i, v: v * F.coalesce(F.try_element_at(table, i), F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)


def max_similarity(tensor: Column, query: list[list[float]]) -> Column:
    """Late interaction: for each query vector the best of the tensor's, summed."""
    best = lambda q: F.array_max(F.transform(tensor, lambda row: V.dot(row, literal_vector(q))))
    return reduce(Column.__add__, map(best, query))


# --- fusion and reranking -----------------------------------------------------------------------------------------------


def _everything() -> Window:
    return Window.partitionBy(F.lit(0))


def fuse(df: DataFrame, text: str, vector: str, weights: tuple[float, float] = FIRST_STAGE, how: str = "raw", out: str = "score") -> DataFrame:
    """Weighted sum of two score columns: raw; after atan (2/pi scaled); or after min-max over all candidates (mean of
    both legs when weights are equal). The minima and maxima are an aggregate, broadcast as one row."""
    if how == "raw":
        return df.withColumn(out, F.col(text) * weights[0] + F.col(vector) * weights[1])
    if how == "atan":
        scaled = lambda c: F.atan(F.col(c)) / F.lit(1.5707963267948966)
        return df.withColumn(out, scaled(text) * weights[0] + scaled(vector) * weights[1])
    if how != "minmax":
        raise ValueError(how)
    edges = df.agg(*(f(c).alias(f"_{n}_{k}") for k, c in enumerate((text, vector)) for n, f in (("lo", F.min), ("hi", F.max))))
    scaled = lambda k, c: F.coalesce(F.try_divide(F.col(c) - F.col(f"_lo_{k}"), F.col(f"_hi_{k}") - F.col(f"_lo_{k}")), F.lit(1.0))
    both = df.crossJoin(F.broadcast(edges))
    return both.withColumn(out, scaled(0, text) * weights[0] + scaled(1, vector) * weights[1]).drop("_lo_0", "_hi_0", "_lo_1", "_hi_1")


def normalised_scores(df: DataFrame, score: str, out: str = "score") -> DataFrame:
    """Rerank scores to [0, 1]: unchanged if all are inside; clamped if their span is under 0.001; else min-max."""
    edges = df.agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    both, s = df.crossJoin(F.broadcast(edges)), F.col(score)
    inside = (F.col("_lo") >= 0) & (F.col("_hi") <= 1)
    value = F.when(inside, s).when(F.col("_hi") - F.col("_lo") < 1e-3, F.least(F.lit(1.0), F.greatest(F.lit(0.0), s))).otherwise((s - F.col("_lo")) / (F.col("_hi") - F.col("_lo")))
    return both.withColumn(out, value).drop("_lo", "_hi")


def rank_features(df: DataFrame, score: str, query_tags: dict[str, float], tags: Column, pagerank: Column, out: str = "score") -> DataFrame:
    """Adds 10 times the tags' cosine and the pagerank; the sum may exceed 1."""
    return df.withColumn(out, F.col(score) + V.tag_cosine(query_tags, tags) * 10 + F.coalesce(pagerank, F.lit(0.0)))


def term_bag_text(content: Column, title: Column | None = None, important: Column | None = None, question: Column | None = None) -> Column:
    """Content, title twice, important words five times, questions six times: the bag that reranking compares."""
    parts = [content] + [title] * 2 * (title is not None) + [important] * 5 * (important is not None) + [question] * 6 * (question is not None)
    return F.concat_ws(" ", *parts)


def hybrid(token: Column, cosine: Column, vector_weight: float = VECTOR_WEIGHT) -> Column:
    return token * (1 - vector_weight) + cosine * vector_weight


def token_similarities(df: DataFrame, question: str, text: Column) -> DataFrame:
    """``df`` with ``tsim``; the question's bag is made once, as a row that every row meets."""
    bag = df.sparkSession.range(1).select(T.bag(X.tokens(F.lit(question))).alias("_bag"))
    return df.crossJoin(F.broadcast(bag)).withColumn("tsim", T.similarity(F.col("_bag"), T.bag_terms(X.tokens(text)))).drop("_bag")


def rerank(df: DataFrame, question: str, text: Column, cosine: str, vector_weight: float = VECTOR_WEIGHT) -> DataFrame:
    """Adds tsim, vsim, sim. If no candidate has a cosine, the token similarity stands alone: a window over the candidates,
    which a limit has bounded, so that they are made once."""
    out = token_similarities(df, question, text).withColumn("vsim", F.col(cosine))
    return out.withColumn("_some", F.coalesce(F.sum(F.abs("vsim")).over(_everything()), F.lit(0.0))).withColumn("sim", F.when(F.col("_some") == 0, F.col("tsim")).otherwise(hybrid(F.col("tsim"), F.col("vsim"), vector_weight))).drop("_some")


def model_rerank(df: DataFrame, question: str, text: Column, model_score: str, vector_weight: float = VECTOR_WEIGHT) -> DataFrame:
    """An external model's score, normalised, blended with the token similarity."""
    out = token_similarities(normalised_scores(df, model_score, "vsim"), question, text)
    return out.withColumn("sim", hybrid(F.col("tsim"), F.col("vsim"), vector_weight))


# --- pages and the pipeline -------------------------------------------------------------------------------------------


def ranked(df: DataFrame, score: str, id_col: str = "id", out: str = "rank") -> DataFrame:
    """Global rank by score, ties by id; meant for a candidate pool that a limit has bounded."""
    return df.withColumn(out, F.row_number().over(_everything().orderBy(F.desc(score), id_col)))


def page(df: DataFrame, score: str, number: int, size: int, id_col: str = "id") -> DataFrame:
    """Page ``number`` (from 1): sorts to the page's end only."""
    return df.orderBy(F.desc(score), id_col).offset((number - 1) * size).limit(size)


def block_of_page(number: int, size: int, least: int = 64) -> tuple[int, int, int]:
    """(offset of the candidate block, its length, the page's begin inside it): blocks are whole pages, 64 rows or more."""
    block = max(-(-least // size) * size, -(-30 // size) * size)
    offset = (number - 1) * size
    return offset // block * block, block, offset % block


def doc_aggs(df: DataFrame, name: str, doc_id: str) -> DataFrame:
    """Surviving chunks by document, most first."""
    return df.groupBy(F.col(name).alias("doc_name")).agg(F.count("*").alias("count"), F.min(doc_id).alias("doc_id"))


def retrieve(
    chunks: DataFrame,
    question: str,
    query_vector: list[float],
    *,
    id_col: str = "id",
    text_col: str = "text",
    vec_col: str = "vec",
    fields: dict[str, str] | None = None,
    boosts: dict[str, float] | None = None,
    synonyms: dict[str, list[str]] | None = None,
    query_tags: dict[str, float] | None = None,
    tags_col: str | None = None,
    pagerank_col: str | None = None,
    where: Column | None = None,
    min_match: float = MIN_MATCH,
    top: int = TOP,
    similarity_threshold: float = FINAL_THRESHOLD,
    knn_threshold: float = KNN_THRESHOLD,
    vector_weight: float = VECTOR_WEIGHT,
    fusion: str = "raw",
) -> DataFrame:
    """Question to ranked chunks: filter, text gate, cosine, first-stage fusion, top candidates, rerank, threshold.

    The question becomes weighted terms, phrases of neighbours and synonyms, scored over ``fields`` (field name to column;
    the text alone by default) with their boosts. At least ``min_match`` of the terms must be in a chunk: the text match
    gates the vectors (not a union of both). Candidates are reranked by the bag of title, important words, questions and
    content, and tags and pagerank are added before the threshold is applied. One lazy plan of two scans: the statistics
    (one row), and scores, cosine and top-k; the text is neither joined nor shuffled.
    """
    base = chunks.where(where) if where is not None else chunks
    terms, more = question_terms(chunks.sparkSession, question, synonyms)
    if not terms:
        return base.limit(0).withColumns({c: F.lit(0.0) for c in ("text_score", "cosine", "first_stage", "tsim", "vsim", "sim")})
    columns = {f: F.col(c) for f, c in (fields or {"content_ltks": text_col}).items()}
    hits = bm25_columns(base, columns, terms, more, (boosts or BOOSTS) if fields else None)
    hits = hits.where(F.col("matched") >= least_matches(len(terms), min_match)).drop("matched").withColumn("cosine", V.cosine(F.col(vec_col), literal_vector(query_vector)))
    hits = fuse(hits.where(F.col("cosine") >= knn_threshold), "text_score", "cosine", FIRST_STAGE, fusion, "first_stage").orderBy(F.desc("first_stage"), id_col).limit(top)
    pick = lambda *names: next((F.col(fields[n]) for n in names if fields and n in fields), None)
    bag = term_bag_text(F.col(text_col), pick("title_tks"), pick("important_kwd", "important_tks"), pick("question_tks"))
    out = rerank(hits, question, bag, "cosine", vector_weight)
    if query_tags is not None or pagerank_col:
        tags = F.col(tags_col) if tags_col else F.create_map().cast("map<string,double>")
        out = rank_features(out, "sim", query_tags or {}, tags, F.col(pagerank_col) if pagerank_col else F.lit(0.0), "sim")
    return out.where(F.col("sim") >= (0.0 if vector_weight == 0 else similarity_threshold))


def retrieve_relaxed(chunks: DataFrame, question: str, query_vector: list[float], **options) -> DataFrame:
    """retrieve, and where nothing is found once more with a looser text match and a cosine that stands for it."""
    out = stored(retrieve(chunks, question, query_vector, **options), "retrieved")  # a page of rows at most
    if out.isEmpty():
        return retrieve(chunks, question, query_vector, **(options | {"min_match": RETRY_MATCH, "knn_threshold": RETRY_THRESHOLD}))
    return out


def both_legs(chunks: DataFrame, question_words: list[str], query_vector: list[float], id_col: str, text_col: str, vec_col: str, k: int) -> DataFrame:
    """The other hybrid: each leg ranked by itself, min-max scaled, and averaged; no gate."""
    text = bm25(chunks, id_col, F.col(text_col), question_words).orderBy(F.desc("score"), "id").limit(k).select("id", F.col("score").alias("_s"))
    near = knn(chunks.select(F.col(id_col).alias("id"), vec_col), vec_col, query_vector, k).select("id", F.col("_score").alias("_v"))

    def scaled(df: DataFrame, c: str) -> DataFrame:
        e = df.agg(F.min(c).alias("_lo"), F.max(c).alias("_hi"))
        return df.crossJoin(F.broadcast(e)).select("id", F.coalesce(F.try_divide(F.col(c) - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(1.0)).alias(c))

    both = scaled(text, "_s").join(scaled(near, "_v"), "id", "full_outer")
    return both.select("id", ((F.coalesce("_s", F.lit(0.0)) + F.coalesce("_v", F.lit(0.0))) / 2).alias("score"))


def children_to_parents(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Chunks with a parent become it: mean similarity, joined text, united keywords. Meant for the chunks that a search
    returns, a page of them at most: the texts of a parent's children come into one row."""
    grouped = children.where("mom_id is not null").groupBy("mom_id").agg(
        F.avg("similarity").alias("similarity"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_order_int", "content"))), lambda x: x["content"]), " ").alias("child_text"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("important_kwd")))).alias("important_kwd"),
        F.count("*").alias("children"),
    )
    return grouped.join(parents, grouped["mom_id"] == parents["id"]).drop("mom_id")


def prune_deleted(chunks: DataFrame, docs: DataFrame, chunk_doc: str = "doc_id", doc_id: str = "id") -> DataFrame:
    return chunks.join(docs.select(F.col(doc_id).alias(chunk_doc)), chunk_doc, "left_semi")
