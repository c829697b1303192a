"""The corpus pipeline against a brute-force version of its stages."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import sentencepiece
from test_near_copies import brute_components
from test_text_ops import brute_quality, words

from lodestone.llm import queries, sentencepieces


def brute(docs, labels):
    """Ids of every copy of every document that the stages leave: a counter of (doc_id, ids)."""
    good = {i for i, q, x in labels if q == 1 and not x}
    kept = {i for i, _, _, k in brute_quality([(i, t) for i, t, _ in docs], good)[0] if k}
    docs = [d for d in docs if d[0] in kept]
    pages, lines = defaultdict(set), Counter()
    for _, t, s in docs:
        if t not in pages[s]:
            pages[s].add(t)
            lines.update((s, x) for x in set(t.split("\n")) if words(x))
    drop = {(s, x) for (s, x), n in lines.items() if n >= 3 and n > 0.01 * len(pages[s])}
    docs = [(i, "\n".join(x for x in t.split("\n") if (s, x) not in drop), s) for i, t, s in docs]
    one = {c for _, c in brute_components(docs)}
    docs = [d for d in docs if d[0] in one]
    c = duckdb.connect()
    c.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "source"]))
    copies = {i: taken // size if size else 0 for i, size, taken in c.sql(queries.OP1_SQL).project("doc_id, size, taken").fetchall()}
    original = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.default_model())
    return Counter({(i, tuple(original.encode(t))): copies[i] for i, t, _ in docs if copies[i]})


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as P

    rnd = random.Random(5)
    vocab = ["".join(rnd.choices("abcdefghijé", k=rnd.randint(2, 8))) for _ in range(40)]
    para = lambda n: " ".join(rnd.choices(vocab, k=n))
    docs = [(i, ("site menu line\n" if i % 2 else "") + para(rnd.randint(45, 90)) + "\n" + para(12), f"src{i % 3}") for i in range(120)]
    docs += [(200 + i, docs[i][1], docs[i][2]) for i in range(8)]  # exact copies
    docs += [(300 + i, docs[40][1] + f" tail{i}", "src1") for i in range(6)]  # near copies
    docs += [(400 + i, " ".join(w.upper() + "$$" for w in rnd.choices(vocab, k=70)), "src2") for i in range(10)]  # junk
    docs += [(500, "too short", "src0"), (501, "again and " * 80, "src0")]
    labels = [(i, 1, 0) for i in range(0, 110)] + [(400, 0, 0), (401, 0, 1)]
    spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = P.run(spark, str(tmp_path))
    want = brute(docs, labels)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got.collect()) == want
    kept = {i for i, _ in want}
    assert not kept & (set(range(200, 208)) | set(range(400, 410)) | {500, 501})
    stage = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, f in P.STAGES[:-1]:
        assert f(spark, stage, str(tmp_path)).columns == stage.columns


def test_stages_take_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows, clashing columns, empty tables."""
    import corpus_pipeline as P

    long = " ".join(f"w{k * 7919 % 100_003}" for k in range(60_000))
    rows = [(None, None, None, None, None, None), (1, "", "en", "s", 0, "m"), (2, long, "en", None, len(long), "m"), (2, long, "en", None, len(long), "m"), (None, "a b " * 60, None, "s", 1, None)]
    rows += [(10 + k, " ".join(f"t{k}x{j}" for j in range(60)), "en", "s", 9, "m") for k in range(6)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, mix_shard string"
    spark.createDataFrame([(2, 1, 0), (10, 1, 0), (None, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for k, (_, stage) in enumerate(P.STAGES):
            docs = stage(spark, docs, str(tmp_path))
            if k < len(P.STAGES) - 1:
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_shard"]
                docs = docs.cache()
        ids = Counter(r["doc_id"] for r in docs.collect())
        assert (set(ids) <= {2, *range(10, 16)} and len(ids) > 3) if data else not ids
