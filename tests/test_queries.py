"""Registered queries against DuckDB on the smallest tables."""

import decimal
import os

import duckdb
import numpy as np
import pytest

from lodestone import queries as Q
from lodestone.operators import tree
from lodestone.sources import parsers

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if v is None or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, (float, np.floating, decimal.Decimal)):
        return round(float(v), 5)
    if isinstance(v, np.ndarray):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if hasattr(v, "isoformat"):
        return str(v)
    return v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_against_sql(spark, db, name):
    got = Q.QUERIES[name](spark, DATA)
    want = db.sql(Q.SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted(repr(tuple(map(plain, r))) for r in got.select(*columns).collect())
    assert rows == sorted(repr(tuple(map(plain, r))) for r in want.project(", ".join(f'"{c}"' for c in columns)).fetchall())


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_runs(spark, name):
    assert Q.QUERIES[name](spark, DATA).count() > 0


@pytest.mark.parametrize("name, labels", [("ward_clusters", tree.ward_labels), ("mixture_clusters", tree.mixture_labels)])
def test_clusters_by_group(spark, db, name, labels):
    """The registered tables' groups one by one, outside Spark."""
    want = set()
    for (label,) in db.sql("SELECT DISTINCT label FROM embeddings").fetchall():
        rows = db.sql(f"SELECT vec_id, embedding FROM embeddings WHERE label = {label} ORDER BY vec_id").fetchall()
        want |= {(label, i, int(c)) for (i, _), c in zip(rows, labels(np.array([v for _, v in rows], float)), strict=True)}
    assert {tuple(r) for r in Q.QUERIES[name](spark, DATA).select("label", "vec_id", "cluster").collect()} == want


def test_psi_tree_by_group(spark, db):
    """Every group is one tree over its rows, no node has over four children, and the nearest pair has one parent."""
    rows = Q.QUERIES["psi_tree"](spark, DATA).collect()
    for (label,) in db.sql("SELECT DISTINCT label FROM embeddings").fetchall():
        tree_rows = [r for r in rows if r["label"] == label]
        ids = db.sql(f"SELECT vec_id, embedding FROM embeddings WHERE label = {label} ORDER BY vec_id").fetchall()
        parent = {r["node"]: r["parent"] for r in tree_rows}
        assert {r["vec_id"] for r in tree_rows if r["vec_id"] is not None} == {i for i, _ in ids}
        assert sum(p == -1 for p in parent.values()) == 1 and all(p == -1 or p in parent for p in parent.values())
        kids = [list(parent.values()).count(n) for n in parent]
        assert max(kids) <= 4
        x = tree.unit(np.array([v for _, v in ids], float))
        close = x @ x.T - 9 * np.eye(len(x))
        a, b = np.unravel_index(close.argmax(), close.shape)
        node = {r["vec_id"]: r["node"] for r in tree_rows if r["vec_id"] is not None}
        assert len(ids) < 2 or parent[node[ids[a][0]]] == parent[node[ids[b][0]]]


def test_hashed_embeddings_against_plain_hashes(spark, db):
    import re
    import struct

    xxhash = pytest.importorskip("xxhash")
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    for r in Q.QUERIES["hashed_embeddings"](spark, DATA).collect():
        vec = np.zeros(16)
        for w in re.findall(r"[^\W_]+", db.sql(f"SELECT text FROM benchmark WHERE item_id = {r['item_id']}").fetchall()[0][0].lower()):
            h = xxhash.xxh64_intdigest(w.encode(), 42)
            vec[signed(h) % 16] += 1 if xxhash.xxh64_intdigest(struct.pack("<i", 1), h) % 2 == 0 else -1
        assert np.allclose(r["vec"], vec / np.linalg.norm(vec), atol=2e-5)


def test_blocks_of_pages_and_documents(spark, db):
    """Parsers outside Spark, and that no word is lost."""
    got = {}
    for r in Q.QUERIES["html_text"](spark, DATA).collect():
        got.setdefault(r["doc_id"], []).append((r["position"], r["kind"], r["content"]))
    for i, page in db.sql("SELECT page_id, html FROM pages").fetchall():
        assert [x[1:] for x in sorted(got.get(str(i), []))] == parsers.html_blocks(page)
    chunks = {}
    for r in Q.QUERIES["html_block_chunks"](spark, DATA).collect():
        assert r["tokens"] <= 128 and r["tokens"] == len(r["content"].split())
        chunks.setdefault(r["doc_id"], []).append((r["position"], r["content"]))
    for i, blocks in got.items():
        assert [w for _, c in sorted(chunks[i]) for w in c.split()] == [w for _, k, c in sorted(blocks) if k == "text" for w in c.split()]
    import hashlib

    marked = {}
    for r in Q.QUERIES["markdown_blocks"](spark, DATA).collect():
        marked.setdefault(r["doc_id"], []).append((r["position"], r["kind"], r["content_md5"]))
    for i, text in db.sql("SELECT doc_id, text FROM documents").fetchall():
        assert [x[1:] for x in sorted(marked.get(str(i), []))] == [(k, hashlib.md5(c.encode()).hexdigest()) for k, c in parsers.markdown_blocks(text or "")]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 10
    assert set(e.oracle_sql()) <= set(e.queries())
