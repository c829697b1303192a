"""The pipeline's line stage drops lines on more than 1%, and on three or more, of a source's different pages."""

import corpus_pipeline
from test_text_ops import DOC


def test_lines_on_a_small_share_of_the_pages(spark, tmp_path):
    big = [(i, ("notice\n" if i % 40 == 0 else "") + ("pair\n" if i in (1, 2) else "") + ("rare\n" if i in (3, 4, 5) else "") + f"page {i}", "big", "x") for i in range(400)]
    middle = [(1000 + i, ("three\n" if i < 3 else "two\n" if i < 5 else "") + f"other page {i}", "middle", "x") for i in range(40)]
    copies = [(3000 + i, "same\npage", "big", "x") for i in range(50)]
    docs = spark.createDataFrame(big + middle + copies, DOC)
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, str(tmp_path)).collect()}
    assert all(out[i] == f"page {i}" for i in range(0, 400, 40))  # on 10 of 401 pages
    assert out[1] == "pair\npage 1" and out[3] == "rare\npage 3"  # on 2; on 3 of 401
    assert out[1000] == "other page 0" and out[1003] == "two\nother page 3"  # on 3 of 40; on 2
    assert out[3000] == "same\npage"  # copies are one page
