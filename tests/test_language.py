"""Languages by profiles: plain counts, and texts that the profiles haven't seen."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from lodestone.functions import language


def test_profiles_are_plain_counts(spark):
    rows = [("en", "The the cat"), ("en", "a Cat"), ("de", "Über die"), (None, "x"), ("de", None)]
    got = {}
    for r in language.train(spark.createDataFrame(rows, "lang string, text string"), "text", "lang", per=5).collect():
        got.setdefault(r["lang"], {})[r["gram"]] = r["weight"]
    for lang in ("en", "de"):
        n = Counter()
        for k, text in rows:
            if k == lang:
                for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
                    w = f" {w} "
                    n.update(w[i : i + size] for size in (1, 2, 3) for i in range(len(w) - size + 1))
        total = n.total()
        top = sorted(n.items(), key=lambda x: (-x[1], x[0]))[:5]
        want = {g: math.log(c / total) for g, c in top} | {"": math.log(0.5 / total)}
        assert got[lang].keys() == want.keys() and all(abs(got[lang][g] - want[g]) < 1e-9 for g in want)


def test_unseen_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 200")
    half = F.pmod(F.xxhash64("text"), F.lit(2)) == 0  # copies are on one side
    profiles = language.train(docs.where(half), "text", "lang")
    told = docs.where(~half).select("lang", language.detect(F.col("text"), profiles).alias("found"))
    right, n = told.agg(F.count_if(F.col("lang") == F.col("found")), F.count("*")).first()
    assert n > 200 and right / n > 0.97
    odd = spark.createDataFrame([(None,), ("",), ("123 !",)], "t string")
    assert [r[0] for r in odd.select(language.detect(F.col("t"), profiles)).collect()] == [None] * 3
