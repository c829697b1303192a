"""The registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_text, line_dedup, media, mix, packing, quality, repeats, secrets, sentencepieces, simhash, spelling, tandem_runs, weak_labels
from .common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards are those that the splitting tree deals the document's copies, in the order of the passes."""
    out = mix.taken(table(spark, sf_dir, "documents"))
    return out.withColumn("shards", F.array_join(F.col("shards").cast("array<string>"), ","))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The site of a document is its source."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), F.col("source"))
    return out.select("doc_id", "source", "n_lines", "n_dropped", F.md5("text").alias("kept_md5"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.from_media(media.to_media(table(spark, sf_dir, "documents")))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classify(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.tokenize(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract takes a letter from some runs."""
    return spelling.variants(spelling.altered_words(table(spark, sf_dir, "documents")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract makes a tenth of the documents periodic."""
    found = tandem_runs.collapse(table(spark, sf_dir, "documents"), text_col=tandem_runs.planted(F.col("doc_id"), F.col("text")))
    return tandem_runs.digests(found)


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.default_tokenizer())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_line_dedup": op2_line_dedup,
        "op3_html_extraction": op3_html_extraction,
        "op4_media_columns": op4_media_columns,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_sentencepiece": op6_sentencepiece,
        "op7_quality_rules": op7_quality_rules,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_simhash": op9_simhash,
        "op10_secret_scan": op10_secret_scan,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_best_fit_packing": op13_best_fit_packing,
    }


_HEX = "('0x' || substr(md5({}), 1, 15))::BIGINT"

#: A level of the splitting tree: slots of a node in seeded order, the first ones to its left half.
_LEVELS = "\n".join(
    f"""drawn{k} AS (
  SELECT lo, hi, (lo + hi) // 2 AS mid, sk, everything, row_number() OVER (PARTITION BY lo, hi ORDER BY {_HEX.format("'mix-1|' || lo || '|' || hi || '|' || sk || '|' || slot")}, sk, slot) AS rk
  FROM (SELECT *, unnest(range(1, n + 1)) AS slot FROM tree{k})),
halved{k} AS (
  SELECT *, rk <= (mid * everything) // 16 - (lo * everything) // 16 AS l FROM drawn{k}),
tree{k + 1} AS (
  SELECT CASE WHEN l THEN lo ELSE mid END AS lo, CASE WHEN l THEN mid ELSE hi END AS hi, sk, everything, count(*) AS n FROM halved{k} GROUP BY ALL),"""
    for k in range(4)
)

OP1_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
keyed AS (
  SELECT *, coalesce('v' || source, 'n') AS sk, {_HEX.format("'mix-1|' || coalesce(doc_id::VARCHAR, '-') || '|' || size")} AS h FROM sized),
per AS (
  SELECT source, sk, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source, sk),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk, sum(source_size) OVER () AS total FROM per),
weighed AS (
  SELECT *, ([3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE])[(rk % 3 + 1)::INT] AS w, source_size * 2.0::DOUBLE AS cap FROM ranked),
level AS (
  SELECT *, (total * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS lv
  FROM weighed WINDOW b AS (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tgt AS (
  SELECT *, least(cap, max(lv) OVER () * w) AS target FROM level),
src AS (
  SELECT sk, source_size, target, passes, target - passes * source_size AS rest,
         greatest(1, ceil(source_size * 4096.0::DOUBLE / total))::BIGINT AS nb
  FROM (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM tgt)),
placed AS (
  SELECT k.doc_id, k.size, k.h, s.*, least(floor(k.h / 1152921504606846976.0::DOUBLE * nb)::BIGINT, nb - 1) AS block
  FROM keyed k JOIN src s USING (sk)),
blocks AS (
  SELECT sk, block, sum(size) AS words, any_value(rest) AS rest, any_value(passes) AS passes FROM placed GROUP BY sk, block),
ordered AS (
  SELECT *, sum(words) OVER (PARTITION BY sk ORDER BY {_HEX.format("'mix-1|block|' || sk || '|' || block")}, block ROWS UNBOUNDED PRECEDING) AS e FROM blocks),
kinds AS (
  SELECT *, rest > 0 AND e <= rest AS whole, NOT (rest > 0 AND e <= rest) AND e - words < rest AS stops FROM ordered),
steps AS (
  SELECT p.sk, p.h, sum(p.size) AS w, any_value(k.rest - k.e + k.words) AS want
  FROM placed p JOIN kinds k ON p.sk = k.sk AND p.block = k.block WHERE k.stops GROUP BY p.sk, p.h),
cuts AS (
  SELECT sk, max(h) AS cut FROM (SELECT *, sum(w) OVER (PARTITION BY sk ORDER BY h) AS upto FROM steps)
  WHERE upto - w / 2 <= want GROUP BY sk),
quotas AS (
  SELECT sk, block, passes, whole, stops, row_number() OVER (PARTITION BY sk ORDER BY e, {_HEX.format("'mix-1|block|' || sk || '|' || block")}, block) - 1 AS pos,
         count(*) OVER (PARTITION BY sk) AS n, passes + CASE WHEN whole OR stops THEN 1 ELSE 0 END AS copies FROM kinds),
tree0 AS (
  SELECT 0 AS lo, 16 AS hi, sk, sum(copies)::BIGINT AS n, sum(sum(copies)) OVER ()::BIGINT AS everything FROM quotas GROUP BY sk HAVING sum(copies) > 0),
{_LEVELS}
spans AS (
  SELECT sk, lo AS shard, n, sum(n) OVER (PARTITION BY sk ORDER BY lo)::BIGINT AS upto FROM tree4),
dealt AS (
  SELECT sk, shard, unnest(range(upto - n, upto)) AS slot FROM spans),
copied AS (
  SELECT sk, block, pass, shard FROM (SELECT sk, block, n, pos, unnest(range(0, copies)) AS pass FROM quotas) q JOIN dealt d USING (sk)
  WHERE d.slot = q.pass * q.n + q.pos),
kept AS (
  SELECT p.*, p.passes + CASE WHEN k.whole OR (k.stops AND p.h <= coalesce(c.cut, -1)) THEN 1 ELSE 0 END AS copies
  FROM placed p JOIN kinds k ON p.sk = k.sk AND p.block = k.block LEFT JOIN cuts c ON p.sk = c.sk),
lists AS (
  SELECT sk, block, list(shard ORDER BY pass) AS shards FROM copied GROUP BY sk, block)
SELECT k.doc_id, k.size, k.source_size, k.target, (k.size * k.copies)::BIGINT AS taken,
       coalesce(array_to_string(list_transform(l.shards[:k.copies], lambda x: x::VARCHAR), ','), '') AS shards
FROM kept k LEFT JOIN lists l ON k.sk = l.sk AND k.block = l.block
"""

OP2_SQL = r"""
WITH pages AS (
  SELECT doc_id, source, text, coalesce('v' || source, 'n') AS host FROM documents),
totals AS (
  SELECT host, count(DISTINCT text) AS pages FROM pages WHERE text IS NOT NULL GROUP BY host),
lines AS (
  SELECT DISTINCT host, text, line FROM (SELECT host, text, unnest(string_split(text, chr(10))) AS line FROM pages) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
boiler AS (
  SELECT l.host, line FROM lines l JOIN totals t ON l.host = t.host
  GROUP BY l.host, line HAVING count(*) >= 3 AND count(*) > any_value(t.pages) * 0.01::DOUBLE),
sets AS (SELECT host, list(line) AS bad FROM boiler GROUP BY host),
cut AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS ls,
         CASE WHEN bad IS NOT NULL THEN list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(bad, x)) END AS kept
  FROM pages LEFT JOIN sets ON pages.host = sets.host)
SELECT doc_id, source, coalesce(len(ls), 0)::INT AS n_lines, (CASE WHEN kept IS NULL THEN 0 ELSE len(ls) - len(kept) END)::INT AS n_dropped,
       md5(coalesce(array_to_string(kept, chr(10)), text)) AS kept_md5
FROM cut
"""


#: crc32 by bytes with its table; letters beyond ASCII are two bytes of UTF-8.
OP11_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM (SELECT unnest(range(0, 256)) AS i)),
runs AS (
  SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS raw FROM documents) WHERE length(raw) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, c, xor(list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR || ':' || run, ''),
      lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)),
    lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM runs, crc),
words AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
rests AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
longer AS (
  SELECT DISTINCT r.word, r.n, w.word AS other, w.n AS m FROM rests r JOIN words w ON r.rest = w.word),
links AS (
  SELECT a.word, b.word AS other, b.n AS m FROM rests a JOIN rests b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT word, other, m FROM longer
  UNION ALL SELECT other, word, n FROM longer),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM links GROUP BY word),
found AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
followed AS (
  SELECT word, word AS root, form AS next FROM found
  UNION ALL SELECT f.word, f.next, g.form FROM followed f JOIN found g ON f.next = g.word)
SELECT f.word, form, root, n, n_near, form_n FROM found f JOIN followed r ON f.word = r.word WHERE r.next IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": OP1_SQL, "op2_line_dedup": OP2_SQL, "op11_spelling_variants": OP11_SQL}
