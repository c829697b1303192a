"""Joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- joins ------------------------------------------------------------------------------------------------------------


def outer_merge(tables: list[DataFrame], on: list[str]) -> DataFrame:
    """Full outer equi-joins, left to right; a column that both sides have keeps the left value, then the right."""

    def merge(a: DataFrame, b: DataFrame) -> DataFrame:
        both = [c for c in b.columns if c in a.columns and c not in on]
        renamed = b.select(*on, *(F.col(c).alias(f"{c}_y" if c in both else c) for c in b.columns if c not in on))
        return a.join(renamed, on, "full_outer")

    return reduce(merge, tables)


def nest(parents: DataFrame, children: DataFrame, parent_id: str, child_ref: str, columns: list[str], out: str) -> DataFrame:
    """Parents with an ordered array of their children's columns; parents without children get an empty one."""
    packed = children.groupBy(F.col(child_ref).alias(parent_id)).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(out))
    return parents.join(packed, parent_id, "left").withColumn(out, F.coalesce(out, F.slice(F.array(F.struct(*(F.lit(None).cast(children.schema[c].dataType).alias(c) for c in columns))), 1, 0)))


def latest(df: DataFrame, keys: list[str], order: str, tie: str | None = None) -> DataFrame:
    """The last row of each key by ``order``: one aggregate with map-side combine, no window."""
    rank = F.struct(order, tie) if tie else F.col(order)
    rest = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.max_by(rest, rank).alias("_row")).select("_row.*")


def fingerprint_diff(old: DataFrame, new: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """Rows (key, change): added, changed or deleted between two listings."""
    a, b = old.select(key, F.col(fingerprint).alias("_old")), new.select(key, F.col(fingerprint).alias("_new"))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "deleted").when(F.col("_old") != F.col("_new"), "changed")
    return a.join(b, key, "full_outer").select(key, change.alias("change")).where("change is not null")


def stale(stored: DataFrame, current: DataFrame, key: str) -> DataFrame:
    return stored.join(current.select(key), key, "left_anti")


def reusable_tasks(tasks: DataFrame, previous: DataFrame) -> DataFrame:
    """Tasks whose page and digest a finished task had."""
    done = previous.where("progress = 1").groupBy("from_page", "digest").agg(F.min("chunk_ids").alias("chunk_ids"))
    return tasks.join(done, ["from_page", "digest"])


def due(connectors: DataFrame, now: Column) -> DataFrame:
    """Connectors whose last poll is a full interval (minutes) ago, or that never ran."""
    return connectors.where(F.col("polled_at").isNull() | (F.col("polled_at") + F.make_dt_interval(mins=F.col("interval_minutes")) <= now))


# --- aggregates -------------------------------------------------------------------------------------------------------


def terms_agg(df: DataFrame, field: str, size: int | None = None) -> DataFrame:
    """Values of a scalar or list field and their counts, most first."""
    values = F.explode(field) if dict(df.dtypes)[field].startswith("array") else F.col(field)
    out = df.select(values.alias("value")).where("value is not null").groupBy("value").count()
    return out.orderBy(F.desc("count"), "value").limit(size) if size else out


def delimited_agg(df: DataFrame, field: str) -> DataFrame:
    """terms_agg of a text of values between ### (tag columns) or commas."""
    parts = F.split(field, "###" if field == "tag_kwd" else ",")
    return df.select(F.explode(F.transform(parts, lambda x: F.trim(x))).alias("value")).where("value <> ''").groupBy("value").count()


def merged_counts(raw: DataFrame, counted: DataFrame) -> DataFrame:
    """Counts of raw values together with rows (value, count) that were counted before."""
    return raw.groupBy("value").count().unionByName(counted.select("value", F.col("count").cast("long"))).groupBy("value").agg(F.sum("count").alias("count"))


def usage_stats(sessions: DataFrame, ts: str, user: str, source: str, wanted: str | None = None) -> DataFrame:
    """By day, of the sessions of a source (those without one where ``wanted`` is null): views, users, tokens, mean rounds,
    thumbs up and seconds. Columns tokens, round, thumb_up and duration are the sessions'."""
    rows = sessions.where(F.col(source).isNull() if wanted is None else F.col(source) == wanted)
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return rows.groupBy(F.date_trunc("day", ts).cast("date").alias("day")).agg(
        F.count("*").alias("pv"), F.countDistinct(user).alias("uv"), zero("tokens"), zero("duration"), zero("thumb_up"), F.avg("round").alias("round"), F.try_divide(F.sum("tokens"), F.sum("duration")).alias("speed")
    )


def daily_stats(df: DataFrame, ts: str, user: str, value: str) -> DataFrame:
    """By day: views, users, the value's sum and mean."""
    return df.groupBy(F.date_trunc("day", ts).cast("date").alias("day")).agg(F.count("*").alias("pv"), F.countDistinct(user).alias("uv"), F.coalesce(F.sum(value), F.lit(0.0)).alias("total"), F.avg(value).alias("mean"))


def histogram(df: DataFrame, group: str, state: str, states: list[str]) -> DataFrame:
    """Counts by state as columns; the states are given, so that no pass is needed to find them."""
    return df.groupBy(group).agg(*(F.count_if(F.col(state) == s).alias(s) for s in states))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).count().where("count > 1")


def latency_summary(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """Mean, minimum and nearest-rank percentiles."""
    return df.groupBy(*([group] if group else [])).agg(
        F.avg(value).alias("avg"), F.min(value).alias("min"), *(F.expr(f"percentile_disc({p}) within group (order by `{value}`)").alias(f"p{int(100 * p)}") for p in (0.5, 0.9, 0.95))
    )


def tag_portion(df: DataFrame, tags: str, smooth: int = 0) -> DataFrame:
    """Share of each tag among all tags."""
    counts = df.select(F.explode(tags).alias("tag")).groupBy("tag").count()
    total = counts.agg(F.sum("count").alias("_all"), F.count("*").alias("_kinds"))
    return counts.crossJoin(F.broadcast(total)).select("tag", ((F.col("count") + smooth) / (F.col("_all") + smooth * F.col("_kinds"))).alias("portion"))


def monotonic(old: Column, new: Column) -> Column:
    return F.coalesce(F.greatest(old, new), new)


# --- windows ----------------------------------------------------------------------------------------------------------


def within_budget(df: DataFrame, partition: list[str], order: list[Column], size: str, budget: float) -> DataFrame:
    """Rows taken in order until the sizes taken reach the budget (the row that reaches it is taken)."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_sum", F.sum(size).over(w)).where(F.col("_sum") - F.col(size) < budget).drop("_sum")


def token_budget(df: DataFrame, order: list[Column], tokens: str, budget: int, partition: list[str] | None = None) -> DataFrame:
    """Rows in order while the running sum stays below the budget; the first that reaches it ends the list."""
    w = Window.partitionBy(*(partition or [F.lit(0)])).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_sum", F.sum(tokens).over(w)).where(F.col("_sum") < budget).drop("_sum")


def apportion(df: DataFrame, weight: str, budget: int, id_col: str, partition: list[str] | None = None, out: str = "share") -> DataFrame:
    """An integer budget by largest remainders: floors first, then one each by remainder, ties by id. Where no weight is
    above 0, it is split evenly, the first by id taking one more."""
    w = Window.partitionBy(*(partition or [F.lit(0)]))
    total, n = F.sum(weight).over(w), F.count("*").over(w)
    df = df.withColumn("_exact", F.when(total > 0, F.col(weight) * budget / F.nullif(total, F.lit(0))).otherwise(F.lit(budget) / n)).withColumn("_floor", F.floor("_exact"))
    df = df.withColumn("_left", F.lit(budget) - F.sum("_floor").over(w))
    df = df.withColumn("_rank", F.row_number().over(w.orderBy(F.desc(F.round(F.col("_exact") - F.col("_floor"), 9)), id_col)))
    return df.withColumn(out, (F.col("_floor") + (F.col("_rank") <= F.col("_left")).cast("int")).cast("long")).drop("_exact", "_floor", "_left", "_rank")


def recent(df: DataFrame, partition: str, order: list[Column], n: int) -> DataFrame:
    """The last n rows of each partition."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(partition).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


# --- sorts ------------------------------------------------------------------------------------------------------------


def sort_key(df: DataFrame, column: str) -> Column:
    """A list sorts by its mean, a missing column as null."""
    kind = dict(df.dtypes).get(column)
    if kind is None:
        return F.lit(None)
    return F.aggregate(column, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(column) if kind.startswith("array") else F.col(column)


def order_by(df: DataFrame, fields: list[tuple[str, bool]], id_col: str) -> DataFrame:
    """(column, ascending) pairs, ties by id."""
    return df.orderBy(*(sort_key(df, c).asc() if up else sort_key(df, c).desc() for c, up in fields), id_col)


def browse_order(df: DataFrame) -> DataFrame:
    """Default order of a listing: page, top, then newest first, by id."""
    return df.orderBy(sort_key(df, "page_num_int"), sort_key(df, "top_int"), F.desc("create_timestamp_flt"), "id")


# --- sets -------------------------------------------------------------------------------------------------------------


def gathered(tables: list[DataFrame]) -> DataFrame:
    """Union of results of different tables, by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def first_distinct(df: DataFrame, key: list[str], position: str) -> DataFrame:
    """Rows without later repeats of their key."""
    return df.groupBy(*key).agg(F.min_by(F.struct(*df.columns), position).alias("_row")).select("_row.*")


def merged_metadata(a: Column, b: Column) -> Column:
    """Maps of value lists united by key, values distinct."""
    return F.map_zip_with(a, b, lambda k, x, y: F.array_distinct(F.concat(F.coalesce(x, F.array()), F.coalesce(y, F.array()))))


def bigram_difference(a: Column, b: Column) -> Column:
    """Symmetric difference of the texts' two-letter sets; a text of under two letters has none."""
    none = F.array().cast("array<string>")
    grams = lambda c: F.when(F.length(c) > 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2))))).otherwise(none)
    return F.concat(F.array_except(grams(a), grams(b)), F.array_except(grams(b), grams(a)))


# --- grouping sets and sketches -------------------------------------------------------------------------------------------


def grouped(df: DataFrame, keys: list[str], aggregates: list[Column], how: str = "group") -> DataFrame:
    """Aggregates by all keys (group), by each prefix of them (rollup) or by every subset (cube), with ``level``: a bit for
    each key that a row sums over, the last key's lowest."""
    by = {"group": df.groupBy, "rollup": df.rollup, "cube": df.cube}[how](*keys)
    return by.agg(*aggregates, *([F.grouping_id().alias("level")] if how != "group" else [F.lit(0).cast("long").alias("level")]))


def distinct_counts(df: DataFrame, keys: list[str], column: str, error: float | None = None) -> DataFrame:
    """Different values by key: exact, or by a sketch of a relative error, which merges map-side and needs no shuffle of the
    values."""
    count = F.count_distinct(column) if error is None else F.approx_count_distinct(column, error)
    return df.groupBy(*keys).agg(count.alias("distinct"))


def sketches(df: DataFrame, keys: list[str], column: str, value: str | None = None, lg_nominal: int = 12, k: int = 200) -> DataFrame:
    """Mergeable summaries by key (a day, say), to be stored: the number of rows, ``distinct`` (HyperLogLog) and ``members``
    (theta, which also intersects) of a column, and ``quantiles`` (KLL) of the numbers in ``value``."""
    parts = [F.count("*").alias("rows"), F.hll_sketch_agg(column, F.lit(lg_nominal)).alias("distinct"), F.theta_sketch_agg(column, F.lit(lg_nominal)).alias("members")]
    if value is not None:
        parts.append(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("quantiles"))
    return df.groupBy(*keys).agg(*parts)


def merged_sketches(stored: DataFrame, keys: list[str]) -> DataFrame:
    """The summaries of coarser keys, from the stored ones alone."""
    parts = [F.sum("rows").alias("rows"), F.hll_union_agg("distinct").alias("distinct"), F.theta_union_agg("members").alias("members")]
    if "quantiles" in stored.columns:
        parts.append(F.kll_merge_agg_double("quantiles").alias("quantiles"))
    return stored.groupBy(*keys).agg(*parts)


def sketch_estimates(stored: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """``distinct`` and ``members`` as numbers, and the quantiles asked for as q50, q90, ..."""
    out = stored.withColumn("distinct", F.hll_sketch_estimate("distinct")).withColumn("members", F.theta_sketch_estimate("members"))
    if "quantiles" in stored.columns:
        out = out.withColumns({f"q{round(100 * q)}": F.kll_sketch_get_quantile_double("quantiles", F.lit(q)) for q in quantiles}).drop("quantiles")
    return out


def sketch_overlap(a: Column, b: Column) -> Column:
    """About how many values two groups share, by their ``members``."""
    return F.theta_sketch_estimate(F.theta_intersection(a, b))
