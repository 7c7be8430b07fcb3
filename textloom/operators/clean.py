"""Order-aware collapse of rows, ids by position, and the reports on them. Order is always a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import strip
from textloom.runtime import materialize


def first_wins(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """One row a key with the values of its first row by ``order``. Two-phase: each task keeps one row a key."""
    first = F.min_by(F.struct(*values), F.struct(order, *[v for v in values if v != order]))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, *[F.col("_first")[v].alias(v) for v in values])


def dedup_cross_filed(df: DataFrame, text: str, order: str, category: str, keep: list[str]) -> DataFrame:
    """Rows with one text become its first row, which lists the categories of the later ones in order.

    Only the others' categories are collected, never their texts. Repeats and blanks among them stay.
    """
    rows = df.filter(F.col(text).isNotNull())
    entry = F.struct(order, F.coalesce(strip(category), F.lit("")).alias("category"))
    some = rows.groupBy(text).agg(F.min_by(F.struct(order, *keep), order).alias("_first"), F.sort_array(F.collect_list(entry)).alias("_all"))
    later = F.transform(F.slice("_all", F.lit(2), F.size("_all")), lambda e: e["category"])
    return some.select(text, *[F.col("_first")[c].alias(c) for c in dict.fromkeys([order, *keep])], later.alias("alternates"))


def union_tokens(df: DataFrame, key: str, order: str, tokens: str, separator: str = ",") -> DataFrame:
    """Per key the tokens of its rows' lists, in order, each once whatever its case, as first written."""
    parts = df.select(key, order, F.posexplode(F.split(F.coalesce(tokens, F.lit("")), separator)).alias("_at", "_token"))
    parts = parts.withColumn("_token", strip("_token")).filter(F.col("_token") != "")
    place = F.struct(order, "_at")
    firsts = parts.groupBy(key, F.lower("_token").alias("_key")).agg(F.min_by("_token", place).alias("_token"), F.min(place).alias("_place"))
    listed = F.sort_array(F.collect_list(F.struct("_place", "_token")))
    return firsts.groupBy(key).agg(F.array_join(F.transform(listed, lambda e: e["_token"]), ", ").alias("tokens"))


def clean_notes(notes: DataFrame, order: str = "pos") -> DataFrame:
    """The cleaning step of clinical notes: cross-filed copies collapsed, keywords of collapsed ones united, ids dense."""
    blank = [c for c in notes.columns if c not in (order, "transcription")]
    notes = notes.filter(F.col("transcription").isNotNull()).fillna("", subset=blank)
    one = dedup_cross_filed(notes, "transcription", order, "medical_specialty", blank)
    union = union_tokens(notes.select("transcription", order, "keywords"), "transcription", order, "keywords").withColumnRenamed("tokens", "_union")
    merged = F.when(F.size("alternates") > 0, F.coalesce("_union", F.lit(""))).otherwise(F.col("keywords"))
    out = one.join(union, "transcription", "left").withColumn("keywords", merged).withColumnRenamed("alternates", "alt_specialties")
    return dense_ids(out, [order], "doc_id").drop("_union", order)


def dense_ids(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Numbers 0, 1, 2, ... by ``order``, without gathering the rows: sorted ranges, and the counts before each.

    The ranges are written once, so that numbers and counts come from the same cut.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part, place = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranges.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return ranges.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + place).drop("_part", "_at", "_start")


def document_frequency(df: DataFrame, doc: str, terms: Column, least: int = 2, most_words: int | None = None) -> DataFrame:
    """In how many documents each term of an array column is, for terms of ``least`` or more."""
    rows = df.select(doc, F.explode(terms).alias("term")).distinct()
    if most_words:
        rows = rows.filter(F.size(F.split("term", " ")) <= most_words)
    return rows.groupBy("term").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") >= least)


def frequencies(df: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """Counts by key, largest first; a report with ``most``."""
    out = df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key)
    return out.limit(most) if most else out


def multimap(df: DataFrame, key: Column, value: str, extra: DataFrame | None = None) -> DataFrame:
    """Key to its sorted distinct values; ``extra`` (key, value) joins in before grouping. ambiguous: more than one."""
    rows = df.select(key.alias("key"), F.col(value).alias("value")).filter("key != '' AND value != ''")
    if extra is not None:
        rows = rows.unionByName(extra.select(F.upper("key").alias("key"), "value"))
    return rows.groupBy("key").agg(F.sort_array(F.collect_set("value")).alias("values")).withColumn("ambiguous", F.size("values") > 1)


def changed(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """The rows of ``after`` whose column differs from ``before``, or is new."""
    old = before.select(key, F.col(column).alias("_old"), F.lit(True).alias("_had"))
    joined = after.join(old, key, "left")
    return joined.filter(F.col("_had").isNull() | ~F.col(column).eqNullSafe(F.col("_old"))).drop("_old", "_had")


def snapshot_diff(a: DataFrame, b: DataFrame, key: str = "text", value: str = "cui") -> DataFrame:
    """Both snapshots by key: agree, disagree, only_a or only_b. An empty value counts as not linked."""
    side = lambda df, s: df.filter(F.col(value) != "").select(F.col(key), F.col(value).alias(f"{value}_{s}"))
    joined = side(a, "a").join(side(b, "b"), key, "full_outer")
    va, vb = F.col(f"{value}_a"), F.col(f"{value}_b")
    return joined.withColumn("status", F.when(va.isNull(), "only_b").when(vb.isNull(), "only_a").when(va == vb, "agree").otherwise("disagree"))


def first_with_conflicts(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Per key the first value and how many rows have another one."""
    firsts = first_wins(df, [key], order, [value]).withColumnRenamed(value, "_first")
    return df.join(firsts, key).groupBy(key).agg(F.first("_first").alias(value), F.sum((F.col(value) != F.col("_first")).cast("long")).alias("conflicts"))


def sample_by_hash(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n distinct rows, the same ones for a seed on every run."""
    rows = df.distinct()
    return rows.withColumn("_h", F.xxhash64(F.lit(seed), *rows.columns)).orderBy("_h", *rows.columns).limit(n).drop("_h")
