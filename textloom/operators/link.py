"""Linking texts to concepts in tiers: exact, full text (BM25), nearest vector. Only distinct texts are looked up."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import col, entity_hash, match_label, words
from textloom.runtime import PIECE_ROWS, in_pieces, materialize, ship

K1, B = 1.2, 0.75
PIECE_DOCS, MOST_QUERIES = 1_000, 1_000
HAS_LETTER_OR_DIGIT = "[A-Za-z0-9]"


def distinct_texts(mentions: DataFrame, text: str = "expanded_text") -> DataFrame:
    """entity_hash, text: one row a hash, blank texts left out."""
    rows = mentions.select(entity_hash(text).alias("entity_hash"), F.trim(text).alias("text")).filter("text != ''")
    return rows.groupBy("entity_hash").agg(F.min("text").alias("text"))


def exact(texts: DataFrame, names: DataFrame, key: str = "entity_hash", text: str = "text") -> DataFrame:
    """key, cui, name: the concept whose stored form equals the lower-cased text; of several, the least cui.

    names: str_norm, cui, name. The stored side is lower-cased and not trimmed.
    """
    one = names.groupBy("str_norm").agg(F.min(F.struct("cui", "name")).alias("c"))
    return texts.withColumn("str_norm", F.lower(F.trim(col(text)))).join(one, "str_norm").select(key, "c.cui", "c.name")


def postings(corpus: DataFrame, doc: str, text: str, terms: DataFrame, parts: int) -> DataFrame:
    """doc, length, term, tf of those terms of every document that are in ``terms`` (term), dealt by document in ``parts``.

    Texts are dealt before they are cut, so that their terms are counted where they are. Every document has the term ''.
    """
    tokens = corpus.select(doc, text).repartition(parts, doc).select(doc, words(text).alias("_w"))
    listed = F.coalesce(F.array_append("_w", F.lit("")), F.array(F.lit("")))
    rows = tokens.select(doc, F.size("_w").alias("length"), F.explode(listed).alias("term")).join(terms, "term", "left_semi")
    return rows.groupBy(doc, "length", "term").agg(F.count("*").alias("tf"))


def bm25(queries: DataFrame, corpus: DataFrame, query: str, query_text: str, doc: str, text: str, k: int = 1, least: float = 0.0, all_terms: bool = False) -> DataFrame:
    """query, doc, score, rank: the k best documents for each query, of at least ``least``; ties to the smaller id.

    Joined by term, and only terms of queries leave the scan of postings. Hits are summed in pieces of about
    ``PIECE_DOCS`` documents (fewer with over 200 queries), each of which gives k rows a query at most; terms of up to
    ``MOST_QUERIES`` queries are broadcast to the pieces, else hits are dealt anew by their number. Scores are rounded to 12 places, so that the
    order of summation decides nothing. all_terms: every term of the query must be there.
    """
    spark = corpus.sparkSession
    terms = queries.select(query, F.explode(words(query_text)).alias("term")).distinct()
    each = terms.select("term").unionByName(spark.createDataFrame([("",)], "term string")).distinct()
    some = terms.agg(F.count("*").alias("rows"), F.count_distinct(query).alias("queries")).first()
    few = some["rows"] <= PIECE_ROWS and some["queries"] <= MOST_QUERIES
    parts = math.ceil(corpus.count() * max(1, some["queries"] / 200 if few else 1) / PIECE_DOCS)
    wanted = postings(corpus, doc, text, F.broadcast(each) if few else each, max(1, parts))
    sums = [F.count("*").alias("df"), F.sum("tf").alias("n"), (F.sum(F.col("tf") * F.col("length")) / F.sum(F.when(F.col("length").isNotNull(), F.col("tf")))).alias("mean")]
    frequency = materialize(wanted.groupBy("term").agg(*sums), "frequency")
    size = frequency.filter("term = ''").first()
    n, mean = (size["n"], size["mean"] or 1.0) if size else (0, 1.0)
    asked = materialize(terms.join(frequency.select("term", "df"), "term"), "asked")
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * (F.col("tf") * (K1 + 1)) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(mean)))
    hits = wanted.join(F.broadcast(asked) if few else asked, "term").select(query, doc, part.alias("part"))
    if not few:
        hits = hits.repartition(in_pieces(asked.agg(F.sum("df")).first()[0] or 0), query, doc)
    scored = hits.groupBy(query, doc).agg(F.round(F.sum("part"), 12).alias("score"), F.count("*").alias("_n"))
    if all_terms:
        scored = scored.join(terms.groupBy(query).agg(F.count("*").alias("_all")), query).filter("_n = _all").drop("_all")
    order = Window.partitionBy(query).orderBy(F.desc("score"), doc)
    return scored.filter(F.col("score") >= least).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(query, doc, "score", "rank")


def _packed(df: DataFrame, key: str, vector: str, block: int, name: str) -> tuple[DataFrame, int]:
    """Rows in blocks of about ``block``: block, data (Arrow bytes). A block is one row."""
    blocks = max(1, -(-df.count() // block))

    def pack(table: pa.Table) -> pa.Table:
        sink = pa.BufferOutputStream()
        held = table.select([key, vector])
        with pa.ipc.new_stream(sink, held.schema) as out:
            out.write_table(held)
        return pa.table({"block": table.column("block").slice(0, 1), "data": [sink.getvalue().to_pybytes()]})

    dealt = df.select(key, F.col(vector).cast("array<double>").alias(vector)).withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)))
    return materialize(dealt.groupBy("block").applyInArrow(pack, "block long, data binary"), name), blocks


def nearest(queries: DataFrame, corpus: DataFrame, query: str, doc: str, k: int = 1, vector: str = "vector", where: Column | None = None, exclude_self: bool = False, block: int = 4096) -> DataFrame:
    """query, doc, score, rank: the k nearest by cosine, exactly; scores have 12 places, so that rounding of sums decides nothing; ties go to the smaller id.

    ``where`` filters the corpus before the search. Blocks of queries meet blocks of the corpus as matrix products;
    each pair of blocks gives k rows a query at most, and a second step merges them.
    """
    spark = corpus.sparkSession
    ship(spark)
    if where is not None:
        corpus = corpus.filter(where)
    left, n_left = _packed(queries, query, vector, block, "queries")
    right, n_right = _packed(corpus, doc, vector, block, "corpus")
    pairs = spark.range(n_right).select(F.col("id").alias("r"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_left - 1).cast("long"))).alias("l"))
    both = pairs.join(right.select(F.col("block").alias("r"), F.col("data").alias("rd")), "r").join(left.select(F.col("block").alias("l"), F.col("data").alias("ld")), "l").select("ld", "rd")
    q_kind, d_kind = queries.schema[query].dataType.simpleString(), corpus.schema[doc].dataType.simpleString()

    def unpack(data, key):
        table = pa.ipc.open_stream(data.as_py()).read_all()
        x = np.array(table.column(1).to_pylist(), float)
        norms = np.sqrt((x * x).sum(1, keepdims=True))
        return table.column(0).combine_chunks(), x / np.where(norms > 0, norms, 1)

    def run(batches):
        for batch in batches:
            for ld, rd in zip(batch.column(0), batch.column(1), strict=True):
                q_ids, q = unpack(ld, query)
                d_ids, d = unpack(rd, doc)
                order_ids = np.argsort(np.array(d_ids.to_pylist(), dtype=object), kind="stable")
                place = np.empty(len(d), np.int64)
                place[order_ids] = np.arange(len(d))
                rows_q, rows_d, scores = [], [], []
                own = {v: i for i, v in enumerate(d_ids.to_pylist())} if exclude_self else {}
                for start in range(0, len(q), 256):
                    s = np.round(q[start : start + 256] @ d.T, 12)
                    for i, row in enumerate(s):
                        if exclude_self and (at := own.get(q_ids[start + i].as_py())) is not None:
                            row[at] = -np.inf
                        if len(row) > k:
                            cut = np.partition(row, len(row) - k)[len(row) - k]
                            near = np.flatnonzero(row >= cut)
                        else:
                            near = np.arange(len(row))
                        best = near[np.lexsort((place[near], -row[near]))][:k]
                        best = best[np.isfinite(row[best])]
                        rows_q += [start + i] * len(best)
                        rows_d += best.tolist()
                        scores += row[best].tolist()
                yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(rows_q, pa.int64())), d_ids.take(pa.array(rows_d, pa.int64())), pa.array(scores, pa.float64())], [query, doc, "score"])

    found = both.mapInArrow(run, f"{query} {q_kind}, {doc} {d_kind}, score double")
    order = Window.partitionBy(query).orderBy(F.desc("score"), doc)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def with_types(linked: DataFrame, types: DataFrame) -> DataFrame:
    """Adds tuis and names of the cui; empty lists where it has none. types: src, tuis, names."""
    return linked.join(types.withColumnRenamed("src", "cui"), "cui", "left").withColumn("tuis", F.coalesce("tuis", F.array().cast("array<string>"))).withColumn("names", F.coalesce("names", F.array().cast("array<string>")))


def lexical(texts: DataFrame, names: DataFrame, least: float = 5.0, all_terms: bool = False, fulltext: bool = True) -> DataFrame:
    """entity_hash, text, cui, match: the exact tier, then, with ``fulltext``, full text for what is left and has a letter or digit.

    texts: entity_hash, text. names: str_norm, cui, name. Full text searches names, each once.
    """
    first = exact(texts, names).select("entity_hash", "cui", match_label("exact").alias("match"))
    if not fulltext:
        return _written_back(texts, first)
    left = texts.join(first, "entity_hash", "left_anti").filter(F.col("text").rlike(HAS_LETTER_OR_DIGIT))
    corpus = names.select("cui", "name").distinct().groupBy("cui").agg(F.min("name").alias("name"))
    found = bm25(left, corpus, "entity_hash", "text", "cui", "name", 1, least, all_terms)
    second = found.select("entity_hash", "cui", match_label("fulltext", "score").alias("match"))
    return _written_back(texts, first.unionByName(second))


def _written_back(texts: DataFrame, linked: DataFrame) -> DataFrame:
    out = texts.join(linked, "entity_hash", "left")
    return out.select("entity_hash", "text", F.coalesce("cui", F.lit("")).alias("cui"), F.coalesce("match", F.lit("")).alias("match"))


def semantic(texts: DataFrame, concepts: DataFrame, least: float = 0.7, exclude_self: bool = False) -> DataFrame:
    """entity_hash, text, cui, score: the nearest concept; below ``least`` the score stays and the cui is empty."""
    found = nearest(texts, concepts, "entity_hash", "cui", 1, exclude_self=exclude_self)
    return texts.select("entity_hash", "text").join(found, "entity_hash", "left").select("entity_hash", "text", F.when(F.col("score") >= least, F.col("cui").cast("string")).otherwise("").alias("cui"), "score")


def hybrid(texts: DataFrame, names: DataFrame, concepts: DataFrame, least: float = 0.7, exclude_self: bool = False) -> DataFrame:
    """entity_hash, text, cui, match, score: exact (score 1), then nearest vector; what is left has score 0."""
    first = exact(texts, names).select("entity_hash", "cui", match_label("exact").alias("match"), F.lit(1.0).alias("score"))
    left = texts.join(first, "entity_hash", "left_anti")
    found = nearest(left, concepts, "entity_hash", "cui", 1, exclude_self=exclude_self).filter(F.col("score") >= least)
    second = found.select("entity_hash", "cui", match_label("vector", "score").alias("match"), "score")
    linked = first.unionByName(second)
    out = texts.select("entity_hash", "text").join(linked, "entity_hash", "left")
    return out.select("entity_hash", "text", F.coalesce("cui", F.lit("")).alias("cui"), F.coalesce("match", F.lit("")).alias("match"), F.coalesce("score", F.lit(0.0)).alias("score"))


def by_alias(rows: DataFrame, column: str, aliases: dict[str, str]) -> DataFrame:
    """Adds ``normal``: the alias's long form whatever the case, else the value itself."""
    table = rows.sparkSession.createDataFrame([(k.upper(), v) for k, v in aliases.items()] or [("", "")], "_alias string, _long string")
    joined = rows.join(F.broadcast(table), F.upper(F.trim(F.col(column))) == F.col("_alias"), "left")  # as many rows as aliases are written down
    return joined.withColumn("normal", F.coalesce("_long", F.col(column))).drop("_alias", "_long")


def with_default(rows: DataFrame, column: str, values: dict[str, str], name: str) -> DataFrame:
    """Adds the value of a dictionary, '' where it has none."""
    if not values:
        return rows.withColumn(name, F.lit(""))
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return rows.withColumn(name, F.coalesce(F.element_at(table, F.col(column)), F.lit("")))


def strings(rows: DataFrame, column: str, names: DataFrame, aliases: dict[str, str], least: float, all_terms: bool = False) -> DataFrame:
    """Links the distinct values of a column (specialties, section types): alias, then exact, then full text."""
    distinct = by_alias(rows.select(column).filter(F.col(column) != "").distinct(), column, aliases)
    texts = distinct.select(F.col(column).alias("entity_hash"), F.col("normal").alias("text"))
    return lexical(texts, names, least, all_terms).withColumnRenamed("entity_hash", column)


def merge_ranks(runs: list[DataFrame], query: str, doc: str, constant: int = 60) -> DataFrame:
    """query, doc, score: reciprocal-rank fusion of ranked results; an extension."""
    out = None
    for run in runs:
        part = run.select(query, doc, (F.lit(1.0) / (constant + F.col("rank"))).alias("part"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy(query, doc).agg(F.sum("part").alias("score"))
