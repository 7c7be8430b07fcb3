"""Queries that link texts or vectors: exact, full text, nearest, cascades of them, and choice of senses."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions.vectors import mean_of
from textloom.operators import abbrev, clean, link
from textloom.plans.registry import query
from textloom.runtime import read

DIM = 64


def _texts(rows, text):
    return link.distinct_texts(rows, text)


def _names(spark, sf_dir, where="p_size < 30"):
    part = read(spark, sf_dir, "part").filter(where)
    return part.select(F.lower("p_name").alias("str_norm"), F.format_string("C%06d", F.col("p_partkey")).alias("cui"), F.col("p_name").alias("name"))


EXACT = """n AS (SELECT lower(p_name) AS k, min(printf('C%06d', p_partkey)) AS cui FROM part WHERE p_size < 30 GROUP BY 1),
t AS (SELECT substr(sha1(lower(trim(p_name))), 1, 16) AS entity_hash, min(trim(p_name)) AS text FROM part GROUP BY 1)"""


@query("exact_link_first", f"WITH {EXACT} SELECT entity_hash, cui FROM t JOIN n ON n.k = lower(t.text)")
def exact_link_first(spark, sf_dir):
    return link.exact(_texts(read(spark, sf_dir, "part"), "p_name"), _names(spark, sf_dir)).select("entity_hash", "cui")


@query("residual_anti", f"WITH {EXACT.replace('p_size < 30', 'p_size < 2')} SELECT entity_hash, text FROM t WHERE lower(text) NOT IN (SELECT k FROM n)")
def residual_anti(spark, sf_dir):
    texts = _texts(read(spark, sf_dir, "part"), "p_name")
    found = link.exact(texts, _names(spark, sf_dir, "p_size < 2"))
    return texts.join(found, "entity_hash", "left_anti").select("entity_hash", "text")


WORDS = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda w: w <> '')"


def bm25_sql(queries: str, q: str, q_text: str, corpus: str, d: str, d_text: str) -> str:
    """Common table expressions that end in ``ranked``: q, d, score, rn."""
    return f"""qt AS (SELECT DISTINCT {q} AS q, unnest({WORDS.format(q_text)}) AS term FROM {queries}),
    dw AS (SELECT {d} AS d, {WORDS.format(d_text)} AS ws FROM {corpus}), st AS (SELECT count(*) AS n, avg(len(ws)) AS m FROM dw),
    tf AS (SELECT d, len(ws) AS dl, term, count(*) AS tf FROM (SELECT d, ws, unnest(ws) AS term FROM dw) GROUP BY 1, 2, 3),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
    sc AS (SELECT q, d, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / m))), 12) AS score
      FROM qt JOIN tf USING (term) JOIN df USING (term), st GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, d) AS rn FROM sc)"""


@query("bm25_top1", f"WITH {bm25_sql('benchmark', 'item_id', 'text', 'documents', 'doc_id', 'text')} SELECT q AS item_id, d AS doc_id, round(score, 6) AS score FROM ranked WHERE rn = 1")
def bm25_top1(spark, sf_dir):
    found = link.bm25(read(spark, sf_dir, "benchmark").withColumnRenamed("text", "q"), read(spark, sf_dir, "documents"), "item_id", "q", "doc_id", "text")
    return found.select("item_id", "doc_id", F.round("score", 6).alias("score"))


COSINE = "round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / sqrt(list_inner_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]) * list_inner_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])), 12)"


@query(
    "knn_top1_threshold",
    f"""WITH s AS (SELECT a.vec_id AS q, b.vec_id AS d, {COSINE} AS score FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, d) AS rn FROM s)
    SELECT q AS vec_id, CASE WHEN score >= 0.4 THEN d::VARCHAR ELSE '' END AS cui, round(score, 6) AS score FROM r WHERE rn = 1""",
)
def knn_top1_threshold(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    texts = rows.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("entity_hash"), F.lit("").alias("text"), "vector")
    found = link.semantic(texts, rows.select(F.col("vec_id").alias("cui"), "vector"), 0.4, exclude_self=True)
    return found.select(F.col("entity_hash").alias("vec_id"), F.col("cui").cast("string").alias("cui"), F.round("score", 6).alias("score"))


@query(
    "knn_topk_filtered",
    f"""WITH s AS (SELECT a.vec_id AS q, b.vec_id AS d, {COSINE} AS score FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0 AND b.label = 3 AND a.vec_id <> b.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, d) AS rn FROM s)
    SELECT q AS query_id, d AS vec_id, rn::INT AS rank, round(score, 6) AS score FROM r WHERE rn <= 5""",
)
def knn_topk_filtered(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    asked = rows.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "vector")
    found = link.nearest(asked, rows, "query_id", "vec_id", 5, where=F.col("label") == 3, exclude_self=True)
    return found.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


CASCADE = f"""WITH t AS (SELECT substr(sha1(lower(trim(x))), 1, 16) AS entity_hash, min(trim(x)) AS text FROM
    (SELECT p_name AS x FROM part UNION ALL SELECT split_part(p_name, ' ', 2) || ' zz' FROM part UNION ALL SELECT '---') GROUP BY 1),
    c AS (SELECT printf('C%06d', p_partkey) AS cui, p_name AS name FROM part WHERE p_size < 3),
    e AS (SELECT entity_hash, min(cui) AS cui FROM t JOIN c ON lower(c.name) = lower(t.text) GROUP BY 1),
    l AS (SELECT * FROM t WHERE entity_hash NOT IN (SELECT entity_hash FROM e) AND regexp_matches(text, '[A-Za-z0-9]')),
    {bm25_sql('l', 'entity_hash', 'text', 'c', 'cui', 'name')},
    f AS (SELECT q AS entity_hash, d AS cui, 'fulltext' AS match FROM ranked WHERE rn = 1 AND score >= 0.5)"""


def _cascade_texts(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    rows = part.select(F.col("p_name").alias("x")).unionByName(part.select(F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(" zz")).alias("x")))
    return link.distinct_texts(rows.unionByName(spark.createDataFrame([("---",)], "x string")), "x")


def _lexical(spark, sf_dir):
    return link.lexical(_cascade_texts(spark, sf_dir), _names(spark, sf_dir, "p_size < 3"), 0.5)


@query("lexical_cascade", f"{CASCADE} SELECT t.entity_hash, coalesce(e.cui, f.cui, '') AS cui, CASE WHEN e.cui IS NOT NULL THEN 'exact' ELSE coalesce(f.match, '') END AS tier FROM t LEFT JOIN e USING (entity_hash) LEFT JOIN f USING (entity_hash)")
def lexical_cascade(spark, sf_dir):
    return _lexical(spark, sf_dir).select("entity_hash", "cui", F.split_part("match", F.lit("/"), F.lit(1)).alias("tier"))


HYBRID = f"""WITH q AS (SELECT 'v' || vec_id AS entity_hash, embedding FROM embeddings WHERE vec_id % 100 = 0), s AS (SELECT a.entity_hash, 'v' || b.vec_id AS cui, {COSINE} AS score
    FROM q a, embeddings b WHERE 'v' || b.vec_id <> a.entity_hash AND a.entity_hash NOT IN (SELECT 'v' || vec_id FROM embeddings WHERE vec_id % 3 = 0)),
    r AS (SELECT *, row_number() OVER (PARTITION BY entity_hash ORDER BY score DESC, cui) AS rn FROM s)"""


def _hybrid(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    name = F.concat(F.lit("v"), "vec_id")
    texts = rows.filter("vec_id % 100 = 0").select(name.alias("entity_hash"), name.alias("text"), "vector")
    names = rows.filter("vec_id % 3 = 0").select(name.alias("str_norm"), F.concat(F.lit("X"), "vec_id").alias("cui"), name.alias("name"))
    return link.hybrid(texts, names, rows.select(name.alias("cui"), "vector"), 0.4, exclude_self=True)


@query(
    "hybrid_cascade",
    f"""{HYBRID} SELECT q.entity_hash, CASE WHEN substr(q.entity_hash, 2)::INT % 3 = 0 THEN 'X' || substr(q.entity_hash, 2) WHEN r.score >= 0.4 THEN r.cui ELSE '' END AS cui,
    CASE WHEN substr(q.entity_hash, 2)::INT % 3 = 0 THEN 1.0 WHEN r.score >= 0.4 THEN round(r.score, 6) ELSE 0.0 END::DOUBLE AS score
    FROM q LEFT JOIN r ON r.entity_hash = q.entity_hash AND rn = 1""",
)
def hybrid_cascade(spark, sf_dir):
    return _hybrid(spark, sf_dir).select("entity_hash", "cui", F.round("score", 6).alias("score"))


@query(
    "linker_diff",
    """WITH a AS (SELECT p_name AS text, min(p_partkey) AS ca FROM part WHERE p_size < 25 GROUP BY 1), b AS (SELECT p_name AS text, min(p_partkey) AS cb FROM part WHERE p_size > 10 GROUP BY 1)
    SELECT text, CASE WHEN ca IS NULL THEN 'only_b' WHEN cb IS NULL THEN 'only_a' WHEN ca = cb THEN 'agree' ELSE 'disagree' END AS status FROM a FULL JOIN b USING (text)""",
)
def linker_diff(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    snap = lambda where: part.filter(where).groupBy(F.col("p_name").alias("text")).agg(F.min("p_partkey").cast("string").alias("cui"))
    return clean.snapshot_diff(snap("p_size < 25"), snap("p_size > 10")).select("text", "status")


def _senses(spark, sf_dir, odd: int):
    """Occurrences against the centroids of the labels; two encoders are the even and the odd dimensions."""
    rows = read(spark, sf_dir, "embeddings")
    part = lambda c: F.transform(F.filter(F.col(c), lambda x, i: i % 2 == odd), lambda x: x.cast("double"))
    rows = rows.select("vec_id", "label", part("embedding").alias("context"))
    centres = rows.groupBy("label").agg(mean_of("context", DIM // 2).alias("sense")).withColumnRenamed("label", "choice")
    near = rows.select("vec_id", "context", F.explode(F.array(*[((F.col("label") + F.lit(k)) % 10).cast("int") for k in range(4)])).alias("choice"))
    best = abbrev.best_sense(near.join(F.broadcast(centres), "choice").withColumn("sense", F.transform("sense", lambda x: F.round(x, 9))), ["vec_id"], "context", "sense", "choice")
    return best.withColumn("score", F.round("score", 6))


def _senses_sql(odd: int, name: str) -> str:
    half = f"list_transform(range({odd + 1}, 65, 2), lambda i: embedding[i]::DOUBLE)"
    centre = ", ".join(f"round(avg(v[{i}]), 9)" for i in range(1, 33))
    return f"""v{name} AS (SELECT vec_id, label, {half} AS v FROM embeddings), c{name} AS (SELECT label AS choice, list_value({centre}) AS s FROM v{name} GROUP BY 1),
    k{name} AS (SELECT vec_id, v, unnest([label % 10, (label + 1) % 10, (label + 2) % 10, (label + 3) % 10])::INT AS choice FROM v{name}),
    s{name} AS (SELECT vec_id, choice, list_inner_product(v, s) AS score FROM k{name} JOIN c{name} USING (choice)),
    r{name} AS (SELECT vec_id, choice, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, choice) AS rn FROM s{name}) WHERE rn = 1)"""


@query("wsd_argmax", f"WITH {_senses_sql(0, 'a')} SELECT vec_id, choice, score FROM ra")
def wsd_argmax(spark, sf_dir):
    return _senses(spark, sf_dir, 0)


HIGH, LOW, LEAST = 0.13, 0.09, 0.05


@query(
    "ensemble_gate",
    f"""WITH {_senses_sql(0, 'a')}, {_senses_sql(1, 'b')} SELECT a.vec_id, a.choice, CASE WHEN a.score < {LEAST} THEN 'below' WHEN a.score >= {HIGH} THEN 'alone'
    WHEN a.choice = b.choice AND b.score >= {LOW} THEN 'agreed' ELSE 'disagreed' END AS reason FROM ra a LEFT JOIN rb b USING (vec_id)""",
)
def ensemble_gate(spark, sf_dir):
    gated = abbrev.accept_by_ensemble(_senses(spark, sf_dir, 0), _senses(spark, sf_dir, 1), ["vec_id"], "choice", HIGH, LOW, LEAST)
    return gated.select("vec_id", "choice", "reason")


@query(
    "wsd_agreement",
    f"""WITH {_senses_sql(0, 'a')}, {_senses_sql(1, 'b')} SELECT count(*) FILTER (a.choice = b.choice) AS n_same, count(*) FILTER (a.choice <> b.choice) AS n_differ,
    count(*) FILTER (a.score >= {LOW}) AS n_accept_a, count(*) FILTER (b.score >= {LOW}) AS n_accept_b, count(*) FILTER (a.score >= {LOW} AND b.score >= {LOW}) AS n_accept_both,
    count(DISTINCT CASE WHEN a.choice <> b.choice THEN a.choice * 100 + b.choice END) AS n_disagreements FROM ra a JOIN rb b USING (vec_id)""",
)
def wsd_agreement(spark, sf_dir):
    return abbrev.agreement(_senses(spark, sf_dir, 0), _senses(spark, sf_dir, 1), ["vec_id"], "choice", LOW, LOW)
