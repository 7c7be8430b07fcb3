"""Queries over tables as graphs and dictionaries: filters, semi-joins, merges, rules, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import clean, graph, link, sections
from textloom.plans.registry import query
from textloom.runtime import read


@query(
    "rrf_filter_first_wins",
    """SELECT l_partkey, min(l_orderkey * 10 + l_linenumber) AS pos, arg_min(l_quantity, l_orderkey * 10 + l_linenumber) AS l_quantity
    FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag NOT IN ('R', 'A') GROUP BY 1""",
)
def rrf_filter_first_wins(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").withColumn("LAT", F.expr("if(l_linestatus = 'O', 'ENG', 'SPA')")).withColumn("SUPPRESS", F.expr("decode(l_returnflag, 'R', 'O', 'A', 'Y', 'N')"))
    rows = graph.kept_rows(rows).withColumn("pos", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return clean.first_wins(rows, ["l_partkey"], "pos", ["pos", "l_quantity"])


@query(
    "edges_two_sided_semi",
    """SELECT l_partkey AS src, l_suppkey AS dst, l_orderkey, l_linenumber FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 20) AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND l_partkey <> l_suppkey""",
)
def edges_two_sided_semi(spark, sf_dir):
    edges = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"), "l_orderkey", "l_linenumber")
    edges = graph.no_loops(edges, "src", "dst")
    ends = {"src": (read(spark, sf_dir, "part").filter("p_size < 20"), "p_partkey"), "dst": (read(spark, sf_dir, "supplier").filter("s_acctbal > 0"), "s_suppkey")}
    return graph.within(edges, ends).select("src", "dst", "l_orderkey", "l_linenumber")


@query(
    "defs_two_dim_semi",
    """SELECT c_custkey, c_nationkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)
    AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 2))""",
)
def defs_two_dim_semi(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    ends = {"c_custkey": (read(spark, sf_dir, "orders").filter("o_totalprice > 100000"), "o_custkey"), "c_nationkey": (read(spark, sf_dir, "nation").filter("n_regionkey IN (1, 2)"), "n_nationkey")}
    return graph.within(rows, ends).select("c_custkey", "c_nationkey", "c_name")


@query(
    "hier_key_resolution",
    """SELECT c_custkey, a.n_regionkey AS src, b.n_regionkey AS dst FROM customer JOIN nation a ON a.n_nationkey = c_nationkey
    JOIN nation b ON b.n_nationkey = c_custkey % 30 WHERE a.n_regionkey <> b.n_regionkey""",
)
def hier_key_resolution(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("child"), (F.col("c_custkey") % 30).cast("int").alias("parent"))
    both = graph.resolve_ends(rows, read(spark, sf_dir, "nation"), "n_nationkey", "n_regionkey", {"child": "src", "parent": "dst"})
    return both.filter("src <> dst").select("c_custkey", "src", "dst")


@query(
    "semtype_collect",
    """SELECT p_brand AS src, string_agg(tui, '|' ORDER BY tui, name) AS tuis, string_agg(name, '|' ORDER BY tui, name) AS names
    FROM (SELECT DISTINCT p_brand, substr(md5(p_type), 1, 6) AS tui, p_type AS name FROM part) GROUP BY 1""",
)
def semtype_collect(spark, sf_dir):
    part, tui = read(spark, sf_dir, "part"), F.substring(F.md5("p_type"), 1, 6)
    nodes = part.select(tui.alias("tui"), F.col("p_type").alias("name")).distinct()
    got = graph.collected_types(part.select(F.col("p_brand").alias("src"), tui.alias("dst")), nodes)
    return got.select("src", F.array_join("tuis", "|").alias("tuis"), F.array_join("names", "|").alias("names"))


@query(
    "tier_labels",
    """SELECT o_custkey, bool_or(o_orderpriority IN ('1-URGENT')) AS core, bool_or(o_orderpriority IN ('2-HIGH', '3-MEDIUM')) AS support,
    NOT bool_or(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS peripheral FROM orders GROUP BY 1""",
)
def tier_labels(spark, sf_dir):
    return graph.tiers(read(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", {"core": ["1-URGENT"], "support": ["2-HIGH", "3-MEDIUM"]}, "peripheral")


@query(
    "pattern_query",
    """SELECT 'p' || l_partkey AS anchor, 's' || l_suppkey AS neighbour FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R' AND p_size = 7
    UNION ALL SELECT 's' || l_suppkey, 'p' || l_partkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag = 'R' AND s_suppkey = 3""",
)
def pattern_query(spark, sf_dir):
    part, supplier = read(spark, sf_dir, "part"), read(spark, sf_dir, "supplier")
    nodes = part.select(F.concat(F.lit("p"), "p_partkey").alias("id"), (F.col("p_size") == 7).alias("is_anchor"))
    nodes = nodes.unionByName(supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("id"), (F.col("s_suppkey") == 3).alias("is_anchor")))
    edges = read(spark, sf_dir, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"), "l_returnflag")
    return graph.neighbours(nodes, edges, F.col("is_anchor"), F.col("l_returnflag") == "R").orderBy("anchor", "neighbour")


@query("source_dim_first_wins", "SELECT n_regionkey, arg_min(n_name, n_nationkey) AS n_name FROM nation GROUP BY 1")
def source_dim_first_wins(spark, sf_dir):
    return clean.first_wins(read(spark, sf_dir, "nation"), ["n_regionkey"], "n_nationkey", ["n_name"])


@query(
    "note_layer_merge",
    """SELECT 'entity' AS kind, role AS id, arg_max(md5(text), conv_id * 1000 + turn) AS detail FROM conversations GROUP BY role
    UNION ALL SELECT DISTINCT 'has_section', conv_id || '>' || conv_id || ':' || turn, '' FROM conversations
    UNION ALL SELECT DISTINCT 'has_mention', conv_id || ':' || turn || '>' || role, '' FROM conversations
    UNION ALL SELECT 'universe', id::VARCHAR, '' FROM (SELECT conv_id AS id FROM conversations UNION SELECT turn FROM conversations)""",
)
def note_layer_merge(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").withColumn("pos", F.col("conv_id") * 1000 + F.col("turn")).withColumn("section", F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))).withColumn("digest", F.md5("text"))
    entity = graph.merged_nodes(rows, ["role"], "pos", ["digest"]).select(F.lit("entity").alias("kind"), F.col("role").alias("id"), F.col("digest").alias("detail"))
    edge = lambda kind, a, b: graph.merged_edges(rows, [a, b]).select(F.lit(kind).alias("kind"), F.concat(F.col(a).cast("string"), F.lit(">"), F.col(b)).alias("id"), F.lit("").alias("detail"))
    known = graph.universe(rows.select("conv_id").distinct(), "conv_id", rows.select("turn")).select(F.lit("universe").alias("kind"), F.col("conv_id").cast("string").alias("id"), F.lit("").alias("detail"))
    return entity.unionByName(edge("has_section", "conv_id", "section")).unionByName(edge("has_mention", "section", "role")).unionByName(known)


RULES = [{"cui": "D1", "any_of": {"purchase", "refund"}, "min_hits": 2}, {"cui": "D2", "any_of": {"click", "view", "signup"}, "min_hits": 2}, {"cui": "D3", "any_of": {"purchase", "click", "view", "search"}, "min_hits": 1}]
EXPLICIT = {"0": "D9", "1": ""}


@query(
    "doctype_rules",
    """WITH u AS (SELECT user_id, list(DISTINCT event_type) AS ts FROM events GROUP BY 1)
    SELECT user_id, CASE WHEN user_id % 7 = 0 THEN 'D9' WHEN len(list_intersect(ts, ['purchase', 'refund'])) >= 2 THEN 'D1'
    WHEN len(list_intersect(ts, ['click', 'view', 'signup'])) >= 2 THEN 'D2' WHEN len(list_intersect(ts, ['purchase', 'click', 'view', 'search'])) >= 1 THEN 'D3' ELSE '' END AS doctype FROM u""",
)
def doctype_rules(spark, sf_dir):
    users = read(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("types")).withColumn("kind", (F.col("user_id") % 7).cast("string"))
    return users.select("user_id", sections.document_type("kind", "types", EXPLICIT, RULES).alias("doctype"))


@query("dict_default_lookup", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'S1' WHEN 'MACHINERY' THEN 'S2' ELSE '' END AS code FROM customer")
def dict_default_lookup(spark, sf_dir):
    return link.with_default(read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", {"BUILDING": "S1", "MACHINERY": "S2", "NOWHERE": ""}, "code").select("c_custkey", "code")


@query("alias_lookup", "SELECT event_id, CASE upper(trim(event_type)) WHEN 'CLICK' THEN 'mouse click' WHEN 'VIEW' THEN 'page view' ELSE event_type END AS normal FROM events")
def alias_lookup(spark, sf_dir):
    return link.by_alias(read(spark, sf_dir, "events"), "event_type", {"click": "mouse click", "View": "page view"}).select("event_id", "normal")


@query("gazetteer_multimap", "SELECT upper(split_part(p_name, ' ', 2)) AS key, string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) AS brands, count(DISTINCT p_brand) > 1 AS ambiguous FROM part WHERE split_part(p_name, ' ', 2) <> '' GROUP BY 1")
def gazetteer_multimap(spark, sf_dir):
    got = clean.multimap(read(spark, sf_dir, "part"), F.upper(F.split_part("p_name", F.lit(" "), F.lit(2))), "p_brand")
    return got.select("key", F.array_join("values", "|").alias("brands"), "ambiguous")


@query("freq_top25", "SELECT p_name, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_name LIMIT 25")
def freq_top25(spark, sf_dir):
    return clean.frequencies(read(spark, sf_dir, "part"), "p_name", 25)


@query("provenance_tally", "SELECT source, count(*) AS n, sum(CASE WHEN lang = 'en' THEN 1 ELSE 0 END)::BIGINT AS n_en, count(DISTINCT lang) AS n_langs FROM documents GROUP BY 1")
def provenance_tally(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.groupBy("source").agg(F.count("*").alias("n"), F.sum((F.col("lang") == "en").cast("long")).alias("n_en"), F.count_distinct("lang").alias("n_langs"))


@query("category_counts_exploded", "SELECT tok, count(*) AS n FROM (SELECT unnest(string_split(p_type, ' ')) AS tok FROM part) GROUP BY 1")
def category_counts_exploded(spark, sf_dir):
    return read(spark, sf_dir, "part").select(F.explode(F.split("p_type", " ")).alias("tok")).groupBy("tok").agg(F.count("*").alias("n"))


@query(
    "hierarchy_closure",
    """WITH RECURSIVE e AS (SELECT o_orderkey AS src, o_orderkey // 16 AS dst FROM orders), r(id, depth) AS (SELECT src, 0 FROM e WHERE src NOT IN (SELECT dst FROM e WHERE src <> dst)
    UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.id WHERE e.src <> e.dst) SELECT id, min(depth)::INT AS depth FROM r GROUP BY id""",
)
def hierarchy_closure(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    edges = orders.select(F.col("o_orderkey").alias("src"), F.floor(F.col("o_orderkey") / 16).cast("long").alias("dst"))
    parents = edges.filter("src != dst").select(F.col("dst").alias("src"))
    return graph.reachable(edges, edges.join(parents, "src", "left_anti").select(F.col("src").alias("id")))


@query(
    "snapshot_conflicts",
    """WITH f AS (SELECT p_name, arg_min(p_brand, p_partkey) AS p_brand FROM part GROUP BY 1)
    SELECT p_name, f.p_brand, sum((part.p_brand <> f.p_brand)::INT)::BIGINT AS conflicts FROM part JOIN f USING (p_name) GROUP BY 1, 2""",
)
def snapshot_conflicts(spark, sf_dir):
    return clean.first_with_conflicts(read(spark, sf_dir, "part").select("p_name", "p_brand", "p_partkey"), "p_name", "p_brand", "p_partkey")
