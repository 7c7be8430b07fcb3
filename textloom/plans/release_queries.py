"""Queries that build terminology tables, the note layer and stored tables from rows shaped like a release's files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from textloom.operators import clean, graph, shards
from textloom.plans.registry import query
from textloom.runtime import read, shared_root
from textloom.sources import readers, sinks

CONSO = """conso AS (SELECT 'C' || l_partkey AS CUI, 'A' || l_orderkey || '_' || l_linenumber AS AUI, CASE WHEN l_linestatus = 'O' THEN 'ENG' ELSE 'SPA' END AS LAT,
    CASE WHEN l_returnflag = 'R' THEN 'O' ELSE 'N' END AS SUPPRESS, 'S' || l_suppkey % 7 AS SAB, l_linenumber::VARCHAR AS CODE, 'PT' AS TTY,
    'A & ' || l_returnflag || ' <' || l_linenumber || '> ' || l_suppkey AS STR, l_orderkey * 10 + l_linenumber AS pos FROM lineitem),
    good AS (SELECT * FROM conso WHERE LAT = 'ENG' AND SUPPRESS NOT IN ('O', 'E', 'Y')), kept AS (SELECT DISTINCT CUI FROM good)"""
SABS = """sabs AS (SELECT sab, arg_min(name, pos) AS name, arg_min(version, pos) AS version FROM (SELECT CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE 'S' || s_suppkey % 8 END AS sab,
    s_name || ' "q" ' || chr(233) AS name, s_nationkey::VARCHAR AS version, s_suppkey AS pos FROM supplier) WHERE sab <> '' GROUP BY sab)"""


def _s(text: str):
    return F.expr(text)


def _conso(spark, sf_dir):
    text = _s("concat('A &amp; ', l_returnflag, ' &lt;', l_linenumber, '&gt; ', l_suppkey)")
    rows = read(spark, sf_dir, "lineitem")
    return rows.select(
        _s("concat('C', l_partkey)").alias("CUI"), _s("concat('A', l_orderkey, '_', l_linenumber)").alias("AUI"), _s("if(l_linestatus = 'O', 'ENG', 'SPA')").alias("LAT"),
        _s("if(l_returnflag = 'R', 'O', 'N')").alias("SUPPRESS"), _s("concat('S', l_suppkey % 7)").alias("SAB"), F.col("l_linenumber").cast("string").alias("CODE"),
        F.lit("PT").alias("TTY"), text.alias("STR"), _s("l_orderkey * 10 + l_linenumber").alias("pos"),
    )


def _kept(spark, sf_dir):
    return graph.concepts(_conso(spark, sf_dir))


@query("terminology_concepts", f"WITH {CONSO} SELECT CUI AS cui, min({{'p': pos, 's': STR}}).s AS name FROM good GROUP BY CUI")
def terminology_concepts(spark, sf_dir):
    return _kept(spark, sf_dir)


@query("terminology_atoms", f"WITH {CONSO} SELECT CUI AS cui, AUI AS aui, SAB AS sab, CODE AS code, TTY AS tty, STR AS str, lower(STR) AS str_norm FROM good")
def terminology_atoms(spark, sf_dir):
    return graph.atoms(_conso(spark, sf_dir), _kept(spark, sf_dir))


@query("terminology_all_languages", f"WITH {CONSO} SELECT CUI AS cui, min({{'p': pos, 's': STR}}).s AS name FROM conso GROUP BY CUI")
def terminology_all_languages(spark, sf_dir):
    return graph.concepts(_conso(spark, sf_dir), language=None, drop_suppressed=False)


def _types(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    rows = part.select(_s("concat('C', p_partkey)").alias("CUI"), _s("concat('T', p_size)").alias("TUI"), _s("concat('type &quot;', p_size, '&quot; ', p_brand)").alias("STY"), _s("concat('A', p_brand)").alias("STN"), F.col("p_partkey").alias("pos"))
    return graph.semantic_types(rows, _kept(spark, sf_dir))


STY = """sty AS (SELECT 'C' || p_partkey AS CUI, 'T' || p_size AS TUI, 'type "' || p_size || '" ' || p_brand AS STY, 'A' || p_brand AS STN, p_partkey AS pos FROM part WHERE 'C' || p_partkey IN (SELECT CUI FROM kept))"""


@query("terminology_semantic_types", f"WITH {CONSO}, {STY} SELECT TUI AS tui, min({{'p': pos, 's': STY}}).s AS name, min({{'p': pos, 's': STY, 't': STN}}).t AS tree_number FROM sty GROUP BY TUI")
def terminology_semantic_types(spark, sf_dir):
    return _types(spark, sf_dir)[0]


@query("terminology_has_semtype", f"WITH {CONSO}, {STY} SELECT CUI AS src, TUI AS dst FROM sty")
def terminology_has_semtype(spark, sf_dir):
    return _types(spark, sf_dir)[1]


@query(
    "terminology_relations",
    f"""WITH {CONSO}, rel AS (SELECT 'C' || l_partkey AS src, 'C' || l_suppkey AS dst, 'RO' AS rel, l_returnflag AS rela, 'S' || l_linenumber AS sab, CASE WHEN l_linenumber = 1 THEN 'E' ELSE 'N' END AS SUPPRESS FROM lineitem)
    SELECT src, dst, rel, rela, sab FROM rel WHERE SUPPRESS = 'N' AND src <> dst AND src IN (SELECT CUI FROM kept) AND dst IN (SELECT CUI FROM kept)""",
)
def terminology_relations(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(_s("concat('C', l_partkey)").alias("CUI1"), _s("concat('C', l_suppkey)").alias("CUI2"), F.lit("RO").alias("REL"), F.col("l_returnflag").alias("RELA"), _s("concat('S', l_linenumber)").alias("SAB"), _s("if(l_linenumber = 1, 'E', 'N')").alias("SUPPRESS"))
    return graph.relations(rows, _kept(spark, sf_dir))


@query(
    "terminology_hierarchy",
    f"""WITH {CONSO}, hier AS (SELECT 'A' || l_orderkey || '_' || l_linenumber AS AUI, CASE WHEN l_linenumber = 1 THEN '' ELSE 'A' || l_orderkey || '_' || (l_linenumber - 1) END AS PAUI, 'S' || l_linenumber AS sab, '' AS rela FROM lineitem),
    own AS (SELECT DISTINCT AUI, CUI FROM conso WHERE CUI IN (SELECT CUI FROM kept))
    SELECT a.CUI AS src, b.CUI AS dst, sab, rela FROM hier JOIN own a ON a.AUI = hier.AUI JOIN own b ON b.AUI = hier.PAUI WHERE a.CUI <> b.CUI""",
)
def terminology_hierarchy(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(_s("concat('A', l_orderkey, '_', l_linenumber)").alias("AUI"), _s("if(l_linenumber = 1, '', concat('A', l_orderkey, '_', l_linenumber - 1))").alias("PAUI"), _s("concat('S', l_linenumber)").alias("SAB"), F.lit("").alias("RELA"))
    return graph.hierarchy(rows, _conso(spark, sf_dir), _kept(spark, sf_dir))


def _sources(spark, sf_dir):
    rows = read(spark, sf_dir, "supplier").select(_s("if(s_suppkey % 10 = 0, '', concat('S', s_suppkey % 8))").alias("RSAB"), _s("concat(s_name, ' &quot;q&#34; &eacute;')").alias("SON"), F.col("s_nationkey").cast("string").alias("SVER"), F.col("s_suppkey").alias("pos"))
    return graph.sources(rows)


@query("terminology_sources", f"WITH {SABS} SELECT sab, name, version FROM sabs")
def terminology_sources(spark, sf_dir):
    return _sources(spark, sf_dir)


@query(
    "terminology_definitions",
    f"""WITH {CONSO}, {SABS}, def AS (SELECT 'C' || o_orderkey % 1000 AS src, 'S' || o_custkey % 9 AS dst, o_orderpriority || ' ''x''' AS def, o_orderstatus AS st FROM orders)
    SELECT src, dst, def FROM def WHERE st <> 'O' AND src IN (SELECT CUI FROM kept) AND dst IN (SELECT sab FROM sabs)""",
)
def terminology_definitions(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select(_s("concat('C', o_orderkey % 1000)").alias("CUI"), _s("concat('S', o_custkey % 9)").alias("SAB"), _s("concat(o_orderpriority, ' &#39;x&#x27;')").alias("DEF"), F.col("o_orderstatus").alias("SUPPRESS"))
    return graph.definitions(rows, _kept(spark, sf_dir), _sources(spark, sf_dir))


LAYER = """docs AS (SELECT o_orderkey AS doc_id, o_orderpriority AS sample_name, o_orderstatus AS description, '' AS doctype_cui, CASE WHEN o_custkey % 3 = 0 THEN '' ELSE 'C' || o_custkey % 50 END AS specialty_cui, 'C' || o_custkey % 7 AS alt FROM orders),
    secs AS (SELECT l_orderkey || ':' || l_linenumber % 2 AS chunk_id, l_orderkey AS doc_id, l_linenumber AS section_pos, l_returnflag AS section_type, 'x' || l_suppkey AS text, CASE WHEN l_linestatus = 'O' THEN 'C1' ELSE '' END AS section_cui FROM lineitem WHERE l_linenumber <= 3),
    ment AS (SELECT l_orderkey || ':' || l_linenumber % 2 AS chunk_id, CASE WHEN l_partkey % 11 = 0 THEN '' ELSE 'e' || l_partkey END AS entity_hash, l_linenumber AS a, l_linenumber + 3 AS b, l_orderkey * 10 + l_linenumber AS pos, 'x' || l_suppkey AS expanded_text, l_returnflag AS type, CASE WHEN l_partkey % 2 = 0 THEN 'C' || l_partkey ELSE '' END AS cui FROM lineitem),
    full_docs AS (SELECT * FROM docs WHERE doc_id IN (SELECT doc_id FROM secs)), known AS (SELECT * FROM ment WHERE entity_hash <> '')"""


@query(
    "note_layer",
    f"""WITH {LAYER} SELECT 'note' AS kind, concat_ws('|', doc_id, sample_name, description, doctype_cui) AS line FROM full_docs
    UNION ALL SELECT 'section', concat_ws('|', chunk_id, m.d, m.s, m.t) FROM (SELECT chunk_id, max({{'p': section_pos, 'd': doc_id, 's': section_type, 't': text}}) AS m FROM secs GROUP BY chunk_id)
    UNION ALL SELECT 'entity', concat_ws('|', entity_hash, m.e, m.t) FROM (SELECT entity_hash, max({{'p': pos, 'e': expanded_text, 't': type}}) AS m FROM known GROUP BY entity_hash)
    UNION ALL SELECT DISTINCT 'in_specialty', concat_ws('|', doc_id, specialty_cui) FROM full_docs WHERE specialty_cui <> ''
    UNION ALL SELECT DISTINCT 'in_alt_specialty', concat_ws('|', doc_id, alt) FROM full_docs
    UNION ALL SELECT DISTINCT 'has_section', concat_ws('|', doc_id, chunk_id) FROM secs
    UNION ALL SELECT DISTINCT 'of_type', concat_ws('|', chunk_id, section_cui) FROM secs WHERE section_cui <> ''
    UNION ALL SELECT DISTINCT 'has_mention', concat_ws('|', chunk_id, entity_hash, a, b) FROM known
    UNION ALL SELECT DISTINCT 'refers_to', concat_ws('|', entity_hash, cui) FROM known WHERE cui <> ''""",
)
def note_layer(spark, sf_dir):
    orders, lines = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    alternates = _s("array(struct('a' AS specialty, concat('C', o_custkey % 7) AS specialty_cui, '' AS doctype_cui), struct('b' AS specialty, '' AS specialty_cui, '' AS doctype_cui))")
    docs = orders.select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderpriority").alias("sample_name"), F.col("o_orderstatus").alias("description"), F.lit("").alias("doctype_cui"), _s("if(o_custkey % 3 = 0, '', concat('C', o_custkey % 50))").alias("specialty_cui"), alternates.alias("alt_specialties"))
    chunk = _s("concat(l_orderkey, ':', l_linenumber % 2)").alias("chunk_id")
    sections = lines.filter("l_linenumber <= 3").select(chunk, F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("section_pos"), F.col("l_returnflag").alias("section_type"), _s("concat('x', l_suppkey)").alias("text"), _s("if(l_linestatus = 'O', 'C1', '')").alias("section_cui"))
    mentions = lines.select(chunk, _s("if(l_partkey % 11 = 0, '', concat('e', l_partkey))").alias("entity_hash"), F.col("l_linenumber").alias("start_char"), (F.col("l_linenumber") + 3).alias("end_char"), _s("l_orderkey * 10 + l_linenumber").alias("pos"), _s("concat('x', l_suppkey)").alias("expanded_text"), F.col("l_returnflag").alias("type"), _s("if(l_partkey % 2 = 0, concat('C', l_partkey), '')").alias("cui"))
    out = None
    for kind, table in graph.note_layer(docs, sections, mentions).items():
        lines = table.select(F.lit(kind).alias("kind"), F.concat_ws("|", *[F.col(c).cast("string") for c in table.columns]).alias("line"))
        out = lines if out is None else out.unionByName(lines)
    return out


def _folder(spark, name: str) -> str:
    return f"{shared_root(spark)}/textloom/{name}-{uuid.uuid4().hex}"


@query(
    "graph_csv_round_trip",
    "SELECT p_partkey::VARCHAR AS cui, p_name || ', \"' || p_brand || '\"' AS name FROM part UNION ALL SELECT 'cui:ID(Concept)', 'name'",
)
def graph_csv_round_trip(spark, sf_dir):
    """The written rows and the header, each once."""
    path = _folder(spark, "csv")
    sinks.graph_csv(read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("cui"), _s("""concat(p_name, ', "', p_brand, '"')""").alias("name")), path, "concepts")
    return spark.read.schema("cui string, name string").options(escape='"').csv([f"{path}/rows", f"{path}/header"])


@query("snapshot_round_trip", "SELECT p_name AS text, min(p_partkey) AS cui FROM part GROUP BY 1")
def snapshot_round_trip(spark, sf_dir):
    path = _folder(spark, "snapshot")
    sinks.snapshot(read(spark, sf_dir, "part").groupBy(F.col("p_name").alias("text")).agg(F.min("p_partkey").alias("cui")), path)
    return spark.read.schema("text string, cui long").json(path)


@query(
    "upsert_points",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN -1.0 ELSE o_totalprice END AS o_totalprice FROM orders UNION ALL SELECT -o_orderkey, -1.0 FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey <> 0",
)
def upsert_points(spark, sf_dir):
    path, orders = _folder(spark, "upsert"), read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    new = orders.filter("o_orderkey % 3 = 0").select(F.explode(F.array("o_orderkey", -F.col("o_orderkey"))).alias("o_orderkey"), F.lit(-1.0).alias("o_totalprice"))
    sinks.upsert(orders, new, ["o_orderkey"], path)
    return spark.read.schema("o_orderkey long, o_totalprice double").parquet(path)


@query(
    "release_file_round_trip",
    "SELECT 'C' || l_partkey AS CUI, 'T' || l_linenumber AS TUI, 'un\"even ' || l_suppkey AS STY FROM lineitem",
)
def release_file_round_trip(spark, sf_dir):
    """Lines with an unbalanced quote and a trailing bar, read as a release's table."""
    path = _folder(spark, "release")
    read(spark, sf_dir, "lineitem").select(_s("""concat('C', l_partkey, '|T', l_linenumber, '|A1|un"even ', l_suppkey, '|AT|256|')""")).write.text(path)
    return readers.rrf(spark, path, "MRSTY").select("CUI", "TUI", "STY")


@query(
    "rows_changed",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 5 = 0",
)
def rows_changed(spark, sf_dir):
    after = read(spark, sf_dir, "orders").select("o_orderkey", _s("if(o_orderkey % 7 = 0, o_totalprice + 1, o_totalprice)").alias("o_totalprice"))
    before = read(spark, sf_dir, "orders").filter("o_orderkey % 5 != 0").select("o_orderkey", "o_totalprice")
    return clean.changed(before, after, "o_orderkey", "o_totalprice")


@query("found_ids", "SELECT count(DISTINCT l_partkey) AS n FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 25)")
def found_ids(spark, sf_dir):
    n = shards.found_ids(read(spark, sf_dir, "part").filter("p_size < 25"), read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey")), "p_partkey")
    return spark.createDataFrame([(n,)], "n long")
