"""Property graphs as tables: nodes by label, edges by type (bags: nothing is made distinct), and patterns over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import unescape_html
from textloom.operators.clean import first_wins
from textloom.runtime import materialize, pieces

HOT_SHARES = 16
SUPPRESSED = ("O", "E", "Y")


def kept_rows(df: DataFrame, language: str | None = "ENG", drop_suppressed: bool = True) -> DataFrame:
    """Terminology rows of one language that are not suppressed; columns LAT and SUPPRESS are used where present."""
    if language and "LAT" in df.columns:
        df = df.filter(F.col("LAT") == language)
    if drop_suppressed and "SUPPRESS" in df.columns:
        df = df.filter(~F.col("SUPPRESS").isin(*SUPPRESSED))
    return df


def within(edges: DataFrame, ends: dict[str, tuple[DataFrame, str]], parts: int | None = None) -> DataFrame:
    """Edges whose named columns all occur in their tables: {column: (table, key)}. One semi-join each.

    With ``parts`` both sides are dealt in so many pieces: for columns without hot values, which adaptive joins must split.
    """
    for column, (table, key) in ends.items():
        known = table.select(F.col(key).alias(column))
        if parts:
            edges, known = edges.repartition(parts, column), known.repartition(parts, column)
        edges = edges.join(known.distinct(), column, "left_semi")
    return edges


def no_loops(edges: DataFrame, src: str, dst: str) -> DataFrame:
    for end in (src, dst):
        edges = edges.filter(F.col(end).isNotNull() & (F.col(end).cast("string") != ""))
    return edges.filter(F.col(src) != F.col(dst))


def concepts(mrconso: DataFrame, order: str = "pos", **keep) -> DataFrame:
    """cui, name: the text of a concept's first kept row. keep: as ``kept_rows`` takes it."""
    rows = first_wins(kept_rows(mrconso, **keep), ["CUI"], order, ["STR"])
    return rows.select(F.col("CUI").alias("cui"), unescape_html("STR").alias("name"))


def atoms(mrconso: DataFrame, kept: DataFrame, **keep) -> DataFrame:
    rows = within(kept_rows(mrconso, **keep), {"CUI": (kept, "cui")}, pieces(mrconso))
    text = unescape_html("STR")
    return rows.select(F.col("CUI").alias("cui"), F.col("AUI").alias("aui"), F.col("SAB").alias("sab"), F.col("CODE").alias("code"), F.col("TTY").alias("tty"), text.alias("str"), F.lower(text).alias("str_norm"))


def semantic_types(mrsty: DataFrame, kept: DataFrame, order: str = "pos") -> tuple[DataFrame, DataFrame]:
    """(nodes: tui, name, tree_number; edges: src, dst)."""
    rows = within(mrsty, {"CUI": (kept, "cui")})
    nodes = first_wins(rows, ["TUI"], order, ["STY", "STN"]).select(F.col("TUI").alias("tui"), unescape_html("STY").alias("name"), F.col("STN").alias("tree_number"))
    return nodes, rows.select(F.col("CUI").alias("src"), F.col("TUI").alias("dst"))


def relations(mrrel: DataFrame, kept: DataFrame, drop_suppressed: bool = True) -> DataFrame:
    rows = within(no_loops(kept_rows(mrrel, None, drop_suppressed), "CUI1", "CUI2"), {"CUI1": (kept, "cui"), "CUI2": (kept, "cui")})
    return rows.select(F.col("CUI1").alias("src"), F.col("CUI2").alias("dst"), F.col("REL").alias("rel"), F.col("RELA").alias("rela"), F.col("SAB").alias("sab"))


def hierarchy(mrhier: DataFrame, mrconso: DataFrame, kept: DataFrame) -> DataFrame:
    """src IS_A dst: child and parent atoms resolved to concepts, through every atom of a kept concept.

    Dealt by atom before rows are made distinct, in pieces of a bounded number of rows: nearly all atoms differ.
    """
    parts = pieces(mrconso, mrhier)
    owner = within(mrconso.select("AUI", "CUI"), {"CUI": (kept, "cui")}, parts).repartition(parts, "AUI").distinct()
    rows = mrhier.filter("PAUI != ''").select("AUI", "PAUI", F.col("SAB").alias("sab"), F.col("RELA").alias("rela"))
    return no_loops(resolve_ends(rows, owner, "AUI", "CUI", {"AUI": "src", "PAUI": "dst"}, parts), "src", "dst").select("src", "dst", "sab", "rela")


def resolve_ends(rows: DataFrame, owner: DataFrame, key: str, value: str, ends: dict[str, str], parts: int | None = None) -> DataFrame:
    """Adds for each {column: new name} the owner's value; rows without one go. parts: pieces in which the owner is dealt by its key."""
    for column, name in ends.items():
        rows = (rows.repartition(parts, column) if parts else rows).join(owner.select(F.col(key).alias(column), F.col(value).alias(name)), column)
    return rows


def definitions(mrdef: DataFrame, kept: DataFrame, sources: DataFrame, drop_suppressed: bool = True) -> DataFrame:
    rows = within(kept_rows(mrdef, None, drop_suppressed), {"CUI": (kept, "cui"), "SAB": (sources, "sab")})
    return rows.select(F.col("CUI").alias("src"), F.col("SAB").alias("dst"), unescape_html("DEF").alias("def"))


def sources(mrsab: DataFrame, order: str = "pos") -> DataFrame:
    rows = first_wins(mrsab.filter("RSAB != ''"), ["RSAB"], order, ["SON", "SVER"])
    return rows.select(F.col("RSAB").alias("sab"), unescape_html("SON").alias("name"), F.col("SVER").alias("version"))


def collected_types(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """src, tuis, names: each concept's distinct types, as pairs, so that both lists are in one order."""
    pairs = edges.join(nodes, edges["dst"] == nodes["tui"]).groupBy("src").agg(F.array_sort(F.collect_set(F.struct("tui", "name"))).alias("p"))
    return pairs.select("src", F.transform("p", lambda x: x["tui"]).alias("tuis"), F.transform("p", lambda x: x["name"]).alias("names"))


def tiers(members: DataFrame, key: str, kind: str, sets: dict[str, list[str]], rest: str) -> DataFrame:
    """key with a boolean for each named set of kinds, which may overlap, and ``rest`` where none holds."""
    out = members.groupBy(key).agg(*[F.coalesce(F.bool_or(F.col(kind).isin(*some)), F.lit(False)).alias(name) for name, some in sets.items()])
    none = ~F.lit(False)
    for name in sets:
        none = none & ~F.col(name)
    return out.withColumn(rest, none)


def neighbours(nodes: DataFrame, edges: DataFrame, anchor: Column, where: Column, key: str = "id") -> DataFrame:
    """anchor, neighbour: nodes one edge away, in either direction, from nodes that meet ``anchor``."""
    start = nodes.filter(anchor).select(F.col(key).alias("anchor"))
    chosen = edges.filter(where)
    both = chosen.select(F.col("src").alias("anchor"), F.col("dst").alias("neighbour")).unionByName(chosen.select(F.col("dst").alias("anchor"), F.col("src").alias("neighbour")))
    return both.join(start, "anchor", "left_semi").join(nodes.select(F.col(key).alias("neighbour")), "neighbour", "left_semi").select("anchor", "neighbour")


def merged_nodes(rows: DataFrame, keys: list[str], order: str, values: list[str], parts: int | None = None, shares: int = 1) -> DataFrame:
    """One node a key with the values of its last row by ``order``.

    With ``parts`` rows are dealt by key in so many pieces first, so that no task sorts more than its piece; a hot
    key's rows by ``shares``, of which the last ones meet.
    """
    if parts and shares > 1:
        share = F.pmod(F.xxhash64(order, *values), F.lit(shares))
        last = F.max_by(F.struct(order, *values), F.struct(order, *values))
        some = rows.select(*dict.fromkeys([*keys, order, *values]), share.alias("_share")).repartition(parts, *keys, "_share").groupBy(*keys, "_share").agg(last.alias("_v"))
        rows = some.select(*keys, *[F.col("_v")[v].alias(v) for v in dict.fromkeys([order, *values]) if v not in keys])
    if parts:
        rows = rows.repartition(parts, *keys)
    last = F.max_by(F.struct(*values), F.struct(order, *values))
    return rows.groupBy(*keys).agg(last.alias("_v")).select(*keys, *[F.col("_v")[v].alias(v) for v in values])


def merged_edges(rows: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """Edges as a set of keys, without those that lack one. parts: pieces in which they are dealt before they meet, where nearly all differ."""
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    rows = rows.select(*keys)
    return (rows.repartition(parts, *keys) if parts else rows).distinct()


def universe(nodes: DataFrame, key: str, *references: DataFrame) -> DataFrame:
    """Known ids and those that edges refer to: a reference makes a bare node. Each reference has one column."""
    out = nodes.select(key)
    for r in references:
        out = out.union(r.select(F.col(r.columns[0]).alias(key)).filter(F.col(key).isNotNull() & (F.col(key).cast("string") != "")))
    return out.distinct()


def note_layer(docs: DataFrame, sections: DataFrame, mentions: DataFrame) -> dict[str, DataFrame]:
    """The note layer by table name. Documents without sections and mentions without a hash are left out.

    Tables are dealt by their keys in pieces of a bounded number of rows. A mention's entity may be hot: its rows are
    shared out, and its edges to concepts, of which many are equal, are merged in each task before they are dealt.
    """
    of_docs, of_sections, of_mentions = pieces(docs), pieces(sections), pieces(mentions)
    full = within(docs, {"doc_id": (sections, "doc_id")}, max(of_docs, of_sections))
    known = mentions.filter("entity_hash IS NOT NULL AND entity_hash != ''")
    alternates = full.select("doc_id", F.explode("alt_specialties").alias("a")).select("doc_id", F.col("a.specialty_cui").alias("cui"))
    return {
        "note": merged_nodes(full, ["doc_id"], "doc_id", ["sample_name", "description", "doctype_cui"], of_docs),
        "section": merged_nodes(sections, ["chunk_id"], "section_pos", ["doc_id", "section_type", "text"], of_sections),
        "entity": merged_nodes(known, ["entity_hash"], "pos", ["expanded_text", "type"], of_mentions, HOT_SHARES),
        "in_specialty": merged_edges(full.select("doc_id", F.col("specialty_cui").alias("cui")), ["doc_id", "cui"], of_docs),
        "in_alt_specialty": merged_edges(alternates, ["doc_id", "cui"], of_docs),
        "has_section": merged_edges(sections, ["doc_id", "chunk_id"], of_sections),
        "of_type": merged_edges(sections.select("chunk_id", F.col("section_cui").alias("cui")), ["chunk_id", "cui"], of_sections),
        "has_mention": merged_edges(known, ["chunk_id", "entity_hash", "start_char", "end_char"], of_mentions),
        "refers_to": merged_edges(known, ["entity_hash", "cui"]),
    }


def reachable(edges: DataFrame, start: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """id, depth: nodes that a walk from ``start`` (id) reaches. Stops when a step adds none; an extension."""
    found = front = materialize(start.select("id").distinct().withColumn("depth", F.lit(0)), "front")
    depth = 0
    while not front.isEmpty():
        depth += 1
        step = front.join(edges, front["id"] == edges[src]).select(F.col(dst).alias("id")).distinct()
        front = materialize(step.join(found, "id", "left_anti").withColumn("depth", F.lit(depth)), "front")
        found = found.unionByName(front)
        if depth % 16 == 0:
            found = materialize(found, "found")  # so that the plan stays short, however deep
    return found


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keyed upsert: of all versions of a key the last by ``order``."""
    return merged_nodes(rows, keys, order, [c for c in rows.columns if c not in keys]).select(*rows.columns)
