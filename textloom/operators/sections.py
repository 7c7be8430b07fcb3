"""Sections of documents by heading, document types by rules, and roll-ups to documents."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import HEADING, slug, strip

START, END = "\u0001", "\u0002"
MAX_WORDS = 8
PIECE_CHARS = 1 << 23


def headings(text: str) -> Column:
    """Array of a text's heading candidates, trimmed."""
    return F.transform(F.regexp_extract_all(F.col(text), F.lit(HEADING), F.lit(1)), lambda h: strip(F.regexp_replace(strip(h), ",+$", "")))


def _body(x: Column) -> Column:
    return strip(F.regexp_replace(strip(F.regexp_replace(x, r"^[ ,\t\n]+", "")), ",+$", ""))


def split_sections(docs: DataFrame, allowed: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, section_pos, chunk_id, section_type, text: bodies between accepted headings, repeats joined by newlines.

    allowed: heading. A heading that is not accepted stays in the body before it, as do texts between; what comes
    before the first accepted heading is dropped, and so are empty bodies. Sections keep the order of their first
    body. The two control characters used as marks are removed from the input.

    Accepted headings (78 characters each at most) are broadcast: a join by heading would bring all bodies of a common
    one to one task.
    Bodies are dealt once, by document, in pieces of about ``PIECE_CHARS`` of text.
    """
    parts = max(1, math.ceil((docs.agg(F.sum(F.length(text))).first()[0] or 0) / PIECE_CHARS))
    clean = F.translate(F.col(text), START + END, "")
    marked = F.split(F.regexp_replace(clean, HEADING, f"{START}$1{END}"), START)
    pieces = docs.select(doc, F.posexplode(marked).alias("pos", "piece")).filter("pos > 0")
    raw, body = F.split_part("piece", F.lit(END), F.lit(1)), F.split_part("piece", F.lit(END), F.lit(2))
    named = pieces.select(doc, "pos", raw.alias("raw"), body.alias("body")).withColumn("heading", strip(F.regexp_replace(strip("raw"), ",+$", "")))
    fits = F.size(F.split("heading", r"\s+")) <= MAX_WORDS
    known = allowed.select(F.col("heading"), F.lit(True).alias("ok")).distinct()
    named = named.join(F.broadcast(known), "heading", "left").withColumn("ok", F.coalesce("ok", F.lit(False)) & fits).repartition(parts, doc)
    order = Window.partitionBy(doc).orderBy("pos")
    grouped = named.withColumn("group", F.sum(F.col("ok").cast("int")).over(order)).filter(F.col("group") > 0)
    piece = F.when(F.col("ok"), F.col("body")).otherwise(F.concat("raw", F.lit(":"), "body"))
    runs = grouped.groupBy(doc, "group").agg(F.max(F.when(F.col("ok"), F.col("heading"))).alias("section_type"), F.sort_array(F.collect_list(F.struct("pos", piece.alias("piece")))).alias("pieces"))
    bodies = runs.select(doc, "group", "section_type", _body(F.array_join(F.transform("pieces", lambda p: p["piece"]), "")).alias("body")).filter("body != ''")
    joined = bodies.groupBy(doc, "section_type").agg(F.min("group").alias("at"), F.sort_array(F.collect_list(F.struct("group", "body"))).alias("bodies"))
    place = F.row_number().over(Window.partitionBy(doc).orderBy("at")) - 1
    return joined.select(doc, place.alias("section_pos"), F.concat_ws(":", F.col(doc).cast("string"), slug("section_type")).alias("chunk_id"), "section_type", F.array_join(F.transform("bodies", lambda b: b["body"]), "\n").alias("text"))


def split_paragraphs(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, section_pos, text: lines that are not blank, for texts without headings."""
    lines = docs.select(doc, F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line")).withColumn("line", F.trim("line")).filter("line != ''")
    return lines.select(doc, (F.row_number().over(Window.partitionBy(doc).orderBy("pos")) - 1).alias("section_pos"), F.col("line").alias("text"))


def document_type(kind: str, types: str, explicit: dict[str, str], rules: list[dict]) -> Column:
    """The first rule, in order, of whose ``any_of`` a document has ``min_hits`` types; before all rules the explicit map."""
    return document_type_of(F.col(kind), F.col(types), explicit, rules)


def document_type_of(kind: Column, types: Column, explicit: dict[str, str], rules: list[dict]) -> Column:
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        hits = F.size(F.array_intersect(types, F.array(*map(F.lit, sorted(rule["any_of"])))))
        out = F.when(hits >= rule.get("min_hits", 1), F.lit(rule["cui"])).otherwise(out)
    if explicit:
        named = F.create_map(*[F.lit(x) for kv in explicit.items() for x in kv])
        out = F.coalesce(F.nullif(F.element_at(named, kind), F.lit("")), out)
    return F.coalesce(out, F.lit(""))


def roll_up(hits: DataFrame, doc: str = "doc_id", score: str = "score", section: str = "section_type") -> DataFrame:
    """Sentence hits by document: how many, the best and mean score, and in how many kinds of section."""
    return hits.groupBy(doc).agg(F.count("*").alias("n_hits"), F.max(score).alias("best"), F.avg(score).alias("mean"), F.count_distinct(section).alias("n_sections"))
