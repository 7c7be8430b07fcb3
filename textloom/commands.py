"""The steps of the engine as commands over a folder of Parquet tables: python -m textloom.commands STEP --work DIR ...

Each step reads the tables of earlier ones and writes new ones; none changes a table that it reads.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom import runtime
from textloom.functions.text import sentences, token_expansions, uuid5
from textloom.operators import abbrev, chunks, clean, graph, link, models, sections, shards
from textloom.sources import readers, sinks

# Namespaces of the ids of points, one a collection.
NAMESPACES = {
    "sentences": "f2b3e841-3c5e-4e1f-a5c3-5a9a2b0e7f9d",
    "windows": "6f3c0c2a-6c2c-4c9a-b9ea-0ea0d3f8f5a1",
    "concepts": "b1010d55-2023-4e1f-9c3b-9a5b7e1f2a44",
}


#: What a link must reach unless --min-score says otherwise: a full-text score, or a cosine.
LEAST_SCORE = {"lexical": 5.0, "vector": 0.7, "hybrid": 0.7}


class Workspace:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def get(self, table: str) -> DataFrame:
        sinks.require(self.spark, [f"{self.path}/{table}"])
        return self.spark.read.parquet(f"{self.path}/{table}")

    def put(self, table: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{table}")

    def replace(self, table: str, df: DataFrame) -> None:
        """As put, for a table that the plan itself reads: written beside it first."""
        self.put(table, runtime.materialize(df, table))

    def has(self, table: str) -> bool:
        return sinks.exists(self.spark, f"{self.path}/{table}")


def clean_step(w: Workspace, a) -> None:
    w.put("notes", clean.clean_notes(readers.notes_csv(w.spark, a.src)))


def headings_step(w: Workspace, a) -> None:
    """Counts over the raw notes, copies included."""
    raw = readers.notes_csv(w.spark, a.src)
    found = clean.document_frequency(raw, "pos", F.filter(sections.headings("transcription"), lambda h: h != ""), a.min_docs, a.max_words)
    w.put("headings", found.withColumnRenamed("term", "heading"))
    sinks.heading_report(found, f"{w.path}/headings_report")


def parse_step(w: Workspace, a) -> None:
    notes, allowed = w.get("notes"), w.get("headings")
    codes = readers.named_values(w.spark, a.specialties) if a.specialties else {}
    explicit, rules = readers.type_rules(w.spark, a.doctypes) if a.doctypes else ({}, [])
    parts = sections.split_sections(notes, allowed, "doc_id", "transcription")
    named = notes.select("doc_id", "description", F.trim("medical_specialty").alias("specialty"), "sample_name", "keywords", "alt_specialties")
    types = parts.groupBy("doc_id").agg(F.collect_set("section_type").alias("types"))
    docs = link.with_default(named.join(types, "doc_id", "left").withColumn("types", F.coalesce("types", F.array().cast("array<string>"))), "specialty", codes, "specialty_cui")
    docs = docs.withColumn("doctype_cui", sections.document_type("specialty", "types", explicit, rules))
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]) if codes else None
    code = lambda s: F.coalesce(F.element_at(table, s), F.lit("")) if table is not None else F.lit("")
    alternates = F.transform("alt_specialties", lambda s: F.struct(s.alias("specialty"), code(s).alias("specialty_cui"), sections.document_type_of(s, F.col("types"), explicit, rules).alias("doctype_cui")))
    w.put("docs", docs.withColumn("alt_specialties", alternates).drop("types"))
    named = docs.select("doc_id", "specialty", "specialty_cui", "keywords")
    w.put("sections", parts.withColumn("section_cui", F.lit("")).join(named, "doc_id"))


def abbreviations_step(w: Workspace, a) -> None:
    none = w.spark.createDataFrame([], "upper string, expansion string")
    override = readers.overrides(w.spark, a.override) if a.override else none
    gazetteer = readers.lexicon(w.spark, a.lexicon) if a.lexicon else none
    if a.augment:
        gazetteer = gazetteer.unionByName(readers.extra_senses(w.spark, a.augment).select(F.col("key").alias("upper"), F.col("value").alias("expansion"))).distinct()
    w.put("section_abbrevs", abbrev.resolve(w.get("sections"), override, gazetteer, models.encoded, least=a.min_score))


def recognise_step(w: Workspace, a) -> None:
    kinds = readers.named_values(w.spark, a.dictionary)
    w.put("mentions_raw", models.recognised(w.get("sections"), "chunk_id", "text", lambda: models.DictionaryRecognizer(kinds)))


def normalise_step(w: Workspace, a) -> None:
    known = w.get("section_abbrevs").select("chunk_id", F.upper("abbrev").alias("upper"), "expansion").groupBy("chunk_id", "upper").agg(F.min("expansion").alias("expansion"))
    w.put("mentions", chunks.normalise_mentions(w.get("mentions_raw"), known))


def _names(w: Workspace) -> DataFrame:
    return w.get("atoms").join(w.get("concepts"), "cui").select("str_norm", "cui", "name")


def _alternates_linked(docs: DataFrame, found: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with the codes of alternate specialties filled in; found: specialty, _cui."""
    one = docs.select("doc_id", F.posexplode("alt_specialties").alias("_at", "_alt")).join(found, F.col("_alt.specialty") == F.col("specialty"), "left")
    entry = F.struct("_at", F.col("_alt.specialty"), F.coalesce("_cui", F.col("_alt.specialty_cui")).alias("specialty_cui"), F.col("_alt.doctype_cui"))
    lists = one.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["specialty"].alias("specialty"), e["specialty_cui"].alias("specialty_cui"), e["doctype_cui"].alias("doctype_cui"))).alias("_alts"))
    return docs.join(lists, "doc_id", "left").withColumn("alt_specialties", F.coalesce("_alts", "alt_specialties")).select(*columns)


def link_specialties_step(w: Workspace, a) -> None:
    docs = w.get("docs")
    every = docs.select("specialty").union(docs.select(F.explode("alt_specialties.specialty").alias("specialty"))).distinct()
    w.put("specialty_links", link.strings(every, "specialty", _names(w), {}, a.min_score))
    found = w.get("specialty_links").filter("cui != ''").select("specialty", F.col("cui").alias("_cui"))
    code = lambda c: F.coalesce("_cui", c)
    w.replace("docs", _alternates_linked(docs.join(found, "specialty", "left").withColumn("specialty_cui", code("specialty_cui")).drop("_cui"), found, docs.columns))
    parts = w.get("sections")
    w.replace("sections", parts.join(found, "specialty", "left").withColumn("specialty_cui", code("specialty_cui")).select(*parts.columns))


def link_sections_step(w: Workspace, a) -> None:
    aliases = readers.named_values(w.spark, a.aliases) if a.aliases else {}
    parts = w.get("sections")
    w.put("section_links", link.strings(parts, "section_type", _names(w), aliases, a.min_score))
    found = w.get("section_links").select("section_type", F.col("cui").alias("_cui"))
    w.replace("sections", parts.join(found, "section_type", "left").withColumn("section_cui", F.coalesce("_cui", F.lit(""))).select(*parts.columns))


def link_entities_step(w: Workspace, a) -> None:
    texts, least = link.distinct_texts(w.get("mentions")), float(a.min_score) if a.min_score else LEAST_SCORE[a.mode]
    if a.mode == "lexical":
        linked = link.lexical(texts, _names(w), least, fulltext=not a.no_fulltext)
    else:
        index = w.get("concept_index").select("cui", "vector")
        pointed = models.encoded(texts, "text")
        linked = link.semantic(pointed, index, least) if a.mode == "vector" else link.hybrid(pointed, _names(w), index, least)
    none = w.spark.createDataFrame([], "src string, tuis array<string>, names array<string>")
    types = none if a.no_tuis else graph.collected_types(w.get("has_semtype"), w.get("semantic_types"))
    linked = link.with_types(linked, types).withColumnRenamed("names", "tui_names")
    linked = linked.join(w.get("concepts").select("cui", F.col("name").alias("cui_name")), "cui", "left").withColumn("cui_name", F.coalesce("cui_name", F.lit("")))
    if "match" not in linked.columns:
        linked = linked.withColumn("match", F.when(F.col("cui") != "", link.match_label("vector", "score")).otherwise(""))
    w.put(f"entity_links_{a.mode}", linked)
    sinks.snapshot(linked.filter("cui != ''").select("text", "cui"), f"{w.path}/snapshot_{a.mode}")
    w.put("mentions_linked", w.get("mentions").join(linked.select("entity_hash", "cui", "cui_name", F.col("match").alias("cui_match"), "tuis", "tui_names"), "entity_hash", "left").withColumn("cui", F.coalesce("cui", F.lit(""))))


def sentences_step(w: Workspace, a) -> None:
    """Sections are told apart by document and place: two of one document may share an id."""
    section = ["doc_id", "section_pos"]
    parts = w.get("sections").withColumn("_section", F.struct(*section)).withColumnRenamed("chunk_id", "section_chunk_id")
    linked = w.get("mentions_linked").withColumnRenamed("chunk_id", "section_chunk_id")
    index = chunks.surface_index(linked.join(parts.select("section_chunk_id", "doc_id").distinct(), "section_chunk_id"))
    split = chunks.sentence_rows(parts, "_section", "text").select("_section", "idx", "text")
    rows = split.join(parts.drop("text"), "_section").withColumn("chunk_id", F.concat("section_chunk_id", F.lit(":s"), F.col("idx").cast("string")))
    rows = runtime.materialize(rows.withColumn("_key", F.concat_ws(":", "doc_id", "section_pos", "idx")), "sentences")
    tagged = chunks.tag(rows, index, key="_key").drop("text")
    payload = ["doc_id", "section_pos", "section_chunk_id", "idx", "section_type", "section_cui", "specialty", "specialty_cui", "keywords", "text"]
    w.put("sentences", rows.select("_key", "chunk_id", *payload).join(tagged, "_key").drop("_key"))


def _upsert_points(w: Workspace, table: str, points: DataFrame, recreate: bool) -> None:
    """New points in place of old ones with their ids; the others stay, unless the table is made anew."""
    rows = points.withColumn("_version", F.lit(1))
    if w.has(table) and not recreate:
        rows = rows.unionByName(w.get(table).withColumn("_version", F.lit(0)), allowMissingColumns=True)
    w.replace(table, graph.latest(rows, ["id"], "_version").drop("_version"))


def embed_step(w: Workspace, a) -> None:
    """Sentence points: id, vector, and the sentence's section, document, specialty, codes and types to filter by."""
    docs = w.get("docs").select("doc_id", "doctype_cui", "sample_name", F.col("description").alias("doc_description"))
    rows = w.get("sentences").join(docs, "doc_id")
    name = F.concat_ws(":", "section_chunk_id", F.col("section_pos").cast("string"), F.concat(F.lit("s"), "idx"))
    _upsert_points(w, "sentence_points", models.encoded(rows, "text").withColumn("id", uuid5(NAMESPACES["sentences"], name)), a.recreate)


def embed_windows_step(w: Workspace, a) -> None:
    _upsert_points(w, "window_points", models.encoded(w.get("windows"), "text"), a.recreate)


def chunk_entities_step(w: Workspace, a) -> None:
    """Recognises each section once and deals its spans out to the section's windows, with the expansions of their tokens."""
    kinds = readers.named_values(w.spark, a.dictionary)
    parts = w.get("sections").withColumn("_section", F.concat_ws(":", "doc_id", "section_pos"))
    spans = models.recognised(parts.withColumn("flat", F.array_join(sentences("text"), " ")), "_section", "flat", lambda: models.DictionaryRecognizer(kinds))
    offsets = chunks.with_offsets(chunks.sentence_rows(parts, "_section", "text"), "_section").groupBy("_section").agg(F.sort_array(F.collect_list(F.struct("idx", "start", "end"))).alias("places"))
    windows = chunks.pack_windows(parts, "_section", "text").join(offsets, "_section").select("_section", "window_index", F.col("places")[F.col("first")]["start"].alias("w_start"), F.col("places")[F.col("stop") - 1]["end"].alias("w_end"))
    inside = chunks.contained(spans.withColumnsRenamed({"start_char": "start", "end_char": "end"}), windows, "_section")
    known = w.get("section_abbrevs").groupBy("chunk_id").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct(F.upper("abbrev"), "expansion")))).alias("known"))
    named = inside.join(parts.select("_section", "chunk_id", "doc_id"), "_section").join(known, "chunk_id", "left")
    out = named.withColumn("expansions", F.when(F.col("known").isNotNull(), token_expansions("surface_text", "known")))
    entity = F.struct(F.col("surface_text").alias("text"), "type", F.col("start").alias("start_char"), F.col("end").alias("end_char"), "expansions")
    w.put("chunk_entities", out.groupBy("doc_id", F.col("chunk_id").alias("parent_chunk_id"), "_section", "window_index").agg(F.collect_list(entity).alias("entities")).drop("_section"))


def windows_step(w: Workspace, a) -> None:
    parts = w.get("sections").withColumnRenamed("chunk_id", "parent_chunk_id")
    rows = chunks.pack_windows(parts, "parent_chunk_id", "text", a.budget, a.overlap)
    w.put("windows", rows.withColumn("id", uuid5(NAMESPACES["windows"], "chunk_id")))


def terminology_step(w: Workspace, a) -> None:
    rrf = lambda t: readers.rrf(w.spark, f"{a.meta}/{t}.RRF", t)
    keep = {"language": None if a.all_languages else "ENG", "drop_suppressed": not a.keep_suppressed}
    conso = rrf("MRCONSO")
    kept = graph.concepts(conso, **keep)
    w.put("concepts", kept)
    kept = w.get("concepts")
    w.put("sources", graph.sources(rrf("MRSAB")))
    made = graph.atoms(conso, kept, **keep)
    w.put("atoms", made)
    nodes, edges = graph.semantic_types(rrf("MRSTY"), kept)
    tables = {"semantic_types": nodes, "has_semtype": edges, "relates": graph.relations(rrf("MRREL"), kept, not a.keep_suppressed), "is_a": graph.hierarchy(rrf("MRHIER"), conso, kept), "defined_by": graph.definitions(rrf("MRDEF"), kept, w.get("sources"), not a.keep_suppressed), "has_atom": w.get("atoms").select(F.col("cui").alias("src"), F.col("aui").alias("dst"))}
    for name, df in tables.items():
        w.put(name, df)
    if a.out:
        for name in ("concepts", "sources", "atoms", *tables):
            sinks.graph_csv(w.get(name), f"{a.out}/{name}", name)


def concept_index_step(w: Workspace, a) -> None:
    """All at once, or ``page`` concepts at a time by cui; --resume goes on after the last page that was written."""
    named = w.get("concepts").filter("coalesce(name, '') != ''").withColumn("id", uuid5(NAMESPACES["concepts"], "cui"))
    if not a.page:
        _upsert_points(w, "concept_index", models.encoded(named, "name"), not a.resume)
        return
    place = f"{w.path}/concept_index_position"
    last = sinks.load_position(w.spark, place) if a.resume else None
    recreate = last is None
    while not (rows := shards.page(named, "cui", last, a.page)).isEmpty():
        last = rows.agg(F.max("cui")).first()[0]
        _upsert_points(w, "concept_index", models.encoded(rows, "name"), recreate)
        sinks.save_position(w.spark, place, last)
        recreate = False


def load_notes_step(w: Workspace, a) -> None:
    if a.drop:
        sinks.drop_layer(w.spark, w.path, [f"graph_{t}" for t in ("note", "section", "entity", "in_specialty", "in_alt_specialty", "has_section", "of_type", "has_mention", "refers_to")])
    for name, df in graph.note_layer(w.get("docs"), w.get("sections"), w.get("mentions_linked")).items():
        w.put(f"graph_{name}", df)


STEPS = {
    "clean": (clean_step, {"src": None}),
    "headings": (headings_step, {"src": None, "min_docs": 2, "max_words": 8}),
    "parse": (parse_step, {"specialties": "", "doctypes": ""}),
    "abbreviations": (abbreviations_step, {"override": "", "lexicon": "", "augment": "", "min_score": 0.35}),
    "recognise": (recognise_step, {"dictionary": None}),
    "normalise": (normalise_step, {}),
    "terminology": (terminology_step, {"meta": None, "out": "", "all_languages": False, "keep_suppressed": False}),
    "concept-index": (concept_index_step, {"page": 0, "resume": False}),
    "link-specialties": (link_specialties_step, {"min_score": 5.0}),
    "link-sections": (link_sections_step, {"aliases": "", "min_score": 4.0}),
    "link-entities": (link_entities_step, {"mode": "lexical", "min_score": "", "no_fulltext": False, "no_tuis": False}),
    "sentences": (sentences_step, {}),
    "embed": (embed_step, {"recreate": False}),
    "embed-windows": (embed_windows_step, {"recreate": False}),
    "chunk-entities": (chunk_entities_step, {"dictionary": None}),
    "windows": (windows_step, {"budget": 200, "overlap": 20}),
    "load-notes": (load_notes_step, {"drop": False}),
}


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="step", required=True)
    for name, (_, options) in STEPS.items():
        sub = commands.add_parser(name)
        sub.add_argument("--work", required=True)
        for option, default in options.items():
            flag = f"--{option.replace('_', '-')}"
            if default is False:
                sub.add_argument(flag, action="store_true")
            else:
                sub.add_argument(flag, default=default, required=default is None, type=type(default) if default is not None else str)
    a = parser.parse_args(args)
    STEPS[a.step][0](Workspace(spark or runtime.session(), a.work), a)


if __name__ == "__main__":
    main()
