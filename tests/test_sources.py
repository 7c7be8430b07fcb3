"""Readers and writers on small files with the odd cases of real ones."""

import json

import pytest
from pyspark.sql import functions as F

from textloom.operators import clean
from textloom.sources import readers, sinks


def test_rrf_quotes_and_trailing_bar(spark, tmp_path):
    (tmp_path / "MRSTY.RRF").write_text('C1|T1|A1|Say "half|AT1||\nC2|T2|A2|Two|AT2|x|\n', encoding="utf-8")
    rows = readers.rrf(spark, str(tmp_path / "MRSTY.RRF"), "MRSTY").orderBy("pos").collect()
    assert [(r.CUI, r.STY, r.CVF) for r in rows] == [("C1", 'Say "half', ""), ("C2", "Two", "x")]


def test_notes_csv(spark, tmp_path):
    (tmp_path / "n.csv").write_text('description,medical_specialty,sample_name,transcription,keywords\nd,Surgery,s,"line one\nline ""two""",k\nd,Urology,s,,k\n,Letters,,text,\n', encoding="utf-8")
    rows = readers.notes_csv(spark, str(tmp_path / "n.csv")).orderBy("pos").collect()
    assert [(r.medical_specialty, r.transcription, r.keywords) for r in rows] == [("Surgery", 'line one\nline "two"', "k"), ("Letters", "text", "")]
    assert readers.notes_csv(spark, str(tmp_path / "n.csv"), fill=False).filter("keywords IS NULL").count() == 1


def test_configuration_files(spark, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"_note": {"x": "y"}, "g": {"bp": "blood pressure"}, "h": "text"}))
    assert [tuple(r) for r in readers.overrides(spark, str(tmp_path / "o.json")).collect()] == [("BP", "blood pressure")]
    (tmp_path / "a.json").write_text(json.dumps({"_c": ["x"], "ed": ["one", " ", 3], "f": "no"}))
    assert [tuple(r) for r in readers.extra_senses(spark, str(tmp_path / "a.json")).collect()] == [("ED", "one")]
    assert readers.extra_senses(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "l").write_text("E1|ct|a|E2|computed tomography|\nE1|CT|a|E2|cerebral thrombosis|\nshort|x\nE|| |E|y|\n")
    pairs = readers.lexicon(spark, str(tmp_path / "l"))
    assert {tuple(r) for r in pairs.collect()} == {("CT", "computed tomography"), ("CT", "cerebral thrombosis")}
    multimap = clean.multimap(pairs, F.col("upper"), "expansion", readers.extra_senses(spark, str(tmp_path / "a.json")))
    assert {r["key"]: (r["values"], r.ambiguous) for r in multimap.collect()} == {"CT": (["cerebral thrombosis", "computed tomography"], True), "ED": (["one"], False)}
    (tmp_path / "h.tsv").write_text("# comment\n\n12\tHPI\n3\tPLAN \n")
    assert {r.heading for r in readers.heading_list(spark, str(tmp_path / "h.tsv")).collect()} == {"HPI", "PLAN"}
    (tmp_path / "d.json").write_text(json.dumps({"explicit_by_specialty": {"Letters": "D9"}, "rules": [{"cui": "D1", "any_of": ["A"]}]}))
    assert readers.type_rules(spark, str(tmp_path / "d.json")) == ({"Letters": "D9"}, [{"cui": "D1", "any_of": {"A"}, "min_hits": 1}])


def test_json_modes(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": "1"}\n\n{"a": "é"}\nbroken\n', encoding="utf-8")
    assert [r.a for r in readers.json_lines(spark, str(tmp_path / "x.jsonl"), "a string", tolerant=True).collect()] == ["1", "é"]
    with pytest.raises(Exception, match="(?i)malformed|failed"):
        readers.json_lines(spark, str(tmp_path / "x.jsonl"), "a string").collect()


def test_documents_round_trip(spark, tmp_path):
    doc = {"doc_id": 1, "description": "d", "specialty": "S", "sections": [{"chunk_id": "1:a", "section_type": "A", "text": "t", "sentences": [{"chunk_id": "1:a:s0", "text": "t", "cuis": ["C1"]}, {"chunk_id": "", "text": "x"}, {"chunk_id": "1:a:s2", "text": " "}]}]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(json.dumps(doc, indent=1))
    docs = readers.documents_json(spark, str(tmp_path / "in"))
    assert [(r.chunk_id, r.section_chunk_id, r.specialty, r.cuis) for r in readers.document_sentences(docs).collect()] == [("1:a:s0", "1:a", "S", ["C1"])]
    sinks.documents(docs, str(tmp_path / "out"))
    sinks.documents(docs, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_upsert_layers_and_positions(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "id long, v string")
    sinks.upsert(old, new, ["id"], str(tmp_path / "p"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "p")).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    sinks.require(spark, [str(tmp_path / "p")])
    with pytest.raises(FileNotFoundError, match="nowhere"):
        sinks.require(spark, [str(tmp_path / "nowhere")])
    sinks.drop_layer(spark, str(tmp_path), ["p"])
    assert not (tmp_path / "p").exists()
    assert sinks.load_position(spark, str(tmp_path / "pos")) is None
    sinks.save_position(spark, str(tmp_path / "pos"), "C0042")
    assert sinks.load_position(spark, str(tmp_path / "pos")) == "C0042"
    assert {r.id for r in clean.changed(old, new, "id", "v").collect()} == {2, 3}


def test_graph_csv_and_reports(spark, tmp_path):
    sinks.graph_csv(spark.createDataFrame([("C1", 'a "b", c')], "cui string, name string"), str(tmp_path / "g"), "concepts")
    lines = {x for part in (tmp_path / "g" / "rows").glob("part-*.csv") for x in part.read_text().splitlines()}
    assert lines == {'C1,"a ""b"", c"'} and next((tmp_path / "g" / "header").glob("part-*.txt")).read_text() == "cui:ID(Concept),name\n"
    sinks.heading_report(spark.createDataFrame([("PLAN", 2), ("HPI", 5)], "term string, n_docs long"), str(tmp_path / "r"))
    assert next((tmp_path / "r").glob("part-*.txt")).read_text().splitlines() == ["5\tHPI", "2\tPLAN"]
    rows, seen = sinks.observed(spark.range(7), n=F.count(F.lit(1)))
    rows.count()
    assert seen.get["n"] == 7


def test_stream_counts(spark, tmp_path):
    from textloom.streaming import events

    rows = spark.range(20).select(F.timestamp_seconds(F.col("id") * 600).alias("ts"), F.lit("a").alias("event_type"), F.col("id").cast("double").alias("value"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = events.counts_by_window(events.read_events(spark, str(tmp_path / "in"), rows.schema))
    query = stream.writeStream.outputMode("complete").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.n for r in spark.table("windows").collect()) == [2, 6, 6, 6]
