import json

from textloom import commands

CSV = 'description,medical_specialty,sample_name,transcription,keywords\n' + "".join(f'd{i},{s},n{i},"{t}",k{i}\n' for i, (s, t) in enumerate([("Surgery", "HPI: The chest pain is mild. No fever today. PLAN: zorbin tablet for BP."), ("Letters", "HPI: The chest pain is mild. No fever today. PLAN: zorbin tablet for BP."), ("Urology", "HPI: fever and an ache. PLAN: rest.")]))
RRF = {
    "MRCONSO": ["C1|ENG|P|L|PF|S|Y|A1||||SRC|PT|1|Chest pain|0|N||", "C2|ENG|P|L|PF|S|Y|A2||||SRC|PT|2|Fever|0|N||", "C3|ENG|P|L|PF|S|Y|A3||||SRC|PT|3|Zorbin tablet|0|N||", "C9|SPA|P|L|PF|S|Y|A9||||SRC|PT|9|fiebre|0|N||", "C4|ENG|P|L|PF|S|Y|A4||||SRC|PT|4|Urology|0|N||", "C5|ENG|P|L|PF|S|Y|A5||||SRC|PT|5|HPI|0|N||", "C6|ENG|P|L|PF|S|Y|A6||||SRC|PT|6|Letters|0|N||"],
    "MRSTY": ["C1|T184|A1.2|Sign|AT||", "C2|T184|A1.2|Sign|AT||", "C3|T121|A1.4|Drug|AT||"],
    "MRREL": ["C1|A1|AUI|RO|C3|A3|AUI|may_be_treated_by|R||SRC||||N||"],
    "MRHIER": ["C1|A1|1|A2|SRC||x||||"],
    "MRDEF": ["C1|A1|AT||SRC|Pain in the chest|N||"],
    "MRSAB": ["||v|SRC|Source|SF|1|||||||||||||||||||"],
}


def test_all_steps(spark, tmp_path):
    work, meta = str(tmp_path / "w"), tmp_path / "meta"
    meta.mkdir()
    (tmp_path / "n.csv").write_text(CSV)
    for name, lines in RRF.items():
        (meta / f"{name}.RRF").write_text("\n".join(lines) + "\n")
    (tmp_path / "dict.json").write_text(json.dumps({"chest pain": "PROBLEM", "fever": "PROBLEM", "zorbin tablet": "TREATMENT"}))
    (tmp_path / "over.json").write_text(json.dumps({"g": {"BP": "blood pressure"}}))
    run = lambda step, *more: commands.main([step, "--work", work, *map(str, more)], spark)
    run("clean", "--src", tmp_path / "n.csv")
    run("headings", "--src", tmp_path / "n.csv")
    run("parse")
    run("abbreviations", "--override", tmp_path / "over.json")
    run("recognise", "--dictionary", tmp_path / "dict.json")
    run("normalise")
    run("terminology", "--meta", meta, "--out", tmp_path / "csv")
    run("concept-index", "--page", 2)
    run("concept-index", "--page", 2, "--resume")
    run("link-specialties")
    run("link-sections")
    run("link-entities", "--mode", "hybrid")
    run("sentences")
    run("embed")
    run("embed")
    run("chunk-entities", "--dictionary", tmp_path / "dict.json")
    run("windows")
    run("embed-windows")
    run("load-notes", "--drop")
    table = lambda t: spark.read.parquet(f"{work}/{t}")
    docs = {r.specialty: r for r in table("docs").collect()}
    assert set(docs) == {"Surgery", "Urology"} and [x.specialty for x in docs["Surgery"].alt_specialties] == ["Letters"]
    assert {r.section_type for r in table("sections").collect()} == {"HPI", "PLAN"}
    assert {(r.abbrev, r.source) for r in table("section_abbrevs").collect()} == {("BP", "override")}
    assert {r.text.lower(): r.cui for r in table("entity_links_hybrid").collect()} == {"chest pain": "C1", "fever": "C2", "zorbin tablet": "C3"}
    tagged = {r.text: (r.cuis, r.tuis) for r in table("sentences").collect()}
    assert tagged["The chest pain is mild."] == (["C1"], ["T184"]) and tagged["zorbin tablet for BP."] == (["C3"], ["T121"])
    assert {(r.src, r.dst) for r in table("is_a").collect()} == {("C1", "C2")} and table("relates").count() == 1 and table("defined_by").count() == 1
    assert {r.specialty: r.cui for r in table("specialty_links").collect()}["Urology"] == "C4"
    assert docs["Urology"].specialty_cui == "C4" and docs["Surgery"].alt_specialties[0].specialty_cui == "C6"
    assert {(r.section_type, r.section_cui) for r in table("sections").collect()} == {("HPI", "C5"), ("PLAN", "")}
    assert table("graph_of_type").count() == 2 and table("concept_index").count() == 6 and table("window_points").count() == table("windows").count()
    points = table("sentence_points")
    assert {"section_type", "section_cui", "specialty", "specialty_cui", "doc_id", "doctype_cui", "keywords", "cuis", "tuis", "surface_forms", "section_chunk_id"} <= set(points.columns)
    assert {r.text for r in points.filter("specialty_cui = 'C4' and section_cui = 'C5'").collect()} == {"fever and an ache."}
    assert {(e.text.lower(), e.start_char) for r in table("chunk_entities").collect() for e in r.entities} == {("chest pain", 4), ("fever", 27), ("fever", 0), ("zorbin tablet", 0)}
    assert {r.cui_name for r in table("mentions_linked").collect()} == {"Chest pain", "Fever", "Zorbin tablet"}
    assert table("graph_refers_to").count() == 3 and table("graph_in_alt_specialty").count() == 1 and table("graph_has_section").count() == 4
    assert table("sentence_points").select("id").distinct().count() == table("sentences").count()
    assert len(list((tmp_path / "csv").iterdir())) == 9
