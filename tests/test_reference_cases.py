"""Small cases with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.functions import vectors
from textloom.operators import abbrev, chunks, clean, graph, link, models, sections, shards


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression.alias("y")).first()["y"]


def test_dedup_and_keyword_union(spark):
    rows = [(0, "T1", "Surgery", "surgery, Knee, scope"), (1, "T2", "Urology", "x"), (2, "T1", "Orthopedic", "Orthopedic,knee, ,scope"), (3, None, "Letters", "z")]
    notes = spark.createDataFrame([(*r, "", "") for r in rows], "pos long, transcription string, medical_specialty string, keywords string, description string, sample_name string")
    got = {r.transcription: r for r in clean.clean_notes(notes).collect()}
    assert len(got) == 2
    assert got["T1"].alt_specialties == ["Orthopedic"] and got["T1"].keywords == "surgery, Knee, scope, Orthopedic" and got["T1"].doc_id == 0
    assert got["T2"].alt_specialties == [] and got["T2"].keywords == "x" and got["T2"].doc_id == 1


def test_sections(spark):
    texts = ["Intro text. HPI:, Cough for 3 days., MEDICATIONS: , Zorbin 5 mg,, PLAN:", "HPI: one NOTE: two PLAN: rest HPI: three", "FOO, PLAN: hidden", "CC: short HPI: ok", "X-RAY/CT: clear X-RAY CT: hazy", "no headings here", "LAB DATA, : WBC 9"]
    allowed = spark.createDataFrame([(h,) for h in ("HPI", "MEDICATIONS", "PLAN", "LAB DATA", "X-RAY/CT", "X-RAY CT")], "heading string")
    got = sections.split_sections(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), allowed)
    assert [(r.chunk_id, r.section_type, r.text) for r in got.orderBy("doc_id", "section_pos").collect()] == [
        ("0:hpi", "HPI", "Cough for 3 days."), ("0:medications", "MEDICATIONS", "Zorbin 5 mg"), ("1:hpi", "HPI", "one NOTE: two\nthree"), ("1:plan", "PLAN", "rest"),
        ("3:hpi", "HPI", "ok"), ("4:x_ray_ct", "X-RAY/CT", "clear"), ("4:x_ray_ct", "X-RAY CT", "hazy"), ("6:lab_data", "LAB DATA", "WBC 9"),
    ]


@pytest.mark.parametrize(
    ("raw", "resolved", "expanded"),
    [("the CT scan", "CT scan", "computed tomography scan"), ("CT-guided biopsy", "CT-guided biopsy", "CT-guided biopsy"), ("hepatitis A", "hepatitis", "hepatitis"), ("The", "The", "The"), ("an  or table", "or table", "operating room table"), ("ct of the chest", "ct of chest", "computed tomography of chest")],
)
def test_articles_and_expansion(spark, raw, resolved, expanded):
    known = F.create_map(F.lit("CT"), F.lit("computed tomography"), F.lit("OR"), F.lit("the operating room"))
    assert one(spark, raw, tx.without_articles("x")) == resolved
    assert one(spark, raw, tx.without_articles(tx.expand_tokens(tx.without_articles("x"), known))) == expanded


def test_text_expressions(spark):
    assert one(spark, "BP and CT2, T of AFib; MRI/CT, x-RAY Hb A1C", tx.acronyms("x")) == ["BP", "CT2", "MRI", "CT", "RAY", "A1C"]
    assert one(spark, "Alert. Oriented x3.\n Dose 2.5 mg.,Then left!  (Stable) ok", tx.sentences("x")) == ["Alert.", "Oriented x3.", "Dose 2.5 mg.,Then left!", "(Stable) ok"]
    assert one(spark, 'e.g. this splits. "Quoted" does not', tx.sentences("x")) == ["e.g.", 'this splits. "Quoted" does not']
    assert one(spark, " Zorbin Tablet ", tx.entity_hash("x")) == "331cec492cc06ae4"
    assert one(spark, "7:plan:s0", tx.uuid5("00000000-0000-0000-0000-000000000001", "x")) == "738d9b5e-9f0e-505a-86dd-366e20c64d02"
    assert [one(spark, v, tx.abbreviation_key("x")) for v in ("BP", " bp ", "BP.", "(BP)")] == ["BP"] * 4
    assert one(spark, "a+b (c)", tx.escape_query("x")) == r"a\+b \(c\)"
    assert one(spark, "A &amp;lt; B &quot;", tx.unescape_html("x")) == 'A &lt; B "'
    assert one(spark, 5.25, tx.match_label("fulltext", "x"), "double") == "fulltext/5.2" and one(spark, 0.7, tx.match_label("vector", "x"), "double") == "vector/0.700"
    lookup = F.create_map(F.lit("CHF"), F.lit("heart failure"), F.lit("MI"), F.lit("infarct"))
    assert one(spark, "post-MI CHF mi MI", tx.token_expansions("x", lookup)) == {"MI": "infarct", "CHF": "heart failure", "mi": "infarct"}
    assert one(spark, "-A/B c!", tx.slug("x")) == "a_b_c"


def test_vectors(spark):
    assert one(spark, [3.0, 4.0], vectors.normalised("x"), "array<float>") == [0.6, 0.8]
    assert one(spark, [0.0, 0.0], vectors.normalised("x"), "array<float>") == [0.0, 0.0]
    assert one(spark, [1.0, 2.0], vectors.cosine("x", "x"), "array<double>") == pytest.approx(1)


def test_surface_tagging(spark):
    index = spark.createDataFrame([(1, i, s, f"C{i}", [f"T{i}"]) for i, s in enumerate(["pain", "chest pain", "mi", "cold (acute)", "PAIN", "x"])], "doc_id long, pos int, surface_text string, cui string, tuis array<string>")
    index = chunks.surface_index(index)
    assert {(r.surface, r.cui, tuple(r.tuis)) for r in index.collect() if r.surface == "pain"} == {("pain", "C0", ("T0", "T4"))}
    texts = ["Chest pain and PAIN, no Mild MI.", "cold (acute) today", "cold (acute)x", "chest painful", None]
    rows = spark.createDataFrame([(1, f"s{i}", t) for i, t in enumerate(texts)] + [(2, "other", "pain")], "doc_id long, chunk_id string, text string")
    got = {r.chunk_id: r.surface_forms for r in chunks.tag(rows, index).collect()}
    assert got == {"s0": ["chest pain", "mi", "pain"], "s1": [], "s2": ["cold (acute)"], "s3": [], "s4": [], "other": []}


@pytest.mark.parametrize(
    ("counts", "want"),
    [([80] * 4, [(0, 2), (1, 3), (2, 4)]), ([150, 15, 10, 150], [(0, 3), (1, 4)]), ([250, 30, 30], [(0, 1), (1, 3)]), ([10] * 5, [(0, 5)]), ([100, 100, 5, 5, 190], [(0, 2), (1, 4), (2, 5)]), ([], [])],
)
def test_windows(counts, want):
    assert chunks.windows_of(counts) == want


def test_window_rows(spark):
    texts = spark.createDataFrame([("a", "One two. " * 150), ("b", "Short one."), ("c", None)], "k string, text string")
    got = chunks.pack_windows(texts, "k", "text").orderBy("k", "window_index").collect()
    assert [r.chunk_id for r in got if r.k == "b"] == ["b"] and got[0].chunk_id == "a#0" and got[0].window_count == sum(r.k == "a" for r in got)


def terminology(spark):
    rows = [("C1", "ENG", "O", "A0", "old"), ("C1", "ENG", "N", "A1", "A &amp; B"), ("C1", "SPA", "N", "A2", "uno"), ("C2", "ENG", "N", "A3", "Two"), ("C3", "SPA", "N", "A4", "tres")]
    return spark.createDataFrame([(i, *r, "S", "code", "PT") for i, r in enumerate(rows)], "pos long, CUI string, LAT string, SUPPRESS string, AUI string, STR string, SAB string, CODE string, TTY string")


def test_terminology_graph(spark):
    conso = terminology(spark)
    concepts = graph.concepts(conso)
    assert {(r.cui, r.name) for r in concepts.collect()} == {("C1", "A & B"), ("C2", "Two")}
    assert {(r.aui, r.str_norm) for r in graph.atoms(conso, concepts).collect()} == {("A1", "a & b"), ("A3", "two")}
    rel = spark.createDataFrame([("C1", "C2", "N"), ("C1", "C1", "N"), ("C1", "C3", "N"), ("C1", "C2", "N"), ("C1", "C2", "O")], "CUI1 string, CUI2 string, SUPPRESS string").withColumns({c: F.lit("") for c in ("REL", "RELA", "SAB")})
    assert [(r.src, r.dst) for r in graph.relations(rel, concepts).collect()] == [("C1", "C2")] * 2
    hier = spark.createDataFrame([("A3", "A2"), ("A0", "A1"), ("A3", ""), ("A4", "A1")], "AUI string, PAUI string").withColumns({c: F.lit("") for c in ("RELA", "SAB")})
    assert [(r.src, r.dst) for r in graph.hierarchy(hier, conso, concepts).collect()] == [("C2", "C1")]
    sty = spark.createDataFrame([(0, "C1", "T1", "1.1", "Type"), (1, "C1", "T1", "1.1", "Later"), (2, "C9", "T2", "2", "Gone")], "pos long, CUI string, TUI string, STN string, STY string")
    nodes, edges = graph.semantic_types(sty, concepts)
    assert [tuple(r) for r in nodes.collect()] == [("T1", "Type", "1.1")] and edges.count() == 2
    assert [(r.tuis, r.names) for r in graph.collected_types(edges, nodes).collect()] == [(["T1"], ["Type"])]
    sab = graph.sources(spark.createDataFrame([(0, "S", "First", "1"), (1, "S", "Second", "2"), (2, "", "None", "")], "pos long, RSAB string, SON string, SVER string"))
    assert [tuple(r) for r in sab.collect()] == [("S", "First", "1")]
    defs = spark.createDataFrame([("C1", "S", "d &gt; e", "N"), ("C1", "Z", "x", "N"), ("C3", "S", "x", "N"), ("C1", "S", "x", "Y")], "CUI string, SAB string, DEF string, SUPPRESS string")
    assert [tuple(r) for r in graph.definitions(defs, concepts, sab).collect()] == [("C1", "S", "d > e")]


def test_linking_cascades(spark):
    texts = link.distinct_texts(spark.createDataFrame([(t,) for t in ("two", " Two ", "a & b", "zzz", "---", "")], "expanded_text string"))
    assert texts.count() == 4
    concepts = graph.concepts(terminology(spark))
    names = graph.atoms(terminology(spark), concepts).join(concepts, "cui").select("str_norm", "cui", "name")
    got = {r.text.lower(): (r.cui, r.match.split("/")[0]) for r in link.lexical(texts, names, 0.1).collect()}
    assert got == {"two": ("C2", "exact"), "a & b": ("C1", "exact"), "zzz": ("", ""), "---": ("", "")}
    vectors_of = {"zzz": [0.7, (1 - 0.49) ** 0.5], "---": [0.69, -((1 - 0.69**2) ** 0.5)]}
    pointed = texts.join(spark.createDataFrame(list(vectors_of.items()), "text string, vector array<double>"), "text", "left").withColumn("vector", F.coalesce("vector", F.array(F.lit(0.0), F.lit(-1.0))))
    index = spark.createDataFrame([("C7", [1.0, 0.0])], "cui string, vector array<double>")
    semantic = {r.text: (r.cui, r.score) for r in link.semantic(pointed, index).collect()}
    assert semantic["zzz"] == ("C7", 0.7) and semantic["---"] == ("", 0.69)
    hybrid = {r.text.lower(): (r.cui, r.match, r.score) for r in link.hybrid(pointed, names, index).collect()}
    assert hybrid["zzz"] == ("C7", "vector/0.700", 0.7) and hybrid["---"] == ("", "", 0.0) and hybrid["two"] == ("C2", "exact", 1.0)


def test_ensemble_gate(spark):
    cases = [(0, 0.50, "y", 0.0, "alone"), (1, 0.49, "x", 0.35, "agreed"), (2, 0.49, "x", 0.34, "disagreed"), (3, 0.49, "y", 0.9, "disagreed"), (4, 0.34, "x", 0.9, "below")]
    a = spark.createDataFrame([(i, "x", s) for i, s, *_ in cases], "k int, choice string, score double")
    b = spark.createDataFrame([(i, c, s) for i, _, c, s, _ in cases], "k int, choice string, score double")
    assert {r.k: r.reason for r in abbrev.accept_by_ensemble(a, b, ["k"], "choice").collect()} == {c[0]: c[4] for c in cases}


def test_document_type(spark):
    rules = [{"cui": "D1", "any_of": {"A", "B"}, "min_hits": 1}, {"cui": "D2", "any_of": {"C", "D"}, "min_hits": 2}]
    rows = spark.createDataFrame([("Letters", ["A"]), ("Other", ["A", "C", "D"]), ("Other", ["C", "D"]), ("Other", ["C"])], "kind string, types array<string>")
    got = [r[0] for r in rows.select(sections.document_type("kind", "types", {"Letters": "D9"}, rules)).collect()]
    assert got == ["D9", "D1", "D2", ""]


def test_shards(spark):
    rows = spark.range(10).withColumnRenamed("id", "k")
    assert sorted(r["count"] for r in shards.equal_runs(rows, 3, ["k"]).groupBy("shard").count().collect()) == [3, 3, 4]
    assert shards.pack_largest_first(list(enumerate([7, 5, 5, 4, 3, 3])), 3) == [(0, 0), (1, 1), (2, 2), (3, 1), (4, 2), (5, 0)]
    assert [r.k for r in shards.page(rows, "k", 3, 2).collect()] == [4, 5]
    assert shards.found_ids(rows, spark.createDataFrame([(3,), (99,), (3,)], "k long"), "k") == 1


def test_definitions():
    assert abbrev.definitions_in("We saw chronic obstructive pulmonary disease (COPD) today.") == [("COPD", "chronic obstructive pulmonary disease")]
    assert abbrev.definitions_in("He had MI (myocardial infarction) then.") == [("MI", "myocardial infarction")]
    assert abbrev.definitions_in("Nothing here (at all) or (x).") == []


def test_resolve_abbreviations(spark):
    rows = spark.createDataFrame([("s1", "heart attack unit (HAU) and BP with ED and HAU"), ("s2", "ED only")], "chunk_id string, text string")
    override = spark.createDataFrame([("BP", "blood pressure")], "upper string, expansion string")
    gazetteer = spark.createDataFrame([("ED", "emergency department"), ("ED", "eating disorder")], "upper string, expansion string")
    got = {(r.chunk_id, r.abbrev): r.source for r in abbrev.resolve(rows, override, gazetteer, models.encoded, least=-1.0).collect()}
    assert got == {("s1", "HAU"): "definition", ("s1", "BP"): "override", ("s1", "ED"): "gazetteer", ("s2", "ED"): "gazetteer"}


def test_models(spark):
    rows = spark.createDataFrame([(1, "Mild chest pain. No fever!"), (2, "  "), (3, None)], "k long, text string")
    found = models.recognised(rows, "k", "text", lambda: models.DictionaryRecognizer({"chest pain": "PROBLEM", "pain": "PROBLEM", "fever": "PROBLEM"}))
    assert sorted((r.k, r.surface_text, r.start_char) for r in found.collect()) == [(1, "chest pain", 5), (1, "fever", 20)]
    assert [(r.idx, r.text) for r in models.split(rows, "k", "text").orderBy("k", "idx").collect()] == [(0, "Mild chest pain."), (1, "No fever!")]
    vector = models.encoded(rows, "text").filter("k = 1").first()["vector"]
    assert sum(x * x for x in vector) == pytest.approx(1, abs=1e-5)
    calls = []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise RuntimeError
        return x

    assert models.with_retries(flaky, wait=0.001, later=lambda e: True)(7) == 7
    calls.clear()
    with pytest.raises(RuntimeError):
        models.with_retries(flaky, wait=0.001)(7)
    assert len(calls) == 1
    busy = type("Busy", (Exception,), {"status": 429})
    waits = iter([busy(), busy(), None])

    def post(texts):
        error = next(waits, None)
        if error:
            raise error
        return [[1.0, 0.0] for _ in texts]

    encoder = models.RemoteEncoder(post, wait=0.001)
    assert encoder.size == 2 and encoder.encode(["a", "b"]).shape == (2, 2)


def test_html_references_and_labels(spark):
    assert one(spark, "caf&eacute; &#233; &#xe9; &amp;amp; &notit; &lt", tx.unescape_html("x")) == "café é é &amp; ¬it; <"
    values = [0.5, 2.25, 0.25, 0.35, 49385.65, 0.05, 1e-9, 12.949999999999999]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in rows.select(tx.fixed("x", 1)).collect()] == [f"{v:.1f}" for v in values]


def test_thresholds_are_met_by_the_score_itself(spark):
    texts = spark.createDataFrame([("h", "t", [1.0, 0.0])], "entity_hash string, text string, vector array<double>")
    near = spark.createDataFrame([("c", [0.69999996, (1 - 0.69999996**2) ** 0.5])], "cui string, vector array<double>")
    assert link.semantic(texts, near, 0.7).first().cui == "" and link.semantic(texts, near, 0.6999).first().cui == "c"


def test_reachable_has_no_depth_limit(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(40, 0), (0, 5), (90, 91)], "src long, dst long").coalesce(1)
    got = {r.id: r.depth for r in graph.reachable(edges, spark.createDataFrame([(0,)], "id long")).collect()}
    assert got == {i: i if i < 5 else i - 4 for i in range(41)}
