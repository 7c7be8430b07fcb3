import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from textloom.llm import bpe, neardup
from textloom.runtime import read

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).cache()
        out.append((name, docs))
    return out


def test_order_and_columns(spark, stages):
    columns = read(spark, SMALL, "documents").columns
    assert [n for n, _ in stages] == ["language_id", "near_dedup", "mixing", "bpe"]
    assert all(df.columns == columns for _, df in stages[:-1])


def test_language_stage_keeps_texts_with_letters(spark, stages):
    before = {r.doc_id: r.text for r in read(spark, SMALL, "documents").collect()}
    after = {r.doc_id for r in stages[0][1].select("doc_id").collect()}
    lost = [t for i, t in before.items() if i not in after]
    assert len(lost) <= 0.02 * len(before) and not [t for i, t in before.items() if i in after and not any(map(str.isalpha, t))]


def test_dedup_stage_against_all_pairs(spark, stages):
    rows = {r.doc_id: r.text for r in stages[0][1].collect()}
    with np.errstate(over="ignore"):
        grams = {i: neardup.kmers(t) for i, t in rows.items()}
    ids, root = sorted(rows), {i: i for i in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if rows[i] == rows[j] or neardup.aligned(grams[i], grams[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert sorted(r.doc_id for r in stages[1][1].collect()) == sorted(i for i in ids if find(i) == i)


def test_mixing_stage_keeps_what_is_not_toxic(spark, stages):
    before = {r.doc_id for r in stages[1][1].select("doc_id").collect()}
    toxic = {r.doc_id for r in read(spark, SMALL, "labels").filter("toxic = 1").collect()}
    after = Counter(r.doc_id for r in stages[2][1].select("doc_id").collect())
    assert len(before - set(after) - toxic) <= 0.1 * len(before) and set(after) <= before


def test_stages_on_odd_rows(spark):
    plain = "the river runs by the old mill and the town in the early morning light of spring"
    rows = [(1, None), (2, ""), (3, "12 !?"), (4, plain), (4, plain), (None, plain + " again"), (None, "quite another text about something else"), (5, "long " * 30_000), (6, plain.upper() + " x y z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, copy string, row int, _id int"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "c", 1, 2) for i, t in rows], schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
    first = corpus_pipeline.language_id(spark, docs, SMALL)
    assert first.columns == docs.columns and sorted(r.doc_id or 0 for r in first.collect()) == [0, 0, 4, 4, 5, 6]
    second = corpus_pipeline.near_dedup(spark, docs, SMALL)
    assert second.columns == docs.columns and sum(r.doc_id == 4 for r in second.collect()) == 1
    assert {r.text for r in second.collect()} >= {None, "12 !?", rows[6][1], rows[7][1]}
    third = corpus_pipeline.mixing_stage(spark, docs, SMALL)
    assert third.columns == docs.columns and {r.text for r in third.collect()} <= {t for _, t in rows}
    fourth = corpus_pipeline.bpe_stage(spark, docs, SMALL)
    assert fourth.count() == len(rows) and {r.n_tokens for r in fourth.collect() if r.doc_id in (1, 2)} == {0}


def test_bpe_stage_is_the_plain_encoding(spark, stages):
    texts = {r.doc_id: r.text for r in stages[2][1].collect()}
    coder = bpe.encoder(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    got = stages[3][1].collect()
    assert len(got) == stages[2][1].count()
    assert all(r.n_tokens == len(coder.encode(texts[r.doc_id])) for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
