"""The queries of this subpackage by name, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers

from textloom.llm import bpe, brown, embeddup, hashforest, langid, licences, mixing, neardup, sharding, urlfilter
from textloom.runtime import read

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


@query("op2_hilbert_sharding")
def op2(spark, sf_dir):
    return sharding.shard(read(spark, sf_dir, "documents"), 16)


_HOST = "translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FITS = lambda key: f"((host = '{key.split('/')[0]}' OR ends_with(host, '.{key.split('/')[0]}')) AND starts_with(path, '/{key.partition('/')[2]}'))"


@query(
    "op3_bloom_cascade_urls",
    f"""
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, {_HOST} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT *, CASE {' '.join(f"WHEN {_FITS(key)} THEN '{key}'" for _, key in sorted(urlfilter.RULES, key=lambda r: -len(r[1])))} END AS rule FROM q)
SELECT page_id, host, path, rule, CASE
  {' '.join(f"WHEN rule = '{key}' THEN '{verdict}'" for verdict, key in urlfilter.RULES)}
  WHEN {' OR '.join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in urlfilter.LISTED_HOSTS)} THEN 'block' ELSE 'allow' END AS verdict
FROM r""",
)
def op3(spark, sf_dir):
    return urlfilter.judge(read(spark, sf_dir, "pages"))


@query("op6_prefix_bpe")
def op6(spark, sf_dir):
    return bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_bigru_language")
def op4(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


@query("op10_brown_classes")
def op10(spark, sf_dir):
    return brown.train_and_score(read(spark, sf_dir, "documents"))


@query("op7_order_minhash")
def op7(spark, sf_dir):
    return neardup.classes(read(spark, sf_dir, "documents"))


@query("op8_pca_tiles")
def op8(spark, sf_dir):
    return embeddup.classes(read(spark, sf_dir, "embeddings"))


@query("op9_prefix_forest")
def op9(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    return hashforest.search(rows.filter("vec_id % 20 = 0"), rows, 20)


@query("op1_soft_mixing")
def op1(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op5_licence_paragraphs")
def op5(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return licences.scan(docs, licences.train(docs))
