"""The registry, and every query with SQL against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__
from textloom.plans.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(rows):
    value = lambda v: "" if v is None else f"{v:.6g}" if isinstance(v, float) and math.isfinite(v) else str(v)
    return sorted(tuple(map(value, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    assert plain([[r[c] for c in names] for r in df.collect()]) == plain(result.fetchall())


def test_definitions_against_the_plain_function(spark):
    """The only query without SQL: every document's definitions, most common first, then first."""
    assert set(QUERIES) - set(ORACLES) == {"schwartz_hearst"}
    from textloom.operators.abbrev import definitions, definitions_in
    from textloom.runtime import read

    docs = read(spark, SMALL, "documents").unionByName(read(spark, SMALL, "documents").limit(3).selectExpr("-1 - doc_id AS doc_id", "concat(text, ' The chest pain clinic (CPC) saw magnetic resonance imaging (MRI). MRI (magnetic resonance imaging) again.') AS text", "lang", "source", "n_chars"))
    want = {}
    for r in docs.collect():
        pairs = definitions_in(r.text)
        for short in {s for s, _ in pairs}:
            longs = [x for s, x in pairs if s == short]
            want[r.doc_id, short] = min(longs, key=lambda x: (-longs.count(x), longs.index(x)))
    got = {(r.doc_id, r.abbrev): r.expansion for r in definitions(docs, "doc_id", "text").collect()}
    assert got == want and len(got) >= 6
    assert QUERIES["schwartz_hearst"](spark, SMALL).count() == sum(k[0] >= 0 for k in want)


def test_core_queries_stay_without_the_optional_parts(monkeypatch):
    def absent(name):
        raise ModuleNotFoundError(name)

    monkeypatch.setattr(__spark_entry__.importlib, "import_module", absent)
    assert set(__spark_entry__.queries()) == set(QUERIES) and set(__spark_entry__.oracle_sql()) == set(ORACLES)


def test_registry():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_balanced_and_windows(spark):
    bins = QUERIES["lpt_shards"](spark, SMALL).groupBy("bin").sum("n_chars").collect()
    loads = [r[1] for r in bins]
    assert len(loads) == 8 and max(loads) <= 4 / 3 * (sum(loads) / 8) + max(loads) / 8


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
