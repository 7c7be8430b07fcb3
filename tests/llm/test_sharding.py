import zlib
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm import sharding

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("shard", T.StringType())])


def test_curve_visits_every_cell_once_by_unit_steps(spark):
    for n, bits in ((2, 3), (3, 2), (4, 2)):
        side = 1 << bits
        cells = spark.range(side**n).select(F.array(*[((F.col("id") / side**j).cast("long") % side) for j in range(n)]).alias("point"))
        rows = sorted((r["h"], tuple(r["point"])) for r in cells.select("point", sharding.hilbert_index("point", n, bits).alias("h")).collect())
        assert [h for h, _ in rows] == list(range(side**n))
        assert all(sum(abs(x - y) for x, y in zip(a, b, strict=True)) == 1 for (_, a), (_, b) in zip(rows, rows[1:], strict=False))


def test_cases(spark):
    rows = [(i, "text é " + "x" * (i % 7), "en", "hot" if i % 3 else None, "z") for i in range(101)]
    rows += [(7, "same", None, "a", None)] * 5 + [(None, None, None, None, None), (8, "", "en", "a", None), (9, "y" * 50_000, "en", "a", None)]
    got = sharding.shard(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, 1 + len((t or "").encode()), None if t is None else zlib.crc32(t.encode())) for i, t, *_ in rows)
    count = Counter(r.shard for r in got)
    assert set(count) == set(range(16)) and max(count.values()) - min(count.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == k) == list(range(count[k])) for k in count)
    in_order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in in_order] == sorted(r.curve for r in got)
    assert sharding.shard(spark.createDataFrame([], DOCS)).collect() == []
    assert len(sharding.shard(spark.createDataFrame(rows[:5], DOCS)).collect()) == 5


def test_manifest_prunes(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * (i % 50 + 1), "en", f"s{i % 4}", None) for i in range(400)], DOCS)
    placed = sharding.shard(docs)
    kept = sharding.shards_for(sharding.manifest(docs, placed), doc_id=(0, 20)).count()
    assert 0 < kept < 16
    sharding.write_shards(docs.drop("shard"), placed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 400
