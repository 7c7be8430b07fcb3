"""Hilbert-curve sharding of documents, in DataFrame operations only.

Each row's metadata (source, language, size, id) is quantised to ``BITS`` bits a dimension; the cells are numbered
along a Hilbert curve, rows are range-partitioned and sorted by (curve, doc_id, ...), and the sorted run is cut into
shards whose row counts differ by at most one. Neighbours on the curve share narrow ranges of every dimension, so
the min/max statistics of a shard's file prune scans on any of them.

Cases: a null text has size 1 and a null checksum; null source, lang or doc_id fall in a fixed cell; an empty table
gives an empty result; equal rows are interchangeable and get slots of their own; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.runtime import materialize

BITS = 8
DIMENSIONS = ("source", "lang", "size", "doc_id")
ORDER = ("curve", "doc_id", "text_crc32", "size")


def _gray(i: int) -> int:
    return i ^ (i >> 1)


def _trailing_ones(i: int) -> int:
    return (~i & (i + 1)).bit_length() - 1


def _tables(n: int) -> dict[str, str]:
    """Per sub-cell of an n-cube: rank of a Gray code, entry corner and direction, as SQL arrays."""
    cells = range(1 << n)
    rank = {_gray(i): i for i in cells}
    entry = [0 if i == 0 else _gray(2 * ((i - 1) // 2)) for i in cells]
    turn = [0 if i == 0 else _trailing_ones(i if i % 2 else i - 1) % n for i in cells]
    return {k: f"array({', '.join(f'{x}L' for x in v)})" for k, v in (("rank", [rank[i] for i in cells]), ("entry", entry), ("turn", turn))}


def hilbert_index(point: str, n: int, bits: int = BITS) -> Column:
    """The Hilbert index of ``point``, a column of n non-negative longs below 2**bits. At most 63 bits in all."""
    if n * bits > 63 or n < 2:
        raise ValueError("2 or more dimensions and at most 63 bits")
    t, mask = _tables(n), (1 << n) - 1
    corner = " | ".join(f"shiftleft(shiftright({point}[{j}], i) & 1L, {j})" for j in range(n))
    turned = f"((shiftright(({corner}) ^ s.e, cast(s.d + 1 as int)) | shiftleft(({corner}) ^ s.e, cast({n} - s.d - 1 as int))) & {mask}L)"
    entered = f"element_at({t['entry']}, cast(w + 1 as int))"
    step = (
        f"named_struct('h', shiftleft(s.h, {n}) | w, "
        f"'e', s.e ^ ((shiftleft({entered}, cast(s.d + 1 as int)) | shiftright({entered}, cast({n} - s.d - 1 as int))) & {mask}L), "
        f"'d', (s.d + element_at({t['turn']}, cast(w + 1 as int)) + 1L) % {n}L)"
    )
    return F.expr(f"aggregate(sequence({bits - 1}, 0, -1), named_struct('h', 0L, 'e', 0L, 'd', 0L), (s, i) -> transform(array(element_at({t['rank']}, cast({turned} + 1 as int))), w -> {step})[0], s -> s.h)")


def quantised(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32 and one cell number for each of DIMENSIONS.

    Categories are cells of their hash, sizes of their logarithm (eight cells an octave), ids of their share of the
    table's range.
    """
    rows = docs.select("doc_id", "source", "lang", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"), F.crc32("text").alias("text_crc32"))
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    top, span = (1 << bits) - 1, float((high or 0) - (low or 0)) + 1
    cell = {
        "source": F.pmod(F.xxhash64("source"), F.lit(top + 1)),
        "lang": F.pmod(F.xxhash64("lang"), F.lit(top + 1)),
        "size": F.floor(F.log2(F.col("size").cast("double")) * (1 << bits) / 32),
        "doc_id": F.floor((F.col("doc_id").cast("double") - float(low or 0)) * (1 << bits) / span),
    }
    bounded = [F.least(F.lit(top), F.coalesce(cell[d].cast("long"), F.lit(0))).cast("long").alias(f"cell_{d}") for d in DIMENSIONS]
    return rows.select("doc_id", "size", "text_crc32", *bounded)


def shard(docs: DataFrame, shards: int = 16, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, curve for each row.

    One range shuffle: the position in a sorted partition comes from the running id of its task, and each
    partition's start from the counts of those before it (one row a partition).
    """
    cells = quantised(docs, bits)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pointed = cells.withColumn("point", F.array(*[f"cell_{d}" for d in DIMENSIONS]))
    curved = pointed.select("doc_id", "size", "text_crc32", hilbert_index("point", len(DIMENSIONS), bits).alias("curve"))
    run = materialize(curved.repartitionByRange(n, *ORDER).sortWithinPartitions(*ORDER).withColumn("at", F.monotonically_increasing_id()), "hilbert")
    within = (1 << 33) - 1
    run = run.select("doc_id", "size", "text_crc32", "curve", F.shiftrightunsigned("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit(within)).alias("place"))
    counts = run.groupBy("part").agg((F.max("place") + 1).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"), F.sum("rows").over(whole).alias("total"))
    ranked = run.join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + F.col("place"))  # starts: a row for each shuffle partition
    placed = ranked.withColumn("shard", F.expr(f"(rank * {shards}) div total"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.expr(f"rank - (shard * total + {shards - 1}) div {shards}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Whole documents as one sorted Parquet folder a shard. Joined by id, so ids must be unique here."""
    keyed = docs.join(placed.select("doc_id", "shard", "slot"), "doc_id")
    shards = keyed.repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard", "slot")
    shards.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def manifest(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """For each shard the least and greatest value of each dimension, to choose shards for a box query."""
    keyed = docs.select("doc_id", "source", "lang").join(placed.select("doc_id", "size", "shard"), "doc_id")
    return keyed.groupBy("shard").agg(F.count("*").alias("rows"), *[f(d).alias(f"{k}_{d}") for d in DIMENSIONS for k, f in (("min", F.min), ("max", F.max))])


def shards_for(table: DataFrame, **ranges: tuple) -> DataFrame:
    """The shards of a manifest that may hold rows with every dimension within its (least, greatest)."""
    for d, (low, high) in ranges.items():
        table = table.filter((F.col(f"max_{d}") >= F.lit(low)) & (F.col(f"min_{d}") <= F.lit(high)))
    return table.select("shard")
