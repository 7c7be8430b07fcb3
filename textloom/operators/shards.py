"""Work sharing: near-equal runs, largest-first packing, and keyed pages."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.clean import dense_ids


def equal_runs(df: DataFrame, shards: int, order: list[str], name: str = "shard") -> DataFrame:
    """Adds a shard number: contiguous runs by ``order`` of sizes that differ by one at most, the longer ones first.

    As the SQL function ntile, but over ranges rather than one task.
    """
    rows = dense_ids(df, order, "_place")
    total = df.count()
    size, longer = divmod(total, shards)
    edge = longer * (size + 1)
    early = F.expr(f"_place div {size + 1}")
    late = F.expr(f"{longer} + (_place - {edge}) div {max(1, size)}")
    return rows.withColumn(name, F.when(F.col("_place") < edge, early).otherwise(late).cast("int")).drop("_place")


def pack_largest_first(weights: list[tuple[object, int]], bins: int) -> list[tuple[object, int]]:
    """(key, bin): the heaviest first, each into the bin with the least load so far, the lowest number on a tie."""
    loads = [(0, i) for i in range(bins)]
    out = []
    for key, weight in sorted(weights, key=lambda x: -x[1]):
        load, i = heapq.heappop(loads)
        out.append((key, i))
        heapq.heappush(loads, (load + weight, i))
    return out


def balanced(df: DataFrame, bins: int, weight: str, order: list[str], cells: int = 4096, name: str = "bin") -> DataFrame:
    """Adds a bin number such that bins have near-equal weight.

    Rows are first dealt into at most ``cells`` cells by hash; only the cells' weights are packed on the driver, so
    what it holds doesn't grow with the rows. With no more rows than cells, and unique keys, a cell is a row.
    """
    total = df.count()
    if total <= cells:
        rows = dense_ids(df, order, "_cell")
    else:
        rows = df.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    loads = [(r["_cell"], r["w"]) for r in rows.groupBy("_cell").agg(F.sum(F.greatest(F.col(weight).cast("long"), F.lit(1))).alias("w")).orderBy("_cell").collect()]
    table = df.sparkSession.createDataFrame(pack_largest_first(loads, bins) or [(0, 0)], f"_cell long, {name} int")
    return rows.join(F.broadcast(table), "_cell").drop("_cell")  # a row a cell


def page(df: DataFrame, key: str, after, size: int, name: str | None = None) -> DataFrame:
    """The next ``size`` rows by key after a given one; with ``name``, only rows where that column is not blank."""
    rows = df if after is None else df.filter(F.col(key) > F.lit(after))
    if name:
        rows = rows.filter(F.coalesce(F.col(name), F.lit("")) != "")
    return rows.orderBy(key).limit(size)


def work_weight(rows: DataFrame, key: str, text: str) -> DataFrame:
    """key, weight: the summed length of its texts, 1 at least."""
    return rows.groupBy(key).agg(F.greatest(F.sum(F.coalesce(F.length(text), F.lit(0))).cast("long"), F.lit(1).cast("long")).alias("weight"))


def found_ids(df: DataFrame, ids: DataFrame, key: str) -> int:
    """How many of the ids a table has."""
    return ids.select(key).distinct().join(df.select(key), key, "left_semi").count()
