"""Approximate nearest neighbours by a forest of sorted hash strings.

Rows are dealt by a hash of id and vector into blocks of about ``BLOCK``, and each block indexes all its rows: each of
``TREES`` trees turns every row by a random rotation and writes down which coordinates are the ``SYMBOLS`` largest, with
their signs (a cross-polytope hash), as one string of bits, and keeps the strings sorted. A query descends each tree
to the longest prefix that any string shares with its own, then ascends all trees together, a bit at a time, taking
in the rows of the prefix each time, until it has ``SHARE`` of the block and ``PER`` rows for each neighbour asked
for. Its candidates are then ranked by their exact inner products in double precision, and the blocks' best are
merged. Rotations see one more coordinate, sqrt(longest^2 - |x|^2) for rows and 0 for queries, which makes the nearest
angle the largest inner product whatever the lengths.

The embeddings of this kind of table are spread almost evenly over 64 dimensions (the 20th neighbour has a cosine near
0.35), so hashes tell near from far only weakly: about a third of a block is ranked; the tests measure recall.

Cases: vectors that are null, zero, or hold null, NaN or infinite components, and rows with a null id, neither ask nor
answer; shorter vectors are padded with zeros; a query's own row is the one of its id, so rows of one id never answer
it; rows of one id are one answer, with the score of the nearest, and ask together; ties go to the smaller id; with
fewer than k candidates in a block all of them answer; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.embeddup import matrix, usable
from textloom.runtime import discard, materialize, ship

TREES = 128
SYMBOLS = 3
BLOCK = 8192
QUERIES = 4096
SHARE, PER = 0.25, 10


@functools.lru_cache(1)
def rotations(width: int, trees: int = TREES) -> np.ndarray:
    """(tree, width + 1, D): D orthogonal directions a tree, the largest power of two that there are."""
    d = 1 << ((width + 1).bit_length() - 1)
    return np.linalg.qr(np.random.default_rng(9).normal(size=(trees, width + 1, width + 1)))[0][:, :, :d].copy()


def bits(turn: np.ndarray) -> int:
    """Length of a string: a symbol is one of 2 * D."""
    d = turn.shape[-1]
    return min(SYMBOLS, d) * d.bit_length()


def strings(x: np.ndarray, extra: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """(tree, row): each row's string in each tree as a number, the first bit highest."""
    full, d = np.concatenate([x, extra[:, None]], 1), turn.shape[-1]
    out = np.zeros((len(turn), len(x)), np.int64)
    for t, directions in enumerate(turn):
        y = full @ directions
        size = np.abs(y)
        for _ in range(min(SYMBOLS, d)):
            at = size.argmax(1)[:, None]
            out[t] = (out[t] << d.bit_length()) | (2 * at + (np.take_along_axis(y, at, 1) > 0))[:, 0]
            np.put_along_axis(size, at, -1.0, 1)
    return out


class Forest:
    def __init__(self, x: np.ndarray, longest: float, turn: np.ndarray) -> None:
        rest = np.sqrt(np.maximum(0, longest**2 - (x * x).sum(1)))
        marks = strings(x, rest, turn)
        self.x, self.turn, self.bits = x, turn, bits(turn)
        self.order = np.argsort(marks, axis=1, kind="stable")
        self.sorted = np.take_along_axis(marks, self.order, 1)

    def spans(self, marks: np.ndarray) -> np.ndarray:
        """(level, tree, query, 2): where the strings with the query's prefix of each length start and stop."""
        out = np.empty((self.bits + 1, *marks.shape, 2), np.int32)
        for level in range(self.bits + 1):
            cut = self.bits - level
            low = marks >> cut << cut
            for t in range(len(marks)):
                out[level, t, :, 0] = np.searchsorted(self.sorted[t], low[t])
                out[level, t, :, 1] = np.searchsorted(self.sorted[t], low[t] + (1 << cut))
        return out

    def candidates(self, q: np.ndarray, want: int):
        """For each query the rows that the descent and the common ascent find, at least ``want`` of them or all."""
        for start in range(0, len(q), 256):
            some = q[start : start + 256]
            spans = self.spans(strings(some, np.zeros(len(some)), self.turn))
            # a level's rows include all deeper ones', so the ascent need not mark levels that can't hold enough
            enough = (spans[..., 1] - spans[..., 0]).sum(1) >= want
            for k in range(len(some)):
                found = np.zeros(len(self.x), bool)
                for level in range(self.bits - int(np.argmax(enough[::-1, k])) if enough[:, k].any() else 0, -1, -1):
                    for t, (first, last) in enumerate(spans[level, :, k].tolist()):
                        found[self.order[t, first:last]] = True  # empty above a tree's longest shared prefix
                    if np.count_nonzero(found) >= want:
                        break
                yield start + k, np.flatnonzero(found)


def best(q: np.ndarray, q_ids: np.ndarray, forest: Forest, ids: np.ndarray, k: int, share: float = SHARE, count: list | None = None):
    """(query, ids, scores) of the k best candidates of each query in one block. count: gets the number ranked."""
    want = min(len(ids), max(PER * k, int(share * len(ids))))
    for i, rows in forest.candidates(q, want):
        if count is not None:
            count.append(len(rows))
        rows = rows[ids[rows] != q_ids[i]]
        scores = forest.x[rows] @ q[i]
        if len(rows) > k:
            edge = np.partition(scores, len(rows) - k)[len(rows) - k]
            near = scores >= edge - 1e-9 * max(1.0, abs(edge))
            rows = rows[near]
        exact = np.einsum("ij,j->i", forest.x[rows], q[i])
        top = np.lexsort((ids[rows], -exact))[:k]
        yield q_ids[i], ids[rows[top]], exact[top]


def search(queries: DataFrame, rows: DataFrame, k: int, share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each query, by largest inner product.

    Every block of queries meets every block of rows once: (queries / QUERIES) * (rows / BLOCK) pairs of packed blocks.
    """
    spark = rows.sparkSession
    ship(spark)
    doubles = lambda df: df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(usable() & F.col("vec_id").isNotNull())
    good, asked = doubles(rows), doubles(queries)
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    n, width, longest = good.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0)), F.coalesce(F.max(square), F.lit(0.0))).first()
    m, wide = asked.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    width, longest = max(width, wide), float(np.sqrt(longest))

    def pack(key, table):
        x = matrix(table.column("embedding").combine_chunks(), width)
        return pa.table({"block": [key[0].as_py()], "ids": [table.column("vec_id").to_numpy().tobytes()], "data": [x.tobytes()]}, pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("data", pa.binary())]))

    def packed(df, count, size, name):
        blocks = max(1, -(-count // size))
        dealt = df.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)))
        return materialize(dealt.groupBy("block").applyInArrow(pack, "block long, ids binary, data binary"), name), blocks

    asking, n_asking = packed(asked, m, QUERIES, "asking")
    held, n_held = packed(good, n, BLOCK, "held")
    pairs = spark.range(n_held).select(F.col("id").alias("h"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_asking - 1).cast("long"))).alias("a"))
    left = held.select(F.col("block").alias("h"), F.col("ids").alias("hi"), F.col("data").alias("hx"))
    right = asking.select(F.col("block").alias("a"), F.col("ids").alias("ai"), F.col("data").alias("ax"))
    spread = min(n_held * n_asking, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    both = pairs.join(left, "h").join(right, "a").repartition(max(1, spread), "h", "a").sortWithinPartitions("h", "a").select("h", "hi", "hx", "ai", "ax")

    def run(batches):
        turn, at, forest = rotations(width), None, None
        for batch in batches:
            for r in range(batch.num_rows):
                block, hi, hx, ai, ax = (batch.column(c)[r].as_py() for c in range(5))
                ids, q_ids = np.frombuffer(hi, np.int64), np.frombuffer(ai, np.int64)
                if block != at:
                    at, forest = block, Forest(np.frombuffer(hx).reshape(-1, width), longest, turn)
                got = list(best(np.frombuffer(ax).reshape(-1, width), q_ids, forest, ids, k, share))
                if not got:
                    continue
                counts = [len(g[1]) for g in got]
                columns = [np.repeat(np.array([g[0] for g in got], np.int64), counts), np.concatenate([g[1] for g in got]), np.concatenate([g[2] for g in got])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    found = materialize(both.mapInArrow(run, "query_id long, vec_id long, score double"), "found")
    discard(asking, held)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
