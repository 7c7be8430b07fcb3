"""Near-duplicate embeddings: exact comparison in tiles, with dimensions in PCA order.

All vectors are normalised, rotated onto the principal axes of their second moments (a table of d x d sums, the only
statistic that reaches the driver) and dealt into blocks of ``BLOCK`` rows. Every pair of blocks is one tile. A tile
first multiplies the leading ``LEAD`` coordinates; by Cauchy-Schwarz the rest of a product is at most the product of
the two suffix norms, so pairs whose sum stays below the threshold stop there. This first bound is one product in
single precision, loosened by ``LOOSE``, far more than its rounding. The others take the next coordinates, and what is
left at the end is decided by the cosine of the vectors as given, in double precision.

A tile finds, for each of its rows that links, how many it links to and the least row of its part of the tile's
graph: counts and a spanning forest, never the pairs. A task merges what its tiles find. Equal vectors are one row with a count from the start.

Blocks are written once, as the vectors were given, and each task of the product of blocks reads its own part of them:
nothing of a tile is shuffled, so the disk that is needed grows with the rows and only the work with their square.
After the blocks, rows are known by the SHA-256 of their vector; vectors are not moved again.

Cases: vectors that are null, zero, or hold null, NaN or infinite components link with nothing and are kept; shorter
vectors are padded with zeros to the longest; rows of one id are rows of their own; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import components
from textloom.runtime import discard, materialize, ship

THRESHOLD = 0.9
BLOCK = 2048
LEAD = 32
SLACK = 1e-9
LOOSE = 1e-5
#: Tasks of the product of blocks that more parts on its streamed side may not exceed.
TASKS = 4096
#: Blocks that a worker keeps in rotated form.
KEPT = 8
#: Rows of results that a task gathers before it merges them into one a node; it lets them go if more than half are left.
HELD = 500_000
#: Rows of a tile whose bounds are found at once, and pairs that go on at once; both bound a tile's memory.
STRIP = 128
PAIRS = 65_536


def usable():
    """Whether column embedding takes part: not null, no null or non-finite component, not all zero."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists("embedding", lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as doubles, padded with zeros to ``width``."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def axes(blocks: DataFrame, width: int, kind: str) -> np.ndarray:
    """The principal axes, largest first, from summed products of unit vectors: width x width numbers from all tasks."""

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            for data in batch.column(0):
                x = unit(np.frombuffer(data.as_buffer(), kind).reshape(-1, width).astype(np.float64))
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "sums"])

    rows = blocks.select("data").mapInArrow(run, "i long, sums array<double>")
    cells = rows.select("i", F.posexplode("sums").alias("j", "s")).groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    moments = np.zeros((width, width))
    for r in cells:
        moments[r["i"], r["j"]] = r["s"]
    return np.linalg.eigh((moments + moments.T) / 2)[1][:, ::-1]


class Side:
    """The vectors of a block as a tile needs them: as unit vectors, on the principal axes, and leading coordinates."""

    def __init__(self, x: np.ndarray, turn: np.ndarray) -> None:
        self.x = unit(x)
        self.turned = self.x @ turn
        d = self.turned.shape[1]
        #: norms of what follows coordinate LEAD, 2 LEAD, ...
        self.rest = {k: np.sqrt(np.einsum("ij,ij->i", self.turned[:, k:], self.turned[:, k:])) for k in range(LEAD, d, LEAD)}
        self.lead = np.column_stack([self.turned[:, :LEAD], *([self.rest[LEAD]] if LEAD < d else [])]).astype(np.float32)


def tile_pairs(a: Side, b: Side, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j) of the pairs with cosine of at least the threshold."""
    d = a.turned.shape[1]
    out_i, out_j = [], []
    least, across = np.float32(threshold - LOOSE), np.ascontiguousarray(b.lead.T)
    for start in range(0, len(a.x), STRIP):
        bound = a.lead[start : start + STRIP] @ across
        alive = np.flatnonzero(bound >= least)
        for first in range(0, len(alive), PAIRS):
            i, j = np.divmod(alive[first : first + PAIRS], len(b.x))
            i, got = i + start, 0.0
            for low in range(0, d, LEAD):
                high = min(low + LEAD, d)
                got = got + np.einsum("ij,ij->i", a.turned[i, low:high], b.turned[j, low:high])
                rest = a.rest[high][i] * b.rest[high][j] if high < d else 0.0
                keep = got + rest >= threshold - SLACK
                i, j, got = i[keep], j[keep], got[keep]
            exact = np.einsum("ij,ij->i", a.x[i], b.x[j]) >= threshold
            out_i.append(i[exact])
            out_j.append(j[exact])
    if not out_i:
        return np.empty(0, np.intp), np.empty(0, np.intp)
    return np.concatenate(out_i), np.concatenate(out_j)


def least_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of nodes 0 to n - 1 with links (i, j), the least each can reach."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row for each node of ``parts``, which hold (node, n, root): its sum of n, and the least node it reaches by them."""
    node, n, root = (np.concatenate(c) for c in zip(*parts, strict=True))
    names, at = np.unique(np.concatenate([node, root]), return_inverse=True)
    least = least_reachable(len(names), at[: len(node)], at[len(node) :])
    return names, np.bincount(at[: len(node)], n, len(names)).astype(np.int64), names[least]


def blocked(vectors: DataFrame, width: int, kind: str) -> DataFrame:
    """Rows of up to ``BLOCK`` vectors: block (distinct), arrays node, times, least and digest, and the vectors' numbers.

    vectors: node (distinct), times (rows that are equal to it), least, digest, embedding. Each task fills blocks from
    its own rows.
    """
    ship(vectors.sparkSession)
    size = BLOCK
    schema = "block long, node array<long>, times array<long>, least array<long>, digest array<binary>, data binary"

    def pack(batches):
        held, n = [], 0

        def out(rows):
            x = matrix(rows.column("embedding").combine_chunks(), width).astype(kind)
            lists = [pa.array([rows.column(c).to_pylist()], pa.list_(pa.binary() if c == "digest" else pa.int64())) for c in ("node", "times", "least", "digest")]
            return pa.RecordBatch.from_arrays([pa.array([rows.column("node")[0].as_py()], pa.int64()), *lists, pa.array([x.tobytes()], pa.binary())], ["block", "node", "times", "least", "digest", "data"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= size:
                table = pa.Table.from_batches(held)
                full = n - n % size
                yield from (out(table.slice(low, size)) for low in range(0, full, size))
                held, n = table.slice(full).to_batches(), n - full
        if n:
            yield out(pa.Table.from_batches(held))

    return vectors.select("node", "times", "least", "digest", "embedding").mapInArrow(pack, schema)


def linked(blocks: DataFrame, width: int, kind: str, threshold: float = THRESHOLD) -> DataFrame:
    """(node, n, root) for nodes in a task's links: how many rows it links to there, and the least node it reaches.

    blocks: as ``blocked`` gives them, written. Each pair is one tile, whose order depends on whether the two blocks'
    hashes are odd together, so that no task's tiles are all left out. The streamed side has fewer parts where the
    product would have very many tasks.
    """
    turn, most = axes(blocks, width, kind), HELD
    sides = blocks.select("block", F.struct("node", "times", "data").alias("rows"), (F.xxhash64("block") % 2 == 0).alias("even"))
    left, right = (sides.select(*(F.col(c).alias(f"{c}_{x}") for c in sides.columns)) for x in "ab")
    parts = max(1, right.rdd.getNumPartitions())
    left = left.coalesce(max(1, min(parts, TASKS // parts)))
    mine = (F.col("block_a") < F.col("block_b")) == (F.col("even_a") == F.col("even_b"))
    both = left.join(right.hint("shuffle_replicate_nl"), (F.col("block_a") == F.col("block_b")) | ((F.col("block_a") != F.col("block_b")) & mine))

    def compare(batches):
        kept, found, rows_held = {}, [], 0

        def out(node, n, root):
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(n), pa.array(root)], ["node", "n", "root"])

        def side(block, rows, k):
            if block not in kept:
                while len(kept) >= KEPT:
                    del kept[next(iter(kept))]
                node, times = (np.array(rows.field(c)[k].values) for c in (0, 1))
                x = np.frombuffer(rows.field(2)[k].as_buffer(), kind).reshape(-1, width)
                kept[block] = node, times, Side(x.astype(np.float64), turn)
            else:
                kept[block] = kept.pop(block)  # now the last to go
            return kept[block]

        for batch in batches:
            for k in range(batch.num_rows):
                one, two = batch.column(0)[k].as_py(), batch.column(2)[k].as_py()
                (na, ta, a), (nb, tb, b) = side(one, batch.column(1), k), side(two, batch.column(3), k)
                i, j = tile_pairs(a, b, threshold)
                if one == two:
                    once = i != j  # within a block each link is seen from both sides
                    i, j = i[once], j[once]
                nodes = na if one == two else np.concatenate([na, nb])
                n = np.bincount(i, tb[j], len(na)).astype(np.int64)
                if one != two:
                    n = np.concatenate([n, np.bincount(j, ta[i], len(nb)).astype(np.int64)])
                    j = j + len(na)
                root = least_reachable(len(nodes), i, j)
                some = np.flatnonzero(n)
                if not len(some):
                    continue
                found.append((nodes[some], n[some], nodes[root[some]]))
                rows_held += len(some)
                if rows_held >= most:
                    found = [merged(found)]
                    rows_held = len(found[0][0])
                    if rows_held > most // 2:
                        yield out(*found.pop())
                        rows_held = 0
        if found:
            yield out(*merged(found))

    return both.select("block_a", "rows_a", "block_b", "rows_b").mapInArrow(compare, "node long, n long, root long")


def classes(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    single = dict(embeddings.dtypes)["embedding"] == "array<float>"
    kind = "float32" if single else "float64"
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"))
    good = rows.filter(usable()).withColumn("digest", F.unhex(F.sha2(F.col("embedding").cast("string").cast("binary"), 256)))
    width = good.agg(F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()[0]
    distinct = good.groupBy("digest", "embedding").agg(F.count("*").alias("times"), F.min("vec_id").alias("least"))
    blocks = materialize(blocked(distinct.withColumn("node", F.monotonically_increasing_id()), width, kind), "blocks")
    tiles = materialize(linked(blocks, width, kind, threshold), "tiles")
    roots = components(tiles.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = tiles.groupBy("node").agg(F.sum("n").alias("n"))
    nodes = blocks.select(F.explode(F.arrays_zip("node", "times", "least", "digest")).alias("e")).select("e.*")
    per = nodes.join(counts, "node", "left").join(roots, "node", "left")
    per = materialize(per.select("digest", "least", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")), "per")
    discard(blocks, tiles)
    names = materialize(per.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    named = per.join(names, "root").select("digest", "n_links", "component_id")
    done = good.select("vec_id", "digest").join(named, "digest").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
