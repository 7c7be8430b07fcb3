"""Near-duplicate documents by Order MinHash and banded alignment.

A document's k-mers are its runs of ``K`` = 5 words (lower-cased letters and digits), each labelled with its
occurrence number. Each of ``SKETCHES`` seeds takes the ``TAKEN`` least hashed ones and keeps them in the order of the
text (Marcais et al. 2019); documents that share two sketches whose seeds are next to each other, or next but one,
are candidates: a passage that many documents share seldom gives them two. A candidate pair is a link if the best
order-keeping alignment of its labelled k-mers, within the band that the threshold allows, matches M of them with
M / (n + m - M) >= 0.8. Classes are the connected components of the links.

Equal texts are one node from the start, so a group of copies costs as much as one text. The texts of one key are a
bucket, whatever its size. It is dealt by hash into blocks of about ``TILE`` texts and ``TILE_KMERS`` k-mers, and every
pair of blocks is a tile of its own, so no task holds a bucket. A tile compares all its pairs but those that share an
earlier key, which the bucket of that key compares: every candidate pair is aligned exactly once, so links are counted
exactly. A tile returns counts and a spanning forest, never pairs. Of buckets with the same texts only the earliest is
kept, which that rule makes lossless.

A sketch with TAKEN = 3 is shared with a probability of about 0.5 at similarity 0.8, so of pairs just at the threshold
6 in 10,000 have no two such sketches at 24 sketches, and far fewer above it; see the tests for measured recall.
The alignment matches k-mers of the same occurrence number: where an early repeat is taken out all later ones are
numbered anew, and M is then a lower bound of the alignment without numbers.

Cases: null texts link with nothing, and those of one id (or of none) are one text; texts without a word are linked
only to equal texts; texts of 1 to 4 words are one k-mer; ties of hashes go to the earlier place; repeated rows share
a class; rows with a null id are compared like all others; a class is named by its least doc_id, null if all are; rows of
one id and one text are one document, rows of one id and different texts are documents of their own; texts of any
length are read whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.components import components
from textloom.runtime import discard, materialize, resident, ship, unused

K = 5
SIMILARITY = 0.8
SKETCHES = 24
TAKEN = 3
#: Texts and k-mers in each side of a tile, in expectation; a longer text is a block of its own.
TILE = 2048
TILE_KMERS = 1_000_000
#: K-mers of a text's partners that are looked up at once.
AT_ONCE = 250_000
LONG = 8_192
WORDS = re.compile(r"\w+")
_rng = np.random.default_rng(24)
SEEDS = _rng.integers(1, 1 << 63, (SKETCHES, 2), dtype=np.uint64) | np.uint64(1)
POWERS = _rng.integers(1, 1 << 63, K, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHash(dict):
    """Word to 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "little")
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def kmers(text: str | None) -> np.ndarray:
    """The hashed, occurrence-labelled k-mers of a whole text, in order."""
    words = WORDS.findall((text or "").lower())
    h = np.fromiter(map(resident(WordHash).__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    n = max(1, len(h) - K + 1)
    grams = np.zeros(n, np.uint64)
    for j in range(min(K, len(h))):
        grams += _mixed(h[j : j + n] * POWERS[j])
    grams = _mixed(grams)
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    if new.all():
        return grams
    at = np.arange(n)
    seen = np.empty(n, np.uint64)
    seen[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return np.where(seen > 0, _mixed(grams + _mixed(seen * _MIX)), grams)


def sketches(grams: np.ndarray) -> np.ndarray:
    """One 64-bit value a seed: of the TAKEN least k-mers in the order of the text. Fewer k-mers: of all of them."""
    if len(grams) > LONG:  # a seed at a time, to bound memory
        return np.concatenate([_sketches(grams, i, i + 1) for i in range(SKETCHES)])
    return _sketches(grams, 0, SKETCHES)


def _sketches(grams: np.ndarray, start: int, stop: int) -> np.ndarray:
    take = min(TAKEN, len(grams))
    x = grams[None, :] * SEEDS[start:stop, :1]
    x ^= x >> np.uint64(32)
    x *= SEEDS[start:stop, 1:]
    least = np.argpartition(x, take - 1, axis=1)[:, :take] if take < len(grams) else np.broadcast_to(np.arange(take), (stop - start, take))
    picked = grams[np.sort(least, axis=1)]
    out = np.arange(start + 1, stop + 1, dtype=np.uint64)
    for j in range(take):
        out = (out * _MIX) ^ picked[:, j]
        out ^= out >> np.uint64(32)
    return out


def joint_keys(values: np.ndarray) -> np.ndarray:
    """Keys of sketches taken two by two: each with the next and with the one after that."""
    out = []
    for step in (1, 2):
        both = (values * _MIX + np.uint64(step)) ^ _mixed(np.roll(values, -step))
        out.append(_mixed(both))
    return np.concatenate(out)


def rising(places: np.ndarray) -> int:
    """The length of the longest rising run within ``places``, by patience sorting."""
    if len(places) < 2 or (places[1:] > places[:-1]).all():
        return len(places)
    tails: list[int] = []
    for p in places.tolist():
        i = bisect_left(tails, p)
        tails[i : i + 1] = [p]
    return len(tails)


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """M / (n + m - M) of the best alignment within the band; 0 where a bound shows that it is below ``least``.

    Labelled k-mers occur once in a text, so an alignment is a rising run of matched places. With at most d unmatched
    k-mers on each side, matches stay within d of the diagonal.
    """
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    need = least / (1 + least) * (n + m)
    near = np.abs(at_a - at_b) <= int(max(n, m) - need) + 1
    if near.sum() < need - 1e-9:
        return 0.0
    matched = rising(at_b[near][np.argsort(at_a[near])])
    return matched / (n + m - matched)


def _linked(others: np.ndarray, n: int, place: np.ndarray, ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray, least: float) -> np.ndarray:
    """Those of ``others`` that link to the text of n k-mers whose places are written down."""
    lengths = sizes[others]
    there = np.concatenate([ids[ends[y] - sizes[y] : ends[y]] for y in others.tolist()])
    which, at = np.repeat(np.arange(len(others)), lengths), np.arange(len(there)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    there = place[there]
    need = least / (1 + least) * (n + lengths)
    near = (there >= 0) & (np.abs(there - at) <= (np.maximum(n, lengths) - need).astype(np.int64)[which] + 1)
    there, which = there[near], which[near]
    matched = np.bincount(which, minlength=len(others))
    for y in np.unique(which[1:][(which[1:] == which[:-1]) & (there[1:] < there[:-1])]).tolist():
        if matched[y] >= need[y] - 1e-9:
            matched[y] = rising(there[which == y])
    return others[matched / (n + lengths - matched) >= least]


def tile_links(grams: list[np.ndarray], earlier: np.ndarray, side: np.ndarray | None, least: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """(links of each text, least text that it reaches) among the pairs of a tile that share no earlier key.

    side: 0 or 1, and only texts of different sides are compared; None: all are. earlier: a row of keys for each text.
    Places of a text's k-mers are written down by k-mer, and those of all its partners looked up there at once; only
    a partner whose matches are out of order is aligned by itself.
    """
    sizes = np.fromiter(map(len, grams), np.int64, len(grams))
    ends = np.cumsum(sizes)
    words, ids = np.unique(np.concatenate(grams), return_inverse=True)
    place = np.full(len(words), -1, np.int64)
    counts, label = np.zeros(len(grams), np.int64), np.arange(len(grams))
    for x, n in enumerate(sizes.tolist()):
        others = np.arange(x + 1, len(grams)) if side is None else np.flatnonzero(side > side[x])
        others = others[np.minimum(sizes[others], n) >= least * np.maximum(sizes[others], n)]
        if earlier.shape[1] and len(others):
            others = others[~(earlier[others] == earlier[x]).any(1)]
        if not len(others):
            continue
        own = ids[ends[x] - n : ends[x]]
        place[own] = np.arange(n)
        part = (np.cumsum(sizes[others]) - 1) // AT_ONCE
        found = np.concatenate([_linked(some, n, place, ids, sizes, ends, least) for some in np.split(others, np.flatnonzero(np.diff(part)) + 1)])
        place[own] = -1
        if len(found):
            counts[x] += len(found)
            counts[found] += 1
            joined = np.unique(label[np.append(found, x)])
            if len(joined) > 1:
                label[np.isin(label, joined)] = joined[0]
    return counts, label


def node():
    """A digest of the text; of the id for a null text."""
    return F.coalesce(F.unhex(F.md5("text")), F.concat(F.lit(bytearray(1)), F.coalesce(F.encode(F.col("doc_id").cast("string"), "UTF-8"), F.lit(bytearray()))))


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, node, keys (of pairs of sketches; none for a text without words), size (k-mers)."""
    ship(docs.sparkSession)

    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                keys, sizes = [], []
                for text in batch.column(1):
                    grams = kmers(text.as_py())
                    sizes.append(len(grams))
                    keys.append(joint_keys(sketches(grams)).view(np.int64) if len(grams) else np.empty(0, np.int64))
                held = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), held, pa.array(sizes, pa.int64())], ["doc_id", "node", "keys", "size"])

    return docs.select("doc_id", "text", node().alias("node")).mapInArrow(run, "doc_id long, node binary, keys array<long>, size long")


def grams_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, grams (the k-mers as bytes), one row for each wanted node. wanted: doc_id (one that has the text), node."""

    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                for i in range(0, batch.num_rows, 256):
                    part = batch.slice(i, 256)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([kmers(t.as_py()).tobytes() for t in part.column(1)], pa.binary())], ["node", "grams"])

    rows, asked = docs.select("doc_id", "text", node().alias("node")), wanted.select(F.col("doc_id").alias("id"), F.col("node").alias("n"))
    found = rows.join(asked, (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    return found.select("node", "text").mapInArrow(run, "node binary, grams binary").dropDuplicates(["node"])


def links(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, n, root): of texts that link in a tile, to how many there, and the first text of their part of its graph.

    rows: as ``sketched`` gives them.
    """
    one = rows.filter(F.size("keys") > 0).groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys"), F.first("size").alias("size"))
    entries = one.select("node", "doc_id", "size", F.posexplode("keys").alias("at", "key"))
    shared = materialize(entries.join(entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key"), "buckets")
    texts = materialize(grams_of(docs, shared.select("doc_id", "node").distinct()), "grams")
    prints = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"print{i}") for i in (1, 2)]
    sets = shared.groupBy("key").agg(F.first("n").alias("n"), F.min("at").alias("at"), F.sum("size").alias("kmers"), *prints)
    kept = sets.groupBy("n", "print1", "print2").agg(F.min_by(F.struct("key", "at", "kmers"), F.struct("at", "key")).alias("kept")).select("n", "kept.*")
    blocks = F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("kmers") / TILE_KMERS)).cast("int")
    dealt = shared.select("key", "node").join(kept.select("key", "at", blocks.alias("blocks")), "key")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), F.col("block").alias("own"), "at", "node")
    keyed = tiles.join(texts.join(one.select("node", "keys"), "node"), "node").select("key", "low", "high", "own", "node", F.slice("keys", F.lit(1), F.col("at")).alias("earlier"), "grams")
    parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = keyed.repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high")
    out = materialize(spread.mapInArrow(_compare, "node binary, n long, root binary"), "tiles")
    discard(shared, texts)
    return out


def _compare(batches):
    """Tiles in a row: a tile's rows stand together, over batches as they come."""

    def done(table: pa.Table):
        table = table.combine_chunks()
        nodes, grams = table.column("node").to_pylist(), [np.frombuffer(g.as_buffer(), np.uint64) for g in table.column("grams")]
        earlier = table.column("earlier").combine_chunks()
        keys = earlier.flatten().to_numpy(zero_copy_only=False).reshape(len(nodes), -1)
        own = table.column("own").to_numpy()
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        counts, label = tile_links(grams, keys, None if low == high else (own == high).astype(np.int64))
        some = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in some], pa.binary()), pa.array(counts[some]), pa.array([nodes[i] for i in label[some]], pa.binary())], ["node", "n", "root"])

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(c).to_numpy() for c in range(3)])
        starts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
        first = [held[-1].column(c)[-1].as_py() for c in range(3)] if held else None
        cuts = [0, *starts.tolist(), batch.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            if held and (start or marks[:, 0].tolist() != first):
                yield done(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(start, stop - start))
    if held:
        yield done(pa.Table.from_batches(held))


def classed(docs: DataFrame) -> DataFrame:
    """doc_id, node, root (the class), n_links of every row."""
    rows = materialize(sketched(docs), "sketched")
    tiles = links(docs, rows)
    roots = components(tiles.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degree = tiles.groupBy("node").agg(F.sum("n").alias("n_links"))
    linked = materialize(degree.join(roots, "node"), "roots")
    discard(tiles)
    return rows.select("doc_id", "node").join(linked, "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links (other texts linked directly), kept (the document that stands for the class)."""
    named = materialize(classed(docs), "classed")
    names = materialize(named.groupBy("root").agg(first_of_class()), "names")  # written: a join of tables can split a large class
    return named.join(names, "root").select("doc_id", F.col("first.doc_id").alias("class_id"), "n_links", (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("node") == F.col("first.node"))).alias("kept"))


def first_of_class():
    """The least id that is not null, and of its texts the one with the least digest."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("first")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, with all columns of ``docs``, whatever their names.

    It is the row with the class's least id; null ids come last, so a class of them keeps one too. Of rows with one id
    and one text, the least by its other columns stays.
    """
    key, row = unused(docs, "copy"), unused(docs, "row")
    of = F.concat(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "UTF-8"), F.lit(bytearray(1)))
    first = classed(docs).groupBy("root").agg(first_of_class()).select("first.doc_id", "first.node").select(F.concat(of, "node").alias(key))
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    one = docs.withColumn(key, F.concat(of, node())).join(first, key, "left_semi")
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    return one.groupBy(key).agg(F.min_by(F.struct(*docs.columns), order).alias(row)).select(f"{row}.*")
