"""Language-model scores from Brown's class-based bigrams.

Counts of all words come from the whole training part. The ``CLUSTERED`` most frequent words are put into ``CLASSES``
classes by exchange: starting from classes by rank, each word in turn moves to the class that raises the likelihood
of the class bigrams most, until a sweep moves nothing. Then every other word of the training part, however rare, goes
to the class that raises that likelihood most, by the same gain over its whole neighbourhood, in tasks: its neighbours
count by their class, or as others where they are not clustered themselves. The end of a text is a class of its own
that also comes before each text; words never seen are one more. The probability of a token is

    p(class | class before) * p(token | class),

with transitions between all words' classes counted over the whole training part and smoothed by their class's overall
share. A word never seen has the chance of a word seen once (Good and Turing); as a class of one token it needs no
emission. Both are proper distributions over all words, the end and the unseen.

Words are counted over all documents and never dropped: the vocabulary stays a distributed table of (word, n, class).
Only the ``CLUSTERED`` words, their pair counts (at most the square of their number), the ``KNOWN`` most frequent words
and the classes reach the driver. Other words meet their classes in a join.

Cases: a null text counts as empty (its only token is the end); texts of any length are read whole; a table without
training rows gives every token the base probability 1/(V+1) with V = 0; repeated rows are each counted and scored;
ties of gains go to the first class; rows with a null id are training rows; other columns are not read.
"""

from __future__ import annotations

import functools
import math
import pickle
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.runtime import discard, materialize, ship

CLUSTERED = 1500
CLASSES = 48
KNOWN = 150_000
ADD = 0.1
#: A task passes on what it has counted at so many distinct words, or at so many occurrences.
FLUSH, HELD = 300_000, 8_000_000


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased. Bytes split at 0x20 and 0x09 to 0x0D and nothing else."""
    return (text or "").encode("utf-8", "replace").lower().split()


def count_words(docs: DataFrame) -> DataFrame:
    """word (binary), n: over all rows. Each task adds up what it has read before it passes it on."""

    def run(batches):
        held: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                held.update(tokens(text.as_py()))
                if len(held) > FLUSH:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def count_pairs(docs: DataFrame, words: list[bytes]) -> np.ndarray:
    """How often each of ``words``, any other (index K) or an end (K + 1) follows each of these. K*K cells at most."""
    k = len(words)
    index = {w: i for i, w in enumerate(words)}
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(index))  # CLUSTERED entries

    def run(batches):
        get = pickle.loads(shared.value).get
        cells = np.zeros((k + 2) * (k + 2), np.int64)
        for batch in batches:
            for text in batch.column(0):
                ids = [k + 1, *map(get, tokens(text.as_py()), repeat(k)), k + 1]
                row = np.array(ids, np.int64)
                codes, n = np.unique(row[:-1] * (k + 2) + row[1:], return_counts=True)
                cells[codes] += n
        found = np.flatnonzero(cells)
        for i in range(0, len(found), 100_000):
            some = found[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(cells[some])], ["cell", "n"])

    rows = docs.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((k + 2) * (k + 2), np.int64)
    out[rows["cell"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out.reshape(k + 2, k + 2)


def _plogp(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def exchange(pairs: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class of each of the first K rows of a (K+2, K+2) table of pair counts; K and K+1 keep classes of their own.

    The likelihood of class bigrams is sum f(N(c, d)) - sum f(N(c, .)) - sum f(N(., d)) with f(x) = x log x. To move
    a word only two rows and columns of N change, so all its destinations are compared at once.
    """
    k = len(pairs) - 2
    c = min(classes, max(1, k))
    n_all = c + 2
    label = np.concatenate([np.arange(k) % c, [c, c + 1]]).astype(np.int64)
    one = np.zeros((len(pairs), n_all))
    one[np.arange(len(pairs)), label] = 1
    after, before = pairs @ one, pairs.T @ one  # of each word: counts to and from each class
    table = one.T @ after
    total_after, total_before = pairs.sum(1).astype(float), pairs.sum(0).astype(float)
    moved = 1
    while moved:
        moved = 0
        for w in range(k):
            own = label[w]
            own_pairs = float(pairs[w, w])
            a, b = after[w].copy(), before[w].copy()  # w's counts to and from the classes, its own included
            rest = table.copy()
            rest[own] -= a
            rest[:, own] -= b
            rest[own, own] += own_pairs
            a[own] -= own_pairs
            b[own] -= own_pairs  # now to and from the classes without w
            row, col = table.sum(1), table.sum(0)  # tokens of each class, without w
            row[own] -= total_after[w]
            col[own] -= total_before[w]
            gain = (_plogp(rest + a[None, :]) - _plogp(rest)).sum(1) + (_plogp(rest + b[:, None]) - _plogp(rest)).sum(0)
            d = np.arange(n_all)
            both = rest[d, d]
            gain += _plogp(both + a + b + own_pairs) - _plogp(both + a) - _plogp(both + b) + _plogp(both)
            gain -= _plogp(row + total_after[w]) - _plogp(row) + _plogp(col + total_before[w]) - _plogp(col)
            best = int(gain[:c].argmax())
            if best != own and gain[best] > gain[own] + 1e-9:
                moved += 1
                label[w] = best
                after[:, own] -= pairs[:, w]
                after[:, best] += pairs[:, w]
                before[:, own] -= pairs[w]
                before[:, best] += pairs[w]
                table = rest
                table[best] += a
                table[:, best] += b
                table[best, best] += own_pairs
    return label


def contexts(docs: DataFrame, class_of: dict[bytes, int], classes: int) -> DataFrame:
    """word, around: of every word without a class, two bytes an occurrence, the classes before and after it.

    classes: the number of classes; the next one stands for other words, and the one after it for ends.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(class_of))  # CLUSTERED entries

    def run(batches):
        get = pickle.loads(shared.value).get
        held: defaultdict[bytes, bytearray] = defaultdict(bytearray)

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(map(bytes, held.values()), pa.binary())], ["word", "around"])
            held.clear()
            return out

        size = 0
        for batch in batches:
            for text in batch.column(0):
                ws = tokens(text.as_py())
                path = bytes([classes + 1, *map(get, ws, repeat(classes)), classes + 1])
                other = np.flatnonzero(np.frombuffer(path, np.uint8)[1:-1] == classes).tolist()
                for i in other:
                    held[ws[i]] += path[i : i + 3 : 2]
                size += len(other)
                if len(held) > FLUSH or size > HELD:
                    yield flush()
                    size = 0
        yield flush()

    return docs.select("text").mapInArrow(run, "word binary, around binary")


def gains(after: np.ndarray, before: np.ndarray, table: np.ndarray) -> np.ndarray:
    """(word, class): what the likelihood of class bigrams gains if one of the shared class's words goes to each class.

    after, before: each word's counts to and from each of the C classes, the shared one (C) and the end (C + 1);
    table: the pair counts of these. Pairs of a word with itself count as pairs with the shared class.
    """
    c = len(table) - 2
    table, own = table.astype(float), np.arange(c)
    total = np.zeros((len(after), c))
    for counts, t in ((after, table), (before, table.T)):
        word, cell = np.nonzero(counts)
        word, cell = word[cell != c], cell[cell != c]
        if len(word):
            n = counts[word, cell].astype(float)[:, None]
            change = _plogp(t[:c, cell].T + n) - _plogp(t[:c, cell].T)
            inner = np.flatnonzero(cell < c)
            change[inner, cell[inner]] = 0  # the class with itself: below, with both counts
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            total[word[starts]] += np.add.reduceat(change, starts, 0)
        left = np.maximum(0, t[:c, c] - (before if counts is after else after)[:, :c])  # pairs of others with what stays shared
        total += _plogp(left + counts[:, c, None]) - _plogp(left)
        whole = t[:c].sum(1)
        total -= _plogp(whole + counts.sum(1)[:, None]) - _plogp(whole)
    both = table[own, own]
    return total + _plogp(both + after[:, :c] + before[:, :c]) - _plogp(both)


def assigned(around: DataFrame, table: np.ndarray) -> DataFrame:
    """word, n, class of every word in ``around`` (as ``contexts`` gives it)."""
    c = len(table) - 2
    width = c + 2

    def judged(words: list[bytes], held: list[bytes]):
        data, sizes = np.frombuffer(b"".join(held), np.uint8).reshape(-1, 2).astype(np.intp), np.array([len(h) // 2 for h in held])
        which = np.repeat(np.arange(len(words)), sizes)
        before, after = (np.bincount(which * width + data[:, k], minlength=len(words) * width).reshape(-1, width) for k in (0, 1))
        best = gains(after, before, table).argmax(1)
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(sizes.astype(np.int64)), pa.array(best.astype(np.int32))], ["word", "n", "class"])

    def run(batches):
        words: list[bytes] = []
        held: list[bytes] = []
        for batch in batches:
            for word, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if words and words[-1] == word:
                    held[-1] += some
                    continue
                if len(words) == 4096:
                    yield judged(words, held)
                    words, held = [], []
                words.append(word)
                held.append(some)
        if words:
            yield judged(words, held)

    parts = int(around.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return around.repartition(parts, "word").sortWithinPartitions("word").mapInArrow(run, "word binary, n long, class int")


@dataclass
class Model:
    """known: of the most frequent words, (class, count). sizes, members: tokens and words of each class.

    Class C is for words never seen, C + 1 for the end. step: log10 transitions, once they are counted.
    """

    known: dict[bytes, tuple[int, int]]
    sizes: np.ndarray
    members: np.ndarray
    once: int
    train_tokens: int
    vocabulary: int
    ends: int
    step: np.ndarray | None = None

    def emission(self, n: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log10 p(word | class); a word never seen is the only token of its class."""
        return np.where(n > 0, np.log10((n + ADD) / (self.sizes[at] + ADD * np.maximum(1, self.members[at]))), 0.0)

    def base(self, n: np.ndarray | float) -> np.ndarray | float:
        return np.log10((n + ADD) / (self.train_tokens + ADD * (self.vocabulary + 1)))

    def with_steps(self, table: np.ndarray) -> Model:
        """table: counts of class pairs, none with the unseen class."""
        c = len(table) - 2
        table = table.astype(float)
        unseen = (self.once + ADD) / max(1.0, float(self.train_tokens))
        table[:, c] = table.sum(1) * unseen
        into = table.sum(0)
        share = (into + ADD) / (into.sum() + ADD * (c + 2))
        step = np.log10((table + 5 * share[None, :]) / (table.sum(1, keepdims=True) + 5))
        return Model(self.known, self.sizes, self.members, self.once, self.train_tokens, self.vocabulary, self.ends, step)


def most_frequent(words: DataFrame, most: int) -> list[tuple]:
    """About the ``most`` most frequent rows (word, n, ...), by n and then in order.

    The count to cut at comes from a histogram (eight cells an octave), so no task sends more than it must; of the
    cell at the cut, words are chosen by hash, ``most`` in expectation.
    """
    cell = F.floor(F.log2(F.col("n").cast("double")) * 8)
    sizes = sorted(((r["cell"], r["words"]) for r in words.groupBy(cell.alias("cell")).agg(F.count("*").alias("words")).collect()), reverse=True)
    left, cut, part = most, -1, 0.0
    for at, size in sizes:
        if size > left:
            cut, part = at, left / size
            break
        left -= size
    kept = words.filter((cell > cut) | ((cell == cut) & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < part * (1 << 20))))
    return sorted(((bytes(r[0]), *r[1:]) for r in kept.collect()), key=lambda x: (-x[1], x[0]))


def learn(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model without its transitions, and the table of all training words (word, n, class)."""
    spark = docs.sparkSession
    ship(spark)
    learnt = docs.filter(~held_out()).select("text")
    counted = materialize(count_words(learnt), "words")
    top = most_frequent(counted, CLUSTERED)
    discard(counted)
    clustered = [w for w, _ in top]
    pairs = count_pairs(learnt, clustered)
    label = exchange(pairs)
    c = int(label[-2])
    one = np.zeros((len(label), c + 2))
    one[np.arange(len(label)), label] = 1
    class_of = {w: int(k) for w, k in zip(clustered, label, strict=False)}
    others = assigned(contexts(learnt, class_of, c), one.T @ pairs @ one)
    frequent = spark.createDataFrame([(bytearray(w), n, class_of[w]) for w, n in top], "word binary, n long, class int")
    words = materialize(others.unionByName(frequent), "classed")
    sizes, members, once = np.zeros(c + 2), np.zeros(c + 2), 0
    for r in words.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words"), F.count_if(F.col("n") == 1).alias("once")).collect():
        sizes[r["class"]], members[r["class"]], once = r["n"], r["words"], once + r["once"]
    ends = int(pairs[-1].sum())
    known = {w: (k, n) for w, n, k in most_frequent(words, KNOWN)}
    return Model(known, sizes, members, once, int(sizes.sum()) + ends, int(members.sum()) + (ends > 0), ends), words


@functools.lru_cache(2)
def _loaded(data: bytes) -> tuple[Model, dict]:
    model = pickle.loads(data)
    words = list(model.known)
    at, n = (np.array([model.known[w][k] for w in words], np.int64) for k in (0, 1))
    emitted, base = model.emission(n, at).tolist(), model.base(n).tolist()
    return model, {w: x for w, x in zip(words, zip(at.tolist(), emitted, base, strict=True), strict=True)}


OPEN = 255  # in a path: a word whose class is still to be joined
FIRST = "row long, doc_id long, n_tokens long, n_known long, base_score double, emitted double, path binary, places binary, words array<binary>"
PATHS = "doc_id long, n_tokens long, n_known long, base_score double, emitted double, path binary"


def encode(docs: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, emitted (log10 emissions), path (a class a token, ends around) of every row.

    A first pass knows the KNOWN most frequent words where the text is read, and leaves a row's other words with their
    places; these meet their classes in a join, and are put in by row.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(pickle.dumps(model))  # KNOWN entries

    def names(schema):
        return [x.split()[0] for x in schema.split(", ")]

    def begin(batches):
        model, get = _loaded(shared.value)
        end, nothing = len(model.sizes) - 1, (OPEN, 0.0, 0.0)
        end_base = float(model.base(model.ends))
        for batch in batches:
            out = []
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ws = tokens(text.as_py())
                classes, emitted, base = zip(*map(get.get, ws, repeat(nothing)), strict=True) if ws else ((), (), ())
                path = bytes((end, *classes, end))
                index: dict[bytes, int] = {}
                places = [index.setdefault(ws[i], len(index)) for i in np.flatnonzero(np.frombuffer(path, np.uint8)[1:-1] == OPEN).tolist()] if OPEN in classes else []
                out.append((row, doc_id, len(ws) + 1, len(ws) - len(places) + (model.ends > 0), sum(base) + end_base, sum(emitted), path, np.array(places, np.int32).tobytes(), list(index)))
            columns = list(zip(*out, strict=True)) if out else [()] * 9
            kinds = [pa.int64()] * 4 + [pa.float64()] * 2 + [pa.binary()] * 2 + [pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names(FIRST))

    def finish(batches):
        model, _ = _loaded(shared.value)
        unseen = len(model.sizes) - 2
        for batch in batches:
            paths, known, base, emitted = [], *(batch.column(c).to_pylist() for c in (2, 3, 4))
            for r in range(batch.num_rows):
                path = np.frombuffer(batch.column(5)[r].as_buffer(), np.uint8)
                found = batch.column(7)[r]
                if found.is_valid:
                    got = found.values
                    place, n, at = (got.field(c).to_numpy(zero_copy_only=False) for c in (0, 1, 2))
                    n, at = n[np.argsort(place)], np.where(at < 0, unseen, at)[np.argsort(place)]
                    places = np.frombuffer(batch.column(6)[r].as_buffer(), np.int32)
                    path = path.copy()
                    path[path == OPEN] = at[places]
                    times = np.bincount(places, minlength=len(n))
                    known[r] += int(times[n > 0].sum())
                    base[r] += float(times @ model.base(n))
                    emitted[r] += float(times @ model.emission(n, at))
                paths.append(path.tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(emitted, pa.float64()), pa.array(paths, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names(PATHS))

    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    first = materialize(rows.select("row", "doc_id", "text").mapInArrow(begin, FIRST), "first")
    asked = first.select("row", F.posexplode("words").alias("place", "word"))
    met = asked.join(words, "word", "left").select("row", F.struct("place", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("class", F.lit(-1)).alias("class")).alias("w"))
    per = met.groupBy("row").agg(F.collect_list("w").alias("found"))  # as many as the row's own text has
    whole = first.join(per, "row", "left").select("doc_id", "n_tokens", "n_known", "base_score", "emitted", "path", "places", "found")
    out = materialize(whole.mapInArrow(finish, PATHS), "paths")
    discard(first)
    return out


def count_steps(paths: DataFrame, classes: int) -> np.ndarray:
    """How often each class follows each other: classes squared cells from all tasks."""

    def run(batches):
        cells = np.zeros(classes * classes, np.int64)
        for batch in batches:
            for path in batch.column(0):
                p = np.frombuffer(path.as_buffer(), np.uint8).astype(np.intp)
                cells += np.bincount(p[:-1] * classes + p[1:], minlength=classes * classes)
        found = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(cells[found])], ["cell", "n"])

    table = np.zeros(classes * classes, np.int64)
    for r in paths.select("path").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        table[r["cell"]] = r["n"]
    return table.reshape(classes, classes)


def scored(paths: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``encode``'s."""
    step = model.step
    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double"

    def run(batches):
        for batch in batches:
            walks = [np.frombuffer(p.as_buffer(), np.uint8) for p in batch.column(5)]
            score = [e + float(step[w[:-1], w[1:]].sum()) for e, w in zip(batch.column(4).to_pylist(), walks, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(score, pa.float64())], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    out = paths.mapInArrow(run, schema)
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score")


def train(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model with its transitions, and the table of all training words."""
    model, words = learn(docs)
    return model.with_steps(count_steps(encode(docs.filter(~held_out()), model, words), len(model.sizes))), words


def score(docs: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """The scores of ``docs`` under a trained model."""
    return scored(encode(docs, model, words), model)


def train_and_score(docs: DataFrame) -> DataFrame:
    """The scores of ``docs`` under the model that its own training rows give: texts are encoded once."""
    model, words = learn(docs)
    paths = encode(docs, model, words)
    return scored(paths, model.with_steps(count_steps(paths.filter(~held_out()), len(model.sizes))))
