import random
from collections import Counter
from itertools import pairwise

import numpy as np
from pyspark.sql import functions as F

from textloom.llm import neardup
from textloom.llm.components import components

RNG = random.Random(3)
VOCABULARY = [f"{a}{b}" for a in "qwertzuiop" for b in "asdfghjkl"]


def prose(n):
    return [RNG.choice(VOCABULARY) for _ in range(n)]


def edited(words, n):
    words = list(words)
    for _ in range(n):
        words[RNG.randrange(len(words))] = RNG.choice(VOCABULARY)
    return words


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 10), (20, 21), (5, 5), (2, 1)] + [(100 + i, 100 + i + 1) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 10: 8, 20: 20, 21: 20} | {100 + i: 100 for i in range(41)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_alignment_is_order_keeping_jaccard():
    with np.errstate(over="ignore"):
        words = prose(200)
        a = neardup.kmers(" ".join(words))
        assert neardup.aligned(a, a) == 1
        b = neardup.kmers(" ".join(words[:100] + ["new"] + words[100:]))
        assert abs(neardup.aligned(a, b) - 192 / (196 + 197 - 192)) < 1e-9
        swapped = neardup.kmers(" ".join(words[100:] + words[:100]))
        assert neardup.aligned(a, swapped) == 0
        assert neardup.aligned(neardup.kmers("a b"), neardup.kmers("a  B!")) == 1
        repeated = neardup.kmers("x " * 50)
        assert len(set(repeated.tolist())) == len(repeated) == 46


def test_classes_against_all_pairs(spark):
    docs, base = [], [prose(RNG.randrange(8, 300)) for _ in range(60)]
    for words in base:
        docs += [words, edited(words, 1), edited(words, max(1, len(words) // 60)), edited(words, len(words) // 8 + 1), words + prose(len(words) // 5)]
    hot = prose(120)
    docs += [hot] * 40 + [edited(hot, 1) for _ in range(60)]
    docs += [prose(3) for _ in range(5)] + [prose(4)] * 2
    rows = [(i, " ".join(w), "x") for i, w in enumerate(docs)]
    rows += [(9001, None, "x"), (9002, None, "x"), (9003, "", "x"), (9004, "", "x"), (9005, "?!", "x"), (9006, "w " * 20_000, "x"), (9007, "w " * 20_000 + "v", "x"), (9006, "w " * 20_000, "x"), (None, "alone by itself", "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_links string")
    got = {r.doc_id: r for r in neardup.classes(table).collect()}
    with np.errstate(over="ignore"):
        grams = {i: neardup.kmers(t) for i, t, _ in rows if i is not None and t}
    want, degree = plain(grams)
    assert {i: (got[i].class_id, got[i].n_links) for i in want} == {i: (want[i], degree[i]) for i in want}
    assert got[9001].class_id == 9001 and got[9002].class_id == 9002 and got[9004].class_id == 9003 and got[9005].class_id == 9005
    kept = neardup.keep_one(table)
    assert kept.columns == table.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.class_id for r in {r.class_id: r for r in got.values()}.values())
    assert neardup.classes(table.limit(0)).count() == 0 and neardup.keep_one(table.limit(0)).count() == 0


def plain(grams):
    """Class and number of links to other texts of each id, from all pairs."""
    ids = [i for i in grams if len(grams[i])]
    root, others = {i: i for i in ids}, {i: set() for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if neardup.aligned(grams[i], grams[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
                x, y = grams[i].tobytes(), grams[j].tobytes()
                if x != y:
                    others[i].add(y)
                    others[j].add(x)
    return {i: find(i) for i in ids}, {i: len(others[i]) for i in ids}


def test_tile_counts_every_pair_once():
    rng = np.random.default_rng(5)
    with np.errstate(over="ignore"):
        texts = [" ".join(edited(hot, e)) for hot in (prose(90), prose(60)) for e in rng.integers(0, 6, 25)]
        texts += [" ".join(w[40:] + w[:40]) for w in [prose(80)]] + ["x y z " * 30, "x y z " * 28]
        grams = [neardup.kmers(t) for t in texts]
    n, side = len(grams), np.arange(len(grams)) % 2
    link = np.array([[i != j and neardup.aligned(grams[i], grams[j]) >= 0.8 for j in range(n)] for i in range(n)])
    counts, label = neardup.tile_links(grams, np.empty((n, 0), np.int64), None)
    assert counts.tolist() == link.sum(1).tolist() and all(label[i] == label[j] for i, j in zip(*np.nonzero(link), strict=True))
    assert neardup.tile_links(grams, np.empty((n, 0), np.int64), side)[0].tolist() == (link & (side[:, None] != side[None, :])).sum(1).tolist()
    earlier = np.stack([np.arange(n) // 4, -np.arange(n)], 1)
    assert neardup.tile_links(grams, earlier, None)[0].tolist() == (link & (earlier[:, None, 0] != earlier[None, :, 0])).sum(1).tolist()


def test_links_of_large_groups_are_counted_exactly(spark, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", 16)
    docs = [edited(hot, 1) for hot in (prose(150), prose(90)) for _ in range(100)]
    for _ in range(12):  # twelve copies, and two texts that are alike but not both like the copies
        copy = prose(200)
        docs += [edited(copy, 1) for _ in range(12)] + [edited(copy, 3), edited(copy, 5)]
    texts = {i: " ".join(w) for i, w in enumerate(docs)}
    with np.errstate(over="ignore"):
        want, degree = plain({i: neardup.kmers(t) for i, t in texts.items()})
    got = {r.doc_id: r for r in neardup.classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert {i: got[i].class_id for i in want} == want
    missed = sum(degree.values()) - sum(r.n_links for r in got.values())
    assert 0 <= missed <= 0.001 * sum(degree.values())  # pairs at the threshold that share no key
    assert sum(degree.values()) > 10_000


def test_rows_without_ids_and_clashing_names(spark):
    words = prose(80)
    rows = [(None, " ".join(words)), (None, " ".join(edited(words, 1))), (5, "one text"), (5, "another text"), (None, "third text"), (5, "one text"), (None, None), (7, None), (7, None), (8, None)]
    table = spark.createDataFrame([(*r, i, "a", {"k": "v"}) for i, r in enumerate(rows)], "doc_id long, text string, node int, copy string, row map<string,string>")
    got = neardup.keep_one(table)
    assert got.columns == table.columns
    kept = sorted(r.node for r in got.collect())
    assert kept[1:] == [2, 3, 4, 6, 7, 9] and kept[0] in (0, 1)
    again = neardup.keep_one(table.orderBy(F.desc("node")))
    assert sorted(r.node for r in again.collect()) == kept
    assert {r.n_links for r in neardup.classes(table).filter("doc_id is null").collect()} == {0, 1}


def test_large_bucket_without_links_is_finished(spark):
    shared = prose(30)
    with np.errstate(over="ignore"):
        texts = [" ".join(prose(3) + shared + prose(3)) for _ in range(30)]
        assert all(neardup.aligned(neardup.kmers(a), neardup.kmers(b)) < 0.8 for a, b in pairwise(texts))
    got = neardup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert all(r.class_id == r.doc_id and r.n_links == 0 for r in got.collect())


def test_copies_of_copies_in_a_large_group(spark):
    rng = random.Random(11)
    fresh = (f"n{i}" for i in range(10_000))

    def changed(words, at):
        return [next(fresh) if i in at else w for i, w in enumerate(words)]

    docs = [[f"w{i}" for i in range(300)]]
    for _ in range(30):
        copy = changed(docs[0], {299})
        docs += [copy, changed(copy, {1, *(rng.randrange(10 + 45 * i, 45 + 45 * i) for i in range(6))})]
    texts = [" ".join(w) for w in docs]
    with np.errstate(over="ignore"):
        grams = [neardup.kmers(t) for t in texts]
    assert all(neardup.aligned(grams[i], grams[i + 1]) >= 0.8 for i in range(1, 61, 2))
    assert all(neardup.aligned(grams[0], grams[i]) < 0.8 for i in range(2, 61, 2))
    got = neardup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


def test_texts_of_one_block_are_compared_in_one_tile(spark, monkeypatch):
    """Few long texts in many blocks: the tiles that only one side's texts reach compare nothing."""
    monkeypatch.setattr(neardup, "TILE_KMERS", 300)
    base = [prose(400) for _ in range(12)]
    rows = [(10 * i + j, " ".join(edited(words, j)), "") for i, words in enumerate(base) for j in range(3)]
    got = {r.doc_id: r for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string, x string")).collect()}
    with np.errstate(over="ignore"):
        want, degree = plain({i: neardup.kmers(t) for i, t, _ in rows})
    assert {i: (r.class_id, r.n_links) for i, r in got.items()} == {i: (want[i], degree[i]) for i in want}


def test_partners_looked_up_in_parts(monkeypatch):
    with np.errstate(over="ignore"):
        words = prose(150)
        grams = [neardup.kmers(" ".join(edited(words, k % 4))) for k in range(30)]
    whole = neardup.tile_links(grams, np.empty((30, 0), np.int64), None)
    monkeypatch.setattr(neardup, "AT_ONCE", 200)
    parts = neardup.tile_links(grams, np.empty((30, 0), np.int64), None)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert neardup.tile_links(grams, np.empty((30, 0), np.int64), np.ones(30, np.int64))[0].sum() == 0
