import math
import zlib
from collections import Counter

import numpy as np

from textloom.llm import brown


def likelihood(pairs, label):
    n = label.max() + 1
    table = np.zeros((n, n))
    np.add.at(table, (label[:, None].repeat(len(label), 1), label[None, :].repeat(len(label), 0)), pairs)
    f = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1)), 0).sum()
    return f(table) - f(table.sum(1)) - f(table.sum(0))


def test_exchange_only_stops_where_no_move_helps():
    rng = np.random.default_rng(4)
    pairs = rng.poisson(1.0, (14, 14)) + 3 * rng.poisson(1.0, (14, 14)) * (np.arange(14)[:, None] % 3 == (np.arange(14)[None, :] + 1) % 3)
    label = brown.exchange(pairs, 3)
    best = likelihood(pairs, label)
    start = np.concatenate([np.arange(12) % 3, [3, 4]])
    assert best >= likelihood(pairs, start)
    for w in range(12):
        for c in range(3):
            other = label.copy()
            other[w] = c
            assert likelihood(pairs, other) <= best + 1e-6


def plain_base(rows):
    train = [r for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 10]
    words = lambda t: (t or "").encode().lower().split()
    count = Counter(w for _, t in train for w in words(t))
    n, v = sum(count.values()) + len(train), len(count) + bool(train)
    out = []
    for i, t in rows:
        cs = [count[w] for w in words(t)] + [len(train)]
        out.append((i, len(cs), sum(c > 0 for c in cs), n, sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in cs)))
    return out


def test_query_against_plain(spark, monkeypatch):
    monkeypatch.setattr(brown, "KNOWN", 12)
    monkeypatch.setattr(brown, "CLUSTERED", 6)
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice([f"W{k}" for k in range(40)], rng.integers(0, 60)))) for i in range(60)]
    rows += [(200, None), (201, ""), (202, "É a b\tx\x0by " * 3000), (202, "É a b\tx\x0by " * 3000), (None, "w1 w2"), (10, "neverseen w1")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, score int")
    model, words = brown.train(docs)
    got = brown.score(docs, model, words).collect()
    key = lambda r: (str(r[0]), r[1], r[4])
    mine = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for a, b in zip(mine, sorted(plain_base(rows), key=key), strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9)
    table = {bytes(r.word): (r.n, r["class"]) for r in words.collect()}
    want = sorted((str(i), plain_score(t, table, [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10])) for i, t in rows)
    for (i, a), (j, b) in zip(sorted((str(r.doc_id), r.score) for r in got), want, strict=True):
        assert i == j and math.isclose(a, b, rel_tol=1e-9)
    assert sorted(brown.train_and_score(docs).collect(), key=str) == sorted(got, key=str)
    assert np.allclose((10**model.step).sum(1), 1)
    for c in range(len(model.sizes) - 2):
        assert math.isclose(sum((n + 0.1) / (model.sizes[c] + 0.1 * model.members[c]) for n, k in table.values() if k == c), 1) or not model.members[c]
    empty = docs.limit(0)
    assert brown.score(empty, *brown.train(empty)).count() == 0 and brown.train_and_score(empty).count() == 0
    assert brown.score(docs, *brown.train(empty)).filter("n_known > 0").count() == 0


def plain_score(text, table, train):
    """Word by word from the counts and classes of all words, every class pair counted anew."""
    c = max((k for _, k in table.values()), default=-1) + 1
    c = max(c, 6 if len(table) >= 6 else c)
    words = lambda t: (t or "").encode().lower().split()
    path = lambda t: [c + 1, *(table[w][1] if w in table else c for w in words(t)), c + 1]
    pairs = np.zeros((c + 2, c + 2))
    for t in train:
        p = path(t)
        for a, b in zip(p, p[1:], strict=False):
            pairs[a, b] += 1
    n_all = sum(n for n, _ in table.values()) + len(train)
    pairs[:, c] = pairs.sum(1) * (sum(n == 1 for n, _ in table.values()) + 0.1) / n_all
    share = (pairs.sum(0) + 0.1) / (pairs.sum() + 0.1 * (c + 2))
    p, out = path(text), 0.0
    for a, b in zip(p, p[1:], strict=False):
        out += math.log10((pairs[a, b] + 5 * share[b]) / (pairs[a].sum() + 5))
    for w in words(text):
        if w in table:
            n, k = table[w]
            mates = [m for m, j in table.values() if j == k]
            out += math.log10((n + 0.1) / (sum(mates) + 0.1 * len(mates)))
    return out


def test_rare_words_go_where_the_likelihood_rises_most():
    rng = np.random.default_rng(7)
    c, rare = 4, 9  # classes 0 to 3 hold fixed words, the shared class the rare ones, and an end
    n = c + rare + 1
    pairs = rng.poisson(3.0, (n, n)) * rng.integers(0, 2, (n, n))
    np.fill_diagonal(pairs, 0)
    label = np.array([*range(c), *[c] * rare, c + 1])
    one = np.eye(c + 2)[label]
    got = brown.gains(pairs[c : c + rare] @ one, (pairs.T @ one)[c : c + rare], one.T @ pairs @ one)
    for w in range(rare):
        moved = []
        for k in range(c):
            other = label.copy()
            other[c + w] = k
            moved.append(likelihood(pairs, other))
        assert np.allclose(got[w] - got[w][0], np.array(moved) - moved[0])


def test_every_training_word_has_a_class(spark, monkeypatch):
    monkeypatch.setattr(brown, "CLUSTERED", 40)
    rng = np.random.default_rng(3)
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice((a, b)[i % 2], 40, p=np.arange(60, 0, -1) / 1830))) for i in range(300)], "doc_id long, text string")
    _, words = brown.learn(docs)
    table = {bytes(r.word).decode(): (r.n, r["class"]) for r in words.collect()}
    count = Counter(w for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 10 for w in r.text.split())
    assert {w: n for w, (n, _) in table.items()} == count
    pure = [Counter(w[0] for w, (_, k) in table.items() if k == c) for c in range(brown.CLASSES)]
    assert sum(max(p.values(), default=0) for p in pure) >= 0.9 * len(table)


def test_most_frequent_is_bounded(spark):
    words = spark.range(5000).selectExpr("encode(concat('w', id), 'UTF-8') AS word", "1L + cast(id < 100 as int) AS n")
    got = brown.most_frequent(words, 600)
    assert all(n == 2 for _, n in got[:100]) and 450 < len(got) < 750
