import numpy as np

from textloom.llm import mixing

RNG = np.random.default_rng(6)
WORDS = {0: ["apple", "berry", "cedar"], 1: ["zzz", "qqq", "xxx"], 2: ["scum", "trash", "moron"]}


def corpus(n=240):
    kinds = [i % 3 for i in range(n)]
    return [(i, " ".join(RNG.choice([*WORDS[k], "the", "of"], 20 + i % 30))) for i, k in enumerate(kinds)], [(i, int(k == 0), int(k == 2)) for i, k in enumerate(kinds) if i % 2 == 0]


def test_rates_are_the_least_squares(spark):
    p = RNG.dirichlet([0.5, 0.5, 0.5], 200)
    n = RNG.integers(1, 100, 200)
    rows = spark.createDataFrame([(i, int(n[i]), *map(float, p[i])) for i in range(200)], "doc_id long, n_tokens long, p_high double, p_low double, p_toxic double")
    now = (n[:, None] * p).sum(0)
    for want, least in (([1.5, 0.7, 0.4], 0.0), ([0.2, 2.0, 0.0], 0.0), ([1.4, 1.3, 0.9], 1.0)):
        targets = (now * want).tolist()
        fitted, totals = mixing.rates(rows, targets, f"{least}D")
        r = np.array([x.rate for x in fitted.orderBy("doc_id").collect()])
        assert (r >= least).all()
        # the same least squares by many plain projected steps
        a = n[:, None] * p / n.sum()
        step = 1 / np.linalg.eigvalsh((n[:, None, None] * p[:, :, None] * p[:, None, :]).sum(0) / n.sum())[-1]
        plain = np.maximum(1.0, least) * np.ones(200)
        goal = np.array(targets) / n.sum()
        for _ in range(60_000):
            plain = np.maximum(least, plain + step * p @ (goal - plain @ a))
        assert np.square(r @ a - goal).sum() <= np.square(plain @ a - goal).sum() + 1e-6
        assert np.allclose([x for _, x in totals.values()], r @ a * n.sum()) and np.allclose([t for t, _ in totals.values()], targets)


def test_floor_of_one_keeps_clean_rows(spark):
    docs, labels = corpus(90)
    docs += [(None, "apple cedar"), (None, None), (5, "berry the of"), (7, "")]
    table = spark.createDataFrame([(*d, "a", 1, 2) for d in docs], "doc_id long, text string, _id string, _again int, row int")
    out = mixing.mixed(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert out.columns == table.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert {d for i, d in enumerate(docs) if i >= 90 or i % 3 < 2} <= set(got) and set(got) <= set(docs)
    assert mixing.mixed(table.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_posteriors_are_the_softmax_of_summed_weights(spark):
    docs, labels = corpus(120)
    model = mixing.fit([t for _, t in docs], np.array([i % 3 for i, _ in docs]), 3)
    text = docs[4][1] + " unseen 12 unseen"
    found, shape = mixing.features(text)
    a = np.array([sum(model.w[model.words[w]][k] for w in found if w in model.words) + shape @ model.shape[:, k] for k in range(3)])
    assert np.allclose(model.posterior(text), np.exp(a) / np.exp(a).sum())


def test_mix(spark):
    docs, labels = corpus()
    docs += [(1000, None), (1001, ""), (1002, "apple " * 20_000), (5, docs[5][1])]
    table = spark.createDataFrame([(*d, 0.0) for d in docs], "doc_id long, text string, rate double")
    marks = spark.createDataFrame([*labels, (None, 1, 0), (5000, 0, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = mixing.mix(table, marks).collect()
    assert len(got) == len(docs)
    by = {r.doc_id: r for r in got}
    assert np.mean([by[i].domain == mixing.DOMAINS[i % 3] for i in range(240)]) > 0.95
    assert all(r.rate >= 0 and 0 <= r.copies - int(r.rate) <= 1 for r in got)
    totals = np.array([sum(r.n_tokens * r.rate * r[f"p_{d}"] for r in got) for d in mixing.DOMAINS])
    assert np.abs(totals / totals.sum() - mixing.WEIGHTS).max() < 1e-6
    assert all(r.gap < 1e-6 for r in got)
    assert mixing.mix(table.limit(0), marks).count() == 0
    assert {round(r.p_low, 6) for r in mixing.mix(table, marks.limit(0)).collect()} == {0.333333}
