import numpy as np

from textloom.llm import embeddup, hashforest

RNG = np.random.default_rng(8)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, n_links int")


def sample(n, d=12):
    centres = RNG.normal(size=(n // 5, d))
    return np.concatenate([centres, np.repeat(centres, 4, 0) + RNG.normal(size=(4 * (n // 5), d)) * RNG.choice([0.05, 0.4], (4 * (n // 5), 1))]).astype(np.float32)


ODD = [(9000, None), (9001, [0.0] * 12), (9002, [float("nan")] + [1.0] * 11), (9003, [None] + [1.0] * 11), (9004, [float("inf")] * 12), (9005, []), (9006, [3.0, 4.0]), (9007, [6.0, 8.0])]


def test_links_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embeddup, "BLOCK", 64)
    x = sample(300)
    x[10:40] = x[10]
    rows = [(i * 3, v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in embeddup.classes(table(spark, rows + ODD)).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = (u @ u.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    root = embeddup.least_reachable(len(x), *np.nonzero(link))
    for i in range(len(x)):
        r = got[i * 3]
        assert (r.n_links, r.component_id, r.kept) == (link[i].sum(), 3 * root[i], root[i] == i)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(9000, 9006))
    assert (got[9007].component_id, got[9007].n_links) == (9006, 1)
    assert embeddup.classes(table(spark, rows).limit(0)).count() == 0
    assert embeddup.classes(table(spark, ODD[:5])).count() == 5


def test_search_against_all(spark, monkeypatch):
    monkeypatch.setattr(hashforest, "BLOCK", 256)
    x = np.concatenate([sample(1000) * RNG.uniform(0.2, 2, (1000, 1)), np.ones((30, 12))]).astype(np.float32)
    rows = table(spark, [(i, v.tolist()) for i, v in enumerate(x)] + [o for o in ODD if o[0] != 9000])
    got = hashforest.search(rows.filter("vec_id % 20 = 0"), rows, 20).collect()
    full = np.zeros((len(x) + 2, 12))
    full[: len(x)] = x
    full[len(x) :, :2] = [[3, 4], [6, 8]]
    ids = np.array([*range(len(x)), 9006, 9007])
    hits, asked = 0, [i for i in ids if i % 20 == 0]
    for q in asked:
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        score = full @ full[list(ids).index(q)]
        want = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:20]
        assert [r for r, _, _ in mine] == list(range(1, 21)) and q not in {v for _, v, _ in mine}
        assert all(abs(s - score[list(ids).index(v)]) < 1e-12 for _, v, s in mine)
        assert [(-s, v) for _, v, s in mine] == sorted((-s, v) for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & set(ids[want]))
    assert {r.query_id for r in got} == set(asked)
    assert hits / (20 * len(asked)) >= 0.9
    few = rows.filter("vec_id < 5")
    assert hashforest.search(few.filter("vec_id = 0"), few, 20).count() == 4
    assert hashforest.search(few.limit(0), few, 20).count() == 0 and hashforest.search(few, few.limit(0), 20).count() == 0


def test_recall_with_production_parameters():
    """Of the 20 nearest, on vectors spread evenly over 64 dimensions: the hardest kind. Part of each block ranked."""
    for n, most in ((500, 0.55), (2000, 0.45), (8192, 0.4)):
        x = np.random.default_rng(n).normal(size=(n, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        ids, asked, ranked, hits = np.arange(n), np.arange(0, n, max(20, n // 100)), [], 0
        forest = hashforest.Forest(x, 1.0, hashforest.rotations(64))
        for q, got, _ in hashforest.best(x[asked], asked, forest, ids, 20, count=ranked):
            score = x @ x[q]
            score[q] = -9
            hits += len(set(got) & set(np.argsort(-score)[:20]))
        assert hits >= 0.9 * 20 * len(asked) and np.mean(ranked) <= most * n, (n, hits / 20 / len(asked), np.mean(ranked) / n)


def test_repeated_ids_ask_and_answer_once(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.0, 0.9]), (3, [-1.0, 0.0]), (None, [1.0, 0.0])]
    got = hashforest.search(table(spark, rows).filter("vec_id = 0"), table(spark, rows), 20).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, 0.9), (0, 3, 3, 0.0)]
    dup = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddup.classes(table(spark, rows[:-1])).collect()}
    assert dup == {(0, 3, 0, True), (0, 1, 0, True), (1, 3, 0, False), (2, 1, 0, False), (3, 0, 3, True)}


def test_tiles_move_no_blocks(spark, monkeypatch):
    """Blocks are read where they are: shuffling both sides of every tile took disk as the square of the rows."""
    monkeypatch.setattr(embeddup, "BLOCK", 8)
    monkeypatch.setattr(embeddup, "TASKS", 3, raising=False)
    x = sample(300)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    plans, write = [], embeddup.materialize
    monkeypatch.setattr(embeddup, "materialize", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or write(df, name))
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddup.classes(rows).collect()}
    assert "Exchange" not in dict(plans)["tiles"] and not any("embedding" in plan for name, plan in plans if name in ("per", "names"))
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = (u @ u.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    root = embeddup.least_reachable(len(x), *np.nonzero(link))
    assert got == {i: (link[i].sum(), root[i]) for i in range(len(x))}


def test_large_group_of_near_copies_gives_few_rows(spark, monkeypatch):
    """A row for each tile that a node links in made rows as the square of a group; a task's tiles are merged."""
    monkeypatch.setattr(embeddup, "BLOCK", 4)
    monkeypatch.setattr(embeddup, "TASKS", 1, raising=False)
    x = (np.ones((200, 12)) + RNG.normal(size=(200, 12)) * 0.01).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    made, write = {}, embeddup.materialize

    def counted(df, name):
        out = write(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(embeddup, "materialize", counted)
    for held in (500_000, 150, 900):
        monkeypatch.setattr(embeddup, "HELD", held, raising=False)
        assert {(r.n_links, r.component_id) for r in embeddup.classes(rows).collect()} == {(199, 0)}
        assert held == 150 or made["tiles"] <= 200 * 50 / 4
