import pickle
import zlib

import numpy as np

from textloom.llm import langid

WORDS = {"xx": ["zogar", "zomig", "zoka", "gozo", "mizog"], "yy": ["phela", "lephi", "alphe", "phip", "helph"]}


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    p = {k: w.astype(np.float64) for k, w in langid.fresh(3, rng).items()}
    x, y = np.array([list(w) for w in (b"abc d", b"hello", b"zz, l")]).T, np.array([0, 2, 1])
    _, g = langid.gradients(p, x, y)
    for k in p:
        at = (ord("l"), 3) if k == "E" else tuple(rng.integers(0, n) for n in p[k].shape)
        up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
        up[k][at] += 1e-4
        down[k][at] -= 1e-4
        slope = (langid.gradients(up, x, y)[0] - langid.gradients(down, x, y)[0]) / 2e-4
        assert abs(slope - g[k][at]) < 1e-4


def test_cases(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(WORDS[lang], 30)), lang, None) for i in range(80) for lang in [("xx", "yy")[i % 2]]]
    odd = [(100, None, "xx", "a"), (101, "", "xx", None), (102, "12 !? 3", "yy", None), (103, "zogar" * 5000, None, None), (103, "zogar" * 5000, None, None), (None, "phela lephi", None, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    model = langid.train(docs)
    got = langid.identify(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert np.mean([by[i].lang_pred == lang for i, _, lang, _ in rows if by[i].held_out]) > 0.9
    assert [by[i].lang_pred for i in (100, 101, 102, 103, None)] == ["und", "und", "und", "xx", "yy"]
    kept = langid.accept(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {103, None} and not {100, 101, 102} & {r.doc_id for r in kept.collect()}
    empty = docs.limit(0)
    assert langid.identify(empty, langid.train(empty)).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, langid.train(docs.withColumn("lang", docs.lang.substr(9, 1)).filter("lang is null"))).collect()} == {"und"}


def plainly(p, raw: bytes, d: str) -> list[np.ndarray]:
    """States of one direction, a byte and a gate at a time."""
    n, h, out = langid.HIDDEN, np.zeros(langid.HIDDEN), []
    squash = lambda v: v / (1 + abs(v))
    for byte in raw if d == "f" else raw[::-1]:
        a, c = (p["E"] @ p[f"W{d}"] + p[f"c{d}"])[byte], h @ p[f"U{d}"]
        z, r = (0.5 + 0.5 * squash(a[i * n : (i + 1) * n] + c[i * n : (i + 1) * n]) for i in range(2))
        h = (1 - z) * h + z * squash(a[2 * n :] + r * c[2 * n :])
        out.append(h)
    return out if d == "f" else out[::-1]


def test_pooled_probabilities_are_those_of_a_plain_recomputation(monkeypatch):
    p = langid.fresh(3, np.random.default_rng(5))
    labeller = langid.Labeller(pickle.dumps((["a", "b", "c"], p)))
    texts = ["Éa b", "zogar, 12 phela! " * 40, None, "12", "x" * langid.SPAN, ("ß " * 3000) + "q"]
    got = list(labeller.predict(texts))
    for text, (lang, score) in zip(texts, got, strict=True):
        if not text or not any(map(str.isalpha, text)):
            assert (lang, score) == ("und", 0.0)
            continue
        raw, sums, n = text.lower().encode(), np.zeros(3), 0
        for at in range(0, len(raw), langid.SPAN):
            room = (bytes(langid.MARGIN) + raw + bytes(langid.SPAN + langid.MARGIN))[at : at + langid.SPAN + 2 * langid.MARGIN]
            states = np.concatenate([plainly(p, room, d) for d in "fb"], 1)[langid.MARGIN : langid.MARGIN + langid.SPAN]
            for byte, state in zip(room[langid.MARGIN :], states, strict=False):
                if byte >= 128 or chr(byte).isalpha():
                    e = np.exp(state @ p["V"] + p["v"])
                    sums, n = sums + e / e.sum(), n + 1
        assert lang == "abc"[int(sums.argmax())] and abs(score - sums.max() / n) < 1e-5
    monkeypatch.setattr(langid, "BLOCK", 3)  # windows of other texts in the same block change nothing
    assert [g[0] for g in labeller.predict(texts)] == [g[0] for g in got]
    assert np.allclose([g[1] for g in labeller.predict(texts)], [g[1] for g in got], atol=2e-6)


def test_ties_go_to_the_first_language():
    p = langid.fresh(2, np.random.default_rng(5))
    p["V"][:, 1], p["v"][:] = p["V"][:, 0], 0
    assert list(langid.Labeller(pickle.dumps((["m", "n"], p))).predict(["abc", "x"])) == [("m", 0.5), ("m", 0.5)]
