"""Mixing documents to target weights of domains that each document belongs to in part.

A softmax regression over word weights and a few shape features, trained here on at most ``SAMPLE`` documents of the
labelled table, gives every document its posterior over the domains (``high`` and ``low`` quality, ``toxic``). Then
nonnegative rates r, one a document, are fitted so that the expected token totals of the domains,

    sum over documents of r * tokens * posterior,

meet the targets: least squares by projected gradient. In the metric that weighs a document by its tokens a gradient
is the same K residuals' product with every posterior, and the projection stays one of each rate by itself. So the
gradients of all rounds add up to K numbers, and a rate is the projection of its start plus their product with the
posterior: no round writes anything, and a round is one aggregation of K totals and the K x K moments of the rates
that are free. Each gradient is scaled by the inverse of these moments, which makes rounds few, and halved until the
objective falls. A pull towards the start of ``PULL`` of the tokens picks, of all rates that meet the targets, those
nearest to the start, and gives targets that can't be met the least squares. Rounds end where the scaled gradient is
below ``CLOSE`` of the tokens; ``rates`` returns targets and totals reached, and raises if ``ROUNDS`` don't suffice.

A rate is how many times a document should be read; ``copies`` rounds it, up with the probability of its fraction, by
a hash of the id and length, so that a rerun gives the same.

Cases: a null text or one without a word has no tokens, so it can't move a total: its rate still follows its
posterior; labels without a document, or null, are not learned from; of different labels for one id the more toxic,
then the lower counts; without labelled rows every posterior is even; a domain that no document can belong to leaves
its target unmet; equal rows get equal rates; texts of any length are read whole; rows with a null or repeated id are
rows of their own; an empty table gives an empty result; other columns are not read, and ``mixed`` returns them
whatever their names.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.runtime import discard, materialize, resident, ship

DOMAINS = ("high", "low", "toxic")
WEIGHTS = (0.70, 0.27, 0.03)
SAMPLE = 4000
SAMPLE_CHARS = 40_000_000
VOCABULARY = 1_000
EPOCHS = 12
ROUNDS = 60
CLOSE, PULL = 1e-9, 1e-8
SHAPES = 10
WORD = re.compile(r"\w+")


def features(text: str | None) -> tuple[list[str], np.ndarray]:
    """The distinct lower-cased words of a whole text, and its shape."""
    text = text or ""
    words = WORD.findall(text)
    found = set(map(str.lower, words))
    n, m, letters = max(1, len(text)), max(1, len(words)), sum(map(len, words))
    lines = text.split("\n")
    upper, spaces = sum(map(str.isupper, words)) / m, text.count(" ") / n
    shape = np.array([1.0, 2 * (letters / n), 2 * len(found) / m, 4 * upper, 4 * sum(map(str.isdigit, words)) / m, min(20.0, letters / m) / 20, len(set(lines)) / len(lines), 4 * (1 - letters / n - spaces), 1 / (1 + m / 20), 4 * sum(a == b for a, b in zip(words, words[1:], strict=False)) / m])
    return list(found), shape


class Classifier:
    """Softmax regression. A word's weight is a row of K numbers; a document's logits add those of its distinct words and its shape's."""

    def __init__(self, words: dict[str, int], w: np.ndarray, shape: np.ndarray) -> None:
        self.words, self.w, self.shape = words, w, shape

    def posterior(self, text: str | None) -> np.ndarray:
        found, shape = features(text)
        at = [i for i in map(self.words.get, found) if i is not None]
        return _softmax((self.w[at].sum(0) if at else 0) + shape @ self.shape)


def _softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(texts: list[str], y: np.ndarray, k: int, seed: int = 1) -> Classifier:
    """Words of two documents or more, the VOCABULARY with the most uneven counts over classes; Adagrad."""
    seen = [features(t) for t in texts]
    total: Counter = Counter()
    by: list[Counter] = [Counter() for _ in range(k)]
    for (found, _), c in zip(seen, y, strict=True):
        total.update(found)
        by[c].update(found)
    share = np.bincount(y, minlength=k) / max(1, len(y))
    uneven = lambda w: sum(abs(by[c][w] - total[w] * share[c]) for c in range(k)) / total[w] ** 0.5
    words = {w: i for i, w in enumerate(sorted((w for w, n in total.items() if n > 1), key=lambda w: (-uneven(w), w))[:VOCABULARY])}
    at = [np.array([i for i in map(words.get, found) if i is not None], np.intp) for found, _ in seen]
    shapes = np.array([s for _, s in seen]).reshape(len(seen), SHAPES)
    rng = np.random.default_rng(seed)
    w, v = np.zeros((len(words), k)), np.zeros((SHAPES, k))
    gw, gv = np.full((len(words), 1), 1e-2), np.full((SHAPES, 1), 1e-2)
    weight = (len(y) / (k * np.maximum(1, np.bincount(y, minlength=k)))) ** 0.5
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            p = _softmax((w[at[i]].sum(0) if len(at[i]) else 0) + shapes[i] @ v)
            p[y[i]] -= 1
            p *= weight[y[i]]
            gv += (shapes[i][:, None] * p).__pow__(2).sum(1, keepdims=True)
            v -= 0.3 * shapes[i][:, None] * p / np.sqrt(gv)
            if len(at[i]):
                gw[at[i]] += (p * p).sum()
                w[at[i]] -= 0.15 * (p / np.sqrt(gw[at[i]])) + 1e-5 * w[at[i]]
    return Classifier(words, w, v)


def train(docs: DataFrame, labels: DataFrame) -> bytes:
    """The pickled classifier, from a bounded, hash-chosen sample of the labelled documents."""
    ship(docs.sparkSession)
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1)
    marked = labels.select("doc_id", domain.alias("domain")).dropna().groupBy("doc_id").agg(F.max("domain").alias("domain"))
    counts = {r["domain"]: r["n"] for r in marked.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return pickle.dumps(None)
    share = F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, min(1.0, SAMPLE / len(counts) / n))])
    chosen = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.element_at(share, F.col("domain")) * (1 << 20))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "domain", "text")  # SAMPLE rows in expectation
    rows = materialize(rows.filter("text is not null").dropDuplicates(["doc_id"]), "labelled")
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    part = min(1.0, SAMPLE_CHARS / max(1, chars))
    sample = sorted(rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) < part * (1 << 20)).collect())
    discard(rows)
    return pickle.dumps(fit([r["text"] for r in sample], np.array([r["domain"] for r in sample], int), len(DOMAINS)) if sample else None)


P = [f"p_{d}" for d in DOMAINS]


def posteriors(docs: DataFrame, model: bytes, keep: str = "doc_id") -> DataFrame:
    """Column ``keep`` of ``docs``, n_tokens, and p_<domain> of each row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # VOCABULARY rows
    rows = docs.select(keep, "text")
    schema = f"{keep} {rows.schema[0].dataType.simpleString()}, n_tokens long, " + ", ".join(f"{p} double" for p in P)

    def run(batches):
        classifier = resident(pickle.loads, shared.value)
        even = np.full(len(DOMAINS), 1 / len(DOMAINS))
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            p = np.array([classifier.posterior(t) if classifier else even for t in texts]).reshape(len(texts), len(DOMAINS))
            n = pa.array([len(t.split()) if t else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, *[pa.array(p[:, k]) for k in range(len(DOMAINS))]], [keep, "n_tokens", *P])

    return rows.mapInArrow(run, schema)


def rates(rows: DataFrame, targets: list[float], least: str = "0.0D") -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """``rows`` with a rate each, at least ``least`` (an SQL expression), and (target, total reached) of each domain.

    rows: n_tokens and p_<domain>. targets: the token totals wanted, one a domain.
    """
    k, total = len(P), rows.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    low, start = F.expr(least), F.greatest(F.lit(1.0), F.expr(least))
    if not total:
        return rows.withColumn("rate", start), {d: (t, 0.0) for d, t in zip(DOMAINS, targets, strict=True)}
    want = np.array(targets, float) / total

    def free(pull):
        return start + sum((F.lit(float(g)) * F.col(p) for g, p in zip(pull, P, strict=True)), F.lit(0.0))

    def measured(pull):
        """(objective, gradient, moments of free rates, totals) at summed gradients ``pull``."""
        n, at = F.col("n_tokens") / float(total), free(pull)
        rate, loose = F.greatest(low, at), n * (at > low).cast("double")
        sums = [F.sum(n * (rate * at - rate * rate / 2))] + [F.sum(n * rate * F.col(p)) for p in P]
        sums += [F.sum(loose * F.col(p) * F.col(q)) for i, p in enumerate(P) for q in P[i:]]
        got = np.array(rows.agg(*sums).first(), float)
        moments = np.zeros((k, k))
        moments[np.triu_indices(k)] = got[k + 1 :]
        moments = np.maximum(moments, moments.T) + PULL * np.eye(k)
        reached = got[1 : k + 1]
        return got[0] + PULL / 2 * pull @ pull - want @ pull, want - reached - PULL * pull, moments, reached

    pull = np.zeros(k)
    value, gradient, moments, reached = measured(pull)
    for _ in range(ROUNDS):
        move = np.linalg.solve(moments, gradient)
        if np.abs(gradient).max() <= CLOSE or gradient @ move <= CLOSE**2:
            break
        part = 1.0
        while True:
            after = measured(pull + part * move)
            if after[0] <= value - 1e-4 * part * (gradient @ move) + 1e-15 * max(1.0, abs(value)) or part < 1e-6:
                break
            part /= 2
        pull, (value, gradient, moments, reached) = pull + part * move, after
    else:
        raise ArithmeticError(f"residual {np.abs(gradient).max()} after {ROUNDS} rounds")
    return rows.withColumn("rate", F.greatest(low, free(pull))), {d: (float(t), float(r * total)) for d, t, r in zip(DOMAINS, targets, reached, strict=True)}


def copies():
    """Column rate as a whole number: up with the probability of its fraction, by a hash of doc_id and n_tokens."""
    toss = F.pmod(F.xxhash64(F.lit("mix"), "doc_id", "n_tokens"), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(F.col("rate") + toss).cast("long")


def domain_totals(rows: DataFrame) -> list[float]:
    return list(rows.agg(*[F.coalesce(F.sum(F.col("n_tokens") * F.col(p)), F.lit(0.0)) for p in P]).first())


def mix(docs: DataFrame, labels: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """doc_id, n_tokens, p_<domain>, domain (the likeliest), rate, copies, gap of every row.

    Target totals are ``weights`` of all tokens; gap is the largest difference of a total reached, as a share of them.
    """
    rows = materialize(posteriors(docs, train(docs, labels)), "posteriors")
    size = sum(domain_totals(rows))
    fitted, totals = rates(rows, [size * w for w in weights])
    gap = max(abs(t - r) for t, r in totals.values()) / max(1.0, size)
    named = F.array_max(F.array(*[F.struct(F.col(f"p_{d}").alias("p"), F.lit(d).alias("d")) for d in DOMAINS]))["d"]
    return fitted.select("doc_id", "n_tokens", *P, named.alias("domain"), "rate", copies().alias("copies"), F.lit(gap).alias("gap"))


def mixed(docs: DataFrame, labels: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """``docs`` with each row as many times as its copies say. All columns, in their order, whatever their names.

    Documents that are likelier clean than toxic are read once at least, so only toxic ones are thinned; target totals
    are as small as lets neither clean domain be read less than once.
    """
    model = train(docs, labels)
    rows = materialize(posteriors(docs.select("text", F.struct(*docs.columns).alias("row")), model, "row"), "posteriors")
    size = max(t / w for t, w in zip(domain_totals(rows)[:2], weights[:2], strict=True))
    fitted, _ = rates(rows, [size * w for w in weights], "CASE WHEN p_toxic < 0.5 THEN 1.0D ELSE 0.0D END")
    times = fitted.select("row", F.col("row.doc_id").alias("doc_id"), "n_tokens", "rate").select("row", F.greatest(copies(), F.lit(0)).cast("int").alias("times"))
    return times.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("row.*")
