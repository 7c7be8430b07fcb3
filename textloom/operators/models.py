"""Models as interfaces, with defaults that need no files: a sentence splitter, a dictionary recogniser, a hashing encoder.

An encoder is any picklable object with ``size`` and ``encode(list of texts) -> array``; recognisers and splitters
likewise. Each Python process builds one (``load`` is called where the rows are).
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators.chunks import SurfaceMatcher
from textloom.runtime import ship

GAP = re.compile(r"(?<=[.!?])\s+(?=[A-Za-z0-9(\[])")


class RuleSplitter:
    """Sentences between the gaps that ``functions.text.sentences`` cuts at."""

    def split(self, text: str) -> list[str]:
        flat = " ".join(text.split())
        starts, stops = [0], []
        for gap in GAP.finditer(flat):
            stops.append(gap.start())
            starts.append(gap.end())
        return [flat[a:b] for a, b in zip(starts, [*stops, len(flat)], strict=True) if a < b]


class DictionaryRecognizer:
    """(surface, kind) pairs; finds the longest leftmost ones, whatever the case."""

    def __init__(self, kinds: dict[str, str]) -> None:
        self.kinds = {k.lower(): v for k, v in kinds.items()}
        self.matcher = SurfaceMatcher(self.kinds)

    def find(self, text: str) -> list[tuple[int, int, str]]:
        return [(a, b, self.kinds[text[a:b].lower()]) for a, b in self.matcher.find(text)]


class HashingEncoder:
    """Words and their letter trigrams hashed into ``size`` signed cells, length 1."""

    def __init__(self, size: int = 64) -> None:
        self.size = size

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.size), np.float32)
        for row, text in zip(out, texts, strict=True):
            for word in re.findall(r"\w+", text.lower()):
                padded = f"^{word}$"
                for gram in (word, *(padded[i : i + 3] for i in range(len(padded) - 2))):
                    h = int.from_bytes(hashlib.blake2b(gram.encode("utf-8", "replace"), digest_size=8).digest(), "little")
                    row[h % self.size] += 1 if h >> 63 else -1
            n = float(np.sqrt((row * row).sum()))
            if n:
                row /= n
        return out


def busy(error: Exception) -> bool:
    """Whether a service asks to be called later: HTTP 429, or no connection in time."""
    status = getattr(error, "status", None) or getattr(error, "code", None) or getattr(getattr(error, "response", None), "status_code", None)
    return status == 429 or isinstance(error, (ConnectionError, TimeoutError))


def with_retries(call: Callable, tries: int = 5, wait: float = 0.25, longest: float = 8.0, later: Callable = busy) -> Callable:
    """For encoders behind a service: calls again after growing pauses while ``later`` says so of the error; raises any other, and the last."""

    def again(*args):
        pause = wait
        for left in range(tries - 1, -1, -1):
            try:
                return call(*args)
            except Exception as error:
                if not left or not later(error):
                    raise
                time.sleep(pause)
                pause = min(longest, 2 * pause)

    return again


class RemoteEncoder:
    """An encoder behind a service: ``post(texts)`` returns vectors; the size comes from one probing call."""

    def __init__(self, post: Callable, **retries) -> None:
        self.post = with_retries(post, **retries)
        self.size = len(self.post(["size"])[0])

    def encode(self, texts: list[str]) -> np.ndarray:
        return np.asarray(self.post(texts), np.float32).reshape(len(texts), self.size)


def encoded(df: DataFrame, text: str, load: Callable = HashingEncoder, name: str = "vector", batch: int = 256) -> DataFrame:
    """Adds a vector for each text. Texts of a batch are encoded by length, so that padding stays small."""
    ship(df.sparkSession)
    at, fields = df.columns.index(text), T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.FloatType()))])

    def run(batches):
        encoder = load()
        for whole in batches:
            for i in range(0, whole.num_rows, batch):
                part = whole.slice(i, batch)
                texts = [t or "" for t in part.column(at).to_pylist()]
                order = np.argsort([-len(t) for t in texts], kind="stable")
                vectors = np.asarray(encoder.encode([texts[j] for j in order]), np.float32)
                if vectors.shape != (len(texts), vectors.shape[1]):
                    raise ValueError("an encoder gives one vector a text")
                back = np.empty_like(vectors)
                back[order] = vectors
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(back), pa.list_(pa.float32()))], [*part.schema.names, name])

    return df.mapInArrow(run, fields)


def recognised(df: DataFrame, key: str, text: str, load: Callable) -> DataFrame:
    """key, pos, start_char, end_char, type, surface_text, recognized_text; blank texts have none."""
    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        model = load()
        for batch in batches:
            out = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if t and t.strip():
                    out += [(k, i, a, b, kind, t[a:b], t[a:b]) for i, (a, b, kind) in enumerate(model.find(t))]
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            kinds = (batch.column(0).type, pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [key, "pos", "start_char", "end_char", "type", "surface_text", "recognized_text"])

    return df.select(key, text).mapInArrow(run, f"{key} {kind}, pos int, start_char int, end_char int, type string, surface_text string, recognized_text string")


def split(df: DataFrame, key: str, text: str, load: Callable = RuleSplitter) -> DataFrame:
    """key, idx, text: the sentences of each text by a splitter model."""
    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        model = load()
        for batch in batches:
            parts = [model.split(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.list_(pa.string()))], [key, "parts"])

    return df.select(key, text).mapInArrow(run, f"{key} {kind}, parts array<string>").select(key, F.posexplode("parts").alias("idx", "text"))
