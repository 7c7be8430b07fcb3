"""Sentences, their offsets, windows with a token budget, span containment, and dictionary tagging."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textloom.functions.text import entity_hash, expand_tokens, sentences, strip, without_articles
from textloom.runtime import ship

BUDGET, OVERLAP, LEAST_SURFACE = 200, 20, 2
MOST_IN_PATTERN = 32
BOUNDARY = re.compile(r"\b")


def sentence_rows(rows: DataFrame, key: str, text: str) -> DataFrame:
    """key, idx, chunk_id, text: a row for each sentence, numbered from 0 within its text."""
    out = rows.select(key, F.posexplode(sentences(text)).alias("idx", "text"))
    return out.select(key, "idx", F.concat(F.col(key).cast("string"), F.lit(":s"), F.col("idx").cast("string")).alias("chunk_id"), "text")


def with_offsets(rows: DataFrame, key: str, idx: str = "idx", text: str = "text", gap: int = 1) -> DataFrame:
    """Adds start and end: places of each sentence in the text that joins them with ``gap`` characters."""
    before = Window.partitionBy(key).orderBy(idx).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length(text) + gap).over(before), F.lit(0)).cast("long")
    return rows.withColumn("start", start).withColumn("end", F.col("start") + F.length(text))


def windows_of(counts: list[int], budget: int = BUDGET, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Half-open ranges of sentences: as many as fit the budget, one at least; each next one starts at least one later,
    at the last sentence from which ``overlap`` tokens or more are shared.

    Both ends are places in the running sums of the counts.
    """
    sums = [0, *accumulate(counts)]
    out: list[tuple[int, int]] = []
    first = 0
    while first < len(counts):
        stop = max(first + 1, bisect_right(sums, sums[first] + budget) - 1)
        out.append((first, stop))
        first = len(counts) if stop == len(counts) else max(first + 1, min(stop, bisect_right(sums, sums[stop] - overlap) - 1))
    return out


def count_blank_separated(text: str) -> int:
    return len(text.split())


def pack_windows(rows: DataFrame, key: str, text: str, budget: int = BUDGET, overlap: int = OVERLAP, count: Callable[[str], int] = count_blank_separated) -> DataFrame:
    """key, window_index, window_count, chunk_id, first, stop, text. The id has a suffix only where there are several."""
    ship(rows.sparkSession)
    split = rows.select(F.col(key), sentences(text).alias("sentences"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for k, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = windows_of([count(s) for s in parts or ()], budget, overlap)
                out += [(k, i, len(found), f"{k}#{i}" if len(found) > 1 else str(k), a, b, " ".join(parts[a:b])) for i, (a, b) in enumerate(found)]
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            kinds = [batch.column(0).type, pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [key, "window_index", "window_count", "chunk_id", "first", "stop", "text"])

    return split.mapInArrow(run, f"{key} {kind}, window_index int, window_count int, chunk_id string, first int, stop int, text string")


def contained(spans: DataFrame, windows: DataFrame, key: str) -> DataFrame:
    """Spans (key, start, end, ...) within windows (key, window, w_start, w_end), rebased; in an overlap once for each."""
    both = spans.join(windows, key).filter((F.col("start") >= F.col("w_start")) & (F.col("end") <= F.col("w_end")))
    return both.withColumn("start", F.col("start") - F.col("w_start")).withColumn("end", F.col("end") - F.col("w_start")).drop("w_start", "w_end")


def surface_index(mentions: DataFrame, doc: str = "doc_id", surface: str = "surface_text", order: str = "pos") -> DataFrame:
    """doc, surface, cui, tuis: the first cui of each surface of a document, and the types of all its mentions."""
    rows = mentions.filter(F.coalesce("cui", F.lit("")) != "").withColumn("surface", F.lower(strip(surface)))
    rows = rows.filter(F.length("surface") >= LEAST_SURFACE)
    types = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("tuis", F.array().cast("array<string>"))))))
    return rows.groupBy(doc, "surface").agg(F.min_by("cui", order).alias("cui"), types.alias("tuis"))


class SurfaceMatcher:
    """Finds surfaces between word boundaries, leftmost first and of these the longest, whatever the case.

    Only boundaries can start or end a surface, so a text is looked up at these, by the lengths that occur with the
    character there; few surfaces are one pattern, the longest first.
    """

    def __init__(self, surfaces) -> None:
        self.known = {s.lower() for s in surfaces if s}
        lengths: dict[str, set[int]] = {}
        for s in self.known:
            lengths.setdefault(s[0], set()).add(len(s))
        self.lengths = {c: sorted(some, reverse=True) for c, some in lengths.items()}
        longest = sorted(self.known, key=len, reverse=True)
        self.pattern = re.compile(rf"\b(?:{'|'.join(map(re.escape, longest))})\b") if 0 < len(longest) <= MOST_IN_PATTERN else None

    def find(self, text: str) -> list[tuple[int, int]]:
        low = text.lower()
        if len(low) != len(text):  # a letter whose lower case is longer stays as it is, so that places agree
            low = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
        if self.pattern:
            return [m.span() for m in self.pattern.finditer(low)]
        edges = [m.start() for m in BOUNDARY.finditer(low)]
        ends, out, at = set(edges), [], 0
        for start in edges:
            if start < at:
                continue
            for n in self.lengths.get(low[start : start + 1], ()):
                if start + n in ends and low[start : start + n] in self.known:
                    at = start + n
                    out.append((start, at))
                    break
        return out


@lru_cache(maxsize=64)
def matcher_of(surfaces: frozenset[str]) -> SurfaceMatcher:
    """Many documents have the same surfaces."""
    return SurfaceMatcher(surfaces)


def tag(sentence_table: DataFrame, index: DataFrame, doc: str = "doc_id", key: str = "chunk_id", text: str = "text") -> DataFrame:
    """key, text, cuis, tuis, surface_forms of every sentence, from the surfaces of its document.

    A document's sentences and its surfaces meet as one row: as many as it has of both.
    """
    ship(sentence_table.sparkSession)
    lists = index.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("surface", "cui", "tuis"))).alias("surfaces"))
    rows = sentence_table.groupBy(doc).agg(F.collect_list(F.struct(F.col(key).alias("key"), F.col(text).alias("text"))).alias("sentences"))
    rows = rows.join(lists, doc, "left").select("sentences", "surfaces")
    kind = sentence_table.schema[key].dataType

    def run(batches):
        for batch in batches:
            out = []
            for held, surfaces in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                known = {s["surface"]: (s["cui"], s["tuis"]) for s in surfaces or ()}
                matcher = matcher_of(frozenset(known))
                for s in held:
                    low = s["text"] or ""
                    hits = sorted({low[a:b].lower() for a, b in matcher.find(low)} & known.keys()) if known else []
                    out.append((s["key"], s["text"], sorted({known[h][0] for h in hits}), sorted({u for h in hits for u in known[h][1]}), hits))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            texts = pa.list_(pa.string())
            kinds = (to_arrow_type(kind), pa.string(), texts, texts, texts)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [key, text, "cuis", "tuis", "surface_forms"])

    return rows.mapInArrow(run, f"{key} {kind.simpleString()}, {text} string, cuis array<string>, tuis array<string>, surface_forms array<string>")


def normalise_mentions(mentions: DataFrame, abbreviations: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Adds resolved_text (no articles) and expanded_text (abbreviations of the section written out, no articles)."""
    maps = abbreviations.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("upper", "expansion"))).alias("_map"))  # distinct acronyms of a section
    rows = mentions.join(maps, key, "left").withColumn("resolved_text", without_articles("recognized_text"))
    expanded = F.when(F.col("_map").isNull(), F.col("resolved_text")).otherwise(without_articles(expand_tokens("resolved_text", "_map")))
    return rows.withColumn("expanded_text", expanded).withColumn("entity_hash", entity_hash("expanded_text")).drop("_map")

