"""Abbreviations: definitions in the text, dictionaries by precedence, and choice of a sense by context."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import acronyms
from textloom.functions.vectors import dot
from textloom.runtime import ship

PARENTHESES = re.compile(r"\(([^()]+)\)")


def _is_short_form(s: str) -> bool:
    return 2 <= len(s) <= 10 and len(s.split()) <= 2 and s[0].isalnum() and any(map(str.isalpha, s))


def _long_form(short: str, before: str) -> str | None:
    """The shortest ending of ``before`` that holds the short form's letters in order, its first at a word's start."""
    at = len(before)
    for k in range(len(short) - 1, -1, -1):
        c = short[k].lower()
        if not c.isalnum():
            continue
        at -= 1
        while at >= 0 and (before[at].lower() != c or k == 0 and at > 0 and before[at - 1].isalnum()):
            at -= 1
        if at < 0:
            return None
    start = before.rfind(" ", 0, at) + 1 if at and before[at - 1].isalnum() else at
    found = before[start:].strip()
    if len(found) <= len(short) or len(found.split()) > min(len(short) + 5, 2 * len(short)) or short.lower() in found.lower().split():
        return None
    return found


def definitions_in(text: str) -> list[tuple[str, str]]:
    """(short, long) pairs by the method of Schwartz and Hearst (2003): ``long form (SF)`` and ``SF (long form)``."""
    out = []
    for sentence in re.split(r"(?<=[.!?;])\s+|\n", text):
        for m in PARENTHESES.finditer(sentence):
            inner, before = re.split(r"[,;]", m[1])[0].strip(), sentence[: m.start()].rstrip()
            if not inner or not before:
                continue
            if _is_short_form(inner):
                window = " ".join(before.split()[-min(len(inner) + 5, 2 * len(inner)) :])
                found = _long_form(inner, window)
                if found:
                    out.append((inner, found))
            else:
                short = before.split()[-1]
                if _is_short_form(short) and len(inner.split()) > 1 and (found := _long_form(short, inner)):
                    out.append((short, found))
    return out


def definitions(sections: DataFrame, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """key, abbrev, expansion: of each section the most common definition of each short form (ties: the first one)."""
    ship(sections.sparkSession)

    def run(batches):
        for batch in batches:
            keys, shorts, longs, places = [], [], [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for i, (short, long) in enumerate(definitions_in(t or "")):
                    keys.append(k)
                    shorts.append(short)
                    longs.append(long)
                    places.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), pa.array(shorts, pa.string()), pa.array(longs, pa.string()), pa.array(places, pa.int32())], [key, "abbrev", "expansion", "at"])

    kind = sections.schema[key].dataType.simpleString()
    found = sections.select(key, text).mapInArrow(run, f"{key} {kind}, abbrev string, expansion string, at int")
    counted = found.groupBy(key, "abbrev", "expansion").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    return counted.groupBy(key, "abbrev").agg(F.min_by("expansion", F.struct(-F.col("n"), "at")).alias("expansion"))


def occurrences(sections: DataFrame, key: str, text: str) -> DataFrame:
    """key, abbrev (first spelling), upper: the distinct acronyms of each section."""
    tokens = sections.select(key, F.posexplode(acronyms(text)).alias("at", "abbrev")).withColumn("upper", F.upper("abbrev"))
    return tokens.groupBy(key, "upper").agg(F.min_by("abbrev", "at").alias("abbrev"))


def by_precedence(found: DataFrame, key: str, sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """key, upper, abbrev, source, expansion from the first source that knows the acronym.

    A source is (name, table of upper, expansion) or, if the table has the section's key too, one of that section.
    """
    out = None
    for rank, (name, table) in enumerate(sources):
        on = [key, "upper"] if key in table.columns else ["upper"]
        hits = found.join(table.select(*on, "expansion"), on).select(key, "upper", "abbrev", F.lit(rank).alias("rank"), F.lit(name).alias("source"), "expansion")
        out = hits if out is None else out.unionByName(hits)
    best = out.groupBy(key, "upper").agg(F.min_by(F.struct("abbrev", "source", "expansion"), F.struct("rank", "expansion")).alias("b"))
    return best.select(key, "upper", "b.abbrev", "b.source", "b.expansion")


def best_sense(candidates: DataFrame, keys: list[str], context: str, sense: str, choice: str) -> DataFrame:
    """keys, choice, score: of each occurrence the candidate nearest its context; ties go to the first in order."""
    scored = candidates.withColumn("score", dot(context, sense))
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), choice)
    return scored.withColumn("_r", F.row_number().over(order)).filter("_r = 1").select(*keys, choice, "score")


def accept_by_ensemble(a: DataFrame, b: DataFrame, keys: list[str], choice: str, high: float = 0.5, low: float = 0.35, least: float = 0.35) -> DataFrame:
    """keys, choice, score, score_b, accepted, reason: encoder a alone from ``high`` on; below it only with b's consent."""
    other = b.select(*keys, F.col(choice).alias("_choice_b"), F.col("score").alias("score_b"))
    both = a.join(other, keys, "left")
    agreed = F.coalesce((F.col("_choice_b") == F.col(choice)) & (F.col("score_b") >= low), F.lit(False))
    reason = F.when(F.col("score") < least, "below").when(F.col("score") >= high, "alone").when(agreed, "agreed").otherwise("disagreed")
    return both.withColumn("reason", reason).withColumn("accepted", F.col("reason").isin("alone", "agreed")).drop("_choice_b")


def agreement(a: DataFrame, b: DataFrame, keys: list[str], choice: str, least_a: float, least_b: float) -> DataFrame:
    """One row of counts about two encoders' choices for the same occurrences."""
    other = b.select(*keys, F.col(choice).alias("choice_b"), F.col("score").alias("score_b"))
    both = a.join(other, keys).withColumn("same", F.col(choice) == F.col("choice_b"))
    in_a, in_b = F.col("score") >= least_a, F.col("score_b") >= least_b
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return both.agg(
        n(F.col("same")).alias("n_same"), n(~F.col("same")).alias("n_differ"), n(in_a).alias("n_accept_a"), n(in_b).alias("n_accept_b"), n(in_a & in_b).alias("n_accept_both"),
        F.count_distinct(F.when(~F.col("same"), F.struct(*keys[1:], F.col(choice), F.col("choice_b")))).alias("n_disagreements"),
    )


def resolve(sections: DataFrame, override: DataFrame, gazetteer: DataFrame, encode, key: str = "chunk_id", text: str = "text", least: float = 0.35) -> DataFrame:
    """key, abbrev, expansion, source, score: definitions of the section, then overrides, then the gazetteer by context.

    override: upper, expansion. gazetteer: upper, expansion (several a key). encode(df, column) adds column vector.
    """
    own = definitions(sections, key, text).withColumn("upper", F.upper("abbrev"))
    found = occurrences(sections, key, text).join(own.select(key, "upper"), [key, "upper"], "left_anti")
    fixed = found.join(override, "upper").select(key, "abbrev", "expansion", F.lit("override").alias("source"), F.lit(1.0).alias("score"))
    rest = found.join(override, "upper", "left_anti").join(gazetteer, "upper")
    senses = encode(rest.select("expansion").distinct(), "expansion").withColumnRenamed("vector", "sense")
    contexts = encode(sections.join(rest.select(key).distinct(), key, "left_semi").select(key, text), text).select(key, F.col("vector").alias("context"))
    best = best_sense(rest.join(senses, "expansion").join(contexts, key), [key, "upper", "abbrev"], "context", "sense", "expansion")
    chosen = best.filter(F.col("score") >= least).select(key, "abbrev", "expansion", F.lit("gazetteer").alias("source"), F.round("score", 4).alias("score"))
    defined = own.select(key, "abbrev", "expansion", F.lit("definition").alias("source"), F.lit(1.0).alias("score"))
    return defined.unionByName(fixed).unionByName(chosen)
