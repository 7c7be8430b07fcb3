"""Text expressions. All are built from SQL functions, so they stay inside generated code; each takes a column or name."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Name = Column | str

# Characters and patterns that results depend on.
HEADING = r"\b([A-Z][A-Z0-9 ,/&'\-]{2,78}):"
SENTENCE_GAP = r"(?<=[.!?])\s+(?=[A-Za-z0-9(\[])"
ARTICLE = r"(?i)\b(?:a|an|the)\b"
ACRONYM = r"\b[A-Z][A-Z0-9]+\b"
TOKEN = r"\b[A-Za-z][A-Za-z0-9-]*\b"
QUERY_SPECIALS = r'([+\-!(){}\[\]^"~*?:\\/&|])'


def col(x: Name) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Name) -> Column:
    """Without white space of any kind at both ends (SQL's trim removes only blanks)."""
    return F.regexp_replace(col(x), r"(?U)^\s+|\s+$", "")


def squeeze(x: Name) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(col(x), r"(?U)\s+", " "))


def slug(x: Name) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(col(x), "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))


def sentences(x: Name) -> Column:
    """Array of a text's sentences: cut at white space after . ! ? and before a letter, digit or opening bracket."""
    return F.filter(F.split(squeeze(x), SENTENCE_GAP), lambda s: F.length(s) > 0)


def without_articles(x: Name) -> Column:
    """Whole-word a, an and the removed, white space squeezed; the text itself if nothing is left."""
    return F.coalesce(F.nullif(squeeze(F.regexp_replace(col(x), ARTICLE, "")), F.lit("")), col(x))


def acronyms(x: Name) -> Column:
    """Tokens of a capital and at least one more capital or digit, in order of the text."""
    return F.regexp_extract_all(col(x), F.lit(ACRONYM), F.lit(0))


def abbreviation_key(x: Name) -> Column:
    """The form by which abbreviations are compared: no punctuation or space at the ends, upper case."""
    inner = F.regexp_replace(strip(x), r"^[.,;:()\[\]{}'\"]+|[.,;:()\[\]{}'\"]+$", "")
    return F.upper(strip(inner))


def expand_tokens(x: Name, expansions: Name) -> Column:
    """Each token whose upper case is a key of the map is replaced by its value; everything else stays in place.

    The text is cut before and after each token, so pieces at odd places are the tokens themselves.
    """
    mark = "\u0001"
    pieces = F.split(F.regexp_replace(col(x), f"({TOKEN})", f"{mark}$1{mark}"), mark)
    swapped = F.transform(pieces, lambda p, i: F.when(i % 2 == 1, F.coalesce(F.element_at(col(expansions), F.upper(p)), p)).otherwise(p))
    return F.when(F.coalesce(F.size(F.map_keys(col(expansions))), F.lit(0)) == 0, col(x)).otherwise(F.array_join(swapped, ""))


def token_expansions(x: Name, lookup: Name) -> Column:
    """Map of the letter-and-digit runs of a text that the map knows, as written, to their expansions."""
    tokens = F.array_distinct(F.regexp_extract_all(col(x), F.lit("[A-Za-z0-9]+"), F.lit(0)))
    known = F.filter(tokens, lambda t: F.coalesce(F.element_at(col(lookup), F.upper(t)), F.lit("")) != "")
    return F.map_from_entries(F.transform(known, lambda t: F.struct(t, F.element_at(col(lookup), F.upper(t)))))


def escape_query(x: Name) -> Column:
    """Characters with a meaning in full-text query syntax, escaped."""
    return F.regexp_replace(col(x), QUERY_SPECIALS, r"\\$1")


def entity_hash(x: Name) -> Column:
    return F.substring(F.sha1(F.lower(strip(x))), 1, 16)


def uuid5(namespace: str, x: Name) -> Column:
    """The name-based UUID (version 5) of a text in a namespace given as a UUID string."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(col(x), "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def unescape_html(x: Name) -> Column:
    """Named and numeric character references as in HTML 5, each undone once. An Arrow function: the names are Python's own table."""

    @F.pandas_udf("string")
    def plain(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return plain(col(x))


def unescape_listed(x: Name, entities: Sequence[tuple[str, str]]) -> Column:
    """Only the references of a list, as written there, so with their semicolons; each undone once if the ampersand's is last."""
    plain = col(x)
    for entity, character in entities:
        plain = F.replace(plain, F.lit(entity), F.lit(character))
    return plain


def fixed(x: Name, digits: int) -> Column:
    """A number with so many digits after the point, rounded on its binary value, halves to even.

    Formatting in Java rounds the shortest decimal instead. Here the product with 10^digits is followed by its error
    (Dekker's split), which decides where the product is a half.
    """
    a, scale = F.abs(col(x)), float(10**digits)
    high = a * 134217729.0 - (a * 134217729.0 - a)
    product = a * scale
    error = (high * scale - product) + (a - high) * scale
    whole = F.floor(product)
    rest = product - whole
    up = (rest > 0.5) | (rest == 0.5) & ((error > 0) | (error == 0) & (whole % 2 == 1))
    n = whole.cast("long") + up.cast("long")
    return F.concat(F.when(col(x) < 0, "-").otherwise(""), F.format_string(f"%d.%0{digits}d", F.floor(n / int(scale)).cast("long"), n % int(scale)))


def match_label(kind: str, score: Name | None = None) -> Column:
    """How a link was found: exact, fulltext/5.2 or vector/0.712."""
    if score is None:
        return F.lit(kind)
    return F.concat(F.lit(f"{kind}/"), fixed(score, {"fulltext": 1, "vector": 3}[kind]))


def words(x: Name) -> Column:
    """Lower-cased runs of ASCII letters and digits."""
    return F.filter(F.split(F.lower(col(x)), "[^a-z0-9]+"), lambda w: w != "")
