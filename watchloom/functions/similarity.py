"""String and vector similarity as Column builders; Python only where there is no built-in."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _grams(padded: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - 2, F.lit(1))), lambda i: F.substring(padded, i, F.lit(3)))


def word_trigrams(c: Column) -> Column:
    """Distinct trigrams of each word, padded with two blanks before and one after."""
    words = F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{Nd}]+"), lambda w: w != "")
    return F.array_distinct(F.flatten(F.transform(words, lambda w: _grams(F.concat(F.lit("  "), w, F.lit(" "))))))


def text_trigrams(c: Column) -> Column:
    """Distinct trigrams of the whole text, padded once around."""
    return F.array_distinct(_grams(F.concat(F.lit("  "), c, F.lit(" "))))


def inner_trigrams(c: Column) -> Column:
    """Distinct trigrams of a text without padding; none where it is shorter."""
    return F.when(F.length(c) >= 3, F.array_distinct(_grams(c))).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    n = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - n
    return F.when(total > 0, n / total).otherwise(0.0)


def similarity(a: Column, b: Column) -> Column:
    return jaccard(word_trigrams(a), word_trigrams(b))


def subset(a: Column, b: Column) -> Column:
    """Whether one token set holds the other."""
    return (F.size(F.array_except(a, b)) == 0) | (F.size(F.array_except(b, a)) == 0)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.StringType())
def composed(s: pd.Series) -> pd.Series:
    """Unicode NFC."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
