"""Column helpers that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: white space that parts words: blank, tab, line feed, vertical tab, form feed, return
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower case for A-Z only."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text in order; none for a text without words."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NOT_SPACE)).cast("long")


def scalar(df: DataFrame):
    """The one row of an aggregate without keys."""
    return df.first()
