"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.shared import written

__all__ = ["GAP", "WORD", "ascii_lower", "differing", "free_name", "sorted_side", "words", "written"]

#: One word: a run of characters other than space and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"
#: What separates words.
GAP = r"[\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit("\x20\x09\x0a\x0b\x0c\x0d"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, _UPPER, _UPPER.lower())


def differing(a: Column, b: Column) -> Column:
    """The number of places in which two arrays of one length differ."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda x: x))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted`` with as many underscores before it as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def sorted_side(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that sorts both. Spark would send it to all executors through the driver while it is below the broadcast threshold,
    and there its rows take several times that; steps with a dozen joins would do so for all of them at once."""
    return df.hint("merge")
