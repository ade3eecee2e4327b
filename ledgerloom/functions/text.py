"""Text normalisation beyond what the built-ins give directly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Drop every kind of white space at both ends (``trim`` drops blanks only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def title_words(text: Column) -> Column:
    """Capitalise each run of letters: "o'neil a-b" gives "O'Neil A-B" (``initcap``: "O'neil A-b")."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    capital = F.transform(runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)),
                                                     F.lower(F.substr(run, F.lit(2)))))
    return F.array_join(capital, "")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
