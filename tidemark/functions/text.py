"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_code(c: Column) -> Column:
    """Country or currency code: outer blanks off, upper case."""
    return F.upper(F.trim(c))


def clean_token(c: Column) -> Column:
    """Vocabulary word: outer blanks off, lower case, each run of white space one ``_``."""
    return F.regexp_replace(F.lower(F.trim(c)), r"\s+", "_")


def clean_token_per_space(c: Column) -> Column:
    """Like ``clean_token``, but every single space becomes its own ``_``.

    All leading and trailing white space goes, not only blanks.
    """
    stripped = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.replace(F.lower(stripped), F.lit(" "), F.lit("_"))
