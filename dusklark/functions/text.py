"""Normalising identifiers, labels and timestamps that arrive in several spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space that may surround an identifier.
WHITE_SPACE = " \t\n\u000b\f\r\u001c\u001d\u001e\u001f\u0085                 　"


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def identifier(c: Column) -> Column:
    """Lower case without surrounding white space; NULL where nothing is left."""
    plain = F.lower(stripped(c))
    return F.when(plain != "", plain)


def label(c: Column) -> Column:
    """Upper case, inner runs of blanks and underscores as one space; NULL where nothing is left."""
    flat = F.upper(F.btrim(F.translate(stripped(c), "_\t\n\r", "    ")))
    # the pattern is only run where there is something to fold
    plain = F.when(flat.contains("  "), F.regexp_replace(flat, " +", " ")).otherwise(flat)
    return F.when(plain != "", plain)


def code(c: Column) -> Column:
    """A site code: upper case without surrounding white space; NULL where nothing is left."""
    plain = F.upper(stripped(c))
    return F.when(plain != "", plain)


def instant(c: Column) -> Column:
    """An ISO timestamp in any notation as a UTC instant (no offset means UTC); NULL if it can't be read."""
    return F.try_to_timestamp(stripped(c))
