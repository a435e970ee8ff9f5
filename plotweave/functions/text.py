"""Text clean-up shared by operators (JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_ws(c: Column) -> Column:
    """Without outer white space of any kind (SQL trim() takes blanks only)."""
    return F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")


def not_blank(c: Column) -> Column:
    """True when the text holds more than white space; NULL counts as blank."""
    return F.coalesce(F.length(strip_ws(c)) > 0, F.lit(False))


def label_key(c: Column) -> Column:
    """Label without case, blanks, ``-`` and ``_``; NULL becomes ''."""
    return F.coalesce(F.lower(F.regexp_replace(c, r"[\s_\-]+", "")), F.lit(""))


def entity_key(c: Column) -> Column:
    """Identifier without case and outer white space; blank becomes NULL."""
    return F.nullif(F.lower(strip_ws(c)), F.lit(""))


def real(c: Column) -> Column:
    """NaN to NULL: missing has one spelling inside the engine."""
    return F.when(~F.isnan(c), c)


def block_number(c: Column) -> Column:
    """Census block as a number: ``'010…'``, ``'10…'`` and ``'10….0'`` agree.

    Blank, NULL and non-numeric codes give NULL.
    """
    t = strip_ws(c)
    return F.when(t.rlike(r"^\+?[0-9]+([.]0*)?$"), F.regexp_extract(t, r"^\+?([0-9]+)", 1).try_cast("bigint"))
