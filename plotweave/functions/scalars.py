"""Scalar column functions (F1-F15 of the survey), all JVM-side."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotweave.config import STATE_NAMES
from plotweave.functions.text import not_blank, strip_ws

# What counts as a number, a height and a place word.
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_INFINITE = r"^[+-]?(inf|infinity)$"
_HEIGHT = r"^([0-9.]+)\s*(m|meter|meters|ft|feet|')?"
_PLACE_WORDS = r"\b(city|town|village|borough|municipality|cdp)\b"


def slugify(*parts: Column) -> Column:
    """Non-blank parts joined by ``_``, other signs than letters and digits as
    one ``_``, lower case; nothing left gives ``place``."""
    joined = F.concat_ws("_", *[F.nullif(p.cast("string"), F.lit("")) for p in parts])
    slug = F.lower(F.regexp_replace(F.regexp_replace(joined, r"[^A-Za-z0-9]+", "_"), r"^_+|_+$", ""))
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("place"))


def state_name(c: Column) -> Column:
    """Two-letter abbreviations as full names; anything else only trimmed."""
    names = F.create_map(*[F.lit(x) for kv in STATE_NAMES.items() for x in kv])
    t = strip_ws(c)
    return F.coalesce(F.when(F.length(t) == 2, F.try_element_at(names, F.upper(t))), t)


def safe_number(c: Column) -> Column:
    """Number in a text, NULL for anything that isn't one (``'3d'``, ``'nan'``)."""
    t = strip_ws(c.cast("string"))
    return F.when(F.lower(t).rlike(_NUMBER) | F.lower(t).rlike(_INFINITE), t.try_cast("double"))


def height_m(c: Column) -> Column:
    """Metres from free text; feet are converted; malformed numbers give NULL."""
    t = F.lower(strip_ws(c.cast("string")))
    number, unit = F.regexp_extract(t, _HEIGHT, 1), F.regexp_extract(t, _HEIGHT, 2)
    led = F.when(number.rlike(_NUMBER), number.try_cast("double")) * F.when(unit.isin("ft", "feet", "'"), F.lit(0.3048)).otherwise(F.lit(1.0))
    return F.coalesce(safe_number(c), led)


def place_name(c: Column) -> Column:
    """Text before the first comma without place words and signs."""
    t = F.lower(F.split_part(c, F.lit(","), F.lit(1)))
    t = F.regexp_replace(t, _PLACE_WORDS, "")
    return F.trim(F.regexp_replace(t, r"[^a-z0-9]+", " "))


def field_name(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "", str(name).lower())


def first_with_source(df: DataFrame, choices: Sequence[tuple[str, str]], kind: str) -> tuple[Column, Column]:
    """First non-NULL (text: non-blank) of the named columns, and its label.
    Columns the frame lacks are skipped."""
    values, labels = [], []
    for name, label in choices:
        if name in df.columns:
            c = F.col(name).cast(kind)
            ok = not_blank(c) if kind == "string" else c.isNotNull() & ~F.isnan(c)
            values.append(F.when(ok, c))
            labels.append(F.when(ok, F.lit(label)))
    if not values:
        return F.lit(None).cast(kind), F.lit(None).cast("string")
    return F.coalesce(*values), F.coalesce(*labels)


def first_number(df: DataFrame, names: Sequence[str]) -> Column:
    """First parsable number of several tag columns."""
    got = [safe_number(F.col(f"`{n}`")) for n in names if n in df.columns]
    return F.coalesce(*got) if got else F.lit(None).cast("double")


def stories_from_height(height: Column) -> Column:
    """Half-even rounding of height / 3.05, between 1 and 200; NULL stays NULL."""
    return F.when(height.isNotNull(), F.least(F.greatest(F.bround(height / 3.05), F.lit(1.0)), F.lit(200.0)))


def sum_either(a: Column, b: Column) -> Column:
    """Sum of two columns; NULL only if both are."""
    return F.when(a.isNull() & b.isNull(), None).otherwise(F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)))


def nested_text(c: Column) -> Column:
    """A struct member or text; empty counts as missing."""
    return F.nullif(c, F.lit(""))
