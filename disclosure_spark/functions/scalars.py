"""Column expressions shared by the operators; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: longest file name the landing zone accepts.
MAX_NAME_LENGTH = 130


def date_prefix(name: str | Column) -> Column:
    """The reporting date a file name starts with."""
    return F.substring(name, 1, 10)


def base_name(path: str | Column) -> Column:
    """Last component of a path with ``/`` or ``\\`` separators."""
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def name_suffixes(name: Column) -> Column:
    """Every dotted suffix of a file name (``a.json.gz`` gives ``.json.gz``).

    Leading dots belong to the stem, and a name ending in a dot has no suffix.
    """
    suffix = F.regexp_extract(base_name(name), r"(?s)^[.]*+[^.]*+([.].*)$", 1)
    return F.when(name.endswith("."), F.lit("")).otherwise(suffix)


def visible(name: str | Column) -> Column:
    """No part of a path starts with ``_`` or ``.``, as Spark's readers pass over such files: ``x`` goes before it."""
    return F.regexp_replace(name, r"(^|/)(?=[_.])", "$1x")


def landing_name(name: str | Column, max_length: int = MAX_NAME_LENGTH, mark: Column | None = None) -> Column:
    """File name in the landing zone: visible, no spaces, shortened but for its suffixes.

    When the suffixes alone exceed the bound the stem loses their excess from
    its end but for one character, so such a name may stay longer than ``max_length``. With ``mark``
    the stem ends in a hyphen and this text, for a name that must differ from others.
    """
    plain = F.translate(name, " ", "_")
    suffix = name_suffixes(plain)
    name = visible(plain)
    if mark is not None:
        stem = F.substring(name, F.lit(1), F.length(name) - F.length(suffix))
        room = F.greatest(F.lit(max_length) - F.length(suffix) - F.length(mark) - 1, F.lit(1))
        return F.concat(F.substring(stem, F.lit(1), room), F.lit("-"), mark, suffix)
    room = F.lit(max_length) - F.length(suffix)
    kept = F.when(room >= 0, room).otherwise(F.greatest(F.length(name) + room, F.lit(1)))
    short = F.concat(F.substring(name, F.lit(1), kept), suffix)
    return F.when(F.length(name) > max_length, short).otherwise(name)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, rounded half up to one decimal.

    Integer arithmetic up to the last division keeps ties exact on any engine.
    A ``whole`` of zero gives null.
    """
    tenths = F.call_function("div", part * 2000 + whole, whole * 2)
    return F.when(whole > 0, tenths / F.lit(10.0))


def bin_edge(index: Column, low: Column, high: Column, bins: int) -> Column:
    """Lower edge of an equal-width bin; the edge after the last one is ``high``."""
    edge = index * ((high - low) / F.lit(float(bins))) + low
    return F.when(index >= bins, high).otherwise(edge)


def bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin of ``value``; the last bin is closed on the right.

    The quotient may land one bin off by floating-point rounding, so it is
    settled against the edges themselves.
    """
    guess = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1))
    return (
        F.when(value < bin_edge(guess, low, high, bins), guess - 1)
        .when((guess < bins - 1) & (value >= bin_edge(guess + 1, low, high, bins)), guess + 1)
        .otherwise(guess)
    )
