"""Number text to numbers, rounding, ratios. All of it stays in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "not applicable" or "missing" (dashes of several kinds, nan, None, nothing)
# need no list of their own: none of them is a number.
# Yen per unit.
UNITS = {"円": 1.0, "千円": 1e3, "百万円": 1e6, "億円": 1e8, "JPY": 1.0}
# Marks of a negative figure.
NEGATIVE_MARKS = ("△", "▲")

_WIDE = "０１２３４５６７８９"
_NARROW = "0123456789"
_SPACES = " \t\n\r\v\f　 "
_NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def _plain(text: Column, drop: str = "") -> Column:
    """Trimmed, with full-width digits narrowed and the characters of ``drop`` gone."""
    return F.btrim(F.translate(text, _WIDE + drop, _NARROW), F.lit(_SPACES))


def to_double(text: Column) -> Column:
    """Number or null. Java's suffixes (``1d``) are no numbers here."""
    plain = _plain(text)
    return F.when(plain.rlike(f"^{_NUMBER}$"), plain.try_cast("double"))


def to_whole(text: Column) -> Column:
    """Whole number or null; ``1.5`` is no whole number."""
    plain = _plain(text)
    return F.when(plain.rlike(r"^[+-]?[0-9]+$"), plain.try_cast("decimal(38,0)"))


def normalize_number(text: Column) -> Column:
    """Statement figure to double: dashes are null, marks and brackets negative, other
    characters (a unit behind the figure, for instance) are ignored."""
    plain = _plain(text, ",")
    marks = "".join(NEGATIVE_MARKS)
    negative = plain.rlike(rf"(?s)^[{marks}]|^\(.*\)$")
    digits = F.regexp_replace(plain, r"[^0-9.eE+\-]", "")
    number = F.when(digits.rlike(f"^{_NUMBER}$"), digits.try_cast("double"))
    return number * F.when(negative, F.lit(-1.0)).otherwise(F.lit(1.0))


def normalize_value(text: Column, unit: Column) -> Column:
    """Accrual figure in yen: strict number, scaled by its unit; an unknown unit counts as yen."""
    plain = _plain(text, ",")
    marks = "".join(NEGATIVE_MARKS)
    valid = plain.rlike(rf"^(\(\s*{_NUMBER}\s*\)|[{marks}]?\s*{_NUMBER})$")
    number = F.translate(plain, "()" + marks + _SPACES, "").try_cast("double")
    sign = F.when(F.substring(plain, 1, 1).isin("(", *NEGATIVE_MARKS), F.lit(-1.0)).otherwise(F.lit(1.0))
    scale = F.lit(1.0)
    for name, factor in UNITS.items():
        if factor != 1.0:
            scale = F.when(unit == name, F.lit(factor)).otherwise(scale)
    return F.when(valid, number * sign * scale)


def to_int(number: Column) -> Column:
    """Nearest whole number, ties to even; null stays null (a blank in the export)."""
    return F.rint(number).cast("bigint")


def to_places(number: Column, places: int = 2) -> Column:
    """``places`` decimals, ties decided on the exact binary value, to even.

    ``bround`` would decide on the shortest decimal text instead (2.675 gives 2.68).
    """
    return F.replace(F.format_number(number, places), F.lit(","), F.lit("")).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null over zero."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def sum_present(values: Sequence[Column]) -> Column:
    """Sum of the values that are there; null if none is."""
    total = F.lit(0.0)
    for value in values:
        total = total + F.coalesce(value, F.lit(0.0))
    return F.when(F.coalesce(*values).isNotNull(), total)


def plus_if_base(base: Column, extra: Column) -> Column:
    """``base`` plus ``extra`` if there; null without a base."""
    return base + F.coalesce(extra, F.lit(0.0))


def rises(before: Column, after: Column) -> Column:
    """1 if ``after`` is larger than ``before``, else 0."""
    return (after > before).cast("int")
