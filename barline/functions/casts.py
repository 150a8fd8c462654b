"""Casts that accept exactly the number texts the source API contract allows."""

from pyspark.sql import Column, functions as F

_PLAIN = r"\A[0-9]{1,15}(\.[0-9]{1,9})?\z"
_DIGITS = r"[0-9](_?[0-9])*"
_NUMBER = rf"\A\s*[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?\s*\z"
_NOT_FINITE = r"\A\s*[+-]?(?i:nan|inf|infinity)\s*\z"


def strict_double(text: Column) -> Column:
    """Text to double, NULL when refused.

    Takes blanks around, exponents, ``1_000``, ``nan`` and ``inf``; refuses the
    ``1d``/``1f`` suffixes and hex floats the JVM parser would let through.
    """
    bare = F.lower(F.regexp_replace(text, r"[\s_+]", ""))
    infinity = F.lit(float("inf"))
    return (
        # Nearly every value is a plain number, which needs no rewriting.
        F.when(text.rlike(_PLAIN), text.try_cast("double"))
        .when(text.rlike(_NUMBER), F.regexp_replace(text, r"[\s_]", "").try_cast("double"))
        .when(
            text.rlike(_NOT_FINITE),
            F.when(bare.endswith("nan"), F.lit(float("nan")))
            .when(bare.startswith("-"), -infinity)
            .otherwise(infinity),
        )
    )


def strict_date(text: Column) -> Column:
    """``YYYY-M-D`` text (zero padding optional, one blank may pad the day) to date."""
    shape = r"\A(?!0000)[0-9]{4}-(0?[1-9]|1[0-2])-(0?[1-9]|[12][0-9]|3[01]| [1-9])\z"
    return F.when(text.rlike(shape), F.try_to_date(F.replace(text, F.lit(" "), F.lit("")), "yyyy-M-d"))
