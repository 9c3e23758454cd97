"""Column helpers that reproduce R's null and ordering rules with built-ins.

Every helper returns a ``Column`` (no Python runs per row).  The table in
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def if_else3(cond: Column, yes, no) -> Column:
    """``ifelse(cond, yes, no)`` with R semantics: a NULL test gives NULL.

    Spark's ``when`` sends a NULL test to ``otherwise``; this helper does not.
    """
    return F.when(cond.isNull(), F.lit(None)).when(cond, _lit(yes)).otherwise(_lit(no))


def assign_where(target, cond: Column, value) -> Column:
    """``x[cond] <- v``: a NULL test leaves the value unchanged."""
    return F.when(cond, _lit(value)).otherwise(_c(target))


def in_set(c, values: Iterable) -> Column:
    """``%in%``: never NULL."""
    return F.coalesce(_c(c).isin(list(values)), F.lit(False))


def na_text(c) -> Column:
    """How ``paste`` prints a value: NULL becomes the text ``NA``."""
    return F.coalesce(_c(c).cast("string"), F.lit("NA"))


def paste(*cols, sep: str = " ") -> Column:
    """``paste(..., sep)``: NULLs are printed as ``NA``, never propagated."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(na_text(c))
    return F.concat(*parts)


def str_c(*cols, sep: str = "") -> Column:
    """``str_c(..., sep)``: any NULL input gives NULL."""
    parts = []
    for i, c in enumerate(cols):
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(_c(c).cast("string"))
    return F.concat(*parts)


def _java_replacement(s: str) -> str:
    return s.replace("\\", "\\\\").replace("$", "\\$")


def replace_first(c, pattern: str, replacement: str = "") -> Column:
    """``str_replace``/``str_remove``: only the first match is replaced.

    ``regexp_replace`` is always global, so the pattern is anchored behind a
    lazy prefix group that is written back.
    """
    anchored = f"(?s)^(.*?)(?:{pattern})"
    return F.regexp_replace(_c(c), anchored, "$1" + _java_replacement(replacement))


def replace_all(c, pattern: str, replacement: str = "") -> Column:
    """``str_replace_all``/``str_remove_all``/``gsub``."""
    return F.regexp_replace(_c(c), pattern, _java_replacement(replacement))


def squish(c) -> Column:
    """``str_squish``: collapse whitespace runs to one space and trim."""
    return F.trim(F.regexp_replace(_c(c), r"\s+", " "))


def is_na_like(c) -> Column:
    """True for NULL, the text ``NA`` and the empty string (never NULL)."""
    c = _c(c)
    return c.isNull() | (c == "NA") | (c == "")


def null_safe_eq(left: Column, right: Column) -> Column:
    """dplyr join key equality: NA matches NA (N4).  Still an equi-join key."""
    return left.eqNullSafe(right)


def nullif_empty(c) -> Column:
    c = _c(c)
    return F.when(c == "", F.lit(None)).otherwise(c)
