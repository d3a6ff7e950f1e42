"""Whitespace handling.

Two different trims are both right in their place. The silver layer removes U+0020 only
(``F.trim``); validation, training rows and text gates strip every Unicode whitespace character.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters str.strip() removes.
WHITESPACE = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)


# First and last bytes of these characters in UTF-8.
_FIRST_BYTES = bytes(sorted({c.encode()[0] for c in WHITESPACE}))
_LAST_BYTES = bytes(sorted({c.encode()[-1] for c in WHITESPACE}))


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends; null stays null.

    Trimming a set of characters indexes the whole text. It is kept to texts whose first or last byte
    may belong to whitespace; looking at a byte costs the same for any length.
    """
    data = text.cast("binary")
    padded = F.contains(F.lit(_FIRST_BYTES), F.substring(data, 1, 1)) | F.contains(
        F.lit(_LAST_BYTES), F.substring(data, -1, 1)
    )
    return F.when(padded, F.trim(text, F.lit(WHITESPACE))).otherwise(text)


def is_blank(text: Column) -> Column:
    """True for whitespace only; stops reading at the first other character."""
    return F.ltrim(text, F.lit(WHITESPACE)) == ""


def at_least(text: Column, chars: int) -> Column:
    """True for texts of ``chars`` or more characters.

    A character takes one to four bytes, so the size in bytes decides for most texts; counting
    characters reads the whole text.
    """
    size = F.octet_length(text)
    return (size >= 4 * chars) | ((size >= chars) & (F.length(text) >= chars))


def first_chars(text: Column, chars: int) -> Column:
    """The first ``chars`` characters; a text that is no longer is passed on as it is."""
    return F.when(at_least(text, chars + 1), F.substring(text, 1, chars)).otherwise(text)


def strip_or_empty(text: Column) -> Column:
    """Like :func:`strip`, with null taken as the empty string."""
    return strip(F.coalesce(text, F.lit("")))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def generated(value: Column) -> Column:
    """``value`` as a generated column, to be named with ``alias`` in a ``select``.

    Spark moves filters and later expressions below a projection by copying the projected expression
    into each of them. It does not do so below a generator, so a costly value is worked out once.
    """
    return F.explode(F.array(value))
