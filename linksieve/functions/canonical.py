"""Canonical form of a URL string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space in Unicode text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: the scheme prefix, group 1 is the scheme itself.
SCHEME_PATTERN = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"


def trim_whitespace(url: Column) -> Column:
    """C1. Unlike plain ``trim``, removes every Unicode space, not only U+0020."""
    return F.btrim(url, F.lit(WHITESPACE))


def strip_scheme(url: Column) -> Column:
    """C2. Drop one leading ``scheme://``."""
    return F.regexp_replace(url, SCHEME_PATTERN, "")


def strip_trailing_slashes(url: Column) -> Column:
    """C3. Drop all slashes at the end of the whole string.

    A native right trim stays linear on a URL that holds long runs of slashes,
    where a ``/+`` pattern tied to the end would retry at every slash.
    """
    return F.rtrim(url, F.lit("/"))


def lower_host(url: Column) -> Column:
    """C4. Lower-case what stands before the first slash, keep the rest."""
    pieces = F.split(url, "/", 2)
    rest = F.concat(F.lit("/"), F.get(pieces, F.lit(1)))
    return F.concat(F.lower(F.get(pieces, F.lit(0))), F.coalesce(rest, F.lit("")))


def canonicalize(url: Column) -> Column:
    """C5. One pass of C1 to C4. A null URL stays null."""
    return lower_host(strip_trailing_slashes(strip_scheme(trim_whitespace(url))))
