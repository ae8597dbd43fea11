"""Canonical forms of identifiers, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space at the ends of a text, tabs and no-break spaces included.
_ENDS = r"(?U)^\s+|\s+$"
_V4 = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"
_V6 = r"^[0-9a-f.]*:[0-9a-f:.]*:[0-9a-f:.]*$"


def squeeze(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, _ENDS, "")


def text_or_empty(c: Column) -> Column:
    """Blanks at the ends removed, null as the empty text."""
    return F.coalesce(squeeze(c), F.lit(""))


def plain_ip(c: Column) -> Column:
    """An address by value: no blanks, lower case, ``::ffff:a.b.c.d`` as ``a.b.c.d``; null if it isn't an address."""
    low = F.lower(F.regexp_replace(c, r"(?U)\s+", ""))
    bare = F.regexp_replace(low, r"^::ffff:(?=[0-9]{1,3}(\.[0-9]{1,3}){3}$)", "")
    return F.when(bare.rlike(_V4) | bare.rlike(_V6), bare)


def plain_cve(c: Column) -> Column:
    """A CVE in upper case without blanks; null if nothing is left."""
    return F.nullif(F.upper(F.regexp_replace(c, r"(?U)\s+", "")), F.lit(""))


def plain_uuid(c: Column) -> Column:
    """An identifier as 8-4-4-4-12 in lower case; letter case, hyphens, braces and blanks are dropped.

    What doesn't hold 32 hexadecimal digits stays as its stripped lower-case text; null if nothing is left.
    """
    bare = F.lower(F.regexp_replace(c, r"(?U)[\s{}\-]+", ""))
    dashed = F.regexp_replace(bare, r"^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$", "$1-$2-$3-$4-$5")
    return F.nullif(dashed, F.lit(""))
