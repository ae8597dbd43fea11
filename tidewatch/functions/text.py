"""Text, governance and scoring helpers as Column expressions."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: A valid dotted address that isn't part of a longer run of digits and dots.
IPV4_IN_TEXT = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9.])"


def redact_ipv4(text: Column) -> Column:
    """Every valid IPv4 address in a text as ``[ip]``; version strings and impossible octets stay."""
    return F.regexp_replace(text, IPV4_IN_TEXT, "[ip]")


def find_ipv4(text: Column) -> Column:
    """The valid IPv4 addresses in a text, in order."""
    return F.regexp_extract_all(text, F.lit(IPV4_IN_TEXT), F.lit(0))


def hmac_sha256(message: Column, key: bytes) -> Column:
    """HMAC-SHA-256 of a text in lower-case hexadecimal, by two nested digests; runs in the JVM."""
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    block = key.ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    first = F.unhex(F.sha2(F.concat(inner, F.encode(message, "UTF-8")), 256))
    return F.sha2(F.concat(outer, first), 256)


def pseudonym(value: Column, key: bytes) -> Column:
    """A stable stand-in for a value that only the key's owner can recompute; null stays null."""
    return F.concat(F.lit("anon-"), F.substring(hmac_sha256(value, key), 1, 16))


def plain_address(value: Column) -> Column:
    """An address in the one form that all its spellings share (IPv6 shortened, IPv4 in IPv6 as IPv4); what is no address is an error, null stays null."""
    text = F.trim(value)
    v4 = text.rlike(r"^((25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(\.(?!$)|$)){4}$")
    other = _unify(F.when(text.isNotNull() & ~v4, text))
    return F.when(text.isNull() | v4, text).when(other.isNotNull(), other).otherwise(F.raise_error(F.lit("a value to be pseudonymised isn't an address")).cast("string"))


def _unify(texts: Column) -> Column:
    import ipaddress

    def one(t):
        try:
            a = ipaddress.ip_address(t) if t is not None else None
        except ValueError:
            return None
        return None if a is None else str(getattr(a, "ipv4_mapped", None) or a)

    def unify(values: pd.Series) -> pd.Series:
        return values.map(one)

    return F.pandas_udf(unify, "string")(texts)


def address_pseudonym(value: Column, key: bytes) -> Column:
    """A pseudonym that is the same for every spelling of an address."""
    return pseudonym(plain_address(value), key)


class KeyTooShort(ValueError):
    """The pseudonymisation key is too short to be safe."""


def load_key(environ: Mapping[str, str], name: str = "TIDEWATCH_PSEUDONYM_KEY", least: int = 32) -> bytes | None:
    """The key of the environment; None if unset, an error if it is shorter than ``least`` bytes."""
    raw = environ.get(name, "").encode()
    if not raw:
        return None
    if len(raw) < least:
        raise KeyTooShort(f"{name} needs at least {least} bytes")
    return raw


def joined_text(*parts: Column) -> Column:
    """Parts joined by one blank, null and empty ones left out."""
    return F.concat_ws(" ", *(F.nullif(p, F.lit("")) for p in parts))


def words(text: Column) -> Column:
    """Lower-case words of two or more word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))


def is_documentation_address(c: Column) -> Column:
    """Addresses reserved for documentation (RFC 5737)."""
    # The three reserved networks.
    return c.startswith("192.0.2.") | c.startswith("198.51.100.") | c.startswith("203.0.113.")


_SAFE_NAME = re.compile(r"(staging|silver|gold|ml)\.[a-z][a-z0-9_]*")


def guarded_name(name: str) -> str:
    """A table name that may go into a statement; anything else is refused."""
    if not _SAFE_NAME.fullmatch(name):
        raise ValueError(f"not a model's name: {name!r}")
    return name


def guarded_query(statement: str) -> str:
    """A statement that only reads; anything else is refused."""
    bare = re.sub(r"/\*.*?\*/|--[^\n]*", " ", statement, flags=re.S).strip().rstrip(";").strip()
    if ";" in bare or not re.match(r"(?i)(select|with|show|describe|explain|values|table)\b", bare):
        raise ValueError("only a single reading statement is allowed")
    if re.search(r"(?i)\b(insert|update|delete|drop|create|alter|merge|truncate|replace\s+table)\b", re.sub(r"'[^']*'", "''", bare)):
        raise ValueError("only a single reading statement is allowed")
    return bare


def preview(text: str, most: int = 300) -> str:
    """One line of at most ``most`` characters."""
    line = re.sub(r"\s+", " ", text)
    return line if len(line) <= most else line[: most - 1] + "…"
