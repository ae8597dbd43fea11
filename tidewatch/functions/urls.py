"""Parts of a URL, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _authority(url: Column) -> Column:
    """What stands between ``//`` and the path, without user information; empty if there is none."""
    return F.regexp_replace(F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1), r"^.*@", "")


def url_host(url: Column) -> Column:
    """The host in lower case; null if the URL has none."""
    return F.nullif(F.lower(F.regexp_replace(_authority(url), r":[0-9]*$", "")), F.lit(""))


def url_port(url: Column) -> Column:
    """The port; 443 for https and 80 for http if none is written, else null."""
    written = F.nullif(F.regexp_extract(_authority(url), r":([0-9]+)$", 1), F.lit("")).try_cast("int")
    scheme = F.lower(F.regexp_extract(F.trim(url), r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    return F.coalesce(written, F.when(scheme == "https", 443).when(scheme == "http", 80))


def url_last_segment(url: Column) -> Column:
    """What follows the path's last slash, without query and fragment; ``(root)`` if that is empty."""
    path = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.when(url.isNotNull(), F.coalesce(F.nullif(F.regexp_extract(path, r"([^/]*)$", 1), F.lit("")), F.lit("(root)")))


def ipv4_24(host: Column) -> Column:
    """The first three octets of a dotted IPv4 host; null for any other host."""
    return F.when(host.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), F.substring_index(host, ".", 3))
