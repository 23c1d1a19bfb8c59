"""URL functions as Column expressions; none of them fails on a malformed URL."""

from __future__ import annotations

import ipaddress
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Query keys that only track a visitor, besides those that start with utm_.
TRACKING_KEYS = ("spm", "from", "source")
_START = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"


def _group(url: Column, pattern: str, group: int = 1) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, group), F.lit(""))


def scheme(url: Column) -> Column:
    return F.lower(_group(url, _START))


def authority(url: Column) -> Column:
    return _group(url, _START + r"([^/?#]*)", 2)


def host(url: Column) -> Column:
    """Lower-case host without port, user or closing dots; '' where there is none."""
    return F.rtrim(F.lower(_group(authority(url), r"^(?:.*@)?(\[[^\]]*\]|[^:]*)(?::.*)?$")), F.lit("."))


def _query(url: Column) -> Column:
    return _group(url, r"^[^?#]*\?([^#]*)")


def _path(url: Column) -> Column:
    return _group(url, _START + r"[^/?#]*([^?#]*)", 2)


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and host, no default port, fragment or tracking keys; pairs sorted if all are key=value."""
    auth = authority(url)
    user = _group(auth, r"^(.*@)")
    bare = F.lower(_group(auth, r"^(?:.*@)?(\[[^\]]*\]|[^:]*)"))
    port = _group(auth, r":([0-9]+)$").try_cast("int")
    default = ((scheme(url) == "http") & (port == 80)) | ((scheme(url) == "https") & (port == 443))
    shown = F.when(port.isNull() | default, F.lit("")).otherwise(F.concat(F.lit(":"), port.cast("string")))

    def tracks(part: Column) -> Column:
        raw = F.substring_index(part, "=", 1)
        key = F.lower(F.coalesce(F.try_url_decode(raw), raw))
        return key.isin(*TRACKING_KEYS) | key.startswith("utm_")

    kept = F.filter(F.split(_query(url), "&"), lambda p: ~tracks(p))
    pairs = F.forall(kept, lambda p: p.rlike("(?s)^[^=]+=.+$"))
    query = F.array_join(F.when(pairs, F.array_sort(kept)).otherwise(kept), "&")
    out = F.concat(scheme(url), F.lit("://"), user, bare, shown, _path(url), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(bare != "", out).otherwise(F.regexp_replace(url, "#.*$", ""))


def in_domains(host_name: Column, domains: Iterable[str]) -> Column:
    """The host is one of the domains or below one."""
    found = F.lit(False)
    for d in domains:
        found |= (host_name == d) | host_name.endswith("." + d)
    return found


def host_suffixes(host_name: Column) -> Column:
    """The host and every domain above it, longest first."""
    labels = F.split(host_name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def shown_url(url: Column) -> Column:
    """Scheme, host, port and path only; 'invalid-url' without a host."""
    bare = F.regexp_replace(authority(url), "^.*@", "")
    return F.when(host(url) != "", F.concat(scheme(url), F.lit("://"), F.lower(bare), _path(url))).otherwise(F.lit("invalid-url"))


def usable_shape(title: Column, summary: Column, url: Column) -> Column:
    """Title and summary are not blank, and the URL is http(s) with a host."""
    filled = lambda c: F.coalesce(c, F.lit("")).rlike(r"(?U)\S")
    return filled(title) & filled(summary) & scheme(url).isin("http", "https") & (host(url) != "")


def _global(address: str | None) -> bool:
    try:
        return address is not None and ipaddress.ip_address(address.strip("[]").split("%")[0]).is_global
    except ValueError:
        return False


@F.pandas_udf(T.BooleanType())
def all_global(addresses: pd.Series) -> pd.Series:
    """Every address of the list is a global one; an empty list is not."""
    return addresses.map(lambda xs: xs is not None and len(xs) > 0 and all(map(_global, xs)))


def fetchable(url: Column, resolved: Column) -> Column:
    """A page that may be fetched: http(s), a valid port, and a host all of whose resolved addresses are public.

    resolved: the addresses that the host's name stood for when it was looked up; a literal address counts as its own.
    """
    name = host(url)
    literal = name.rlike(r"^(?:\[[0-9a-f:.]+\]|[0-9]+(?:\.[0-9]+){3})$")
    port = _group(authority(url), r":([^:\]]*)$")
    fits = (port == "") | F.coalesce(port.try_cast("int").between(0, 65_535), F.lit(False))
    every = F.when(literal, F.array_union(F.array(name), F.coalesce(resolved, F.array().cast("array<string>")))).otherwise(resolved)
    return scheme(url).isin("http", "https") & (name != "") & fits & all_global(every)
