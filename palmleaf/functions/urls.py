"""URL column functions: parts, identities, guards and routes, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..tables import EXCLUDED, NON_DOWNLOAD_KEYS, PROVIDERS, SEARCH_KEYS, SEARCH_LABELS, TRACKING_KEYS

# Fixed value: scheme, authority, path, query and fragment of a URL.
PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(url: Column, i: int) -> Column:
    return F.regexp_extract(url, PARTS, i)


def scheme(url: Column) -> Column:
    return F.lower(part(url, 1))


def port(url: Column) -> Column:
    return F.regexp_extract(part(url, 2), r":(\d*)$", 1)


def host(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null for other schemes and ports above 65535."""
    name = F.regexp_replace(F.lower(F.regexp_replace(F.regexp_replace(part(url, 2), "^.*@", ""), r":\d*$", "")), r"\.$", "")
    valid = scheme(url).isin("http", "https") & (F.when(port(url) == "", F.lit(0)).otherwise(port(url).try_cast("int")) <= 65535)
    return F.when(valid & (name != ""), name)


def site_key(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def in_domains(name: Column, domains: str) -> Column:
    exact = domains.split()
    return F.coalesce(name.isin(exact) | name.rlike("\\.(" + "|".join(d.replace(".", "\\.") for d in exact) + ")$"), F.lit(False))


def _by_suffix(name: Column, families: tuple[tuple[str, str], ...]) -> Column:
    """What stands for the listed domain that a host is or ends with: one search and one look-up."""
    known = {d: what for what, domains in reversed(families) for d in domains.split()}
    pattern = r"(?:^|\.)(" + "|".join(d.replace(".", "\\.") for d in sorted(known, key=len, reverse=True)) + ")$"
    table = F.map_from_arrays(F.array(*map(F.lit, known)), F.array(*map(F.lit, known.values())))
    return F.try_element_at(table, F.regexp_extract(name, pattern, 1))


_LABEL = r"(?:^|\.)(?:" + "|".join(SEARCH_LABELS.split()) + r")(?:\.|$)"


def excluded_host(name: Column) -> Column:
    """The first family that excludes a host; null where it may be crawled. Families do not hold domains of each other."""
    return F.coalesce(_by_suffix(name, EXCLUDED), F.when(name.rlike(_LABEL), EXCLUDED[-1][0]))


def excluded_reason(url: Column) -> Column:
    """Why a URL may not be crawled, null where it may."""
    out = F.when(~scheme(url).isin("http", "https") | (part(url, 2) == ""), "only HTTP(S) sites can be crawled").when(host(url).isNull(), "invalid HTTP(S) URL")
    return out.otherwise(excluded_host(host(url)))


def provider_of(name: Column) -> Column:
    return _by_suffix(name, PROVIDERS)


def provider(url: Column) -> Column:
    return provider_of(host(url))


def query_keys(url: Column) -> Column:
    return F.transform(F.filter(F.split(part(url, 4), "&"), lambda x: x != ""), lambda x: F.lower(F.regexp_extract(x, "^([^=]*)", 1)))


def is_site_search(url: Column) -> Column:
    first = F.lower(F.regexp_extract(part(url, 3), "^/*([^/]*)", 1))
    return (first == "search") | F.arrays_overlap(query_keys(url), F.array(*map(F.lit, SEARCH_KEYS)))


def is_document(url: Column) -> Column:
    return part(url, 3).rlike(r"(?i)\.(pdf|docx)$")


def guarded(url: Column) -> Column:
    """The identity of a URL without fragment and tracking keys; null for other schemes and share or print variants."""
    fields = F.filter(F.split(part(url, 4), "&"), lambda x: x != "")
    key = lambda x: F.lower(F.regexp_extract(x, "^([^=]*)", 1))
    kept = F.filter(fields, lambda x: ~(key(x).isin(*TRACKING_KEYS) | key(x).startswith("utm_")))
    query = F.when(F.size(kept) == F.size(fields), part(url, 4)).otherwise(F.array_join(kept, "&"))
    path = F.when(part(url, 3) == "", "/").otherwise(part(url, 3))
    user = F.regexp_extract(part(url, 2), "^(.*@)", 1)
    tail = F.when(port(url) == "", "").otherwise(F.concat(F.lit(":"), port(url)))
    rejected = F.arrays_overlap(F.transform(fields, key), F.array(*map(F.lit, NON_DOWNLOAD_KEYS)))
    return F.when(host(url).isNotNull() & ~rejected, F.concat(scheme(url), F.lit("://"), user, host(url), tail, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def canonical(url: Column) -> Column:
    """Lower scheme and host, no fragment, ports 80 and 443 left out for either scheme."""
    tail = F.when(port(url).isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port(url)))
    return F.when(host(url).isNotNull(), F.concat(scheme(url), F.lit("://"), host(url), tail, part(url, 3), F.when(part(url, 4) == "", "").otherwise(F.concat(F.lit("?"), part(url, 4)))))


def variants(url: Column) -> Column:
    """Distinct forms under which a URL may be recorded."""
    return F.array_distinct(F.filter(F.array(canonical(url), F.regexp_replace(canonical(url), r"\?.*$", "")), lambda x: x.isNotNull()))


def site_root(url: Column) -> Column:
    own = ((scheme(url) == "http") & (port(url) == "80")) | ((scheme(url) == "https") & (port(url) == "443")) | (port(url) == "")
    return F.concat(scheme(url), F.lit("://"), host(url), F.when(own, "").otherwise(F.concat(F.lit(":"), port(url))), F.lit("/"))


def segments(url: Column) -> Column:
    return F.filter(F.split(part(url, 3), "/"), lambda x: x != "")


def guide_chain(url: Column) -> Column:
    """The root and every ancestor path, shortest first."""
    parts = segments(url)
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.concat(site_root(url), F.array_join(F.slice(parts, 1, i), "/")))


def is_prefix_child(current: Column, candidate: Column) -> Column:
    a, b = F.regexp_replace(part(current, 3), "/$", ""), F.regexp_replace(part(candidate, 3), "/$", "")
    return (host(current) == host(candidate)) & b.startswith(F.concat(a, F.lit("/"))) & (F.length(b) > F.length(a) + 1)


def file_name(url: Column) -> Column:
    """Last path part, else host and a hash; unsafe characters become _, 180 characters at most."""
    last = F.regexp_extract(part(url, 3), "([^/]*)$", 1)
    name = F.coalesce(F.nullif(last, F.lit("")), F.concat_ws("-", host(url), F.substring(F.sha2(url, 256), 1, 10)))
    return F.substring(F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_"), 1, 180)
