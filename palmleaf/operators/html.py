"""Download candidates of web pages as relations: every element's targets and every form as rows, and rules over them.

Only the parsing of a page is Python; guards, routes, precedence and identities are column functions over its rows.
"""

from __future__ import annotations

import re
import urllib.parse
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.batches import rows_of
from ..tables import DOWNLOAD_WORDS, OTHER_WORDS, PROVIDERS, VOLATILE_FIELDS

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Attributes that hold a target, and those whose words describe an element.
TARGETS = frozenset("href action formaction data-url data-href data-link data-download-url".split())
DESCRIBING = ("title", "aria-label", "id", "class", "value")
LABEL = 180
_QUOTED = re.compile(r"""(?P<q>['"])(?P<x>[^'"]+)(?P=q)""")
_ABSOLUTE = re.compile(r"https?://[^\s\"'<>]+", re.I)


@dataclass
class Element:
    """An element, its attributes and the text within it."""

    tag: str
    attrs: dict[str, str]
    parent: Element | None
    text: list[str] = field(default_factory=list)

    def words(self) -> str:
        return " ".join(" ".join(self.text).split())

    def described(self) -> str:
        return " ".join(x for x in (self.words(), *(self.attrs.get(a, "") for a in DESCRIBING)) if x)

    def inside(self, tag: str) -> Element | None:
        e = self.parent
        while e is not None and e.tag != tag:
            e = e.parent
        return e


class Page(HTMLParser):
    """All elements of a page in order. An element without an end ends with the one around it."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.elements: list[Element] = []
        self.open: list[Element] = []
        self.feed(html)

    def handle_starttag(self, tag, attrs):
        e = Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.open[-1] if self.open else None)
        self.elements.append(e)
        if tag not in VOID:
            self.open.append(e)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if data.strip() and not (self.open and self.open[-1].tag in ("script", "style")):
            for e in self.open:
                e.text.append(data)


def resolved(base: str, raw: str) -> str | None:
    try:
        return urllib.parse.urljoin(base, raw.strip())
    except ValueError:
        return None


def targets_of(html: str, url: str) -> Iterator[tuple[int, str, str, str, str, str]]:
    """(pos, tag, via, target, label, marker): every attribute, quoted part of a handler and absolute URL that may lead to a file."""
    page = Page(html)
    base = next((resolved(url, e.attrs["href"]) for e in page.elements if e.tag == "base" and e.attrs.get("href")), url) or url
    pos = 0
    for e in page.elements:
        found = [(k, v) for k, v in e.attrs.items() if k in TARGETS or k.startswith("data-")]
        found += [("onclick", m["x"]) for m in _QUOTED.finditer(e.attrs.get("onclick", "").replace("\\/", "/"))]
        if not found:
            continue
        label, marker = e.words() or e.attrs.get("title", ""), e.described()
        for via, raw in found:
            if raw.strip() and not raw.strip().startswith("#") and (full := resolved(base, raw)):
                yield pos, e.tag, via, full, label, marker
                pos += 1
    for m in _ABSOLUTE.finditer(html.replace("\\/", "/")):
        yield pos, "", "text", m[0].rstrip(").,;}"), "", ""
        pos += 1


def _table(pages: DataFrame, schema: str, one) -> DataFrame:
    return rows_of(pages, ["page_id", "url", "html"], schema, lambda page, url, html: ((page, url, *x) for x in one(html or "", url or "")))


def page_targets(pages: DataFrame) -> DataFrame:
    """page_id, page_url, pos, tag, via, target, label, marker of pages (page_id, url, html); a null page has none."""
    return _table(pages, "page_id long, page_url string, pos int, tag string, via string, target string, label string, marker string", targets_of)


def _label(x: Column) -> Column:
    return F.substring(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " ")), 1, LABEL)


def _first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key, reduced before it is moved."""
    names = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*names), F.struct(*order)).alias("_f")).select(*(F.col(c) if c in keys else F.col("_f")[c].alias(c) for c in df.columns))


def file_links(targets: DataFrame) -> DataFrame:
    """Guarded URLs of PDF and DOCX files, the label of an anchor before that of another element."""
    via = F.col("via")
    rows = targets.filter((via == "onclick") | via.isin("action", "formaction") | via.startswith("data-") | ((via == "href") & (F.col("tag") == "a")))
    rows = kept(rows, "url", U.guarded(F.col("target"))).filter(U.is_document(F.col("url")))
    rows = rows.withColumn("rank", F.when((via == "href") & (F.col("tag") == "a"), 0).otherwise(1))
    return _first(rows.select("page_id", "page_url", "url", _label(F.col("label")).alias("label"), "rank", "pos"), ["page_id", "page_url", "url"], [F.col("rank"), F.col("pos")]).drop("rank")


def is_share(url: Column, provider: Column) -> Column:
    """Whether a file host's URL is one of a file or folder, by provider."""
    path, query, fragment = F.lower(U.part(url, 3)), U.part(url, 4), U.part(url, 5)
    has = lambda key: query.rlike(rf"(?:^|&){key}=[^&]")
    rules = {
        "drive": path.rlike("/(?:file|document|spreadsheets|presentation)/d/") | path.isin("/open", "/uc", "/download") | has("id"),
        "mega": path.rlike("^/(?:file|folder)/") | fragment.startswith("!"),
        "mediafire": path.rlike("^/(?:file|view|download)/") | U.host(url).rlike(r"^download[^.]*\."),
        "dropbox": U.host(url).rlike(r"(?:^|\.)dropboxusercontent\.com$") | path.rlike("^/(?:s|scl/fi|scl/fo)/"),
        "terabox": path.rlike("^/(?:s|share|sharing|download)/") | has("surl"),
    }
    out = F.lit(False)
    for name, rule in rules.items():
        out = F.when(provider == name, rule).otherwise(out)
    return U.is_document(url) | out


def provider_links(targets: DataFrame) -> DataFrame:
    """URLs of known file hosts, without their fragment but for mega, whose key it is; users in a URL are refused."""
    rows = targets.filter(F.col("via").isin(*TARGETS, "text", "onclick") & F.col("target").rlike("(?i)^https?://[^/?#@]+(?:[/?#]|$)"))
    rows = rows.withColumn("host", U.host(F.col("target"))).withColumn("provider", U.provider_of(F.col("host")))
    rows = rows.filter(F.col("provider").isNotNull() & is_share(F.col("target"), F.col("provider")))
    rows = rows.withColumn("url", F.when(F.col("provider") == "mega", F.col("target")).otherwise(F.regexp_replace("target", "#.*$", "")))
    anchor = (F.col("tag") == "a") & (F.col("via") == "href")
    rank = F.when(anchor, 0).when(F.col("via") == "text", 2).otherwise(1).alias("rank")
    label = _label(F.when(anchor, F.col("label")).otherwise(F.col("marker"))).alias("label")
    return _first(rows.select("page_id", "page_url", "url", "provider", label, rank, "pos"), ["page_id", "page_url", "url", "provider"], [F.col("rank"), F.col("pos")]).drop("rank")


def kept(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column, without the rows where it is null. The value is worked out once: no filter is moved below a generator."""
    return df.withColumn("_kept", value).withColumn(name, F.explode(F.array("_kept"))).filter(F.col(name).isNotNull()).drop("_kept")


def site_pages(df: DataFrame, name: str, url: Column, page: Column) -> DataFrame:
    """df with the guarded URL of a page of the same site that may be crawled and is no search; rows without one are dropped."""
    clean, own = F.col("_clean"), F.col("_host")
    df = kept(df, "_clean", U.guarded(url)).withColumn("_host", U.host(clean)).withColumn("_site", U.site_key(page))
    mine = (F.regexp_replace(own, r"^www\.", "") == F.col("_site")) & ~U.part(clean, 2).contains("@") & U.excluded_host(own).isNull() & ~U.is_site_search(clean)
    return kept(df, name, F.when(mine, clean)).drop("_clean", "_host", "_site")


def controls(targets: DataFrame) -> DataFrame:
    """Same-site targets of elements that call themselves downloads but name no file."""
    marked = targets.filter(F.col("marker").rlike(DOWNLOAD_WORDS) & ~F.col("marker").rlike(OTHER_WORDS) & F.col("via").isin(*TARGETS, "onclick"))
    rows = site_pages(marked, "target", F.col("target"), F.col("page_url")).filter(~U.is_document(F.col("target")))
    return _first(rows.select("page_id", "page_url", F.col("target").alias("url"), _label(F.col("marker")).alias("label"), "pos"), ["page_id", "page_url", "url"], [F.col("pos")])


SKIPPED = frozenset("submit button image reset file".split())


def fields_of(form: Element, elements: list[Element]) -> dict[str, str]:
    """What a browser would send of a form: named, enabled controls with a value."""
    out: dict[str, str] = {}
    for e in elements:
        name, kind = e.attrs.get("name", ""), (e.attrs.get("type") or "text").lower()
        if e.inside("form") is not form or not name or "disabled" in e.attrs:
            continue
        if e.tag == "textarea":
            out[name] = "".join(e.text)
        elif e.tag == "select":
            options = [o for o in elements if o.tag == "option" and o.inside("select") is e]
            chosen = [o for o in options if "selected" in o.attrs] or ([] if "multiple" in e.attrs else options[:1])
            for o in chosen:
                out[name] = o.attrs.get("value", o.words())
        elif e.tag == "input" and kind not in SKIPPED and (kind not in ("checkbox", "radio") or "checked" in e.attrs):
            out[name] = e.attrs.get("value", "")
    return out


def forms_of(html: str, url: str) -> Iterator[tuple[int, str, str, str, dict[str, str]]]:
    """(pos, action, method, label, data) of every form and of every button that sends it elsewhere; GET fields are in the action."""
    page, pos = Page(html), 0
    for form in page.elements:
        if form.tag != "form":
            continue
        data, method = fields_of(form, page.elements), (form.attrs.get("method") or "GET").strip().upper()
        sent = [(form.attrs.get("action") or url, method)]
        for e in page.elements:
            kind = (e.attrs.get("type") or "").lower()
            sends = (e.tag == "button" and kind in ("", "submit")) or (e.tag == "input" and kind in ("submit", "image"))
            if sends and e.inside("form") is form and e.attrs.get("formaction", "").strip():
                sent.append((e.attrs["formaction"], (e.attrs.get("formmethod") or "").strip().upper() or method))
        for action, how in sent:
            full = resolved(url, action)
            if full is None:
                continue
            if how == "GET" and data:
                parts = urllib.parse.urlsplit(full)
                query = urllib.parse.parse_qsl(parts.query, keep_blank_values=True) + sorted(data.items())
                full = urllib.parse.urlunsplit(parts._replace(query=urllib.parse.urlencode(query), fragment=""))
            yield pos, full, "GET" if how == "GET" else "POST", form.described(), {} if how == "GET" else data
            pos += 1


def download_forms(pages: DataFrame) -> DataFrame:
    """page_id, page_url, url, method, label, data, key of the same-site forms that call themselves downloads; one per key."""
    rows = _table(pages, "page_id long, page_url string, pos int, action string, method string, label string, data map<string,string>", forms_of)
    rows = site_pages(rows.filter(F.col("label").rlike(DOWNLOAD_WORDS) & ~F.col("label").rlike(OTHER_WORDS)), "url", F.col("action"), F.col("page_url"))
    plain = U.is_document(F.col("url"))
    rows = rows.withColumn("method", F.when(plain, "GET").otherwise(F.col("method"))).withColumn("data", F.when(plain, F.create_map().cast("map<string,string>")).otherwise(F.col("data")))
    rows = rows.withColumn("key", form_key(F.col("method"), F.col("url"), F.col("data")))
    order = F.array_join(F.transform(F.array_sort(F.map_entries("data")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&")
    rows = rows.withColumn("label", _label(F.col("label"))).withColumn("_data", order)
    names = ["url", "method", "label", "data", "pos"]
    return rows.groupBy("page_id", "page_url", "key").agg(F.min_by(F.struct(*names), F.struct("pos", "_data")).alias("f")).select("page_id", "page_url", "key", *(F.col("f")[n].alias(n) for n in names))


def form_key(method: Column, url: Column, data: Column) -> Column:
    """METHOD url k=v&..., fields in order, without those that change with every visit."""
    kept = F.filter(F.array_sort(F.map_entries(data)), lambda e: ~F.lower(e["key"]).isin(*VOLATILE_FIELDS))
    query = F.array_join(F.transform(kept, lambda e: F.concat(F.replace(F.url_encode(e["key"]), F.lit("%20"), F.lit("+")), F.lit("="), F.replace(F.url_encode(e["value"]), F.lit("%20"), F.lit("+")))), "&")
    return F.concat_ws(" ", F.upper(method), url, F.nullif(query, F.lit("")))


def candidate_key(url: Column, provider: Column) -> Column:
    """Identity of a candidate that is no form: mega with its key, other hosts without fragment, else the guarded URL."""
    return F.when(provider == "mega", url).when(provider.isNotNull(), F.regexp_replace(url, "#.*$", "")).otherwise(F.coalesce(U.guarded(url), url))


def candidates(pages: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """page_id, key, url, method, label, provider: the downloads of every page, one row per key.

    File links come first, then file hosts, forms and controls; a later, better label replaces an empty one or one that only
    says "download". Controls that lead to known pages (url) or to where a form is posted are left to those.
    """
    targets = page_targets(pages)
    files = file_links(targets).filter(~F.col("label").rlike(OTHER_WORDS)).withColumn("host", U.host(F.col("url")))
    files = files.withColumn("provider", U.provider_of(F.col("host"))).filter(F.col("provider").isNotNull() | U.excluded_host(F.col("host")).isNull())
    hosts = provider_links(targets)
    forms = download_forms(pages)
    buttons = controls(targets).join(forms.filter("method = 'POST'").select("page_id", "url").distinct(), ["page_id", "url"], "left_anti")
    if known is not None:
        buttons = buttons.join(known.select("url").distinct(), "url", "left_anti")
    none = F.lit(None).cast("string")

    def part(df: DataFrame, step: int, provider: Column, key: Column, method: Column) -> DataFrame:
        return df.select("page_id", key.alias("key"), F.struct("url", method.alias("method"), provider.alias("provider")).alias("row"), "label", F.struct(F.lit(step).alias("step"), "pos").alias("at"))

    get = F.lit("GET")
    both = part(files, 0, F.col("provider"), candidate_key(F.col("url"), F.col("provider")), get)
    both = both.unionByName(part(hosts, 1, F.col("provider"), candidate_key(F.col("url"), F.col("provider")), get))
    both = both.unionByName(part(forms, 2, none, F.when(F.col("method") == "POST", F.col("key")).otherwise(F.col("url")), F.col("method")))
    both = both.unionByName(part(buttons, 3, none, candidate_key(F.col("url"), none), get))
    weak = (F.col("label") == "") | F.lower("label").isin("download", "pdf", "docx")
    found = both.groupBy("page_id", "key").agg(F.min_by("row", "at").alias("row"), F.min_by("label", F.when(~weak, F.col("at"))).alias("good"), F.min_by("label", F.when(F.col("label") != "", F.col("at"))).alias("some"))
    return found.select("page_id", "key", "row.url", "row.method", F.coalesce("good", "some", F.lit("")).alias("label"), "row.provider")


# ---- sitemaps, robots, bodies, logins ----


def sitemap_of(text: str) -> tuple[str, list[str]] | None:
    """urlset or sitemapindex, and its locations; null for anything else. Namespaces do not matter."""
    try:
        root = ET.fromstring(text.lstrip("﻿"))
    except (ET.ParseError, ValueError):
        return None
    local = lambda e: e.tag.rsplit("}", 1)[-1].lower()
    entry = {"urlset": "url", "sitemapindex": "sitemap"}.get(local(root))
    if entry is None:
        return None
    found = [next(((c.text or "").strip() for c in e if local(c) == "loc"), "") for e in root if local(e) == entry]
    return local(root), [x for x in found if x]


def sitemap_entries(maps: DataFrame) -> DataFrame:
    """url, kind, pos, loc, route of sitemaps (url, body): pages of the site, downloads elsewhere, maps of an index; the rest is dropped."""

    def one(url: str | None, body: str | None) -> Iterator[tuple]:
        kind, found = sitemap_of(body or "") or ("", [])
        yield from ((url, kind, i, resolved(url, x)) for i, x in enumerate(found))

    rows = rows_of(maps, ["url", "body"], "url string, kind string, pos int, loc string", one)
    loc, same = F.col("loc"), F.coalesce(U.site_key(F.col("loc")) == U.site_key(F.col("url")), F.lit(False))
    host = U.host(loc)
    file = U.provider_of(host).isNotNull() | (U.is_document(loc) & ~same & U.excluded_host(host).isNull())
    route = F.when(F.col("kind") == "sitemapindex", F.when(same, "map")).when(file, "download").when(same, "page")
    return rows.withColumn("route", route).filter("route IS NOT NULL")


def robots_sitemaps(robots: DataFrame) -> DataFrame:
    """url, pos, sitemap: the same-site maps that a robots file (url, body) declares, each once, in order."""
    lines = robots.select("url", F.posexplode(F.split("body", r"\r\n|\r|\n")).alias("pos", "line"))
    told = F.trim(F.regexp_extract("line", r"(?i)^\s*sitemap\s*:([^#]*)", 1))
    rows = kept(lines, "told", F.nullif(told, F.lit("")))
    full = F.when(F.col("told").rlike("(?i)^https?://"), F.col("told")).otherwise(F.concat(F.regexp_replace(U.site_root(F.col("url")), "/$", ""), F.when(F.col("told").startswith("/"), "").otherwise("/"), F.col("told")))
    rows = site_pages(rows, "sitemap", full, F.col("url"))
    return _first(rows.select("url", "sitemap", "pos"), ["url", "sitemap"], [F.col("pos")])


def bare_url(body: Column) -> Column:
    """The URL that a short body consists of, else null."""
    text = F.trim(body, F.lit(" \t\r\n\"'"))
    return F.when((F.octet_length(body) <= 8192) & (F.length(text) <= 2048) & text.rlike(r"(?i)^https?://[^\s\"'<>]+$"), text)


def login_score(pages: DataFrame) -> DataFrame:
    """page_id, forms: for every page how many forms ask for one password and a name beside it, as a login does and a registration does not."""

    def count(html: str, url: str) -> Iterator[tuple[int]]:
        page = Page(html)
        total = 0
        for form in page.elements:
            if form.tag == "form":
                kinds = [(e.attrs.get("type") or "text").lower() for e in page.elements if e.tag == "input" and e.inside("form") is form]
                total += kinds.count("password") == 1 and any(k in ("text", "email", "tel") for k in kinds)
        yield (total,)

    return _table(pages, "page_id long, page_url string, forms int", count).drop("page_url")


PROVIDER_HOSTS = " ".join(d for _, d in PROVIDERS)
