"""Line dedup by site-relative frequency, in DataFrame operations only.

A line's frequency is the share of its host's pages that contain it. Lines at or above a ratio, on enough pages, are
boilerplate and are dropped. Lines are compared by a 64-bit hash of the trimmed line. A host has at most (mean distinct
lines of a page / ratio) such lines, so its list is bounded however large the host is. The list is joined to pages on host
and salt, so a host with a third of all pages is dealt out over SALTS tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

RATIO = 0.3
#: The same for documents, whose sources are broader than a site. On sf0.1 the common line of a source is on 0.086 to 0.132 of its
#: texts and any other line on 0.048 at most. It is one ratio for all lengths: long lines on a few texts can be those of near copies,
#: and dropping them before these are joined would drop them from the one that is to stay, too.
DOCUMENT_RATIO = 0.065
#: A line on fewer pages of its host than this is never boilerplate.
LEAST_PAGES = 3
SALTS = 32

# The host of a URL, and the tags that end a line.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
HIDDEN = r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->"
BLOCK = r"(?i)</?(?:html|head|body|title|nav|ul|ol|li|div|article|section|header|footer|aside|main|h[1-6]|p|table|tr|td|th|br|hr|form)\b[^>]*>"
TAG = r"<[^>]*>"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def page_text(html: Column) -> Column:
    """The text of a page with a line for each block element."""
    for pattern, to in ((HIDDEN, ""), (BLOCK, "\n"), (TAG, "")):
        html = F.regexp_replace(html, pattern, to)
    return html


def _line(x: Column) -> Column:
    return F.trim(x, F.lit(" \t\r"))


def boilerplate(rows: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """host, lines (array of hashes) from rows of (host, text). Rows without a host have nothing in common and count nowhere."""
    rows = rows.filter("host <> ''")
    totals = rows.groupBy("host").agg(F.count("*").alias("n_pages"))
    distinct = F.array_distinct(F.transform(F.filter(F.transform(F.split("text", "\n"), _line), lambda x: x != ""), lambda x: F.xxhash64(x)))
    counts = rows.select("host", F.explode(distinct).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= least_pages)
    common = counts.join(totals, "host").filter(F.col("n") >= ratio * F.col("n_pages"))
    return common.groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(rows: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """rows (host, text and any more columns) with text cut to its other lines, and n_lines and n_dropped, which take the place
    of columns of these names.

    Lines are split at \\n and compared without outer blanks; blank lines are kept where they are and not counted. A null
    text stays null, with no lines; a null or empty host is no site, and its rows lose no line. Every row counts as a page, repeated rows too, so
    text that fills a site with copies is boilerplate there.
    """
    names = [c for c in rows.columns if c not in ("host", "text", "n_lines", "n_dropped")]
    held = rows.select(F.coalesce("host", F.lit("")).alias("host"), "text", F.struct(*names).alias("_row") if names else F.lit(None).alias("_row"))
    found = boilerplate(held.select("host", "text"), ratio, least_pages).select("host", F.col("lines").alias("_lines"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    # rows with equal texts differ in other columns, by which they are dealt, too
    plain = [F.col("_row")[c] for c in names if isinstance(rows.schema[c].dataType, AtomicType)]
    joined = held.withColumn("_salt", F.pmod(F.xxhash64("text", *plain), F.lit(SALTS)).cast("int")).join(found, ["host", "_salt"], "left")
    none = F.array().cast("array<bigint>")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x: (_line(x) == "") | ~F.array_contains(F.coalesce("_lines", none), F.xxhash64(_line(x))))
    full = lambda a: F.coalesce(F.size(F.filter(a, lambda x: _line(x) != "")), F.lit(0))
    out = joined.withColumn("_kept", kept).withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(full(lines)))
    out = out.withColumn("n_dropped", F.col("n_lines") - F.when(F.col("text").isNull(), 0).otherwise(full(F.col("_kept")))).withColumn("text", F.array_join("_kept", "\n"))
    return out.select(*(F.col("_row")[c].alias(c) for c in names), "host", "text", "n_lines", "n_dropped")


def dedup_pages(pages: DataFrame) -> DataFrame:
    """page_id, host, n_lines, n_dropped, text of every row of pages (page_id, url, html; other columns are left behind).

    A page with a null URL, or one without a host, has host "" and loses no line. A null page has a null text.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), page_text(F.col("html")).alias("text"))
    return drop_boilerplate(rows).select("page_id", "host", "n_lines", "n_dropped", "text")


def dedup_documents(docs: DataFrame) -> DataFrame:
    """docs with the same columns and rows: source is the site, text loses its boilerplate, n_chars follows the text.

    Rows are as in drop_boilerplate; those without a source lose no line.
    """
    names = docs.columns
    rows = docs.select(*(F.col(c).alias(f"d_{i}") for i, c in enumerate(names)), F.col("source").alias("host"), "text")
    out = drop_boilerplate(rows, DOCUMENT_RATIO)
    new = {"text": F.col("text")}
    if "n_chars" in names:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col(f"d_{i}")).alias(c) for i, c in enumerate(names)))


SQL = r"""
WITH texts AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
  regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->', '', 'g'),
    '(?i)</?(?:html|head|body|title|nav|ul|ol|li|div|article|section|header|footer|aside|main|h[1-6]|p|table|tr|td|th|br|hr|form)\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g') AS text FROM pages),
numbered AS (SELECT *, row_number() OVER () AS k FROM texts),
split AS (SELECT k, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM numbered),
lines AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS t FROM split),
totals AS (SELECT host, count(*) AS n_pages FROM numbered GROUP BY host),
common AS (SELECT l.host, l.t FROM lines l JOIN totals USING (host) WHERE t <> '' AND l.host <> '' GROUP BY l.host, l.t, n_pages HAVING count(DISTINCT k) >= 3 AND count(DISTINCT k) >= 0.3::DOUBLE * n_pages),
marked AS (SELECT l.*, c.t IS NOT NULL AS bad FROM lines l LEFT JOIN common c ON l.host = c.host AND l.t = c.t),
back AS (SELECT k, count(*) FILTER (t <> '')::INT AS n_lines, count(*) FILTER (bad)::INT AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT bad), '') AS text FROM marked GROUP BY k)
SELECT n.page_id, n.host, coalesce(b.n_lines, 0)::INT AS n_lines, coalesce(b.n_dropped, 0)::INT AS n_dropped, CASE WHEN n.text IS NULL THEN NULL ELSE b.text END AS text FROM numbered n LEFT JOIN back b USING (k)
"""
