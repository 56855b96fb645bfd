"""More named queries: documents, candidates, ledgers, mends and shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import mends as M
from ..functions import script as S
from ..functions import shape
from ..functions import urls as U
from ..operators import documents as D
from ..operators import html as H
from ..operators import ledger as L
from ..storage import cut
from ..streaming import jobs
from ..tables import COMMON_ENGLISH, IMPOSSIBLE_LETTERS, SCRIPT_2, VOWELLESS
from .queries import _URL, ONE, QUERIES, SQL, _list, query, script_docs, t

# ---- text ----
_known = _list(COMMON_ENGLISH.split())
_pair = _list(IMPOSSIBLE_LETTERS.split())


@query(f"""WITH r AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+') AS runs FROM documents),
w AS (SELECT doc_id, unnest(runs) AS w, lower(unnest(runs)) AS l FROM r),
f AS (SELECT doc_id, length(w) AS n, l, (CASE WHEN NOT (length(w) <= 6 AND w = upper(w)) AND length(w) >= 3 AND l NOT IN ({_list(VOWELLESS.split())}) AND NOT regexp_matches(l, '[aeiouy]') THEN 1 ELSE 0 END)
  + CASE WHEN len(list_filter(range(1, length(l) - 2), lambda i: l[i] = l[i + 1] AND l[i] = l[i + 2] AND l[i] = l[i + 3])) > 0 THEN 2 ELSE 0 END
  + len(list_filter(range(1, length(l)), lambda i: l[i:i + 1] IN ({_pair}))) + len(list_filter(range(1, length(l)), lambda i: l[i] = 'q' AND l[i + 1] <> 'u'))
  + (CASE WHEN length(w) > 16 THEN 1 ELSE 0 END) + (CASE WHEN length(w) > 20 THEN 1 ELSE 0 END) + (CASE WHEN length(w) > 45 THEN 2 ELSE 0 END) AS bad FROM w),
a AS (SELECT doc_id, sum(n) AS letters, count(*) AS runs, sum(bad) AS bad, max(n) AS longest, count(*) FILTER (n >= 2) AS words, count(*) FILTER (n >= 2 AND l IN ({_known})) AS common FROM f GROUP BY doc_id),
x AS (SELECT r.doc_id, coalesce(letters, 0) AS letters, coalesce(a.runs, 0) AS runs, CASE WHEN words > 0 THEN common / words ELSE 0.0 END AS ratio, CASE WHEN a.runs > 0 THEN bad / letters ELSE 0.0 END AS rate, coalesce(longest, 0) AS longest, coalesce(a.runs, 0) > 1 AND contains(text, ' ') AS spaced FROM r LEFT JOIN a USING (doc_id))
SELECT doc_id, letters::INT AS letters, runs::INT AS runs, round(ratio, 9) AS common_ratio, round(rate, 9) AS violation_rate, longest::INT AS max_run,
  CASE WHEN letters >= 12 THEN CASE WHEN (ratio >= 0.15 AND rate <= 0.02 AND longest <= 20) OR (ratio >= 0.08 AND spaced AND rate <= 0.01 AND longest <= 16) THEN 'english'
  WHEN (rate > 0.03 AND ratio < 0.05) OR (NOT spaced AND longest > 20 AND ratio < 0.05) OR (ratio > 0 AND ratio < 0.05 AND rate > 0.015) OR (ratio = 0 AND letters >= 24 AND runs >= 4) THEN 'not-english' END END AS verdict FROM x""")
def q_english_likeness(spark, sf):
    told = t(spark, sf, "documents").select("doc_id", S.likeness(F.col("text")).alias("c")).select("doc_id", "c.*")
    verdict = S.english_verdict({n: F.col(n) for n in S.LIKENESS.names})
    return told.select("doc_id", "letters", "runs", F.round("common_ratio", 9).alias("common_ratio"), F.round("violation_rate", 9).alias("violation_rate"), "max_run", verdict.alias("verdict"))


@query()
def q_scan_report(spark, sf):
    """Per language and rule: hits, distinct words, and the 25 most frequent words with where they were first seen."""
    words = cut(S.scan_words(script_docs(spark, sf)))  # read twice below, which would scan the texts twice
    totals = words.groupBy("lang", "rule").agg(F.sum("n").alias("total"), F.count("*").alias("n_words"))
    totals = F.broadcast(totals.withColumnsRenamed({"lang": "_lang", "rule": "_rule"}))  # one row for each of a few languages and six rules
    found = L.leading_words(words).join(totals, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("rule") == F.col("_rule")))
    return found.drop("_lang", "_rule")


@query(f"""WITH s AS (SELECT doc_id, t, stray + digit + virama AS issues FROM ({SQL["q_scan_totals"]}) JOIN {ONE} USING (doc_id)),
g AS (SELECT doc_id, len(regexp_extract_all(t, '[က-႟]')) AS my, 1 + length(t) // 2000 AS pages, issues FROM s)
SELECT doc_id, pages::INT AS pages, CASE WHEN my / pages < 12 OR (my > 0 AND issues / my > 0.01) OR my = 0 THEN 'old' ELSE 'convertable' END AS category FROM g""")
def q_old_font_gate(spark, sf):
    c = F.col("c")
    rows = script_docs(spark, sf).select("doc_id", "t", S.scan_totals(F.col("t")).alias("c"))
    pages = (1 + F.floor(F.length("t") / 2000)).cast("int")
    return rows.select("doc_id", pages.alias("pages"), D.old_font_gate(F.regexp_count("t", F.lit("[က-႟]")), pages, c["stray"] + c["digit"] + c["virama"]).alias("category"))


def _mended(f):
    return lambda spark, sf: script_docs(spark, sf, SCRIPT_2).select("doc_id", M.column(f)(F.col("t")).alias("mended"))


QUERIES |= {f"q_{f.__name__}": _mended(f) for f in (M.digits_mended, M.logical_order, M.prebase_moved, M.stored_order_unmixed)}

# ---- PDF ----
_CLEAN = r"[^A-Za-z0-9 \n]"


def pdf_of(text):
    """A PDF of one page with a text object for each line, as bytes."""
    shown = F.transform(F.split(text, "\n"), lambda x, i: F.concat(F.lit("BT /F1 10 Tf 10 "), (10000000 - 14 * i).cast("string"), F.lit(" Td ("), x, F.lit(") Tj ET")))
    objects = ("1 0 obj\n<< /Type /Catalog /Pages 2 0 R >>\nendobj\n2 0 obj\n<< /Type /Pages /Kids [3 0 R] /MediaBox [0 0 300 400] >>\nendobj\n"
               "3 0 obj\n<< /Type /Page /Parent 2 0 R /Contents 4 0 R /Resources << /Font << /F1 5 0 R >> >> >>\nendobj\n"
               "5 0 obj\n<< /Type /Font /BaseFont /Body /Encoding /WinAnsiEncoding >>\nendobj\n4 0 obj\n<< >>\nstream\n")  # fmt: skip
    return F.concat(F.lit("%PDF-1.4\n" + objects), F.array_join(shown, "\n"), F.lit("\nendstream\nendobj\n%%EOF")).cast("binary")


@query(r"""WITH c AS (SELECT doc_id, regexp_replace(text, '[^A-Za-z0-9 \n]', '', 'g') AS c FROM documents) SELECT 'd' || doc_id AS name, 0 AS page, c AS text FROM c""")
def q_pdf_text(spark, sf):
    """Every document as a PDF, and the text of its pages read back."""
    files = t(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("name"), pdf_of(F.regexp_replace("text", _CLEAN, "")).alias("content"))
    return D.page_texts(files)


@query(r"""SELECT 'd' || doc_id AS name, true AS is_pdf, 0 AS header, 1 AS n_pages, 'Body' AS fonts FROM documents""")
def q_pdf_files(spark, sf):
    files = t(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("name"), pdf_of(F.regexp_replace("text", _CLEAN, "")).alias("content"))
    return D.pdf_files(files).select("name", "is_pdf", "header", "n_pages", F.array_join("fonts", ",").alias("fonts"))


@query("""WITH RECURSIVE p AS (SELECT l_orderkey, l_quantity * 10 AS x, l_partkey % 40 * 2 AS y, l_returnflag || l_linestatus AS text, min(l_linenumber) AS seq FROM lineitem GROUP BY ALL),
a AS (SELECT l_orderkey, 0 AS line, max(y) AS y FROM p GROUP BY l_orderkey UNION ALL SELECT a.l_orderkey, a.line + 1, max(p.y) FROM a JOIN p ON p.l_orderkey = a.l_orderkey AND p.y < a.y - 3 GROUP BY a.l_orderkey, a.line)
SELECT a.l_orderkey, a.line, min(p.x)::DOUBLE AS x, a.y::DOUBLE AS y, 10::DOUBLE AS size, string_agg(p.text, '' ORDER BY p.x, p.y DESC, p.seq, p.text) AS text
FROM a JOIN p ON p.l_orderkey = a.l_orderkey AND p.y BETWEEN a.y - 3 AND a.y GROUP BY a.l_orderkey, a.line, a.y""")
def q_line_assembly(spark, sf):
    """Lines of pages whose pieces are the items of orders, with their two flags as text. Items of an order share line numbers."""
    i = t(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("seq"), (F.col("l_quantity").cast("double") * 10).alias("x"), (F.col("l_partkey") % 40 * 2.0).alias("y"), F.lit(10.0).alias("size"), F.concat("l_returnflag", "l_linestatus").alias("text"))
    return D.page_lines(i, ["l_orderkey"])


# ---- pages ----
def _with_files(spark, sf):
    more = F.concat(F.lit('<a href="/files/'), F.col("page_id").cast("string"), F.lit('.pdf?x=1&utm_source=a#top">Get <b>it</b></a><form action="/send" method="post">Download file<input name=uid value="'), F.col("page_id").cast("string"), F.lit('"><input type=hidden name=_token value=z></form><a href="https://drive.google.com/open?id='), F.col("page_id").cast("string"), F.lit('">drive</a>'))
    return t(spark, sf, "pages").withColumn("html", F.concat("html", more))


@query(f"SELECT page_id, sch || '://' || host || '/files/' || page_id || '.pdf?x=1' AS url, 'Get it' AS label FROM {_URL}")
def q_file_links(spark, sf):
    return H.file_links(H.page_targets(_with_files(spark, sf))).select("page_id", "url", "label")


@query("SELECT page_id, 'https://drive.google.com/open?id=' || page_id AS url, 'drive' AS provider, 'drive' AS label FROM pages")
def q_provider_links(spark, sf):
    return H.provider_links(H.page_targets(_with_files(spark, sf))).select("page_id", "url", "provider", "label")


@query(f"SELECT page_id, sch || '://' || host || '/send' AS url, 'POST' AS method, 'POST ' || sch || '://' || host || '/send uid=' || page_id AS key FROM {_URL}")
def q_download_forms(spark, sf):
    return H.download_forms(_with_files(spark, sf)).select("page_id", "url", "method", "key")


@query()
def q_download_candidates(spark, sf):
    return H.candidates(_with_files(spark, sf))


@query()
def q_page_links(spark, sf):
    """Every distinct HTTP target of a page without its fragment, with the first label, in order."""
    rows = H.page_targets(t(spark, sf, "pages")).filter("via <> 'text'").withColumn("link", F.regexp_replace("target", "#.*$", ""))
    rows = rows.filter(F.col("link").rlike("(?i)^https?://"))
    return rows.groupBy("page_id", F.col("link").alias("url")).agg(F.min_by("label", "pos").alias("label"), F.min("pos").alias("pos"))


@query()
def q_login_pages(spark, sf):
    return H.login_score(t(spark, sf, "pages"))


_robots = "'User-agent: *' || chr(10) || 'Sitemap: /s' || page_id || '.xml # main' || chr(10) || ' sitemap :m.xml' || chr(10) || 'Sitemap: https://elsewhere.example/x.xml' || chr(10) || 'SITEMAP:/s' || page_id || '.xml'"


@query(f"SELECT DISTINCT url, sch || '://' || host || '/s' || page_id || '.xml' AS sitemap, 1 AS pos FROM {_URL} UNION ALL SELECT DISTINCT url, sch || '://' || host || '/m.xml', 2 FROM {_URL}")
def q_robots_sitemaps(spark, sf):
    return H.robots_sitemaps(t(spark, sf, "pages").select("url", F.expr(_robots).alias("body"))).select("url", "sitemap", "pos")


@query(f"SELECT url, sch || '://' || host || '/p' || page_id AS loc, 'page' AS route FROM {_URL} UNION ALL SELECT url, 'https://other.example/f.pdf', 'download' FROM {_URL}")
def q_sitemap_entries(spark, sf):
    body = F.concat(F.lit("<urlset><url><loc>/p"), F.col("page_id").cast("string"), F.lit("</loc></url><url><loc>https://other.example/f.pdf</loc></url><url><loc>https://other.example/q</loc></url></urlset>"))
    return H.sitemap_entries(t(spark, sf, "pages").select("url", body.alias("body"))).select("url", "loc", "route")


@query(f"SELECT page_id, len(list_filter(string_split(path, '/'), lambda x: x <> '')) > 1 AS child FROM {_URL}")
def q_prefix_child(spark, sf):
    """Whether a page lies below the first part of its own path."""
    chain = U.guide_chain(F.col("url"))
    return t(spark, sf, "pages").select("page_id", F.coalesce(U.is_prefix_child(F.try_element_at(chain, F.lit(2)), F.col("url")), F.lit(False)).alias("child"))


_canon = f"(SELECT page_id, sch || '://' || host || path || CASE WHEN query = '' THEN '' ELSE '?' || query END AS c, sch || '://' || host || path AS bare FROM {_URL})"


@query(f"""WITH c AS {_canon}, told AS (SELECT '01-01 00:00:00' || chr(9) || 'failed' || chr(9) || c || '/more' AS line FROM c WHERE page_id % 2 = 0 UNION ALL SELECT 'x' || page_id FROM c WHERE page_id % 2 = 1)
SELECT c AS url, min(page_id)::BIGINT AS pos FROM c WHERE NOT EXISTS (SELECT 1 FROM told WHERE contains(line, c.c) OR contains(line, c.bare)) GROUP BY c""")
def q_failed_backfill(spark, sf):
    p = t(spark, sf, "pages")
    line = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("01-01 00:00:00\tfailed\t"), U.canonical(F.col("url")), F.lit("/more"))).otherwise(F.concat(F.lit("x"), F.col("page_id").cast("string")))
    return L.never_downloaded(p.select("url", F.col("page_id").alias("pos")), p.select(line.alias("value")), all_urls=True)


# ---- ledgers ----
@query("""WITH p AS (SELECT p_partkey, p_brand, sha256(p_name) AS h FROM part), host AS (SELECT lower(p_brand) || '.pdf' AS name, max(h) AS h FROM p WHERE p_partkey % 2 = 0 GROUP BY 1), led AS (SELECT p_brand AS name, min(h) AS h FROM p WHERE p_partkey % 2 = 1 GROUP BY 1),
b AS (SELECT DISTINCT p_brand AS base, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE substr(h, 1, 8) END AS head FROM p)
SELECT DISTINCT base || CASE WHEN head = '' THEN '' ELSE '-' || head END AS book, coalesce(CASE WHEN head = '' THEN coalesce(host.h, led.h) WHEN starts_with(led.h, head) THEN led.h END, '') AS sha256,
  CASE WHEN head = '' THEN CASE WHEN host.h IS NOT NULL THEN 'host' WHEN led.h IS NOT NULL THEN 'ledger' ELSE '' END WHEN starts_with(led.h, head) THEN 'ledger' ELSE '' END AS source
FROM b LEFT JOIN host ON host.name = lower(base) || '.pdf' LEFT JOIN led ON led.name = base""")
def q_key_cascade(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_brand", F.sha2("p_name", 256).alias("h"))
    odd = F.col("p_partkey") % 2 == 1
    host = p.filter(~odd).groupBy(F.concat(F.lower("p_brand"), F.lit(".pdf")).alias("name")).agg(F.max("h").alias("sha256"))
    ledger = p.filter(odd).groupBy(F.col("p_brand").alias("name")).agg(F.min("h").alias("sha256"))
    book = F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.concat_ws("-", "p_brand", F.substring("h", 1, 8)))
    return L.hashes_of_books(p.select(book.alias("book")), [("host", host), ("ledger", ledger)])


_state = "CASE event_type WHEN 'click' THEN 'downloading' WHEN 'view' THEN 'downloaded' WHEN 'purchase' THEN 'parsing' WHEN 'signup' THEN 'success' ELSE 'failed' END"


@query()
def q_state_machine(spark, sf):
    """The state of every user's book after all events as steps, and how many of them were refused."""
    e = t(spark, sf, "events").select(F.col("user_id").cast("string").alias("source"), F.struct("ts", "event_id").alias("seq"), F.expr(_state).alias("status"))
    return L.advanced(e)


@query("""WITH u AS (SELECT DISTINCT 'http://h.example/' || user_id AS url, user_id FROM events) SELECT url, CASE WHEN user_id % 5 BETWEEN 1 AND 3 THEN (user_id % 5)::INT END AS turn FROM u""")
def q_retry_turns(spark, sf):
    e = t(spark, sf, "events").select(F.concat(F.lit("http://h.example/"), F.col("user_id").cast("string")).alias("url"), "event_type")
    number = F.regexp_extract("url", r"(\d+)$", 1).cast("long")
    failed = e.filter("event_type = 'click'").select(F.lit("failed").alias("status"), "url")
    return L.retried(failed, e.filter("event_type <> 'click'").select("url"), lambda left, turn: left.filter(number % 5 == turn))


@query()
def q_reminder_latch(spark, sf):
    """The notices due when purchases count as failures: three of them, at most one notice in an hour."""
    e = t(spark, sf, "events").select(F.col("user_id").cast("string").alias("key"), F.unix_timestamp(F.date_trunc("second", "ts")).alias("at"), (F.col("event_type") == "purchase").alias("failed"))
    return jobs.latched(e, 3, 3600)


@query("SELECT dir, name, id, CASE WHEN k = 1 THEN name ELSE regexp_extract(name, '^(.*?)([.][^.]*)?$', 1) || ' (' || k || ')' || regexp_extract(name, '^(.*?)([.][^.]*)?$', 2) END AS free_name FROM (SELECT p_type AS dir, p_brand || '.pdf' AS name, p_partkey AS id, row_number() OVER (PARTITION BY p_type, p_brand ORDER BY p_partkey) AS k FROM part)")
def q_free_names(spark, sf):
    return L.free_names(t(spark, sf, "part").select(F.col("p_type").alias("dir"), F.concat("p_brand", F.lit(".pdf")).alias("name"), F.col("p_partkey").alias("id")), ["id"])


@query("""WITH i AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders) SELECT count(*) FILTER (o_orderstatus = 'F') AS n_saved, coalesce(sum(floor(o_totalprice)) FILTER (o_orderstatus = 'F'), 0)::BIGINT AS saved_bytes,
 count(*) FILTER (o_orderstatus = 'O') AS n_uploaded, coalesce(sum(floor(o_totalprice)) FILTER (o_orderstatus = 'O'), 0)::BIGINT AS uploaded_bytes, count(*) FILTER (o_orderstatus = 'P') AS n_failed, coalesce(sum(floor(o_totalprice)) FILTER (o_orderstatus = 'P'), 0)::BIGINT AS failed_bytes,
 count(*) FILTER (o_orderstatus = 'F') - count(*) FILTER (o_orderstatus = 'O') AS n_left FROM i""")
def q_run_report(spark, sf):
    o = t(spark, sf, "orders").select(F.expr("CASE o_orderstatus WHEN 'F' THEN 'saved' WHEN 'O' THEN 'uploaded' ELSE 'failed' END").alias("outcome"), F.floor("o_totalprice").cast("long").alias("size"))
    return L.run_report(o)


@query("""SELECT o_orderkey, CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm' WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS took FROM (SELECT o_orderkey, o_orderkey * 7 AS s FROM orders)""")
def q_elapsed(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", L.elapsed(F.col("o_orderkey") * 7).alias("took"))


@query("""WITH d AS (SELECT event_id, user_id, event_id::DOUBLE AS arrived, value, sum(value / 10) OVER (PARTITION BY user_id ORDER BY event_id) AS s FROM events), m AS (SELECT *, max(arrived - s + value / 10) OVER (PARTITION BY user_id ORDER BY event_id) + s AS e FROM d)
SELECT event_id, round(greatest(e - value / 10 - arrived, 0), 6) AS wait FROM m""")
def q_token_delay(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", F.col("event_id").cast("double").alias("at"), F.col("value").alias("size"))
    return L.token_delay(e, "user_id", "event_id", 10.0).select("event_id", F.round("wait", 6).alias("wait"))


@query("""WITH s AS (SELECT o_custkey AS archive, o_orderkey % 9 AS name, max(o_orderkey) AS seen FROM orders GROUP BY ALL), a AS (SELECT c_custkey AS archive, c_custkey * 10 AS mtime FROM customer), m AS (SELECT o_custkey AS archive, o_orderkey % 7 AS name, count(*) AS n FROM orders GROUP BY ALL),
j AS (SELECT coalesce(s.archive, m.archive) AS archive, coalesce(s.name, m.name) AS name, seen, n FROM s FULL JOIN m ON s.archive = m.archive AND s.name = m.name)
SELECT * FROM (SELECT archive, name, CASE WHEN n IS NULL AND seen > mtime THEN 'late' WHEN n IS NULL THEN 'missing' WHEN seen IS NULL THEN 'unknown' WHEN n > 1 THEN 'doubled' END AS problem FROM j LEFT JOIN a USING (archive)) WHERE problem IS NOT NULL""")
def q_archive_problems(spark, sf):
    o, c = t(spark, sf, "orders"), t(spark, sf, "customer")
    part = lambda k: o.select(F.col("o_custkey").alias("archive"), (F.col("o_orderkey") % k).alias("name"), F.col("o_orderkey").alias("at"))
    return L.archive_problems(part(9), c.select(F.col("c_custkey").alias("archive"), (F.col("c_custkey") * 10).alias("mtime")), part(7).select("archive", "name"))


# ---- shapes ----
@query("""WITH v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), c AS (SELECT label, i, avg(x) AS x FROM v GROUP BY label, i),
d AS (SELECT v.vec_id, c.label, sqrt(sum((v.x - c.x) * (v.x - c.x))) AS d FROM v JOIN c USING (i) GROUP BY v.vec_id, c.label), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, label) AS k, lead(d) OVER (PARTITION BY vec_id ORDER BY d, label) - d AS margin FROM d)
SELECT vec_id, label, round(d, 6) AS distance, round(margin, 6) AS margin, d <= 1.0 AND margin >= 0.05 AS accepted FROM r WHERE k = 1""")
def q_knn_margin(spark, sf):
    """The nearest mean vector of a label, and the margin to the next."""
    e = t(spark, sf, "embeddings")
    parts = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    means = parts.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("vector"))
    found = shape.nearest_labels(e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector")), means, 1.0, 0.05)
    return found.select(F.col("id").alias("vec_id"), "label", F.round("distance", 6).alias("distance"), F.round("margin", 6).alias("margin"), "accepted")
