"""PDF parsing, page candidates, mends, ledgers and shapes on small made inputs."""

import collections
import math
import random
import zipfile
import zlib
from io import BytesIO

import duckdb
import numpy as np
from pyspark.sql import functions as F

from palmleaf.functions import mends as M
from palmleaf.functions import pdf
from palmleaf.functions import script as S
from palmleaf.functions import shape
from palmleaf.functions import text_udf as T
from palmleaf.operators import documents as D
from palmleaf.operators import html as H
from palmleaf.operators import ledger as L
from palmleaf.plans import more  # noqa: F401  registers queries
from palmleaf.plans import queries as Q

CMAP = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfchar <0001> <1000> endbfchar 2 beginbfrange <0002> <0002> <1001> <0003> <0004> [<1002> <10031004>] endbfrange"
CONTENT = b"BT /F1 12 Tf 100 700 Td (Hel\\154o) Tj ET BT /F1 12 Tf 100.5 700 Td (Hello) Tj ET BT /F2 10 Tf 1 0 0 1 160 701 Tm [<0001> -20 <00020003>] TJ ET q BI /W 2 ID \x00(\x01 EI Q BT /F1 9 Tf 50 650 Td (A\\(b\\)) Tj 0 -20 TD (c) Tj ET"


def pdf_bytes(title=b"(T\\351)"):
    packed = zlib.compress(CONTENT)
    parts = {
        1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [3 0 R 2 0 R] /MediaBox [0 0 300 400] /Resources << /Font << /F1 5 0 R /F2 6 0 R >> >> >>",
        3: b"<< /Type /Page /Parent 2 0 R /Contents [4 0 R] >>", 4: b"<< /Filter /FlateDecode >>\nstream\n" + packed + b"\nendstream", 5: b"<< /Type /Font /BaseFont /ABCDEF+Zawgyi#2dOne /Encoding << /BaseEncoding /WinAnsiEncoding /Differences [99 /uni1019] >> >>",
        6: b"<< /Type /Font /Subtype /Type0 /BaseFont /My /ToUnicode 7 0 R >>", 7: b"<< >>\nstream\n" + CMAP + b"\nendstream", 8: b"<< /Title " + title + b" /Author <FEFF1000> >>", 9: b"<< /Subtype /Image >>\nstream\n12345endstream",
    }
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%b\nendobj\n" % x for x in parts.items()) + b"%%EOF"


def test_pdf_objects_pages_and_lines(spark):
    files = spark.createDataFrame([("a", bytearray(pdf_bytes())), ("b", bytearray(b"<html>%PDF-")), ("c", None)], "name string, content binary")
    got = {r["name"]: r for r in D.pdf_files(files).collect()}
    assert got["a"]["is_pdf"] and got["a"]["n_pages"] == 1 and got["a"]["fonts"] == ["ABCDEF+Zawgyi-One", "My"] and got["a"]["info"] == {"Title": "Té", "Author": "က"} and got["a"]["image_bytes"] == 5
    assert not got["b"]["is_pdf"] and got["c"]["n_pages"] == 0
    pieces = D.pdf_pieces(files)
    assert {(r["width"], r["height"]) for r in pieces.collect()} == {(300.0, 400.0)}
    lines = [(r["line"], r["x"], r["y"], r["size"], r["text"]) for r in D.page_lines(pieces, ["name", "page"]).orderBy("line").collect()]
    assert lines == [(0, 100.0, 701.0, 12.0, "Helloကခဂ"), (1, 50.0, 650.0, 9.0, "A(b)မ")]
    assert D.pdf_objects(files).filter("name = 'a'").count() == 9


def test_pdf_parts():
    assert pdf.code_map(CMAP) == ({1: "က", 2: "ခ", 3: "ဂ", 4: "ဃင"}, [(2, 0, 65535)])
    assert pdf.usable_map({i: " " for i in range(20)} | {30: "x"}) == {30: "x"} and pdf.usable_map({1: " ", 2: "a"}) == {1: " ", 2: "a"}
    assert list(pdf.codes_of(b"\x01\x02\x03", [], False)) == [1, 2, 3] and list(pdf.codes_of(b"\x01\x02\x03\x04", [], True)) == [258, 772]
    assert list(pdf.codes_of(b"\x41\x81\x02", [(1, 0, 0x7F), (2, 0x8000, 0xFFFF)], True)) == [0x41, 0x8102]
    assert pdf.parsed(b"<< /A [1 -2.5 (x(y)) <4142>] /B 3 0 R >> true") == [{"A": [1, -2.5, b"x(y)", b"AB"], "B": (3, 0)}, "true"]
    assert pdf.inflated(zlib.compress(b"a" * 1000), 10) == b"a" * 10 and pdf.inflated(b"junk") == b""
    assert pdf.looks_like_html(b"\xef\xbb\xbf <!-- x --> <!DOCTYPE html>") and not pdf.looks_like_html(b"%PDF-1.4") and pdf.header_offset(b"xx%PDF-") == 2
    assert pdf.glyph_text("uni10001001.alt") == "ကခ" and pdf.glyph_text("u1000") == "က" and pdf.glyph_text("none") == ""
    columns = [(10.0 + 200 * (i % 2), 700.0 - 20 * (i // 2), 10.0, "some words") for i in range(16)]
    assert pdf.gutter(columns) == 110.0 and pdf.gutter(columns[:6]) is None
    box = BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("mimetype", "application/epub+zip")
    assert D.kind_of(box.getvalue()) == "epub" and D.kind_of(pdf_bytes()) == "pdf" and D.kind_of(b"PK") is None


def test_gates_and_font_names(spark):
    rows = spark.createDataFrame([(100, 5, 0), (10, 5, 0), (100, 5, 2), (0, 1, 0)], "my int, pages int, bad int")
    assert [r[0] for r in rows.select(D.old_font_gate(F.col("my"), F.col("pages"), F.col("bad"))).collect()] == ["convertable", "old", "old", "old"]
    fonts = spark.createDataFrame([("ABCDEF+WinInnwa-Bold",), ("Arial",), ("Win",)], "f string")
    assert [r[0] for r in fonts.select(D.is_known_font(F.col("f"), ["wininnwa", "ab"])).collect()] == [True, False, True]
    books = spark.createDataFrame([(["a" * 6, "", "b" * 6, "c"],)], "p array<string>")
    assert books.select(D.book_text(F.col("p"), 10)).first()[0] == "a" * 6 + "\n\n" + "b" * 6


HTML = """<base href="/d/"><a href="x.pdf#a" title="t">One <b>two</b></a><a href="/y.pdf?print=1">no</a><a href="/share.pdf">share it</a>
<button data-url="/get/9" class="btn">Download now</button><a onclick="go('z.docx')">pdf</a><a href="/search?q=pdf">download</a>
<form action="/send" method="post"><input type=hidden name=_token value=z><input name=uid value="4 2"><input type=checkbox name=no><select name=k><option value=1>a<option selected>b</select><button formaction="/alt">Download file</button></form>
<form action="/find"><input name=a value="b c">get file</form><a href="https://drive.google.com/file/d/abc/view#x">d</a> see https://mega.nz/file/abc#key, <a href="https://www.mediafire.com/about">m</a>"""


def test_candidates_of_a_page(spark):
    page = spark.createDataFrame([(1, "https://www.h.example/p/q", HTML), (2, None, None)], "page_id long, url string, html string")
    got = {r["url"]: (r["method"], r["label"], r["provider"]) for r in H.candidates(page).collect()}
    assert got == {
        "https://www.h.example/d/x.pdf": ("GET", "One two", None), "https://www.h.example/d/z.docx": ("GET", "pdf", None), "https://www.h.example/get/9": ("GET", "Download now btn", None),
        "https://www.h.example/send": ("POST", "a b Download file", None), "https://www.h.example/alt": ("POST", "a b Download file", None), "https://www.h.example/find": ("GET", "get file", None),
        "https://www.h.example/find?a=b+c": ("GET", "get file", None), "https://drive.google.com/file/d/abc/view": ("GET", "d", "drive"), "https://mega.nz/file/abc#key": ("GET", "", "mega"),
    }
    keys = sorted(r["key"] for r in H.download_forms(page).collect())
    assert keys == ["GET https://www.h.example/find?a=b+c", "POST https://www.h.example/alt k=b&uid=4+2", "POST https://www.h.example/send k=b&uid=4+2"]
    known = spark.createDataFrame([("https://www.h.example/get/9",)], "url string")
    assert "https://www.h.example/get/9" not in {r["url"] for r in H.candidates(page, known).collect()}


def test_sitemaps_bodies_and_logins(spark):
    assert H.sitemap_of('<urlset xmlns="u"><url><loc> a </loc></url><url/></urlset>') == ("urlset", ["a"]) and H.sitemap_of("<x") is None and H.sitemap_of("<x/>") is None
    bodies = spark.createDataFrame([(' "https://a.example/f" \n',), ("https://a.example b",), ("x",)], "b string")
    assert [r[0] for r in bodies.select(H.bare_url(F.col("b"))).collect()] == ["https://a.example/f", None, None]
    pages = spark.createDataFrame([(1, "u", "<form><input name=a><input type=password></form>"), (2, "u", "<form><input type=password><input type=password><input></form>")], "page_id long, url string, html string")
    assert {r["page_id"]: r["forms"] for r in H.login_score(pages).collect()} == {1: 1, 2: 0}


def test_mends():
    assert [M.digits_mended(x) for x in ("ပါ၀င်", "၁၀ ၅၀၊", "၃ရရ", "၅ရက်", "ရ၅ကတ်", "၅၀ရာ", "ရရ၅", "ကောင်း")] == ["ပါဝင်", "၁၀ ၅၀၊", "၃၇၇", "၅ရက်", "၇၅ကတ်", "၅၀ရာ", "၇၇၅", "ကောင်း"]
    assert [M.logical_order(x) for x in ("ေက", "သေကင်္တ", "သချင်္ာ", "ေဏ္ဏ")] == ["ကေ", "သင်္ကေတ", "သင်္ချာ", "ဏ္ဏေ"]
    assert M.prebase_moved("ကူးေြပာင်း") == "ကူးပေြာင်း" and M.prebase_moved("ကြေ") == "ကြေ" and M.prebase_moved("အြကီး") == "အကြီး"
    assert M.prebase_moved("သေလမ်း", {"သေ"}) == "သေလမ်း" and M.stored_order_unmixed("နြေပီ") == "နေပြီ" and M.stored_order_unmixed("ခြွင်းချက်") == "ခြွင်းချက်"
    assert M.MODES["wrapped"]("abc d 12 ၁၂ က") == "{abc d} {12} {၁၂} က" and M.outside_braces("a{a}a", str.upper) == "A{a}A"
    words = {"ကခ", "ဂ"}
    assert M.number_unglued("၁၂ကခ", words, 2) == "၁၂ ကခ" and M.number_unglued("ကခဂ၁", words, 2) == "ကခဂ ၁" and M.number_unglued("၁က၂", words, 2) == "၁က၂"
    assert M.repair_tally([("a", "b"), ("a", "b"), ("c", "c")]) == [("a", "b", 2)]
    assert M.lines_mended("xx\nab", lambda t: t.replace("xx", "yx"), lambda t: t.count("x")) == "yx\nab"


def test_scan_rows_are_where_the_rules_hit(spark):
    text = "က\nာ ကခကခကခ ၁ ာာ"
    rows = spark.createDataFrame([(text,), (None,)], "t string").select(F.explode(S.scan_rows(F.col("t"))).alias("h")).select("h.*").collect()
    assert {(r["rule"], r["pos"], r["word"], r["line"]) for r in rows} == {("orphan", 2, "ာ", 2), ("stray", 2, "ာ", 2), ("repeat", 4, "ကခကခကခ", 2), ("orphan", 13, "ာာ", 2), ("orphan", 14, "ာာ", 2), ("stray", 13, "ာာ", 2), ("impossible", 13, "ာာ", 2)}
    assert {r["context"] for r in rows} == {"ာ ကခကခကခ ၁ ာာ"}


def test_scan_report_counts_every_hit(spark, sf):
    report = Q.QUERIES["q_scan_report"](spark, sf).collect()
    hits = collections.Counter(r["rule"] for r in Q.script_docs(spark, sf).select(F.explode(S.scan_rows(F.col("t"))).alias("h")).select("h.rule").collect())
    told = {(r["lang"], r["rule"]): r["total"] for r in report}
    assert {k: sum(n for (_, rule), n in told.items() if rule == k) for k in hits} == dict(hits)
    totals = Q.QUERIES["q_scan_totals"](spark, sf).groupBy().sum("orphan", "impossible", "stray", "digit", "virama").first()
    assert [hits.get(k, 0) for k in ("orphan", "impossible", "stray", "digit", "virama")] == list(totals)


def test_encoding_labels(spark):
    matrix = np.full((3, 3), np.nan)
    matrix[0, 1], matrix[1, 0] = -2.0, 3.0
    rows = spark.createDataFrame([("ab",), ("bab",), ("xyz",)], "t string").select(T.transition_probability(F.col("t"), "ab", matrix).alias("p"))
    got = rows.select("p", T.encoding_label(F.col("p")).alias("l")).collect()
    assert math.isclose(got[0]["p"], 1 / (1 + math.exp(-2))) and [r["l"] for r in got] == ["ZAWGYI", "UNICODE", "UNKNOWN"]


def test_states_equal_a_plain_fold(spark, sf):
    events = collections.defaultdict(list)
    names = {"click": "downloading", "view": "downloaded", "purchase": "parsing", "signup": "success"}
    for r in spark.read.parquet(f"{sf}/events.parquet").orderBy("ts", "event_id").collect():
        events[str(r["user_id"])].append(names.get(r["event_type"], "failed"))
    want = {}
    for source, told in events.items():
        state, refused = "pending", 0
        for s in told:
            state, refused = (s, refused) if s in L.STEPS[state] else (state, refused + 1)
        want[source] = (state, refused)
    assert {r["source"]: (r["status"], r["n_refused"]) for r in Q.QUERIES["q_state_machine"](spark, sf).collect()} == want


def test_notices_equal_a_plain_fold(spark, sf):
    failed = collections.defaultdict(list)
    for r in spark.read.parquet(f"{sf}/events.parquet").selectExpr("user_id", "unix_timestamp(date_trunc('second', ts)) AS at", "event_type = 'purchase' AS failed").collect():
        failed[str(r["user_id"])].append((r["at"], r["failed"]))
    want = set()
    for key, told in failed.items():
        n, last = 0, -(1 << 40)
        for at, bad in sorted(told):
            n = max(n + (1 if bad else -1), 0)
            if n >= 3 and at - last >= 3600:
                want.add((key, at))
                last = at
    assert {tuple(r) for r in Q.QUERIES["q_reminder_latch"](spark, sf).collect()} == want


def test_versions_appends_and_puts(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    table = L.Versions(spark, str(tmp_path / "t"))
    assert table.write(rows) == 1 and not table.delete(rows.filter("k = 9"), ["k"]) and table.current() == 1
    assert table.delete(rows.filter("k = 1"), ["k"]) and [r["k"] for r in table.read().collect()] == [2] and table.current() == 2
    for _ in range(2):
        L.append_unless_known(spark, rows, str(tmp_path / "a"), ["k"])
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2
    new = spark.createDataFrame([(2, "c"), (3, "d"), (3, "d")], "k long, v string")
    assert sorted(map(tuple, L.put(rows, new, ["k"], True).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, L.put(rows, new, ["k"], False).collect())) == [(1, "a"), (2, "b"), (3, "d")]
    files = L.here(str(tmp_path / "a"))
    assert sum(L.footer(f)[0] for f in files) == 2 and {L.footer(f)[1] for f in files} - {""} == {"SNAPPY"} and L.footer(str(tmp_path / "none")) is None


def test_names_plans_and_reports(spark):
    paths = spark.createDataFrame([("/b/scan/x.pdf",), ("/b/.h/y.pdf",), ("/b/old/scan/z.pdf",), ("/a/q.PARQUET",)], "path string")
    assert [r[0] for r in L.waiting_files(paths).collect()] == ["/b/old/scan/z.pdf", "/b/scan/x.pdf"] and [r[0] for r in L.waiting_files(paths, L.scanned_part).collect()] == ["/b/scan/x.pdf"]
    files, there = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "name string, sha256 string"), spark.createDataFrame([("b", "2"), ("c", "9")], "name string, sha256 string")
    assert dict(map(tuple, L.publish_plan(files, there).collect())) == {"a": "add", "b": "same", "c": "update"}
    books = spark.createDataFrame([("A/B", "C", "s"), ("", None, "slug"), (None, "x", "s2")], "t string, a string, s string")
    assert [r[0] for r in books.select(L.book_name(F.col("t"), F.col("a"), F.col("s"), "pdf")).collect()] == ["A B - C.pdf", "slug.pdf", "s2.pdf"]
    assert [r[0] for r in L.shown_first(spark.range(20), [F.col("id")], F.col("id").cast("string"), 3).orderBy("pos").collect()] == ["0", "1", "2", "and 17 more"]
    ledger = spark.createDataFrame([("p", "success", "k"), ("q", "success", "z"), ("r", "failed", "k")], "source string, status string, book_key string")
    assert dict(map(tuple, L.released(ledger, spark.createDataFrame([("k",)], "book string")).collect())) == {"p": "release", "q": "requeue"} and [r["source"] for r in L.unfinished(ledger).collect()] == ["r"]


def test_shapes():
    square = np.array([[0, 0], [10, 0], [10, 10], [0, 10]])
    mask, aspect = shape.filled([square])
    assert mask.sum() == 44 * 44 and aspect == 1.0
    hole, _ = shape.filled([square, np.array([[3, 3], [7, 3], [7, 7], [3, 7]])])
    assert 0 < hole.sum() < mask.sum() and shape.filled([]) is None
    bits = np.zeros((20, 20), bool)
    bits[5:12, 4:15] = True
    fit = shape.trimmed(bits)
    assert fit[1] == 11 / 7 and shape.shape_distance(fit, fit) == 0.0 and shape.shape_distance(fit, (mask, 1.0)) > 0 and shape.trimmed(~np.ones((3, 3), bool)) is None
    field, ink = shape.distance_field(bits), np.argwhere(bits)
    for y, x in ((0, 0), (19, 19), (3, 9), (6, 6)):
        dy, dx = np.abs(ink - (y, x)).T
        assert math.isclose(field[y, x], (np.maximum(dy, dx) + (math.sqrt(2) - 1) * np.minimum(dy, dx)).min())
    gray = np.array([[10] * 5 + [200] * 7])
    assert 10 <= shape.otsu(gray) < 200 and shape.otsu(np.array([[5, 5]])) == 127
    walks = shape.outlines(bits)
    assert len(walks) == 1 and {tuple(p) for p in walks[0]} == {(x, y) for y in range(5, 12) for x in range(4, 15) if y in (5, 11) or x in (4, 14)}
    a, b = shape.signature(walks), shape.signature([walks[0] * 3 + 5])
    assert shape.same_topology(a, b) and shape.cloud_distance(a[0], b[0]) < 1e-9 and not shape.same_topology(a, shape.signature([walks[0], walks[0]]))
    assert shape.not_nested(np.array([[0, 0, 10, 10], [1, 1, 2, 2], [20, 0, 21, 1]])).tolist() == [True, False, True]
    assert shape.text_lines(np.array([1.0, 30, 2, 31, 90]), np.full(5, 10.0)).tolist() == [0, 1, 0, 1, -1]
    assert np.allclose(shape.aligned(np.array([0.0, 1, 2]), np.array([1.0, 3, 5])), (2, 1)) and np.allclose(shape.cloud([square], 10, 10)[0], (0, 1))


def test_lines_equal_a_plain_walk(spark):
    rng = random.Random(2)
    pieces = [(1, i, float(rng.randrange(0, 500)), float(rng.randrange(0, 90)), 10.0 + i % 3, f"t{i}") for i in range(120)]
    want, y0 = [], None
    for p in sorted(pieces, key=lambda p: (-p[3], p[2])):
        if y0 is None or abs(p[3] - y0) > 3:
            y0 = p[3]
            want.append([])
        want[-1].append(p)
    rows = D.page_lines(spark.createDataFrame(pieces, "page int, seq int, x double, y double, size double, text string"), ["page"]).orderBy("line").collect()
    assert [r["text"] for r in rows] == ["".join(p[5] for p in sorted(b, key=lambda p: p[2])) for b in want]


def test_lines_of_items_that_share_numbers_and_places(spark, tmp_path):
    rows = [(1, 2, 1, 5.0, "A", "F"), (1, 42, 2, 5.0, "A", "F"), (1, 1, 1, 3.0, "N", "O"), (1, 0, 1, 1.0, "R", "F"), (2, 5, 1, 2.0, "R", "F"), (2, 5, 1, 2.0, "A", "F"), (2, 5, 2, 2.0, "A", "A")]
    want = [(1, 0, 30.0, 4.0, 10.0, "NOAF"), (1, 1, 10.0, 0.0, 10.0, "RF"), (2, 0, 20.0, 10.0, 10.0, "AFRFAA")]
    for n, some in enumerate((rows, rows[::-1])):
        path = tmp_path / str(n)
        spark.createDataFrame(some, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string").coalesce(1).write.parquet(str(path / "lineitem.parquet"))
        assert sorted(map(tuple, Q.QUERIES["q_line_assembly"](spark, str(path)).collect())) == want
        with duckdb.connect() as con:
            con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{path}/lineitem.parquet/*.parquet')")
            assert sorted(con.execute(Q.SQL["q_line_assembly"]).fetchall()) == want
    pieces = [(1, 0, 10.0, 0.0, 10.0, x) for x in "ba"]
    assert [r["text"] for r in D.page_lines(spark.createDataFrame(pieces, "page int, seq int, x double, y double, size double, text string").coalesce(1), ["page"]).collect()] == ["ab"]
    none = D.page_lines(spark.createDataFrame([], "page int, seq int, x double, y double, size double, text string"), ["page"])
    assert none.columns == ["page", "line", "x", "y", "size", "text"] and none.count() == 0
