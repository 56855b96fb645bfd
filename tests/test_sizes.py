"""Queries on odd inputs, and the bounds that hold however large the tables are."""

import collections
import random
import time
import tracemalloc

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palmleaf.functions import batches as B
from palmleaf.functions import mends as M
from palmleaf.functions import pdf
from palmleaf.functions import script as S
from palmleaf.operators import collection as C
from palmleaf.operators import documents as D
from palmleaf.operators import html as H
from palmleaf.plans import more  # noqa: F401  registers queries
from palmleaf.plans import queries as Q

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", None, "abc", "the of and to in is you", "xqzt bqbq aaaa qqq", "A" * 50, "THE QQ", "é ñ 12 -", "e e\ne", "hahahaha nonono", " ", "f e"]


def written(spark, path, texts, langs=("a", None, "b")):
    rows = [(i, t, langs[i % len(langs)], "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).coalesce(2).write.parquet(f"{path}/documents.parquet")
    return str(path)


def by_sql(path, name):
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
        return sorted(con.execute(Q.SQL[name]).fetchall(), key=repr)


def test_report_of_words_equals_its_hits(spark, tmp_path):
    rng = random.Random(4)
    path = written(spark, tmp_path, [*ODD, *("".join(rng.choice("ek tpqga .\n") for _ in range(300)) for _ in range(40))])
    hits = Q.script_docs(spark, path).select("lang", "doc_id", F.explode(S.scan_rows(F.col("t"))).alias("h")).select("lang", "doc_id", "h.*").collect()
    n, first = collections.Counter(), {}
    for r in hits:
        key = (r["lang"], r["rule"], r["word"])
        n[key] += 1
        first[key] = min(first.get(key, (1 << 40,)), (r["doc_id"], r["pos"], r["line"], r["context"]))
    words = S.scan_words(Q.script_docs(spark, path)).collect()
    assert {(r["lang"], r["rule"], r["word"]): r["n"] for r in words} == dict(n) and {(r["lang"], r["rule"], r["word"]): tuple(r["first"]) for r in words} == first
    report = Q.QUERIES["q_scan_report"](spark, path)
    assert "MapInArrow" not in report._jdf.queryExecution().optimizedPlan().toString()  # the texts are scanned once, before
    report = report.collect()
    totals = collections.Counter()
    for (lang, rule, _), times in n.items():
        totals[lang, rule] += times
    assert {(r["lang"], r["rule"]): r["total"] for r in report} == dict(totals) and None in {r["lang"] for r in report}


def test_hits_of_one_long_line_are_found_in_time():
    began = time.time()
    held = {}
    S._count_words(held, [""], [0], ["ာ " * 60_000])
    assert held[("", 0, "ာ")][0] == 60_000 and time.time() - began < 10
    assert S.context_at("a\n  b c  ", 4) == "b c" and S.context_at("x" * 200, 150) == "x" * 110 and S.context_at("\n \n", 1) == ""

def test_ratio_of_texts_without_characters_equals_sql(spark, tmp_path):
    path = written(spark, tmp_path, [*ODD, None], ("a", None, "b", "c"))
    got = sorted(map(tuple, Q.QUERIES["q_myanmar_ratio_by_lang"](spark, path).collect()), key=repr)
    assert repr(got) == repr(by_sql(path, "q_myanmar_ratio_by_lang")) and "nan" in repr(got)  # NaN is not equal to itself


def test_slim_fold_equals_the_plain_fold(spark):
    rng = random.Random(6)
    texts = [x * n for x in "abc" for n in (1, 199, 200, 300)] + ["\xa0" + "a" * 200, ""]
    row = lambda: {"author": rng.choice("xy"), "book": rng.choice(["", "A", "B", "C", "D"]), "text": rng.choice(texts) + rng.choice(["", "", str(rng.random())]), "segmented": "", "sha256": rng.choice(["", "1", "2", "3", str(rng.random())])}
    for n in (5, 40, 400):
        books, new = [row() | {"pos": i} for i in range(n)], [row() | {"seq": i} for i in range(n)]
        rows, done = C.fold(books, new)
        names = ", ".join(f"{c} string" for c in C.COLUMNS)
        frame = lambda some, key: spark.createDataFrame([tuple(r[c] for c in (*C.COLUMNS, key)) for r in some], f"{names}, {key} long")
        got = C.upsert_all(frame(books, "pos"), frame(new, "seq")).collect()
        assert sorted((r["seq"], r["outcome"]) for r in got if r["seq"] is not None) == sorted(done)
        assert sorted(tuple(r[c] for c in C.COLUMNS) for r in got if r["seq"] is None) == sorted(tuple(r[c] for c in C.COLUMNS) for r in rows)


def test_fold_holds_no_row_that_nothing_leads_to():
    def rows():
        yield "g", None, "b0", "A", None, None, True
        yield from (("g", None, f"b{i}", "A", None, None, True) for i in range(1, 200_000))
        yield from (("g", i, f"i{i}", "A", None, None, True) for i in range(200_000))

    tracemalloc.start()
    told = collections.Counter(what for _, what, _, _ in C.slim_fold(rows()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert told == {"row": 200_000, "replace": 200_000} and peak < 1 << 20


def test_texts_of_pages_equal_their_lines_and_many_pieces_are_read_in_time(spark, tmp_path):
    rng = random.Random(8)
    texts = ["\n".join("".join(rng.choice("ab ()") for _ in range(9)) for _ in range(n)) for n in (1, 3, 40)]
    docs = spark.createDataFrame([(str(i), x) for i, x in enumerate(texts)], "name string, text string")
    files = docs.select("name", more.pdf_of(F.regexp_replace("text", more._CLEAN, "")).alias("content")).unionByName(spark.createDataFrame([("none", None)], "name string, content binary"))
    lines = collections.defaultdict(list)
    for r in D.page_lines(D.pdf_pieces(files), ["name", "page"]).orderBy("line").collect():
        lines[r["name"], r["page"]].append(r["text"])
    assert {(r["name"], r["page"]): r["text"] for r in D.page_texts(files).collect()} == {k: "\n".join(v) for k, v in lines.items()}
    began = time.time()
    many = [(10.0, 14.0 * i, 10.0, "x") for i in range(20_000)]
    assert pdf.distinct_pieces([*many, (10.5, 14.0, 10.0, "xy")])[1] == (10.5, 14.0, 10.0, "xy") and time.time() - began < 5


def test_single_bytes_are_read_as_one_by_one():
    for codec in ("", "cp1252", "mac_roman"):
        font = pdf.Font(codec=codec, mapped={65: "XY"}, differences={65: "n", 66: "q"}, fallback={66: "n", 200: "zz"})
        assert font.text(bytes(range(256))) == "".join(map(font._one, range(256)))


def peak_mb(column, texts):
    """Peak MB of an Arrow function's Python over one batch, without its input."""
    run, values = getattr(column, "func", column), pa.array(texts)
    tracemalloc.start()
    n = sum(len(x) for x in run(iter([values])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(texts)
    return peak / 1e6


def holds_a_slice(column):
    texts = ["ကာ ေ က္က၀ရ" * 300, None] * 700
    small, large = (peak_mb(column, texts * n) for n in (1, 4))
    return large < 1.3 * small and large < 80


def test_damage_counts_hold_a_slice_of_a_batch(spark, tmp_path):
    assert holds_a_slice(S.scan_totals)
    none = written(spark, tmp_path, [])
    assert Q.QUERIES["q_old_font_gate"](spark, none).count() == 0


def test_rewritten_texts_hold_a_slice_of_a_batch():
    assert all(map(holds_a_slice, (S.reorder_marks, S.clean_imposters, S.order_text, S.cleanup_text, S.normalize_text)))


def test_mark_counts_hold_a_slice_of_a_batch():
    assert holds_a_slice(S.mark_counts)


def test_stretches_are_unmixed_as_the_whole_text():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice("ေြျွှကခဂရသ ာိီု့်း\n၀.္") for _ in range(rng.randrange(50)))
        assert M.stored_order_unmixed(text) == M._unmixed(text)
    assert M._STRETCH.search("ကာခဂိ.") is None  # clusters with one mark that is not stored are not touched
    assert holds_a_slice(M.column(M.stored_order_unmixed))


def test_totals_of_odd_texts_equal_sql(spark, tmp_path):
    path = written(spark, tmp_path, [x for x in ODD if x is not None] * 30)
    assert sorted(map(tuple, Q.QUERIES["q_scan_totals"](spark, path).collect()), key=repr) == by_sql(path, "q_scan_totals")
    # tables of a class are looked up for a slice, whatever the batch
    assert peak_mb(S.scan_totals, ["ာ" * 1000] * 5000) < 80


def test_rows_of_pages_leave_in_small_batches():
    schema = pa.schema([("page", pa.int64()), ("label", pa.string()), ("data", pa.map_(pa.string(), pa.string()))])
    rows = ((i, "x" * 30_000, {"k": "v"} if i % 2 else None) for i in range(400))
    made = list(B.arrow_rows(rows, schema))
    assert sum(b.num_rows for b in made) == 400 and max(b.nbytes for b in made) <= B.SLICE_BYTES and made[0].column(2).to_pylist()[:2] == [None, [("k", "v")]]
    assert list(B.bounds(pa.array([B.SLICE_BYTES * 2, 1, 1]).to_numpy())) == [(0, 1), (1, 3)]


def test_targets_of_a_page_of_nested_elements(spark):
    pages = spark.createDataFrame([(1, "https://h.example/", "<div>" * 50 + "<a href=/x.pdf>one</a>" * 50), (2, "https://h.example/", "")], "page_id long, url string, html string")
    assert [(r["page_id"], r["url"], r["label"]) for r in H.candidates(pages).collect()] == [(1, "https://h.example/x.pdf", "one")]


def test_files_leave_in_few_batches():
    rows = ((str(i), True, 0, 1, ["Body"], {}, 0) for i in range(10_000))
    schema = pa.schema([("name", pa.string()), ("is_pdf", pa.bool_()), ("header", pa.int32()), ("n_pages", pa.int32()), ("fonts", pa.list_(pa.string())), ("info", pa.map_(pa.string(), pa.string())), ("image_bytes", pa.int64())])
    assert [b.num_rows for b in B.arrow_rows(rows, schema)] == [4096, 4096, 1808]


def test_files_without_content(spark):
    files = spark.createDataFrame([("a", None), ("b", bytearray(b"")), ("c", bytearray(b"%PDF-"))], "name string, content binary")
    assert {r["name"]: (r["is_pdf"], r["header"], r["n_pages"]) for r in D.pdf_files(files).collect()} == {"a": (False, None, 0), "b": (False, None, 0), "c": (True, 0, 0)}


def test_likeness_of_odd_texts_equals_sql(spark, tmp_path):
    rng = random.Random(7)
    path = written(spark, tmp_path, [*ODD, *("".join(rng.choice("aeqzxbjTHE  ") for _ in range(rng.randrange(80))) for _ in range(300)), "q" * 70, "the " * 30 + "x" * 47])
    assert sorted(map(tuple, Q.QUERIES["q_english_likeness"](spark, path).collect()), key=repr) == by_sql(path, "q_english_likeness")


def test_zeros_are_mended_from_left_to_right():
    assert [M.digits_mended(x) for x in ("က၀၀က", "၀၀က", "၁၀၀က", "က၀", "၀", "", "က၀၀ာ", "က၀က", "၀က")] == ["က၀၀က", "၀၀က", "၁၀၀က", "က၀", "၀", "", "က၀ဝာ", "ကဝက", "ဝက"]
    assert holds_a_slice(M.column(M.digits_mended))


def test_runs_of_marks_before_a_base():
    assert M.prebase_moved("ေ") == "ေ" and M.prebase_moved("ေြက") == "ကေြ" and M.prebase_moved("ကေြခ") == M.prebase_moved("ကေြခ", {"ခေ"}) and M.prebase_moved("") == ""
    assert holds_a_slice(M.column(M.prebase_moved))


def test_a_url_is_guarded_once_in_a_row(spark, sf):
    for df in (Q.QUERIES["q_robots_sitemaps"](spark, sf), H.controls(H.page_targets(spark.read.parquet(f"{sf}/pages.parquet")))):
        filters = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if x.lstrip(" +-:").startswith("Filter")]
        assert len(filters) > 1 and max(x.count("regexp_extract(") for x in filters) < 20


def test_logical_order_holds_a_slice_of_a_batch():
    assert holds_a_slice(M.column(M.logical_order)) and M.logical_order("") == ""
