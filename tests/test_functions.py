from decimal import Decimal

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from palmleaf.functions import script as S
from palmleaf.functions import text_udf as T
from palmleaf.functions import urls as U
from palmleaf.operators import collection as C
from palmleaf.plans import more  # noqa: F401  registers more queries
from palmleaf.plans import queries as Q
from palmleaf.sources import ledgers
from palmleaf.streaming import jobs
from palmleaf.tables import IMPOSTERS, PRIORITY

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cells(rows, names):
    return sorted(tuple("" if r[n] is None else f"{r[n]:.9g}" if isinstance(r[n], (int, float, Decimal)) and not isinstance(r[n], bool) else str(r[n]) for n in sorted(names)) for r in rows)


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for x in TABLES:
        con.execute(f"CREATE VIEW {x} AS SELECT * FROM read_parquet('{sf}/{x}.parquet')")
    got = Q.QUERIES[name](spark, sf)
    want = con.execute(Q.SQL[name]).to_arrow_table().to_pylist()
    assert cells([r.asDict() for r in got.collect()], got.columns) == cells(want, got.columns)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@given(st.text(alphabet="ကစာေျ္် \nab", max_size=30))
@settings(max_examples=200, deadline=None)
def test_reordering_is_idempotent_and_sorted(text):
    once = S.marks_reordered(text)
    assert S.marks_reordered(once) == once
    assert set(once) == set(text)


def test_imposters_are_replaced_once():
    for key, value in IMPOSTERS.items():
        assert S.imposters_cleaned(key) == value
    assert S.marks_reordered("ကာျာ") == "ကျာ"
    assert min(PRIORITY.values()) == 1


def test_scores_are_shares(spark):
    rows = spark.createDataFrame([("ကာ",), ("ာ",), ("",), (None,), ("ကာျ",)], "t string")
    got = [r.asDict() for r in rows.select(S.mark_counts(F.col("t")).alias("c")).select(*(c.alias(n) for n, c in S.score(F.col("c")).items())).collect()]
    assert got[0]["score"] == 1.0 and got[1]["orphan"] == 1.0 and got[2]["score"] == 0.0 and got[4]["disorder"] == 1.0


def test_url_edges(spark):
    rows = [("HTTP://WWW.A.example:80/x?utm_source=1&b=2#f",), ("ftp://a.example/",), ("https://a.example:99999/",), ("https://a.example/p?print=1",), (None,), ("https://sub.wikipedia.org",)]
    df = spark.createDataFrame(rows, "u string").select(U.host(F.col("u")).alias("h"), U.guarded(F.col("u")).alias("g"), U.canonical(F.col("u")).alias("c"), U.excluded_reason(F.col("u")).alias("r"))
    got = df.collect()
    assert got[0]["h"] == "www.a.example" and got[0]["g"] == "http://www.a.example:80/x?b=2" and got[0]["c"] == "http://www.a.example/x?utm_source=1&b=2"
    assert got[1]["h"] is None and got[2]["h"] is None and got[3]["g"] is None and got[4]["h"] is None
    assert got[5]["r"].startswith("wiki") and got[1]["r"].startswith("only HTTP")


def test_word_break_repair_and_segments(spark):
    df = spark.createDataFrame([("ကခ ဂ",), (None,)], "t string")
    assert T.breaks("abab", frozenset({"ab"}), 2) and not T.breaks("aba", frozenset({"ab"}), 2)
    assert [r[0] for r in df.select(T.unknown_tokens(F.col("t"), ["က", "ခ"])).collect()] == [["ဂ"], None]
    assert df.select(T.repaired(F.col("t"), ["ကခ", "ဃ"], [("ဂ", "ဃ")])).first()[0] == "ကခ ဃ"
    assert df.select(T.segmented(F.col("t"), ["ကခ"])).first()[0] == "ကခ  ဂ"
    assert df.select(T.convert(F.col("t"), [("က(ခ)", r"\1\1")])).first()[0] == "ခခ ဂ"


def test_upsert_outcomes(spark):
    long, other = "a" * 200, "b" * 200
    row = lambda book, text, sha, seq=None: {"author": "", "book": book, "text": text, "segmented": "", "sha256": sha, "seq": seq}
    rows, done = C.fold([row("A", long, "1")], [row("B", long, "2", 0), row("A", long, "1", 1), row("A", long, "3", 2), row("C", other, "3", 3), row("A", "short", "9", 4), row("D", "new", "8", 5)])
    assert [o for _, o in done] == ["deny", "deny", "fix", "update", "replace", "append"]
    assert [r["book"] for r in rows] == ["A", "D"]
    assert C.fold(rows, [])[0] == rows
    # the hash leads before the text; short texts are compared, too; a text that its row no longer holds is checked again
    assert C.fold([row("A", long, "1"), row("B", other, "2")], [row("C", other, "1", 0)])[1] == [(0, "update")]
    assert C.fold([row("A", "short", "1")], [row("A", " short", "1", 0)])[1] == [(0, "deny")]
    assert [o for _, o in C.fold([row("A", long, "1")], [row("A", other, "1", 0), row("Z", long, "7", 1)])[1]] == ["replace", "update"]


def test_upsert_of_a_collection_equals_one_fold(spark, sf):
    books, incoming = Q.upsert_tables(spark, sf)
    put = lambda r, seq: {"author": "", "book": r["book"], "text": r["text"], "segmented": "", "sha256": r["sha256"], "seq": seq}
    want = C.fold([put(r, None) for r in books.orderBy("pos").collect()], [put(r, r["seq"]) for r in incoming.orderBy("seq").collect()])[1]
    got = Q.q_upsert_fold(spark, sf).collect()
    assert sorted((r["seq"], r["outcome"]) for r in got) == sorted(want) and len({o for _, o in want}) > 2


def test_ledgers_and_stream(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"u":"a","c":["b","c"]}\n\n{"u":"a","c":["d"]}\n{"u":')
    assert [tuple(r) for r in ledgers.crawl_edges(spark, str(tmp_path / "c.jsonl")).collect()] == [("a", "d")]
    (tmp_path / "d.txt").write_text("# note\n" + "a" * 64 + " some id\nshort x\n" + "b" * 64 + "\n")
    assert sorted((r[0][0], r[1]) for r in ledgers.downloaded(spark, str(tmp_path / "d.txt")).collect()) == [("a", "some id"), ("b", None)]
    (tmp_path / "t.log").write_text("01-02 03:04:05 saved x y\nbad\n13-41 00:00:00 no\n")
    assert [(r["event"], r["detail"]) for r in ledgers.timeline(spark, str(tmp_path / "t.log"), 2024).collect()] == [("saved", "x y")]
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string").write.parquet(str(tmp_path / "in"))
    for n in (1, 2):
        jobs.append_new(spark, str(tmp_path / "in"), "k long, v string", ["k"], str(tmp_path / "out"), str(tmp_path / f"ck{n}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    events = spark.createDataFrame([("x", i, True) for i in range(5)], "key string, at long, failed boolean")
    assert [r["at"] for r in jobs.latched(events, 2, 3).collect()] == [1, 4]
