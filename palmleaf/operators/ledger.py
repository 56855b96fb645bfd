"""Ledgers as tables: guarded appends, deletes by new version, states, retries, look-ups by several keys, names and reports."""

from __future__ import annotations

import os
from collections.abc import Callable

import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..storage import cut

# ---- files ----


def footer(path: str) -> tuple[int, str] | None:
    """Rows and codec from a Parquet file's footer, nothing else is read; null where it is none."""
    try:
        meta = pq.ParquetFile(path).metadata
    except (OSError, ValueError):
        return None
    return meta.num_rows, meta.row_group(0).column(0).compression if meta.num_row_groups else ""


def publish_plan(files: DataFrame, remote: DataFrame) -> DataFrame:
    """name, action of local files (name, sha256) against remote ones: add, update, or same, which needs no transfer."""
    there = remote.select("name", F.col("sha256").alias("_there"))
    action = F.when(F.col("_there").isNull(), "add").when(F.col("_there") == F.col("sha256"), "same").otherwise("update")
    return files.join(there, "name", "left").select("name", action.alias("action"))


def waiting_files(files: DataFrame, wanted: Callable[[Column], Column] = lambda parts: F.lit(True)) -> DataFrame:
    """Paths, in order, without hidden parts, caches and Parquet; parts of a path in lower case can be asked for more."""
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    hidden = F.exists(parts, lambda p: p.startswith(".") | p.isin("__pycache__", "parquet", "..")) | F.lower("path").endswith(".parquet")
    return files.filter(~hidden & wanted(F.transform(parts, F.lower))).orderBy("path")


def scanned_part(parts: Column) -> Column:
    """A path below scan or scanned and not below old or convertable."""
    return F.arrays_overlap(parts, F.array(F.lit("scan"), F.lit("scanned"))) & ~F.arrays_overlap(parts, F.array(F.lit("old"), F.lit("convertable")))


def free_names(files: DataFrame, order: list[str], most: int | None = None) -> DataFrame:
    """files (dir, name, ...) with free_name: name, name (2), name (3) ...; with most, null where a name is taken that often.

    Only names that are taken more than once are numbered, so a directory of distinct names is no window.
    """
    count = files.groupBy("dir", "name").agg(F.count("*").alias("_n")).filter("_n > 1").select("dir", "name")
    many = files.join(count, ["dir", "name"], "left_semi").withColumn("_k", F.row_number().over(Window.partitionBy("dir", "name").orderBy(*order)))
    one = files.join(count, ["dir", "name"], "left_anti").withColumn("_k", F.lit(1))
    stem, ext = F.regexp_extract("name", r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract("name", r"^(.*?)(\.[^.]*)?$", 2)
    name = F.when(F.col("_k") == 1, F.col("name")).otherwise(F.concat(stem, F.lit(" ("), F.col("_k").cast("string"), F.lit(")"), ext))
    if most is not None:
        name = F.when(F.col("_k") <= most, name)
    return one.unionByName(many).withColumn("free_name", name).drop("_k")


def book_name(title: Column, author: Column, slug: Column, extension: str) -> Column:
    """title - author, title, or slug; unsafe characters become spaces, 120 characters."""
    clean = lambda c: F.nullif(F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\\/:*?\"<>|\x00-\x1f]", " "), r"\s+", " ")), F.lit(""))
    stem = F.coalesce(F.when(clean(title).isNotNull(), F.concat_ws(" - ", clean(title), clean(author))), clean(slug))
    return F.concat(F.trim(F.substring(stem, 1, 120)), F.lit("." + extension))


# ---- appends and deletes ----


def append_unless_known(spark: SparkSession, rows: DataFrame, target: str, keys: list[str]) -> None:
    """Rows whose keys target does not have, each once, are added to it; a target that is not there yet is made."""
    fresh = rows.dropDuplicates(keys)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        fresh = fresh.join(spark.read.parquet(target).select(*keys).distinct(), keys, "left_anti")
    fresh.write.mode("append").parquet(target)


class Versions:
    """A table of whole versions: a rewrite makes a new one, and a pointer file names the present one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def current(self) -> int:
        names = [f.getPath().getName() for f in self.fs.listStatus(self.path(self.root))] if self.fs.exists(self.path(self.root)) else []
        return max((int(n.removeprefix("current-")) for n in names if n.startswith("current-")), default=0)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/v{self.current()}")

    def write(self, rows: DataFrame) -> int:
        """The rows as the next version; readers see it when it is whole. The version before it stays for those who read it."""
        new = self.current() + 1
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/v{new}")
        self.fs.create(self.path(f"{self.root}/current-{new}"), False).close()
        return new

    def delete(self, gone: DataFrame, keys: list[str]) -> bool:
        """Without the rows whose keys are in gone; where none is, nothing is written."""
        rows, keyed = self.read(), gone.select(*keys).distinct()
        if rows.join(keyed, keys, "left_semi").isEmpty():
            return False
        self.write(rows.join(keyed, keys, "left_anti"))
        return True


# ---- states ----

#: What may follow a state of a book that is parsed, or read as images.
STEPS = {"pending": ("downloading",), "downloading": ("downloaded", "failed"), "downloaded": ("parsing", "ocr"), "parsing": ("success", "failed"), "ocr": ("segmenting", "failed"), "segmenting": ("success", "failed"), "failed": ("pending", "removed"), "success": ("removed", "pending"), "removed": ()}
DONE = ("success", "removed")


def advanced(events: DataFrame, start: str = "pending") -> DataFrame:
    """source, status, n_refused after the events (source, seq, status) of each source in order; steps that may not follow are refused.

    The fold is one aggregation in the JVM over the events of one source.
    """
    allowed = F.map_from_arrays(F.array(*map(F.lit, STEPS)), F.array(*(F.array(*map(F.lit, v)) if v else F.array().cast("array<string>") for v in STEPS.values())))
    first = F.struct(F.lit(start).alias("status"), F.lit(0).alias("n"))

    def step(s: Column, e: Column) -> Column:
        fits = F.coalesce(F.array_contains(F.element_at(allowed, s["status"]), e["status"]), F.lit(False))
        return F.struct(F.when(fits, e["status"]).otherwise(s["status"]).alias("status"), (s["n"] + F.when(fits, 0).otherwise(1)).alias("n"))

    told = events.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("seq", "status"))).alias("e"))
    return told.select("source", F.aggregate("e", first, step).alias("s")).select("source", "s.status", F.col("s.n").alias("n_refused"))


def unfinished(books: DataFrame) -> DataFrame:
    return books.filter(~F.col("status").isin(*DONE)).orderBy("source")


def released(ledger: DataFrame, books: DataFrame) -> DataFrame:
    """source, action: a successful source whose book is in the collection can be released, another is put back."""
    have = books.select(F.col("book").alias("book_key")).distinct().withColumn("_have", F.lit(True))
    return ledger.filter("status = 'success'").join(have, "book_key", "left").select("source", F.when(F.col("_have"), "release").otherwise("requeue").alias("action"))


def put(table: DataFrame, rows: DataFrame, keys: list[str], replace: bool) -> DataFrame:
    """Insert or replace, or insert or ignore: rows of one key are never doubled."""
    fresh = rows.dropDuplicates(keys)
    if replace:
        return table.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)
    return table.unionByName(fresh.join(table.select(*keys), keys, "left_anti"))


def retried(failed: DataFrame, blocked: DataFrame, attempt: Callable[[DataFrame, int], DataFrame], turns: int = 3) -> DataFrame:
    """url, turn (null where none helped) of the distinct HTTP URLs in failed (status, url) and blocked (url).

    attempt(urls, turn) gives the URLs that it recovers; these are in no later turn. It ends early when nothing is left.
    """
    left = failed.filter(F.col("status").isin("failed", "error", "timeout")).select("url").unionByName(blocked.select("url"))
    left = cut(left.filter(F.lower("url").rlike("^https?://")).distinct())
    out = left.limit(0).withColumn("turn", F.lit(None).cast("int"))
    for turn in range(1, turns + 1):
        won = cut(attempt(left, turn).select("url").distinct().join(left, "url", "left_semi"))
        out, left = out.unionByName(won.withColumn("turn", F.lit(turn))), cut(left.join(won, "url", "left_anti"))
        if left.isEmpty():
            break
    return out.unionByName(left.withColumn("turn", F.lit(None).cast("int")))


# ---- look-ups ----


def hashes_of_books(books: DataFrame, tables: list[tuple[str, DataFrame]]) -> DataFrame:
    """book, sha256, source: the first table (name, sha256) that knows the book by its name, name.pdf, or those in lower case.

    A book called name-hash8 is looked up by that name, too, and takes a hash that begins so, before the plain keys of a table.
    """
    b = F.col("book")
    shaped = F.regexp_extract("book", r"^(.+)-([0-9a-f]{8})$", 1)
    head = F.regexp_extract("book", r"^(.+)-([0-9a-f]{8})$", 2)
    none = F.lit("")
    keys = [F.struct(k.alias("name"), F.lit(i).alias("rank"), p.alias("head")) for i, (k, p) in enumerate([(shaped, head), (F.concat(shaped, F.lit(".pdf")), head), (b, none), (F.concat(b, F.lit(".pdf")), none), (F.lower(b), none), (F.concat(F.lower(b), F.lit(".pdf")), none)])]
    asked = books.select("book").distinct().select("book", F.explode(F.array(*keys)).alias("k")).select("book", "k.*").filter("rank > 1 OR head <> ''")
    known = None
    for i, (source, table) in enumerate(tables):
        part = table.filter("sha256 <> ''").select("name", "sha256", F.lit(i).alias("place"), F.lit(source).alias("source"))
        known = part if known is None else known.unionByName(part)
    found = asked.join(known, "name").filter(F.col("sha256").startswith(F.col("head")))
    best = found.groupBy("book").agg(F.min_by(F.struct("sha256", "source"), F.struct("place", "rank", "sha256")).alias("f"))
    return books.select("book").distinct().join(best, "book", "left").select("book", F.coalesce("f.sha256", none).alias("sha256"), F.coalesce("f.source", none).alias("source"))


def never_downloaded(crawled: DataFrame, recorded: DataFrame, all_urls: bool = False) -> DataFrame:
    """url, pos: the canonical URLs of crawled (url, pos) that no line of recorded (value) holds in any of their forms, first seen first.

    A line holds a URL if it goes on from one of the line's own URLs, on the same host. The least recorded URL that is not
    below a form is the only one that can begin with it, so one sort per host answers all.
    """
    rows = crawled.withColumn("key", U.canonical(F.col("url"))).filter("key IS NOT NULL")
    if not all_urls:
        rows = rows.filter(U.is_document(F.col("url")) | U.provider_of(U.host(F.col("url"))).isNotNull())
    rows = rows.groupBy("key").agg(F.min("pos").alias("pos"))
    forms = rows.select("key", F.explode(U.variants(F.col("key"))).alias("form")).select(U.host(F.col("form")).alias("host"), F.col("form").alias("text"), F.lit(0).alias("side"), "key")
    told = recorded.select(F.explode(F.regexp_extract_all("value", F.lit(r"(https?://.*?)(?=https?://|$)"), 1)).alias("text")).distinct()
    told = told.select(U.host(F.regexp_extract("text", r"^(\S+)", 1)).alias("host"), "text", F.lit(1).alias("side"), F.lit(None).cast("string").alias("key"))
    after = Window.partitionBy("host").orderBy(F.desc("text"), F.desc("side")).rowsBetween(Window.unboundedPreceding, 0)
    seen = forms.unionByName(told).withColumn("next", F.last(F.when(F.col("side") == 1, F.col("text")), ignorenulls=True).over(after))
    held = seen.filter((F.col("side") == 0) & F.col("next").startswith(F.col("text"))).select("key").distinct()
    return rows.join(held, "key", "left_anti").select(F.col("key").alias("url"), "pos")


def archive_problems(saved: DataFrame, archives: DataFrame, members: DataFrame) -> DataFrame:
    """archive, name, problem: files (archive, name, at) saved after their archive (archive, mtime) was written and not in it, files
    that are in it twice, and members (archive, name) of which nothing was saved."""
    inside = members.groupBy("archive", "name").agg(F.count("*").alias("n"))
    both = saved.groupBy("archive", "name").agg(F.max("at").alias("at")).join(inside, ["archive", "name"], "full").join(archives, "archive", "left")
    problem = F.when(F.col("n").isNull() & (F.col("at") > F.col("mtime")), "late").when(F.col("n").isNull(), "missing").when(F.col("at").isNull(), "unknown").when(F.col("n") > 1, "doubled")
    return both.select("archive", "name", problem.alias("problem")).filter("problem IS NOT NULL")


# ---- reports ----


def elapsed(seconds: Column) -> Column:
    """h m, m s or s."""
    s = F.floor(seconds).cast("long")
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return F.when(h > 0, F.format_string("%dh %dm", h, m)).when(m > 0, F.format_string("%dm %ds", m, s % 60)).otherwise(F.format_string("%ds", s))


def sized(n: Column) -> Column:
    """GB with one digit from one up, else MB."""
    return F.when(n >= 1 << 30, F.format_string("%.1f GB", n / float(1 << 30))).otherwise(F.format_string("%.0f MB", n / float(1 << 20)))


def local_clock(at: Column, zone: str = "+06:30") -> Column:
    return F.date_format(F.from_utc_timestamp(at, zone), "h:mm a")


def local_day(at: Column, zone: str = "+06:30") -> Column:
    return F.date_format(F.from_utc_timestamp(at, zone), "EEEE d MMM yyyy")


def run_report(events: DataFrame) -> DataFrame:
    """One row: files and bytes by what became of them (outcome, size), and what is left."""
    when = lambda o: F.col("outcome") == o
    counts = [c for o in ("saved", "uploaded", "failed") for c in (F.count_if(when(o)).alias(f"n_{o}"), F.coalesce(F.sum(F.when(when(o), F.col("size"))), F.lit(0)).alias(f"{o}_bytes"))]
    return events.agg(*counts, (F.count_if(when("saved")) - F.count_if(when("uploaded"))).alias("n_left"))


def shown_first(rows: DataFrame, order: list[Column], line: Column, most: int = 15) -> DataFrame:
    """line of the first rows, and a last line that says how many more there are. One pass counts, another takes the first."""
    total = rows.agg(F.count("*").alias("n"))
    first = rows.orderBy(*order).limit(most).select(line.alias("line"), F.row_number().over(Window.orderBy(*order)).alias("pos"))
    more = total.filter(F.col("n") > most).select(F.format_string("and %d more", F.col("n") - most).alias("line"), F.lit(most + 1).alias("pos"))
    return first.unionByName(more)


def leading_words(words: DataFrame, most: int = 25) -> DataFrame:
    """lang, rule, word, n, place, doc_id, pos, line, context of the most frequent words; equal ones by where they were first seen."""
    place = F.row_number().over(Window.partitionBy("lang", "rule").orderBy(F.desc("n"), "first.doc_id", "first.pos", "word"))
    return words.withColumn("place", place).filter(F.col("place") <= most).select("lang", "rule", "word", "n", "place", "first.*")


def low_disk(free: Column, floor: int = 5 << 30) -> Column:
    return free < floor


def token_delay(sizes: DataFrame, key: str, order: str, rate: float) -> DataFrame:
    """sizes with wait: how long each transfer waits where the ones before it take size / rate: deadline = max(now, deadline) + size / rate.

    In closed form: the deadline after a row is the greatest of at_i + (cost from i on), one window maximum of differences.
    """
    w = Window.partitionBy(key).orderBy(order)
    df = sizes.withColumn("_cost", F.col("size") / F.lit(rate)).withColumn("_sum", F.sum("_cost").over(w))
    df = df.withColumn("_end", F.max(F.col("at") - F.col("_sum") + F.col("_cost")).over(w) + F.col("_sum"))
    return df.withColumn("wait", F.greatest(F.col("_end") - F.col("_cost") - F.col("at"), F.lit(0.0))).drop("_cost", "_sum", "_end")


def here(path: str) -> list[str]:
    """Parquet files of a folder, or the file itself; hidden names are left out, sorted."""
    if os.path.isfile(path):
        return [path]
    return sorted(os.path.join(path, n) for n in os.listdir(path) if n.endswith(".parquet") and not n.startswith((".", "_")))
