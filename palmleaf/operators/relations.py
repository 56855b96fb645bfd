"""Relational operators over ledgers and collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import cut


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the first in order; rows are reduced before they are moved."""
    names = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*names), F.struct(*order)).alias("_first"))
    return best.select(*(F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns))


def new_rows(incoming: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return incoming.join(known.select(*keys).distinct(), keys, "left_anti")


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side only, with the side."""
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))


def doubled_texts(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Names of texts that occur more than once. Texts are grouped by digest, so no text is moved."""
    grouped = docs.groupBy(F.sha2(F.col(text), 256).alias("digest")).agg(F.count("*").alias("n"), F.sort_array(F.collect_set(name)).alias("names"))
    return grouped.filter("n > 1")


def book_keys(df: DataFrame, base: str, source: str) -> DataFrame:
    """The base name for the first source that has it; base-hash8 for all later ones."""
    place = F.row_number().over(Window.partitionBy(base).orderBy(source))
    return df.withColumn("book_key", F.when(place == 1, F.col(base)).otherwise(F.concat_ws("-", base, F.substring(F.sha2(F.col(source), 256), 1, 8))))


def numbered_copies(files: DataFrame) -> DataFrame:
    """Rows of files (dir, name) called "stem (N).ext" whose "stem.ext" stands in the same directory; N has up to three digits."""
    split = files.select("dir", "name", F.regexp_extract("name", r"^(.*) \((\d{1,3})\)(\.[^.]+)$", 1).alias("stem"), F.lower(F.regexp_extract("name", r"^(.*) \((\d{1,3})\)(\.[^.]+)$", 3)).alias("ext"))
    plain = files.select("dir", F.regexp_extract("name", r"^(.*)(\.[^.]+)$", 1).alias("stem"), F.lower(F.regexp_extract("name", r"^(.*)(\.[^.]+)$", 2)).alias("ext"))
    return split.filter("stem <> ''").join(plain, ["dir", "stem", "ext"], "left_semi").select("dir", "name")


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: str) -> DataFrame:
    """left with the latest value of right at or before its time, by one union and one window instead of a range join."""
    a = left.select(key, F.col(left_time).alias("at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("row"), F.lit(None).cast(right.schema[value].dataType).alias("v"))
    b = right.select(key, F.col(right_time).alias("at"), F.lit(0).alias("_side"), F.lit(None).cast(a.schema["row"].dataType).alias("row"), F.col(value).alias("v"))
    latest = F.last("v", ignorenulls=True).over(Window.partitionBy(key).orderBy("at", "_side").rowsBetween(Window.unboundedPreceding, 0))
    return a.unionByName(b).withColumn("as_of", latest).filter("_side = 1").select("row.*", "as_of")


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("place") <= k)


def budgeted(df: DataFrame, group: str, order: str, size: Column, cap: int) -> DataFrame:
    """Rows up to and including the one that crosses the cap of the group."""
    before = F.sum(size).over(Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") <= cap)


def overlaps(spans: DataFrame, regions: DataFrame, width: float) -> DataFrame:
    """Pairs of (id, lo, hi) intervals that overlap, by equal cells of the axis; each pair once, in its first common cell."""
    cells = lambda df, p: df.select(*(F.col(c).alias(f"{p}_{c}") for c in ("id", "lo", "hi")), F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))).alias("cell"))
    both = cells(spans, "s").join(cells(regions, "r"), "cell")
    first = F.greatest(F.floor(F.col("s_lo") / width), F.floor(F.col("r_lo") / width)) == F.col("cell")
    return both.filter(first & (F.col("s_lo") < F.col("r_hi")) & (F.col("s_hi") > F.col("r_lo"))).drop("cell")


def sha_backfill(books: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """books (book, sha256) with the hash of ledger (book, sha256) and what became of it: filled, same, forced, conflict, absent."""
    found = ledger.groupBy("book").agg(F.max("sha256").alias("new_sha"))
    joined = books.join(found, "book", "left")
    state = F.when(F.col("new_sha").isNull(), "absent").when(F.coalesce("sha256", F.lit("")) == "", "filled").when(F.col("sha256") == F.col("new_sha"), "same").otherwise("forced" if force else "conflict")
    return joined.withColumn("outcome", state)


BLANK = " \t\n\r\f\x0b"
LEAST_TEXT = 200


def _stripped(text: str) -> Column:
    return F.trim(F.coalesce(F.col(text), F.lit("")), F.lit(BLANK))


def upsert_outcomes(books: DataFrame, incoming: DataFrame) -> DataFrame:
    """What each incoming row (seq, book, text, sha256) does to books (pos, book, text, sha256), each judged against books alone.

    The row that it meets is the last one with its hash, else the last one with its text of LEAST_TEXT characters or more.
    Equal words under another name or with an equal hash are denied, equal words with a new hash are a fix, other words under
    another name an update in place. All else that meets a row, by one of those or by its name, replaces; the rest is
    appended. Empty hashes are no identity. Texts are compared by digest, and rows without a key are dealt by their number.
    """
    b = books.select("pos", F.struct("pos", "book", "sha256", F.sha2(_stripped("text"), 256).alias("digest")).alias("row"), F.length(_stripped("text")).alias("size"))
    last = lambda df, key, name: df.groupBy(key).agg(F.max("row").alias(name))
    by_sha = last(b.filter("row.sha256 <> ''").withColumn("sha_key", F.col("row.sha256")), "sha_key", "held")
    by_text = last(b.filter(F.col("size") >= LEAST_TEXT).withColumn("text_key", F.col("row.digest")), "text_key", "same")
    by_name = books.groupBy(F.col("book").alias("named")).agg(F.count("*").alias("n_named"))
    own = F.concat(F.lit("~"), F.col("seq").cast("string"))
    i = incoming.select("seq", "book", F.coalesce("sha256", F.lit("")).alias("sha256"), F.sha2(_stripped("text"), 256).alias("digest"))
    i = i.withColumn("sha_key", F.when(F.col("sha256") != "", F.col("sha256")).otherwise(own)).withColumn("text_key", F.col("digest"))
    j = i.join(by_sha, "sha_key", "left").join(by_text, "text_key", "left").join(by_name, F.col("book") == F.col("named"), "left")
    j = j.withColumn("met", F.coalesce("held", "same"))
    words, name, sha = F.col("met.digest") == F.col("digest"), F.col("met.book") == F.col("book"), F.col("met.sha256") == F.col("sha256")
    there = F.col("met").isNotNull()
    outcome = F.when(there & words & (~name | sha), "deny").when(there & words & (F.col("sha256") != ""), "fix").when(there & ~words & ~name, "update").when(there | F.col("n_named").isNotNull(), "replace").otherwise("append")
    return j.select("seq", "book", outcome.alias("outcome"))


def grouped_by_keys(rows: DataFrame, id: str, keys: list[str]) -> DataFrame:
    """id, group: rows that share a non-empty key, directly or by others, have one group, the least id of them.

    Labels are passed from rows to keys and back until none changes; every round is a stored table and two aggregations.
    """
    pairs = rows.select(F.col(id).alias("id"), F.explode(F.array(*(F.when(F.coalesce(k, F.lit("")) != "", F.concat(F.lit(f"{k}:"), F.sha2(F.col(k), 256))) for k in keys))).alias("key")).filter("key IS NOT NULL").distinct()
    # a key of one row leads nowhere
    pairs = cut(pairs.join(pairs.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key", "left_semi"))
    label = cut(rows.select(F.col(id).alias("id"), F.col(id).alias("group")))
    while True:
        by_key = pairs.join(label, "id").groupBy("key").agg(F.min("group").alias("group"))
        best = pairs.join(by_key, "key").groupBy("id").agg(F.min("group").alias("least"))
        # a group is itself a row, whose own label may be lower by now
        new = label.join(best, "id", "left").select("id", "group", F.least("group", F.coalesce("least", "group")).alias("to"))
        up = new.select(F.col("id").alias("to"), F.col("to").alias("further"))
        new = cut(new.join(up, "to", "left").select("id", "group", F.least("to", F.coalesce("further", "to")).alias("to")))
        changed = new.filter(F.col("group") != F.col("to")).limit(1).count()
        label = new.select("id", F.col("to").alias("group"))
        if not changed:
            return label


def reachable(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """node, depth by breadth-first search over edges (src, dst); every level is a stored table."""
    seen = cut(seeds.select("node").distinct().withColumn("depth", F.lit(0)))
    front = seen
    for level in range(1, depth + 1):
        front = cut(front.join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("depth", F.lit(level)))
        seen = cut(seen.unionByName(front))
        if front.isEmpty():
            break
    return seen


def routing_probe(pages: DataFrame, most: int = 32) -> DataFrame:
    """doc, n_pages, sampled, text_bytes from pages (doc, page from 0, text): at most so many evenly spaced pages, scaled up.

    Halves round to even.
    """
    n = F.count("*").over(Window.partitionBy("doc"))
    k = F.least(n, F.lit(most))
    step = pages.withColumn("n", n).withColumn("k", k)
    wanted = F.exists(F.sequence(F.lit(0), (F.col("k") - 1).cast("int")), lambda i: F.when(F.col("k") > 1, F.bround(i * (F.col("n") - 1) / (F.col("k") - 1))).otherwise(0.0) == F.col("page"))
    picked = step.filter(wanted).groupBy("doc", "n").agg(F.count("*").alias("sampled"), F.sum(F.octet_length(F.trim("text"))).alias("bytes"))
    return picked.select("doc", F.col("n").alias("n_pages"), "sampled", F.bround(F.col("bytes") * F.col("n") / F.col("sampled")).cast("long").alias("text_bytes"))
