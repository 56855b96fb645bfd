"""The guarded upsert into one collection: incoming rows are folded in order, within groups that can touch the same rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.batches import SLICE_ROWS, arrow_rows, rows_of
from ..storage import cut
from .relations import grouped_by_keys

COLUMNS = ["author", "book", "text", "segmented", "sha256"]
LEAST_TEXT = 200


def fold(rows: list[dict], incoming: list[dict]) -> tuple[list[dict], list[tuple[int, str]]]:
    """The collection after the incoming rows, and what each did: deny, fix, update, replace or append.

    A row is met by its hash, else by its text of LEAST_TEXT characters or more, which it may no longer hold: what a row held
    before still leads to it. What counts is whether its present words are those of the incoming row.
    """
    rows = [dict(r) for r in rows]
    by_sha, by_text, by_name = {}, {}, {}

    def index(i: int) -> None:
        r = rows[i]
        if r["sha256"]:
            by_sha[r["sha256"]] = i
        if len(r["text"].strip()) >= LEAST_TEXT:
            by_text[r["text"].strip()] = i

    for i, r in enumerate(rows):
        index(i)
        by_name.setdefault(r["book"], i)
    done = []
    for new in incoming:
        text = new["text"].strip()
        at = by_sha.get(new["sha256"]) if new["sha256"] else None
        at = by_text.get(text) if at is None else at
        put, what = {c: new[c] for c in COLUMNS}, "replace"
        if at is not None:
            held = rows[at]
            words, name = held["text"].strip() == text, held["book"] == new["book"]
            if words and (not name or held["sha256"] == new["sha256"]):
                done.append((new["seq"], "deny"))
                continue
            if words and new["sha256"]:
                what = "fix"
            elif not words and not name:
                what = "update"
            put["book"] = held["book"]
        elif new["book"] in by_name:
            at = by_name[new["book"]]
        else:
            at, what = len(rows), "append"
            by_name[new["book"]] = at
            rows.append(put)
        rows[at] = put
        index(at)
        done.append((new["seq"], what))
    return rows, done


def slim_fold(rows: Iterator[tuple]) -> Iterator[tuple]:
    """fold of rows (group, seq, id, book, sha256, text, long) in order of group, with the collection, whose seq is null, first.

    The text is a digest, and a hash or text that no other row of the input has is null, so only names, shared keys and the rows
    they lead to are held. Gives (seq, outcome, null, null) of incoming rows and (null, "row", book, id) of the collection
    after them, where id is the row whose columns it holds.
    """
    last: object = None
    slots, by_sha, by_text, by_name = [], {}, {}, {}
    for group, seq, id, book, sha, text, long in rows:
        if group != last:
            yield from ((None, "row", slot[0], slot[3]) for slot in slots)
            last, slots, by_sha, by_text, by_name = group, [], {}, {}, {}
        leads = bool(text) and long
        if seq is None:
            if book in by_name and not sha and not leads:
                yield None, "row", book, id
                continue
            at, what = len(slots), None
            by_name.setdefault(book, at)
            slots.append([book, None, None, None])
        else:
            at, what = by_sha.get(sha) if sha else None, "replace"
            at = by_text.get(text) if at is None and leads else at
            if at is not None:
                held = slots[at]
                words, name = text is not None and held[2] == text, held[0] == book
                if words and (not name or (sha is not None and held[1] == sha)):
                    yield seq, "deny", None, None
                    continue
                if words and sha != "":
                    what = "fix"
                elif not words and not name:
                    what = "update"
            elif book in by_name:
                at = by_name[book]
            else:
                at, what = len(slots), "append"
                by_name[book] = at
                slots.append([book, None, None, None])
            yield seq, what, None, None
        slots[at][1:] = sha, text, id
        if sha:
            by_sha[sha] = at
        if leads:
            by_text[text] = at
    yield from ((None, "row", slot[0], slot[3]) for slot in slots)


def _digest(id: str, seq: int | None, pos: int | None, book: str, sha: str, text: str) -> Iterator[tuple]:
    text = text.strip()
    yield id, seq, pos, book, sha, hashlib.blake2b(text.encode(errors="surrogatepass"), digest_size=16).hexdigest(), len(text) >= LEAST_TEXT


def upsert_all(books: DataFrame, incoming: DataFrame) -> DataFrame:
    """books (COLUMNS and pos, their order) after incoming (COLUMNS and seq), with a null seq, and the seq and outcome of incoming rows.

    Rows are folded in groups: a group holds all rows that share a hash, a text or a name, directly or by others; only rows of one
    group can meet. Texts are folded by digest and joined to the result by row.
    """
    clean = [F.coalesce(c, F.lit("")).alias(c) for c in COLUMNS]
    null = F.lit(None).cast("long")
    name = lambda p, c: F.concat(F.lit(p), F.lpad(F.col(c).cast("string"), 20, "0")).alias("id")
    both = books.select(*clean, name("b", "pos"), null.alias("seq"), F.col("pos").cast("long").alias("pos")).unionByName(incoming.select(*clean, name("i", "seq"), F.col("seq").cast("long").alias("seq"), null.alias("pos")))
    slim = cut(rows_of(both, ["id", "seq", "pos", "book", "sha256", "text"], "id string, seq long, pos long, book string, sha256 string, text string, long boolean", _digest))
    keyed = slim.select("id", F.concat(F.lit("="), "book").alias("book"), "sha256", F.when(F.col("long"), F.col("text")).alias("words"))
    # which hashes and texts any other row has
    keys = slim.select("id", F.explode(F.array(F.struct(F.lit("s").alias("kind"), F.col("sha256").alias("key")), F.struct(F.lit("t").alias("kind"), F.col("text").alias("key")))).alias("k")).select("id", "k.*").filter("key <> ''")
    shared = keys.groupBy("kind", "key").agg(F.count("*").alias("n")).filter("n > 1")
    flags = keys.join(shared, ["kind", "key"], "left_semi").groupBy("id").agg(F.max(F.col("kind") == "s").alias("s"), F.max(F.col("kind") == "t").alias("t"))
    told = slim.join(grouped_by_keys(keyed, "id", ["book", "sha256", "words"]), "id").join(flags, "id", "left")
    told = told.withColumn("sha256", F.when((F.col("sha256") == "") | F.col("s"), F.col("sha256"))).withColumn("text", F.when(F.col("t"), F.col("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for a in range(0, batch.num_rows, SLICE_ROWS) for row in zip(*(c.slice(a, SLICE_ROWS).to_pylist() for c in batch.columns), strict=True))
        yield from arrow_rows(slim_fold(rows), pa.schema([("seq", pa.int64()), ("outcome", pa.string()), ("book", pa.string()), ("id", pa.string())]))

    dealt = told.repartition("group").sortWithinPartitions("group", F.col("seq").asc_nulls_first(), "pos", "book", "id")
    done = cut(dealt.select("group", "seq", "id", "book", "sha256", "text", "long").mapInArrow(run, "seq long, outcome string, book string, id string"))
    held = done.filter("seq IS NULL").select("id", "book").join(both.drop("book", "seq", "pos"), "id")
    log = done.filter("seq IS NOT NULL")
    empty = [F.lit(None).cast("string").alias(c) for c in COLUMNS]
    return held.select(*COLUMNS, null.alias("seq"), F.lit("row").alias("outcome")).unionByName(log.select(*empty, "seq", "outcome"))
