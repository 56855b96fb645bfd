"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Within a source every document is expected target / source_size times. Documents are ranked by size, so that the rounding
of neighbours cancels; the prefix sum of expected copies is rank * expectation, one random offset per source is added, and
a document is emitted once per integer boundary that its step crosses. Ranks come from three levels of counts (sizes
within a source, id ranges within a size, rows within an id range), so no task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored

WEIGHTS = (5, 2, 1)
#: The mix has this share of all words; a source gives at most LIMIT times its own.
SHARE = 1.5
LIMIT = 2.0
#: Ids in one range: the most distinct ids that one window sorts.
ID_RANGE = 65536
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target from rows of (source, size): water-filling in closed form over one row per source."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weights = F.array(*(F.lit(float(w)) for w in WEIGHTS))
    w = total.withColumn("weight", F.element_at(weights, ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))).withColumn("cap", F.col("source_size") * LIMIT)
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    everything = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("level", (F.sum("source_size").over(everything) * SHARE - (F.sum("cap").over(by_fill) - F.col("cap"))) / F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
    w = w.withColumn("place", F.row_number().over(by_fill)).withColumn("open", F.col("weight") * F.col("level") <= F.col("cap"))
    w = w.withColumn("fill", F.min_by("level", F.when(F.col("open"), F.col("place"))).over(everything))
    return w.select("source", "source_size", F.coalesce(F.least("cap", F.col("weight") * F.col("fill")), F.col("cap")).alias("target"))


def offset(source: Column) -> Column:
    """The random number in [0, 1) of a source, the same in every run."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(source, F.lit("")))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def copies(rows: DataFrame, sizes: DataFrame, tie: list[Column] | None = None) -> DataFrame:
    """rows (doc_id, source, size and any more columns) with source_size, target and copies.

    sizes has (doc_id, source, size) of the same rows, cheap to read again. Null sources are a source of their own, the
    last one; null ids come first within a size; a source without words gets no copies; rows that repeat count each.
    """
    targets = source_targets(sizes)
    keyed = lambda df: df.withColumn("_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    part = F.floor(F.coalesce(F.col("doc_id"), F.lit(-1)) / ID_RANGE)
    ranged = keyed(sizes).groupBy("_key", "size", part.alias("_range")).agg(F.count("*").alias("_n"))
    per_size = ranged.groupBy("_key", "size").agg(F.sum("_n").alias("_n"))
    before_size = per_size.select("_key", "size", (F.sum("_n").over(Window.partitionBy("_key").orderBy("size")) - F.col("_n")).alias("_before_size"))
    before_range = ranged.select("_key", "size", "_range", (F.sum("_n").over(Window.partitionBy("_key", "size").orderBy("_range")) - F.col("_n")).alias("_before_range"))
    rates = keyed(targets).select("_key", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_rate"), offset(F.col("source")).alias("_offset"))
    starts = before_range.join(before_size, ["_key", "size"]).join(rates, "_key")
    inside = Window.partitionBy("_key", "size", "_range").orderBy("doc_id", *(tie or []))
    ranked = keyed(rows).withColumn("_range", part).withColumn("_row", F.row_number().over(inside))
    rank = F.col("_before_size") + F.col("_before_range") + F.col("_row")
    crossed = F.floor(rank * F.col("_rate") + F.col("_offset")) - F.floor((rank - 1) * F.col("_rate") + F.col("_offset"))
    return ranked.join(starts, ["_key", "size", "_range"]).withColumn("copies", crossed.cast("long")).drop("_key", "_range", "_row", "_before_size", "_before_range", "_rate", "_offset")


def mix_words(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of docs (doc_id, source, text; other columns are left behind).

    A null text has size 0 and is not taken; nulls, ties and repeated rows are as in copies().
    """
    sizes = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    return copies(sizes, sizes).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of docs with all their columns, each as often as it is taken, numbered by copy_no from 0.

    Null texts have no words and are never taken; nulls, ties and repeated rows are as in copies(). Where docs has a column
    copy_no, the number's name gets underscores behind it until it is free.
    """
    number = "copy_no"
    while number in docs.columns:
        number += "_"
    names = docs.columns
    kept = docs.withColumnsRenamed({c: f"d_{i}" for i, c in enumerate(names)})
    at = {c: f"d_{i}" for i, c in enumerate(names)}
    rows = kept.select(F.col(at["doc_id"]).alias("doc_id"), F.col(at["source"]).alias("source"), word_count(F.col(at["text"])).alias("size"), "*")
    sizes = stored(rows.select("doc_id", "source", "size"), "sizes")
    out = copies(rows, sizes, [F.xxhash64(at["text"])]).filter("copies > 0")
    return out.select(*(F.col(at[c]).alias(c) for c in names), F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1)).alias(number))


SQL = f"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
total AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, source_size * 2.0::DOUBLE AS cap FROM total),
ordered AS (SELECT *, row_number() OVER f AS place, (sum(source_size) OVER () * 1.5::DOUBLE - (sum(cap) OVER f - cap)) / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed WINDOW f AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
filled AS (SELECT *, (SELECT arg_min(level, place) FROM ordered WHERE weight * level <= cap) AS fill FROM ordered),
targets AS (SELECT source, source_size, coalesce(least(cap, weight * fill), cap) AS target, ('0x' || substr(md5('{SEED}:' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS o FROM filled),
ranked AS (SELECT doc_id, s.size, t.source_size, t.target, row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id NULLS FIRST) AS r, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate, o FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(r * rate + o) - floor((r - 1) * rate + o)) * size)::BIGINT AS taken FROM ranked
"""
