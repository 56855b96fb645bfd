"""Merkle fixity audit of two replicas of a record archive.

A record's leaf is its length and the SHA-256 of its WARC form. Records are in the order of their addresses, FANOUT ** FILE
of them in one file, and a node is the SHA-256 over the addresses, offsets and digests of its children: an ordered range of
offsets. Roots are compared first; level by level, only children of nodes that differ are read, so equal subtrees are never
visited, and what is left at level 0 are the corrupt, missing and surplus records. Every level is stored once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

FANOUT = 16
#: Levels above the records: a root covers FANOUT ** LEVELS addresses, and there are as many roots as the archive needs.
LEVELS = 4
#: The level whose nodes are files, in which offsets count from 0.
FILE = 3
#: The address of records without an id; no id is this low.
NO_ID = -(1 << 63)


def warc_record(url: Column, payload: Column) -> Column:
    """The record's bytes as text. Null parts count as empty."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def leaves(records: DataFrame) -> DataFrame:
    """address, size, digest from rows of (address, record). Records that share an address are hashed in the order of their digests."""
    each = records.select(F.coalesce("address", F.lit(NO_ID)).cast("long").alias("address"), F.octet_length("record").cast("long").alias("size"), F.sha2("record", 256).alias("digest"))
    grouped = each.groupBy("address", "digest").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    many = F.array_sort(F.collect_list(F.struct("digest", "n")))
    joined = F.array_join(F.transform(many, lambda x: F.concat(x["digest"], F.lit("*"), x["n"].cast("string"))), ",")
    one = (F.size(many) == 1) & (many[0]["n"] == 1)
    return grouped.groupBy("address").agg(F.sum("size").alias("size"), F.when(one, many[0]["digest"]).otherwise(F.sha2(joined, 256)).alias("digest"))


def parents(nodes: DataFrame) -> DataFrame:
    """The nodes above: each the digest of FANOUT children at most, in order, with the offsets at which they begin."""
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, child: Column) -> Column:
        told = F.concat_ws(":", child["address"].cast("string"), state["at"].cast("string"), child["digest"])
        return F.struct((state["at"] + child["size"]).alias("at"), F.concat(state["parts"], F.array(told)).alias("parts"))

    grouped = nodes.groupBy(F.floor(F.col("address") / FANOUT).alias("address")).agg(F.array_sort(F.collect_list(F.struct("address", "size", "digest"))).alias("children"))
    told = grouped.select("address", F.aggregate("children", first, step).alias("s"))
    return told.select("address", F.col("s.at").alias("size"), F.sha2(F.array_join("s.parts", ","), 256).alias("digest"))


def merkle_tree(records: DataFrame, name: str, levels: int = LEVELS) -> list[DataFrame]:
    """(address, size, digest) for each level, the records' first, each stored: no record and no node is hashed twice."""
    tree = [stored(leaves(records), f"leaves-{name}")]
    for level in range(levels):
        tree.append(stored(parents(tree[-1]), f"level-{level + 1}-{name}"))
    return tree


def audit(ours: list[DataFrame], theirs: list[DataFrame]) -> DataFrame:
    """address, status (corrupt, missing, surplus), expected, found, start, stop: every address at which the replicas differ.

    start and stop are the record's offsets in our file of it, null for a surplus record.
    """
    wanted: DataFrame | None = None
    offsets = ours[0]
    up = lambda levels: F.floor(F.col("address") / FANOUT**levels).alias("up")
    for level in range(len(ours) - 1, -1, -1):
        a, b = ours[level].select("address", F.col("digest").alias("expected")), theirs[level].select("address", F.col("digest").alias("found"))
        if wanted is not None:
            a, b = (df.withColumn("up", up(1)).join(wanted, "up", "left_semi").drop("up") for df in (a, b))
        differing = a.join(b, "address", "full_outer").filter(~F.col("expected").eqNullSafe(F.col("found")))
        if level:
            wanted = stored(differing.select(F.col("address").alias("up")), f"differing-{level}")
        if level == FILE:
            offsets = offsets.withColumn("up", up(FILE)).join(wanted, "up", "left_semi")
    if "up" not in offsets.columns:
        offsets = offsets.withColumn("up", up(FILE))
    # a file has FANOUT ** FILE records at most, the bound of this window
    inside = Window.partitionBy("up").orderBy("address")
    offsets = offsets.select("address", (F.sum("size").over(inside) - F.col("size")).alias("start"), F.sum("size").over(inside).alias("stop"))
    status = F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "surplus").otherwise("corrupt")
    return differing.join(offsets, "address", "left").select("address", status.alias("status"), "expected", "found", "start", "stop")


def replica_with_faults(pages: DataFrame) -> DataFrame:
    """A second copy of pages with known faults: by id, some records lose a byte, some are missing and some are extra."""
    kind = F.coalesce(F.pmod("page_id", F.lit(97)), F.lit(0))
    html = F.when(kind == 5, F.substring("html", 2, 2147483647)).otherwise(F.col("html"))
    kept = pages.filter(kind != 11).select("page_id", "url", html.alias("html"))
    return kept.unionByName(pages.filter(kind == 23).select((-F.col("page_id") - 2).alias("page_id"), "url", "html"))


def audit_pages(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """page_id, status, expected, found, start, stop for every page at which the two tables (page_id, url, html) differ.

    Records with a null id share an address of their own, given back as null. Equal ids with several records are one address.
    Null URLs and pages count as empty. Two empty tables differ nowhere. Other columns are left behind.
    """
    form = lambda df: df.select(F.col("page_id").alias("address"), warc_record(F.col("url"), F.col("html")).alias("record"))
    found = audit(merkle_tree(form(pages), "ours"), merkle_tree(form(replica), "theirs"))
    return found.select(F.nullif("address", F.lit(NO_ID)).alias("page_id"), "status", "expected", "found", "start", "stop")


_RECORD = r"""'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10)"""
SQL = f"""
WITH pairs AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
copy AS (SELECT page_id, url, CASE WHEN page_id % 97 = 5 THEN substr(html, 2) ELSE html END AS html FROM pairs WHERE page_id % 97 <> 11
  UNION ALL SELECT -page_id - 2, url, html FROM pairs WHERE page_id % 97 = 23),
ours AS (SELECT page_id, sha256({_RECORD}) AS expected, strlen({_RECORD}) AS size FROM pairs),
placed AS (SELECT *, sum(size) OVER (PARTITION BY page_id // {FANOUT**FILE} ORDER BY page_id) AS stop FROM ours),
theirs AS (SELECT page_id, sha256({_RECORD}) AS found FROM copy)
SELECT page_id, CASE WHEN found IS NULL THEN 'missing' WHEN expected IS NULL THEN 'surplus' ELSE 'corrupt' END AS status, expected, found, (stop - size)::BIGINT AS start, stop::BIGINT AS stop
FROM placed FULL JOIN theirs USING (page_id) WHERE expected IS DISTINCT FROM found
"""
