"""Readers of the corpus ledgers: plain text, tab-separated and JSON lines, with fixed schemas and tolerant rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOOKS = "author string, book string, text string, segmented string, sha256 string"
JOURNAL = "filename string, author string, sha256 string, encoding string, pages int, text string, scan_counts map<string,bigint>, source_url string, collected_at timestamp"
CRAWL = "u string, c array<string>"
SEARCH = "url string, title string, keyword string, page int"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value, line (ordered within a file), without blank lines and # comments."""
    return spark.read.text(path).withColumn("line", F.monotonically_increasing_id()).filter((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))


def books(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(BOOKS).parquet(path)
    return df.select(*(F.coalesce(c, F.lit("")).alias(c) for c in df.columns))


def journal(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOURNAL).option("mode", "DROPMALFORMED").json(path)


def crawl_edges(spark: SparkSession, path: str) -> DataFrame:
    """url, child of every crawled page; the last record of a page wins."""
    rows = spark.read.schema(CRAWL).option("mode", "DROPMALFORMED").json(path).filter("u IS NOT NULL").withColumn("line", F.monotonically_increasing_id())
    return rows.groupBy("u").agg(F.max_by("c", "line").alias("c")).select(F.col("u").alias("url"), F.explode("c").alias("child"))


def search_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEARCH).option("multiLine", True).json(path).filter("url IS NOT NULL")


def downloaded(spark: SparkSession, path: str) -> DataFrame:
    """sha256, identity; identities may hold spaces or be missing."""
    parts = F.split("value", " ", 2)
    return lines(spark, path).select(parts[0].alias("sha256"), F.try_element_at(parts, F.lit(2)).alias("identity")).filter(F.length("sha256") == 64).distinct()


def failed(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", "\t")
    return lines(spark, path).filter(F.size(parts) >= 3).select(parts[1].alias("status"), parts[2].alias("url")).distinct()


def uploaded(spark: SparkSession, path: str) -> DataFrame:
    """sha256, remote_path; the later line wins."""
    parts = F.split("value", "\t")
    return lines(spark, path).filter((F.size(parts) >= 4) & (F.length(parts[0]) == 64)).groupBy(parts[0].alias("sha256")).agg(F.max_by(parts[2], "line").alias("remote_path"))


def timeline(spark: SparkSession, path: str, year: int) -> DataFrame:
    pattern = r"^(\d\d-\d\d \d\d:\d\d:\d\d) (\S+) ?(.*)$"
    at = F.try_to_timestamp(F.concat_ws("-", F.lit(str(year)), F.regexp_extract("value", pattern, 1)), F.lit("yyyy-MM-dd HH:mm:ss"))
    return lines(spark, path).select(at.alias("ts"), F.regexp_extract("value", pattern, 2).alias("event"), F.regexp_extract("value", pattern, 3).alias("detail")).filter("ts IS NOT NULL")


def files(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 of every file below path, without hidden parts."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return df.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).filter(~F.col("path").rlike(r"/\.[^/]"))
