"""Continuous forms: a file stream that is folded into an append-only ledger, and a latched reminder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_new(spark: SparkSession, source: str, schema: str, keys: list[str], target: str, checkpoint: str) -> StreamingQuery:
    """Files of source, as they come, into target without rows whose keys it has. Replayed batches add nothing."""

    def write(batch: DataFrame, _: int) -> None:
        fresh = batch.dropDuplicates(keys)
        try:
            fresh = fresh.join(spark.read.parquet(target).select(*keys), keys, "left_anti")
        except Exception as e:  # the first batch has no target yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        fresh.write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latched(events: DataFrame, threshold: int, gap_s: int) -> DataFrame:
    """ts, failing of the notices due: failures reach the threshold, and the last notice is gap_s old; one fold per key in JVM arrays."""
    first = F.struct(F.lit(0).alias("n"), F.lit(-(1 << 40)).cast("long").alias("last"), F.array().cast("array<long>").alias("sent"))

    def step(s, e):
        n = F.greatest(s["n"] + F.when(e["failed"], 1).otherwise(-1), F.lit(0))
        due = (n >= threshold) & (e["at"] - s["last"] >= gap_s)
        return F.struct(n.alias("n"), F.when(due, e["at"]).otherwise(s["last"]).alias("last"), F.when(due, F.concat(s["sent"], F.array(e["at"]))).otherwise(s["sent"]).alias("sent"))

    grouped = events.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(F.col("at").cast("long").alias("at"), "failed"))).alias("e"))
    return grouped.select("key", F.explode(F.aggregate("e", first, step, lambda s: s["sent"])).alias("at"))
