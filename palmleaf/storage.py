"""Tables in the shared checkpoint folder, which cut the lineage of iterative operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df as a reliable checkpoint in the folder of spark.checkpoint.dir; on one machine a folder is made where none is named."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="palmleaf-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
