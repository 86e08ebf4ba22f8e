"""Reading the tables, sizing the work, and cutting lineage in the shared folder."""

import math
import os
import tempfile
import uuid

from pyspark.sql import functions as F


def read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _folder(spark):
    """The cluster's shared folder; one of this machine only where Spark runs on it alone (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = os.path.join(tempfile.gettempdir(), "motorpool-llm")
    return folder.rstrip("/")


def saved(df):
    """The same rows, checkpointed in the shared folder: later jobs survive lost executors, and
    Spark removes the files after use where it is told to clean checkpoints."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df, purpose):
    """The same rows as a Parquet table in the shared folder, for what later jobs read by column."""
    path = f"{_folder(df.sparkSession)}/{purpose}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(docs, column="text"):
    """Bytes of a text column, at least 1."""
    total = docs.agg(F.sum(F.octet_length(column).cast("bigint"))).first()[0]
    return max(1, total or 0)


def pieces(total, each):
    return max(1, math.ceil(total / each))


def power_of_two(n):
    return 1 << max(0, math.ceil(math.log2(max(1, n))))
