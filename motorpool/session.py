"""Session settings the jobs rely on, and the shared folder for written state."""

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE picks the partition counts and splits hot join partitions at run time;
# the force flag lets it do so even where that costs a later exchange.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Dimensions this small (as files, of the columns a join needs) stay off the shuffle.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # Data-frame files written with nanosecond datetimes are read as BIGINT nanos.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def build_session(app_name="motorpool", master=None, **extra):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark):
    """Within, the shuffle files of a query are deleted when it ends. By default they stay until the
    driver happens to collect its garbage, so a run of many queries holds those of all of them."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def shared_dir(spark, purpose):
    """A fresh folder under the cluster's shared checkpoint folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = os.path.join(tempfile.gettempdir(), "motorpool")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
