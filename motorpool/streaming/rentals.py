"""Landed rental files absorbed as they arrive."""

from pyspark.sql import types as T

from ..plans.daily import absorb_rentals, extend_fact
from ..schemas import TRANSACTIONS


def stream_rentals(warehouse, folder, checkpoint, dimensions, files_per_batch=1000):
    """Merge the new parquet files of ``folder`` into rentals and fact; returns the ended query.

    Micro-batches only land their rows beside the checkpoint, each in a folder by its number. When
    the trigger has taken all files, the landed rows are absorbed together, in the steps of the daily
    run: against the marks from before the trigger, repeated keys settled over all of its files. So
    ``files_per_batch`` bounds a micro-batch and decides nothing else. A trigger that stops early
    leaves its rows landed; the next one absorbs them with its own. ``dimensions`` are the users,
    vehicles and locations tables.
    """
    spark, landed, absorbed = warehouse.spark, f"{checkpoint}-landed", f"{checkpoint}-absorbed"
    # So that there is a table to read before anything has come.
    spark.createDataFrame([], TRANSACTIONS).write.mode("overwrite").parquet(f"{landed}/batch=-1")
    spark.createDataFrame([(-1,)], "batch bigint").write.mode("append").parquet(absorbed)

    def land(batch, number):
        batch.write.mode("overwrite").parquet(f"{landed}/batch={number}")

    files = (
        spark.readStream.schema(TRANSACTIONS)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )
    query = (
        files.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    done = spark.read.parquet(absorbed).agg({"batch": "max"}).first()[0]
    columns = T.StructType([*TRANSACTIONS.fields, T.StructField("batch", T.LongType())])
    new = spark.read.schema(columns).parquet(landed).where(f"batch > {done}")
    last = new.agg({"batch": "max"}).first()[0]
    if last is not None:
        absorb_rentals(warehouse, new.drop("batch"))
        extend_fact(warehouse, *dimensions)
        # Absorbing the same rows again would change nothing: they are no longer above the mark.
        spark.createDataFrame([(last,)], "batch bigint").write.mode("append").parquet(absorbed)
    return query
