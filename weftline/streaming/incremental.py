"""Incremental runs: only what a target doesn't hold yet is added to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..tables import exists


def append_new(batch: DataFrame, target: str, keys: list[str], order: str | None = None) -> int:
    """Append the batch's rows with new keys to a Parquet target; the number added.
    Of rows that share a key the first by ``order`` counts."""
    spark = batch.sparkSession
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order or keys[0]))
    rows = batch.withColumn("__n", rank).where("__n = 1").drop("__n")
    if exists(spark, target):
        rows = rows.join(spark.read.parquet(target).select(*keys), keys, "left_anti")
    rows = rows.persist()
    added = rows.count()
    if added:
        rows.write.mode("append").parquet(target)
    rows.unpersist()
    return added


class _FirstOfKey(StatefulProcessor):
    """The first row of a key that has none yet, and none of one that has."""

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues):
        first = min(rows, key=lambda r: [(r[c] is None, r[c]) for c in self.order])
        if not self.seen.exists():
            self.seen.update((True,))
            yield first

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((True,))

    def close(self) -> None:
        pass


def append_stream(stream: DataFrame, target: str, checkpoint: str, keys: list[str], order: list[str], name: str = "batch") -> DataFrame:
    """Append a stream's rows to a target, each key once, ever; all that it holds.

    Which keys it has is state in a RocksDB store beside the checkpoint, looked up
    key by key, so that a batch costs what it holds and not what the target does.
    The first start fills the state with the keys that the target has by then. A
    batch is a folder, ``target/name=number``, which a repeated batch replaces. Of
    rows that share a key in a batch the first by ``order`` counts, nulls last."""
    spark = stream.sparkSession
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    old = appended(spark, target, stream.schema) if exists(spark, target) else None
    had = old.select(*keys).distinct().groupBy(*keys) if old is not None and not exists(spark, f"{checkpoint}/commits") else None
    new = stream.groupBy(*keys).transformWithState(_FirstOfKey(order), outputStructType=stream.schema, outputMode="append", timeMode="none", initialState=had)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/{name}={number:09d}")

    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        new.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(provider, before) if before else spark.conf.unset(provider)
    return appended(spark, target, stream.schema)


def appended(spark: SparkSession, target: str, schema) -> DataFrame:
    """The rows of all batches of a target."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(target)


def run_incremental(spark: SparkSession, source: str, schema, target: str, checkpoint: str, keys: list[str], order: str | None = None, files_per_batch: int = 1, kind: str = "parquet"):
    """Stream the files of a folder into the target, each key once. The
    checkpoint resumes where a run stopped; a repeated batch adds nothing."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(kind).load(source)
    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: append_new(df, target, keys, order) and None).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(target)


def unique_stream(stream: DataFrame, keys: list[str], event_time: str | None = None, late: str = "1 day") -> DataFrame:
    """The first row of each key. With an event time, state older than ``late``
    is dropped; without one, it grows with the number of keys."""
    if event_time:
        return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def tumbling_counts(events: DataFrame, width: str = "1 hour", late: str = "1 hour", time: str = "ts", key: str = "event_type") -> DataFrame:
    """Events and their sum per window and type. An extension."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), key, "n", "total")
