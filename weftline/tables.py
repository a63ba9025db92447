"""Tables that end a lineage, for operators that go in rounds, and tables that are
dealt out evenly."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes (as stored) of a table that one task should work on. One row group is read by one
#: task, whatever its size, and becomes many times as large where texts are cut up.
SHARE = 4 << 20

_made: list[tuple[SparkSession, str]] = []


def _remove_made() -> None:
    for spark, path in _made:
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session may have ended before the interpreter
            return


atexit.register(_remove_made)


def work_dir(spark: SparkSession) -> str:
    """The folder that all machines share: spark.checkpoint.dir, or a local one
    where that is unset, in local sessions only."""
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (base or f"file://{tempfile.gettempdir()}/weftline-rounds").rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def settle(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it again, so that a lost executor
    costs no earlier round. The files go when the interpreter ends."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Remove a table that settle() wrote and that no plan reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        for spark, own in list(_made):
            if path.rstrip("/").endswith(own.rsplit("/", 1)[-1]):
                _made.remove((spark, own))
                p = spark._jvm.org.apache.hadoop.fs.Path(own)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def spread(df: DataFrame) -> DataFrame:
    """A table dealt out by rows, to as many partitions as there are cores, and to
    more where it is larger: a task's share doesn't grow with the table, however the
    table lies in files."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // SHARE)))
