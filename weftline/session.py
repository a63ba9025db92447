"""Sessions: a local one for tests and benches, and what any session needs."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


#: Rows and bytes of a batch that goes to a Python worker: long texts come in
#: few at a time.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
#: For Python workers: memory of large arrays goes back to the system when they end
#: (idle workers would keep it otherwise), that of small ones is used again.
WORKERS = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(8 << 20)}


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where it is installed at the same
    place on every machine; elsewhere submit it with --py-files."""
    environment = getattr(spark.sparkContext, "environment", None)
    if environment is not None and ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, environment.get("PYTHONPATH", "")) if x)
    return spark


def bound_workers(spark: SparkSession) -> SparkSession:
    """prepare(), and less memory for Python workers: for runs of many steps, whose
    idle workers add up. Settings that the session was started with stay."""
    environment = getattr(prepare(spark).sparkContext, "environment", None)
    for name, value in WORKERS.items() if environment is not None else ():
        environment.setdefault(name, value)
    own = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for name, value in BATCH.items():
        if name not in own:
            spark.conf.set(name, value)
    return spark


def need(module: str, hint: str = "") -> None:
    """Fail on the driver, before a job starts, where a model's library is missing."""
    import importlib.util

    if importlib.util.find_spec(module) is None:
        raise RuntimeError(f"{module} is not installed" + (f": {hint}" if hint else ""))


def session() -> SparkSession:
    """The session that is active, or that spark-submit or the configuration
    describes; a local one only where nothing names a master."""
    if SparkSession.getActiveSession() or "PYSPARK_GATEWAY_PORT" in os.environ or os.environ.get("SPARK_CONF_DIR") or os.environ.get("SPARK_REMOTE"):
        return prepare(SparkSession.builder.appName("weftline").getOrCreate())
    return local_session()


def local_session(cpus: int = 8, memory: str = "8g", partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("weftline")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
