"""Spark session settings the library expects, and where durable scratch data goes."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Fixed settings: wall-clock columns are TIMESTAMP_NTZ, so the session zone only
# matters where Spark itself formats instants; UTC keeps those stable.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Settings of the stateful streaming jobs.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # States are JSON text, on the disk of an executor and once more in the checkpoint.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    # A processing-time stateful query under trigger(availableNow) would otherwise
    # keep planning empty batches and never finish.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def local_session(cores: int | str = 8, app: str = "leaseflow", **conf: str) -> SparkSession:
    """Single-JVM session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", "8")
        # State traffic between the JVM and the Python workers over a socket file.
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    for name, value in {**BASE_CONF, **STREAM_CONF, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _temporary_root() -> str:
    return tempfile.mkdtemp(prefix="leaseflow-")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a session whose executors run
    inside the driver may go without: it gets a temporary folder. Anywhere else machines
    would each write to a disk of their own, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder (master is {master})")
    return _temporary_root()


def side_by_side(spark: SparkSession, actions: Iterable[Callable[[], object]]) -> None:
    """Run Spark actions that don't need each other at the same time, so that the tasks of one
    use the cores that the planning, last tasks and commit of another leave idle.

    All have ended when this returns or raises what the first failed one raised.
    """
    waiting = [inheritable_thread_target(spark)(action) for action in actions]
    with ThreadPoolExecutor(max_workers=max(1, len(waiting))) as pool:
        ended = [pool.submit(action) for action in waiting]
    for action in ended:
        action.result()
