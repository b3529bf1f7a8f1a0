"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session. ANSI stays on (the default): overflow and
# division by zero raise instead of giving wrong numbers.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Up to so many rows per group, tasks cut to the first k before the shuffle of a ranking window.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    # Streaming state lives on disk instead of the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the engine relies on to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return configure(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("perennia")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        # Naming the Python line of every column expression doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def cut(rows: DataFrame) -> DataFrame:
    """The same rows, stored below the shared checkpoint folder, without their lineage."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(rows.sparkSession, "checkpoints"))
    return rows.checkpoint()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder that `spark.checkpoint.dir` names.

    Only a local session may do without that setting; it then gets a temporary folder. On a
    cluster a machine-local folder would be lost with its executor, so there we refuse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="perennia-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
