"""Session helpers.

Library code never changes session configuration. ``local_session`` builds a
session for tests, the bench and the command line; ``shared_dir`` finds the
folder that all machines of a cluster share.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "chatscope",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """A local session configured like a small cluster (AQE on, UI off).

    ``checkpoint_dir`` names the folder for checkpoints and written tables; a
    fresh temporary folder by default (all "machines" are this one).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # HotSpot does not JIT methods over 8000 bytecodes; past that, whole-stage
        # codegen runs interpreted and is slower than the expression fallback
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", os.environ.get("CHATSCOPE_DRIVER_MEMORY", "8g"))
        # the driver tables are one-file tables: a scan of one would be a single task
        .config("spark.chatscope.fixture.partitions", str(os.cpu_count() if cores == "*" else cores))
        .config("spark.checkpoint.dir", checkpoint_dir or tempfile.mkdtemp(prefix="chatscope-ckpt-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder shared by all machines, for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir``, else from the directory registered with
    ``SparkContext.setCheckpointDir``. Where neither is set, a session whose
    master is ``local`` gets a temporary folder; on a cluster that would be a
    different folder on every machine, so it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    sc = spark.sparkContext
    registered = sc._jsc.sc().getCheckpointDir()
    if registered.isDefined():
        return registered.get().rstrip("/")
    if sc.master == "local" or sc.master.startswith("local["):
        return _LOCAL_DIRS.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="chatscope-ckpt-"))
    raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def parallelism(spark: SparkSession) -> int:
    """Total task slots (falls back to the shuffle width where no SparkContext is exposed)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def plan_bytes(df: DataFrame) -> int:
    """The plan's size estimate; 0 where it is unknown (such a plan reports the largest long)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 62 else 0


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared folder for written intermediate tables."""
    return f"{shared_dir(spark)}/{name}"


_WRITTEN: list[str] = []


def release_tables(spark: SparkSession) -> int:
    """Delete the intermediate tables that this process has written; results that still read them must be done.

    Returns how many there were.
    """
    jvm, n = spark.sparkContext._jvm, len(_WRITTEN)
    while _WRITTEN:
        p = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return n


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a written table in the shared folder.

    For results that several branches of one plan must see identically (an
    exchange that is executed twice may sample and order its input
    differently). The data is computed once, written as Parquet under the
    shared folder (so it survives executor loss) and read back. ``release_tables``
    removes the tables that this process has written.
    """
    path = scratch_path(df.sparkSession, f"tables/{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
