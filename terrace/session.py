"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "terrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators were designed for.

    Adaptive execution does the size-checked broadcasts, splits skewed join partitions
    and coalesces small ones, so no operator fixes a partition count or a join strategy.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split skewed partitions even where the next step then needs one more shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Call sites are only wanted in error messages and cost much when plans are built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    A session without that setting, as in tests, gets one beside its warehouse, which the session
    names as well; a warehouse without a scheme must be reachable by all executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    current = sc.getCheckpointDir()
    if current is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        sc.setCheckpointDir(f"{warehouse}/_terrace-{uuid.uuid4().hex}")
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return os.path.join(shared_root(spark), f"{purpose}-{uuid.uuid4().hex}")


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if it isn't there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def reachable_code(spark: SparkSession) -> None:
    """Lets Python workers on this host import the package; a cluster's executors need it installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, have)))


def cut_lineage(df: DataFrame, under: str | None = None) -> DataFrame:
    """The rows as stored under the shared folder: what is read back survives lost executors.

    A written table rather than `checkpoint()`: it is columnar, so later steps read only the
    columns they use, and the plan is computed once. `under` is a folder that its owner removes.
    """
    path = os.path.join(under, uuid.uuid4().hex) if under else new_folder(df.sparkSession, "cut")
    df.write.option("compression", "zstd" if under else "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for rows that are only needed inside the block; afterwards shuffles that nothing uses go, too."""
    folder = new_folder(spark, "scratch")
    try:
        yield folder
    finally:
        remove(spark, folder)
        free_shuffles(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of plans that are done with: it does so when the driver collects them.

    A driver with memory to spare does that rarely, and until then a job of many steps keeps the shuffles of all.
    """
    gc.collect()
    spark._jvm.java.lang.System.gc()


def side_by_side(spark: SparkSession, steps: Sequence[Callable[[], None]], workers: int = 8) -> None:
    """Run steps as concurrent jobs: threads that carry the session's local properties.

    Small tables and fits, which are many short jobs one after the other, fill a cluster only together.
    The first failure is raised after the others have ended.
    """
    with ThreadPool(max(1, min(workers, len(steps)))) as pool:
        done = [pool.apply_async(inheritable_thread_target(spark)(step)) for step in steps]
        for result in done:
            result.wait()
        for result in done:
            result.get()
