"""Session helpers: a local test session, and cutting lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


# Whether the shuffle files of a statement go when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", app: str = "landcarbon", memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Plans here have hundreds of small expressions; recording a call site for each would take longer than they do.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Methods beyond this size are never compiled by the JVM; Spark then splits them.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="landcarbon-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def dealt(df: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """Rows dealt by key into a number of parts that follows their number, and into one per core at least.

    Left alone, Spark has as many parts as its settings say and merges small ones, so that tasks grow with the input.
    """
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), *keys)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a result to the shared folder and read on from there, also after executors are lost.

    As a Parquet table, so that a later step reads only the columns it needs. What was shuffled for it is of no more use
    then, so Spark is told to remove it at once rather than when the driver next collects its garbage.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/stage-{uuid.uuid4().hex}"
    for written in _written()[-1:]:
        written.append(path)
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_steps = threading.local()


def _written() -> list[list[str]]:
    """Tables written in each of the ``settled`` steps that are open in this thread, outermost first."""
    if not hasattr(_steps, "open"):
        _steps.open = []
    return _steps.open


def settled(build: Callable[[], DataFrame]) -> DataFrame:
    """Write the result of a step and remove the tables that ``cut_lineage`` wrote on the way to it.

    For steps whose tables are read for this result only. A step that fails leaves its tables.
    """
    _written().append([])
    try:
        done = cut_lineage(build())
    except BaseException:
        _written().pop()
        raise
    *passed, result = _written().pop()
    jvm = done.sparkSession._jvm
    for path in passed:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(done.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
    for outer in _written()[-1:]:
        outer.append(result)
    return done
