"""Session settings and the shared folder of the running cluster."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cpus: int | str = "*", shared: str | None = None, **settings: str
) -> SparkSession:
    """A single-machine session for tests and the benchmark.

    ``shared`` is the folder for intermediate data; without it a temporary one is
    made and set as ``spark.checkpoint.dir``, and removed when Python ends.
    """
    if shared is None:
        made = tempfile.TemporaryDirectory(prefix="docklens-")
        atexit.register(made.cleanup)
        shared = made.name
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("docklens")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", shared)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A local session that names none (one that others have made) gets a temporary
    folder, which is set as its ``spark.checkpoint.dir`` and removed when Python
    ends; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        made = tempfile.TemporaryDirectory(prefix="docklens-")
        atexit.register(made.cleanup)
        folder = made.name
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_SCRATCH: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created there yet.

    What is written there is removed when the Python process of the driver ends.
    """
    root = f"{shared_folder(spark).rstrip('/')}/docklens-{spark.sparkContext.applicationId}"
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    _SCRATCH[root] = spark
    return f"{root}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of any file system that Spark knows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _remove_scratch() -> None:
    for root, spark in _SCRATCH.items():
        try:
            delete_folder(spark, root)
        except Exception:  # the session has ended; a local folder of ours goes with Python
            pass


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there.

    Used before iterative fits: a lost executor re-reads the written copy
    instead of repeating the joins and windows before it.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
