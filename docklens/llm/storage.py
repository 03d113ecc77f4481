"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, SparkSession] = {}


def shared_root(spark: SparkSession) -> str:
    """This session's folder below ``spark.checkpoint.dir``.

    Only a local session that names no folder (a test) gets one of this machine.
    The folder is removed when the Python process of the driver ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = os.path.join(tempfile.gettempdir(), "docklens-llm")
    root = f"{folder.rstrip('/')}/llm-{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        if not _ROOTS:
            atexit.register(_remove_all)
        _ROOTS[root] = spark
    return root


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; nothing is created there yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read again: later steps start from the files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Remove a table made by ``stored`` that nothing reads any more."""
    for file in {os.path.dirname(f) for f in df.inputFiles()}:
        _delete(df.sparkSession, file)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _remove_all() -> None:
    for root, spark in _ROOTS.items():
        try:
            _delete(spark, root)
        except Exception:  # the session has ended before
            pass
