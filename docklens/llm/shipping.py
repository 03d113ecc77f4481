"""The package, sent to the Python workers of the executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import docklens

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """``addPyFile`` this package once a session, so that tasks can import it.

    A cluster started with the package in ``--py-files`` has it already; then this copy is
    the same.
    """
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    _SENT.add(context.applicationId)
    top = os.path.dirname(os.path.abspath(docklens.__file__))
    folder = tempfile.TemporaryDirectory()  # executors that join later fetch it, too
    atexit.register(folder.cleanup)
    path = os.path.join(folder.name, "docklens_package.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for where, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(where, name)
                    packed.write(file, os.path.relpath(file, os.path.dirname(top)))
    context.addPyFile(path)
