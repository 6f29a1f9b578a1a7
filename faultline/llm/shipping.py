"""Sends this package to the Python workers, which need not have it installed."""

from __future__ import annotations

import io
import os
import uuid
import zipfile

from pyspark.sql import SparkSession

from faultline.functions.settle import checkpoint_dir

_SENT: set[str] = set()


def _zipped() -> bytes:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    return held.getvalue()


def send_code(spark: SparkSession) -> None:
    """Adds a zip of the package to the session's Python files, once per application.

    The zip lies in the shared folder, where every executor that joins later finds it.
    """
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{checkpoint_dir(spark)}/package-{uuid.uuid4().hex}.zip")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(path)
    try:
        out.write(bytearray(_zipped()))
    finally:
        out.close()
    context.addPyFile(files.makeQualified(path).toString())
    _SENT.add(context.applicationId)
