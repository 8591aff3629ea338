"""Makes this package importable in the Python workers of any cluster."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import sensorlake

_shipped: set[str] = set()
_sent: set[tuple[str, str]] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    home = os.path.dirname(os.path.abspath(sensorlake.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="sensorlake-"), "sensorlake_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("sensorlake", os.path.relpath(path, home)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def send(spark: SparkSession, path: str) -> str:
    """Send a file to the executors, once for each application; its name for ``SparkFiles.get``.

    The name holds a digest of the content, so different files never meet.
    """
    with open(path, "rb") as f:
        raw = f.read()
    name = hashlib.sha256(raw).hexdigest()[:24] + os.path.splitext(path)[1]
    sc = spark.sparkContext
    if (sc.applicationId, name) not in _sent:
        copy = os.path.join(tempfile.mkdtemp(prefix="sensorlake-"), name)
        with open(copy, "wb") as f:
            f.write(raw)
        sc.addFile(copy)
        _sent.add((sc.applicationId, name))
    return name
