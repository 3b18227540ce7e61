"""Executors need the package's modules for Arrow functions: ship them with the session.

``spark-submit --py-files`` or a wheel installed on every node does the same; this
is for a session that runs already, or was started outside the repository.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from weakref import WeakSet

from pyspark.sql import SparkSession

_SHIPPED: WeakSet = WeakSet()


def package_zip(folder: str | None = None) -> str:
    """A zip of the package's Python files, in a folder of its own on the driver."""
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(folder or tempfile.mkdtemp(prefix="settlebook-ship-"), "settlebook.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for top, folders, names in os.walk(root):
            folders[:] = sorted(f for f in folders if f != "__pycache__")
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.join("settlebook", os.path.relpath(full, root)))
    return path


def ship(spark: SparkSession) -> None:
    """Let the session's executors import ``settlebook``, wherever they run; once per session."""
    if spark not in _SHIPPED:
        spark.sparkContext.addPyFile(package_zip())
        _SHIPPED.add(spark)
