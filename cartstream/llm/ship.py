"""The package for the Python workers of a session, and how much they take at once."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import SparkSession

import cartstream
from cartstream.session import new_run_dir


# Bytes of rows that Spark sends to a Python worker at once. A batch is there twice in
# the executor and up to twice in the worker, for each core; rows of word numbers are
# some megabytes, so a number of rows bounds nothing.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Send BATCH_BYTES at a time, unless the session says how many."""
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def _archive() -> bytes:
    root = Path(cartstream.__file__).parent
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    return target.getvalue()


# Sessions that have it.
_served: set[SparkContext] = set()


def ship_package(spark: SparkSession) -> None:
    """What `--py-files` does, for sessions started without it: once per session
    the package goes to the shared folder, and from there to the workers.

    Operators whose tasks run Python need it there; call this once before them, or
    start the session with `--py-files`. A package that was itself loaded from an
    archive has come that way already: nothing is shipped. Batches are bounded in
    either case.
    """
    bound_batches(spark)
    context = spark.sparkContext
    if context in _served or not Path(cartstream.__file__).is_file():
        return
    path = context._jvm.org.apache.hadoop.fs.Path(new_run_dir(spark, "package"), "cartstream.zip")
    file = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    file.write(_archive())
    file.close()
    context.addPyFile(path.toString())
    _served.add(context)
