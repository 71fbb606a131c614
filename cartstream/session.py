"""The shared folder for checkpoints and landed tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark import SparkContext
from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


_made: list[tuple[SparkContext, str]] = []


@cache
def _test_dir() -> str:
    folder = tempfile.mkdtemp(prefix="cartstream-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local session without the setting (tests) gets a folder of its own; a
    cluster session without it is refused, since a machine-local folder would
    be lost with its executor.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return _test_dir()


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A folder of its own for one table between jobs; see `remove_run_dirs`."""
    folder = f"{shared_dir(spark)}/cartstream/{label}-{uuid.uuid4().hex}"
    _made.append((spark.sparkContext, folder))
    return folder


def remove_run_dirs(spark: SparkSession) -> None:
    """Delete the session's run folders, when no frame reads them any more."""
    conf = spark._jsc.hadoopConfiguration()
    for context, folder in [made for made in _made if made[0] is spark.sparkContext]:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
        _made.remove((context, folder))
