"""Where shared files go."""

import os
from unittest.mock import MagicMock

import pytest

from cartstream import session as own
from cartstream.session import new_run_dir, remove_run_dirs, shared_dir


def session(**settings):
    spark = MagicMock()
    spark.conf.get.side_effect = lambda name, default=None: settings.get(
        name.removeprefix("spark.").replace(".", "_"), default
    )
    return spark


def test_the_cluster_names_the_folder():
    spark = session(master="spark://host:7077", checkpoint_dir="hdfs://shared/ck/")
    assert shared_dir(spark) == "hdfs://shared/ck"
    first, second = new_run_dir(spark, "run"), new_run_dir(spark, "run")
    assert first.startswith("hdfs://shared/ck/cartstream/run-") and first != second


def test_a_local_session_gets_its_own():
    spark = session(master="local[8]")
    assert shared_dir(spark) == shared_dir(spark) != ""


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session(master=master))


def test_the_setting_is_read_from_a_real_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_run_folders_can_be_removed(spark, monkeypatch):
    other = session(master="spark://host:7077", checkpoint_dir="hdfs://shared/ck/")
    monkeypatch.setattr(own, "_made", [])
    new_run_dir(other, "of another session")
    gone = new_run_dir(spark, "gone")
    spark.range(1).write.parquet(gone)
    remove_run_dirs(spark)
    assert not os.path.exists(gone) and len(own._made) == 1
