"""Shared folders: set by the cluster, local only in local mode, removable."""

import os
from types import SimpleNamespace

import pytest

from touchline.session import ensure_checkpoint_dir, remove_folder, scratch_path


def test_scratch_lies_under_the_checkpoint_folder_and_can_be_removed(spark):
    path = scratch_path(spark, "gone")
    assert path.startswith(ensure_checkpoint_dir(spark))
    spark.range(3).write.parquet(path)
    remove_folder(spark, path)
    assert not os.path.exists(path.replace("file:", ""))


def test_a_cluster_without_a_shared_folder_is_an_error():
    sc = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=sc)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)
