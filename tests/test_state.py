import os

import pytest
from pyspark.sql import functions as F

from strata.sources import state, versioned
from strata.session import ensure_checkpoint_dir


def _spoil(path):
    os.makedirs(path, exist_ok=True)
    for name in list(os.listdir(path)):
        if name.endswith(".json") or name.endswith(".crc"):
            os.unlink(f"{path}/{name}")
    with open(f"{path}/part-0.json", "w") as f:
        f.write("\x00 not json")


def test_missing_state_is_none_and_unreadable_state_raises(spark, tmp_dir):
    path = f"{tmp_dir}/mark"
    assert state.read_mark(spark, path) is None and state.last_epoch(spark, path, "s") is None
    state.save_mark(spark, path, spark.range(1).select(F.lit("2020-01-01").alias("m")), stream="s", epoch=4)
    assert state.read_mark(spark, path) == "2020-01-01" and state.last_epoch(spark, path, "s") == 4
    _spoil(path)
    with pytest.raises(Exception):
        state.read_mark(spark, path)
    with pytest.raises(Exception):
        state.last_epoch(spark, path, "s")


def test_unreadable_pointer_raises_and_keeps_versions(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    assert versioned.read_current(spark, base) is None
    versioned.write_version(spark.range(3), base)
    assert versioned.read_current(spark, base).count() == 3
    _spoil(f"{base}/{versioned.POINTER}")
    with pytest.raises(Exception):
        versioned.read_current(spark, base)
    assert len([d for d in os.listdir(base) if d.startswith("v_")]) == 1


class _Cluster:
    """A session on a cluster whose checkpoint folder is unset."""

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_cluster_without_shared_folder_raises():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Cluster)
