"""SparkSession settings shared by the library, the tests and the bench.

The library never hard-codes a cluster: it reads what the session already
has and only fills in defaults that are unset (local runs and tests).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every session should carry. AQE re-plans joins at runtime
# (broadcast only when the measured side is small, split skewed
# partitions); UTC keeps timestamp arithmetic free of DST shifts.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only used when given; on a cluster the launcher sets it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; if it is unset there, this raises. With a local master (tests) a
    private scratch folder is created, and removed when the process ends.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("STRATA_SCRATCH", "/tmp"))
    atexit.register(shutil.rmtree, path, ignore_errors=True)  # this process made it
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # some deployments refuse core settings at runtime
        pass
    sc.setCheckpointDir(path)
    return path
