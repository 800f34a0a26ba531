"""Session construction and the shared work folder.

Library code never picks a machine-local folder on a cluster: the shared
folder comes from ``spark.checkpoint.dir`` as the cluster sets it. Only a
local-mode session (tests, bench) without that setting gets a fresh
temporary folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Settings every fieldbook session should carry. AQE re-plans joins at run
#: time (broadcast when a shuffled side turns out small, skew splits for
#: inner/left/anti joins, partition coalescing); UTC and ANSI make results
#: independent of the machine.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def shuffle_partitions_for(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024,
                           minimum: int = 200) -> int:
    """Initial shuffle partition count so one partition holds ~``partition_bytes``.

    The joins and aggregates here shuffle at most about the size of their
    inputs, so sizing from the input keeps every shuffle partition well
    inside executor memory (no spill storms) at any scale; AQE then
    coalesces the partitions that turn out small. For 100 TB of input this
    gives about 400k partitions.
    """
    return max(minimum, -(-int(input_bytes) // int(partition_bytes)))


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fieldbook", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the fieldbook defaults.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster the
    launcher supplies the master and the partition count should follow the
    data size (AQE coalesces small partitions either way).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("FIELDBOOK_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder for versioned outputs and landed files.

    Reads ``spark.checkpoint.dir`` from the session. When it is unset and the
    session is local, a new temporary folder is created and registered as the
    checkpoint folder; on a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before publishing")
    root = tempfile.mkdtemp(prefix="fieldbook-")
    sc.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root
