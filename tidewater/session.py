"""Session construction and shared-folder helpers.

Library code never creates its own session: every operator takes DataFrames.
``build_session`` is for tests, the bench and local runs; on a cluster the
caller's session (and its ``spark.checkpoint.dir``) is used as is.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around. AQE re-plans shuffles at run
# time (coalescing small partitions, splitting skewed join partitions);
# sessions are merged map-side before the shuffle; time is UTC.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local/test session with the library's defaults.

    ``spark.checkpoint.dir`` is only given a scratch folder when nothing set
    it (a local run); a cluster session keeps its shared folder.
    """
    master = master or os.environ.get("TIDEWATER_MASTER", "local[*]")
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if master.startswith("local"):
        # single-machine runs: keep the driver on loopback, size its heap
        conf["spark.driver.host"] = "127.0.0.1"
        conf["spark.driver.bindAddress"] = "127.0.0.1"
        conf["spark.driver.memory"] = os.environ.get("TIDEWATER_DRIVER_MEMORY", "16g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without one gets a fresh scratch folder; on a
    cluster a missing setting is an error rather than a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at the cluster's shared folder")
    path = tempfile.mkdtemp(prefix="tidewater-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (stream checkpoints, cut tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])
