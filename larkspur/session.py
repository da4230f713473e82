"""Session helpers.

Everything here is configuration only: the library never assumes a local
filesystem on a cluster.  ``checkpoint_root`` reads ``spark.checkpoint.dir``
from the session and only falls back to a caller-provided folder (tests).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python stateful workers talk to the JVM over a unix socket, not TCP.
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "larkspur",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for checkpoints / lineage cuts.

    Uses ``spark.checkpoint.dir`` when the cluster names one; a fallback is
    only honoured when the setting is unset (local tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
    # core conf cannot be set on a live session; register the folder for
    # Dataset.checkpoint() instead.
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback.rstrip("/")
