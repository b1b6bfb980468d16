"""Session settings and the two cluster-wide rules every operator follows.

* Lineage is cut only into the shared folder named by ``spark.checkpoint.dir``; a machine-local
  folder is chosen only for a ``local[...]`` master where that setting is unset (tests, bench).
* No join side is marked for broadcast: AQE measures each side at run time, broadcasts the small
  ones and uses a sort-merge join, whose skewed keys it splits, for the others.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the join's partitioning would otherwise be reused
    # by the aggregation above it (e.g. clicks joined on user_id, then counted per user): the
    # extra shuffle costs less than one task holding a user with a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # AQE merges small shuffle outputs up to this size; the default (1 MB) turns a stage of a few
    # hundred KB that expands its rows (the 60-window trend) into a single task.  Large stages
    # are sized by spark.sql.shuffle.partitions and the advisory size as before.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.ui.enabled": "false",
    # PySpark records the Python call site of every column function for error messages, at the
    # price of several JVM round trips per call (tens of milliseconds of driver time per query).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "visitflow",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the library assumes (UTC, AQE, no UI)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or an earlier ``setCheckpointDir``).  Only a
    local master without that setting gets a fresh folder of its own; on a cluster the setting is
    required, because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="visitflow-ckpt-"))
    return sc.getCheckpointDir()

