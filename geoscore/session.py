"""Session construction and the shared work folder.

Cluster runs name a shared folder in ``spark.checkpoint.dir``; every
lineage cut (checkpoint or written intermediate table) and every model
artifact goes below it. Only when the setting is absent (tests, local
bench) do we pick a fresh scratch folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings that matter at scale: AQE re-plans joins from runtime
# sizes, coalesces small shuffle partitions and splits skewed ones.
_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "geoscore", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the settings above."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, *parts: str) -> str:
    """Shared folder for lineage cuts and artifacts.

    Reads ``spark.checkpoint.dir`` from the session. If unset (local tests),
    a fresh folder is created and registered with
    ``SparkContext.setCheckpointDir``, so that ``DataFrame.checkpoint()`` and
    this function agree.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="geoscore-ckpt-")
        sc.setCheckpointDir(base)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    if parts:
        return os.path.join(base, *parts)
    return base


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new, unused path below the work folder."""
    return work_dir(spark, kind, uuid.uuid4().hex)


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Used where one intermediate result feeds several later steps (global
    statistics, candidate cells, training tables): later steps scan the
    written table instead of recomputing its lineage, and a lost executor
    costs a re-read, not a recomputation."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20,
               shuffle_fraction: float = 0.25) -> dict:
    """SQL settings sized from the input volume, so shuffle partitions fit in
    executor memory without spilling much: about ``partition_bytes`` per
    shuffle partition for the part of the input that is shuffled (after
    projection and partial aggregation, ``shuffle_fraction`` of it), AQE
    coalescing towards the same size and splitting partitions 4x larger,
    scans split into ``partition_bytes`` chunks, and stats-based broadcast of
    sides up to 64 MB (size bound checked by the planner)."""
    shuffled = max(1, int(input_bytes * shuffle_fraction))
    parts = max(200, -(-shuffled // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, **kw) -> dict:
    """Set :func:`scale_conf` on a running session (all are runtime SQL confs)."""
    conf = scale_conf(input_bytes, **kw)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
