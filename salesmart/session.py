"""SparkSession for tests, the bench and command-line use.

On a cluster the session comes from the platform; this only fills in
what is unset. The checkpoint directory is read from the session
(``spark.checkpoint.dir``, a shared folder on a cluster) and only set to
a fresh local folder when nothing is configured, as in tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "salesmart", extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder (shared storage on a cluster).

    Only a local-mode session (tests, a laptop) gets a fresh local folder
    when none is configured; on a cluster a machine-local folder would be
    invisible to the other executors, so an unset setting is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on storage shared by the cluster")
        d = tempfile.mkdtemp(prefix="salesmart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint dir (shared storage on a cluster)."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def scale_settings(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for a given input volume and cluster.

    * scan splits and post-shuffle partitions of ``partition_bytes``
      (default 256 MiB: fits an executor core's share of memory with room
      for sort / hash-aggregate buffers, and makes fact files of that size);
    * initial shuffle partitions = input / partition size, at least 3 per
      core, so the largest shuffle (the order lines) never needs spills of
      multi-GB partitions; AQE coalesces the smaller shuffles down;
    * a partition is skewed above 4 × the median and 2 × the target size,
      and is then split to the target size.

    e.g. 100 TB on 1000 executors × 8 cores → 400k shuffle partitions.
    """
    parts = max(3 * total_cores, -(-input_bytes // partition_bytes))
    size = f"{partition_bytes // (1 << 20)}m"
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * partition_bytes // (1 << 20)}m",
    }


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package.

    They can where it is on their path (installed, PYTHONPATH, or local
    mode started from its folder); else Spark sends them an archive, once a session.
    """
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc = spark.sparkContext
    path = sc._jvm.System.getenv("PYTHONPATH") or ""
    if root in map(os.path.abspath, filter(None, path.split(":"))) or (sc.master.startswith("local") and os.getcwd() == root):
        return
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        base = os.path.join(tempfile.mkdtemp(prefix="salesmart-package-"), "salesmart")
        sc.addPyFile(shutil.make_archive(base, "zip", root, "salesmart"))


_SHIPPED: set[str] = set()
