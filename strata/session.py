"""Session construction and the shared scratch / checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC day boundaries (trap T7), ANSI casts, AQE.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(CORE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "16g",
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
        # local disk only: skip the .crc side file written next to every file
        "spark.hadoop.fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
        "spark.hadoop.fs.file.impl.disable.cache": "true",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must come from the deployment (a shared
    filesystem every executor sees).  Only a local-mode session without the
    setting gets a fresh folder under the system temp dir, as in tests.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


GIB = 1024 ** 3


def cluster_conf(input_bytes: int, total_cores: int, shuffle_partition_bytes: int = GIB // 2,
                 split_bytes: int = 256 * 1024 ** 2,
                 max_partitions: int | None = 200_000) -> dict[str, str]:
    """Settings for a large cluster, to apply when the session is built.

    * scan splits of ``split_bytes`` (parquet row groups are read in parallel
      within a file);
    * the first shuffle of a job starts with enough partitions that each holds
      about ``shuffle_partition_bytes`` of the *input* (an upper bound of
      what a pre-aggregated shuffle carries), never fewer than two per core,
      and AQE coalesces what turns out smaller;
    * AQE splits skewed shuffle partitions of joins at five times the median.
    """
    parts = max(2 * total_cores, -(-input_bytes // shuffle_partition_bytes))
    if max_partitions is not None:  # scheduling cost; raise it together with the input
        parts = min(parts, max_partitions)
    conf = dict(CORE_CONF)
    conf.update({
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 ** 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    })
    return conf
