"""Session helpers: recommended settings, the shared checkpoint folder and scratch paths.

The library never creates a session for the caller's jobs; ``local_session`` exists for tests,
the bench and the driver entry only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are designed around.  AQE re-plans joins at run time (broadcast when a side
# turns out small, skew-split of oversized shuffle partitions, coalescing of small ones).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def sizing(largest_table_bytes: int, shuffle_bytes: int | None = None, target_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run, from the data size: partitions of about ``target_bytes``.

    * ``spark.sql.shuffle.partitions`` / AQE's initial number: the biggest shuffle over the target size
      (AQE then coalesces small ones and splits skewed ones);
    * ``spark.sql.files.maxPartitionBytes``: the scan split size;
    * ``graph_buckets``: a bucket count for ``GraphStore(buckets=...)`` so one bucket of the largest label
      is about the target size (rounded up to a power of two; keep it fixed for a label's life).
    """
    shuffle_bytes = shuffle_bytes or largest_table_bytes
    parts = max(8, -(-shuffle_bytes // target_bytes))
    buckets = 1
    while buckets * target_bytes < largest_table_bytes:
        buckets *= 2
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "graph_buckets": str(buckets),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "graphmill") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir``).  Only a local-mode session (tests, bench) without the
    setting gets a fresh folder under the system temp dir; a cluster session without it is an error, since
    a machine-local folder is not visible to other executors and does not survive their loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        configured = tempfile.mkdtemp(prefix="graphmill-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder (nothing is written yet)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
