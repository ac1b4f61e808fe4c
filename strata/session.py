"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every strata session wants; the cluster may already set them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    # Noting the Python call site of every Column operation takes several times as long as the
    # operation; errors still name the SQL fragment.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "strata",
                  extra: dict | None = None) -> SparkSession:
    """A local-mode session (tests, bench). On a cluster use the session you are given."""
    # folders are listed by a few tasks: one task per folder costs more than the listing
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
               .config("spark.driver.memory", "8g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none and runs in local mode (tests) is a private
    temporary folder created and registered; on a cluster a missing setting is
    an error, never a silent fallback to a machine-local disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: name a folder on shared storage")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")  # local mode (tests) only
        if _conf_settable(spark):
            spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _conf_settable(spark: SparkSession) -> bool:
    try:
        return spark.conf.isModifiable("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - older sessions lack the key
        return False


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, total_cores: int, advisory_mb: int = 256) -> dict[str, str]:
    """Shuffle sizing for a job over ``input_bytes`` on ``total_cores`` executor cores.

    Adaptive execution can coalesce shuffle partitions but never split them (skew
    aside), so the *initial* count must be large enough for the biggest shuffle
    (a full-row de-duplication moves about the whole input): one partition per
    ``advisory_mb`` of input, at least two waves of tasks. AQE then merges the small ones after aggregations.
    """
    advisory = advisory_mb * 1024 * 1024
    initial = max(2 * total_cores, -(-input_bytes // advisory))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{advisory_mb * 4}m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(2 * total_cores),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL options (those a running session accepts)."""
    for k, v in conf.items():
        spark.conf.set(k, v)
