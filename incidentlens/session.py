"""Session settings the reports rely on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a session running the reports should carry: AQE with skew-join splitting, and runtime
# filters. The job and the benchmark set them; library calls leave the session as it is.
REPORT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the keys of a report (one month, one school) reach the scans of details and participations as
    # a bloom filter, so rows of other incidents are not shuffled; by default only scans over 10 GB
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
}


# Partition sizing for very large inputs (tens to hundreds of TB). AQE starts every shuffle
# with many partitions and coalesces them toward 256 MB, so no task holds more than it can
# sort without heavy spilling and small reports do not end up with thousands of tiny tasks;
# file splits match that size; a partition counts as skewed from 1 GB.
LARGE_INPUT_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32768",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
}


def apply_large_input_conf(spark: SparkSession) -> None:
    for key, value in LARGE_INPUT_CONF.items():
        spark.conf.set(key, value)


def build_session(master: str = "local[*]", app: str = "incidentlens", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session for tests and local benchmarks. On a cluster, use the cluster's session and
    only make sure ``REPORT_CONF`` is applied (``apply_report_conf``)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for key, value in {**REPORT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if _context(spark) is not None:
        _context(spark).setLogLevel("ERROR")
    apply_report_conf(spark)
    return spark


def apply_report_conf(spark: SparkSession) -> None:
    for key, value in REPORT_CONF.items():
        spark.conf.set(key, value)


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach; it is read, never
    replaced. Unset, it raises, except on a local master (tests), where driver and executors
    are one process: there a fresh scratch folder is created and set.
    """
    sc = _context(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="incidentlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured
