"""Session helpers for tests, the bench and local runs.

On a cluster the session comes from the platform; these helpers only fill in
settings that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the plans are designed for (AQE re-plans shuffles at run time,
# splits skewed join partitions and coalesces small ones).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cores: int | str = 8,
    shuffle_partitions: int | None = None,
    app: str = "spanpack",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session (tests, bench). The Spark UI stays off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """For local runs only (tests, bench): the session's checkpoint folder,
    or a fresh temporary one when none is configured. Library code never
    calls this; on a cluster ``spark.checkpoint.dir`` names a shared folder
    and :mod:`spanpack.plans.jobs` uses only that."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    path = fallback or tempfile.mkdtemp(prefix="spanpack-ckpt-")
    sc.setCheckpointDir(path)
    return path
