"""The session's shared checkpoint folder (``spark.checkpoint.dir``).

Library code only ever uses the folder the cluster configures; it never
invents a local one (tests and the bench set theirs through
:func:`spanpack.session.local_session`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        folder = spark.sparkContext.getCheckpointDir()
        if folder is None and spark.conf.get("spark.checkpoint.dir", None):
            folder = spark.conf.get("spark.checkpoint.dir")
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    except Exception:  # no SparkContext in the client (Spark Connect): the conf is all there is
        return spark.conf.get("spark.checkpoint.dir", None)


def reliable_checkpoint(df: DataFrame) -> DataFrame | None:
    """``df.checkpoint(eager=True)`` into the shared folder, or None when the
    session has none."""
    if checkpoint_dir(df.sparkSession) is None:
        return None
    return df.checkpoint(eager=True)
