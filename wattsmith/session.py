"""Session settings the feature build relies on.

Library functions never create a session; they take the caller's. ``get_session``
is for tests, the bench and scripts: it applies the settings below only where the
caller has not set them already.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package is written against.
#  * UTC + TIMESTAMP_NTZ keep hour shifts pure wall-clock arithmetic.
#  * AQE re-plans joins from measured stage sizes: a weather mean or client snapshot
#    that turns out small is broadcast, one that does not stays a sort-merge join.
#  * The feature frame is ~170 columns wide; codegen.maxFields must exceed that or
#    whole-stage codegen switches off for the last stages.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.maxFields": "400",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Folds of a cross-validation are fitted at once, each in a pool of its own.
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "wattsmith") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("WATTSMITH_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none and runs in local mode (tests) do we make one
    under the local temp folder; a cluster session without one is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        # A machine-local folder is invisible to the other executors.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                           "for cluster runs")
    path = tempfile.mkdtemp(prefix="wattsmith-ckpt-")
    sc.setCheckpointDir(path)
    return path
