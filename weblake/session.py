"""Session construction and the few runtime settings the engine relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings for a session we build ourselves (tests, bench). On a cluster the
# operator's spark-defaults win; `prepare` only pins what results depend on.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app: str = "weblake",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on: times are read and bucketed in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``. Only a local-mode session (tests) may
    fall back to a fresh folder under /tmp; a cluster must name a shared one.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder visible to all executors"
        )
    path = tempfile.mkdtemp(prefix="weblake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
