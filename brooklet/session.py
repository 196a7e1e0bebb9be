"""Session helpers: where shared files go, and the settings used in tests and benches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A folder of our own is used only on a local master where the setting is absent.
    """
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="brooklet-")
    return _local_dir


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, so that no run ever sees the output of an earlier one."""
    return f"{shared_dir(spark)}/brooklet/{name}-{uuid.uuid4().hex}"


def local_session(app: str, cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and benches; on a cluster the submitter's own settings apply."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
