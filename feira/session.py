"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs count on. Adaptive execution re-plans joins from measured sizes,
# merges small shuffle partitions and splits skewed ones, so one build of the code
# serves a laptop sample and a cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", app: str = "feira", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_test_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it."""
    global _test_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if _test_folder is None:
        _test_folder = tempfile.mkdtemp(prefix="run-")
    return _test_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one run inside the shared folder."""
    return f"{shared_folder(spark)}/feira/{name}-{uuid.uuid4().hex}"
