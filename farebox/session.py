"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    # Naive timestamps are handled as they are; UTC keeps every day 24 hours long.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Upper bounds for large input; small input is still divided among the cores. A load writes
    # one file per read split, a rebalanced one per advisory size, so both set the file size.
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # A load task rarely sees more than a couple of months, so it can keep one open file for
    # each and skip the per-task sort Spark would otherwise add before a partitioned write.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "farebox", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above; ``conf`` adds to them or overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder, which every executor must reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session that names none gets a
    temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if configured:
            current = configured
        elif spark.sparkContext.master.startswith("local"):
            current = tempfile.mkdtemp(prefix="farebox-checkpoint-")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        spark.sparkContext.setCheckpointDir(current)
    return configured or current
