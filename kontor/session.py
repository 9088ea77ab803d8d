"""Session helpers.

Nothing here runs at import time: callers pass a ``SparkSession`` in, or ask
``build_session`` for one (tests, benches, the jobs in ``jobs/``).
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings of the sessions made here: AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "kontor",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally
    pass ``local[N]``. The UI is off: nothing here needs a web server.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return pin_session(builder.getOrCreate())


def pin_session(spark: SparkSession) -> SparkSession:
    """Set the one setting that results depend on: text timestamps are rendered in
    UTC. Raises where the session refuses it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session's ``spark.checkpoint.dir``
    names it; it is the context's checkpoint folder too. Where that is unset, a session
    that runs in this one process gets a scratch folder, any other an error."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc.getCheckpointDir() is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="kontor-shared-"))
    return configured or sc.getCheckpointDir()
