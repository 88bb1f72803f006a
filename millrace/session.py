"""Session set-up and the few settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings every plan is written for. Adaptive execution
# picks broadcast joins by measured size, splits skewed join partitions and
# merges small ones, so no operator carries its own broadcast hint.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",  # rows may hold whole texts
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere; memory, core and
    shuffle sizes stay as the cluster set them."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_FOLDERS: dict[str, str] = {}  # application id -> folder, local sessions only


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in
    ``spark.checkpoint.dir``. Only a local master may fall back to /tmp."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_FOLDERS[context.applicationId]
