"""Session settings the jobs count on, and where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .errors import ConfigurationError

CHECKPOINT_KEY = "spark.checkpoint.dir"


def builder(app_name: str = "recallset") -> SparkSession.Builder:
    """A builder with adaptive execution, skew handling and UTC; master and sizes stay the caller's."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster shares for checkpoints.

    Executors and a restarted driver must see the same files, so a machine-local folder is used
    only when Spark itself runs in one process.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
            raise ConfigurationError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="recallset-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(rows: DataFrame) -> DataFrame:
    """Rows written to the checkpoint folder and read back from there, so a lost executor costs nothing."""
    spark = rows.sparkSession
    root = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return rows.checkpoint()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors of a session that was started without it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="recallset-")) / "recallset.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
