"""Session settings, and the folder all executors share."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What the plans here rely on at scale; the rest is the cluster's business.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's partition also where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Size of a shuffled partition, and so of a written file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Above this measured size no side is broadcast.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # Encoded columns unpack to several times their file size.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # Lets a filtered parent thin out the detail scan before its shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256m",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that all executors share: the cluster's
    checkpoint folder, else one below the warehouse directory, which a cluster
    points at shared storage."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared"
    return folder.rstrip("/")
