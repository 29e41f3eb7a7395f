"""Session settings the library relies on and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# forceOptimizeSkewedJoin lets adaptive execution split a hot key even where the
# split costs one more exchange (a join followed by a grouping on the same key).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; cluster sizing stays with whoever made the session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, or its warehouse where none is set; both are shared by all executors.

    Off a single machine a warehouse in a local folder is refused: executors would write what others cannot read.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and is_local(root):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {root} is on one machine")
    return root.rstrip("/")


def is_local(path: str) -> bool:
    return path.startswith(("file:", "/"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder path in the application's own folder, which goes when the driver ends."""
    own = f"{shared_root(spark)}/auriga-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex}"
