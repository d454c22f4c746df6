"""Session construction and the shared-storage helpers every job uses.

On a cluster the session is created by the platform; ``build_session``
is for tests, the bench and local runs.  ``shared_dir`` reads the
checkpoint folder the cluster names in ``spark.checkpoint.dir`` and only
falls back to a local temporary folder when Spark runs in local mode.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

# Fixed defaults for local runs (tests, bench).  A cluster sizes these itself.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.driver.memory": "8g",
}


def build_session(master: str | None = None, app: str = "civiclake", **conf: str) -> SparkSession:
    """Create (or reuse) a session with the local defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.sparkContext.master
    except Exception:  # Spark Connect: no SparkContext on the client
        master = spark.conf.get("spark.master", "")
    return master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only when unset.

    The cluster names its shared folder in ``spark.checkpoint.dir``; we
    never override it.  When it is unset we create a temporary folder,
    which is only acceptable in local mode (tests); on a cluster we fail
    loudly instead of writing to a machine-local path.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the folder must come from the conf
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for this cluster")
        return tempfile.mkdtemp(prefix="civiclake-ckpt-")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="civiclake-ckpt-"))
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "tables", *parts, uuid.uuid4().hex])


def materialize(df: DataFrame, label: str = "stage", scratch: Scratch | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used for small derived sides (group statistics, boundary rows) and
    to cut lineage before an iterative step.  Reading the written files
    gives Catalyst exact size statistics, so its own size-checked
    broadcast decision (``autoBroadcastJoinThreshold``) applies and a
    side that turns out large is joined by shuffle instead.  The files
    live in the cluster's shared folder, so a lost executor does not
    lose them.  With a ``scratch``, that owns the folder and removes it.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    if scratch is not None:
        scratch.paths.append(path)
    df.write.mode("errorifexists").parquet(path)
    # the schema is known: skip the footer-inference job on read-back
    schema = StructType([StructField(f.name, f.dataType, True, f.metadata) for f in df.schema.fields])
    return spark.read.schema(schema).parquet(path)


class Scratch:
    """Owner of folders written on the way to a result; ``clear`` removes them
    once nothing that is still to run reads them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def folder(self, label: str) -> str:
        self.paths.append(shared_dir(self.spark, label))
        return self.paths[-1]

    def clear(self) -> None:
        for path in self.paths:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
        self.paths.clear()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
