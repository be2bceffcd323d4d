"""Session construction and the shared scratch folder.

Cluster jobs must not write to a machine-local temporary folder.  Scratch data
(landed files, lineage cuts, streaming checkpoints) goes below the folder the
cluster names in ``spark.checkpoint.dir``; a private folder is created only
when that setting is absent (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that every job relies on.  ANSI stays on (Spark 4 default): plain
# casts and divisions fail loudly, so lenient paths use try_* explicitly.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The EUC-KR / CP949 CSV source (O-04) needs the JDK charset table.
    "spark.sql.legacy.javaCharsets": "true",
}


# Cluster profile (large inputs): many shuffle partitions as an upper bound
# that AQE coalesces to ~128 MB each, 256 MB scan splits, skew-join splitting
# above 256 MB, and the same 64 MB broadcast bound the lookup check uses.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def get_session(master: str | None = None, app: str = "regiostat",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    """Build (or get) a session with the settings every job relies on;
    ``cluster=True`` adds :data:`CLUSTER_CONF` for large inputs."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if cluster:
        for k, v in CLUSTER_CONF.items():
            builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**_BASE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session someone else built."""
    for k, v in _BASE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf already fixed by the cluster
            pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; set a private one only if unset.

    The SparkContext's reliable-checkpoint folder is pointed there too when
    it is not set yet, so ``DataFrame.checkpoint()`` works in either case.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="regiostat-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    path = f"{root}/regiostat/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith(("file:", "/")) and spark.sparkContext.master.startswith("local"):
        os.makedirs(path.replace("file://", "", 1).replace("file:", "", 1), exist_ok=True)
    return path


def materialize(df):
    """Cut lineage of a derived input that a plan reads more than once: a
    reliable checkpoint into the shared checkpoint folder (survives executor
    loss; never a local checkpoint)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
