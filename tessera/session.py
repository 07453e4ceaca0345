"""Session-level helpers that read (never impose) cluster settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for written tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (or the directory already given to
    ``SparkContext.setCheckpointDir``).  The library never falls back to a
    machine-local folder: on a cluster that would lose data with the executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - Spark Connect: only the conf is visible
            base = None
    if not base:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/...) before writing intermediate tables"
        )
    return base.rstrip("/")


def ensure_shared_dir(spark: SparkSession) -> None:
    """Give a one-machine session (``local[...]``) a scratch folder if it names none.

    On a cluster the setting is required: executors would write to their own disks.
    """
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        shared_dir(spark)  # raises with the reason
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-shared-"))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df, eager: bool = True):
    """Cut lineage with a reliable checkpoint in the shared folder.

    Unlike ``localCheckpoint`` the data survive the loss of an executor.
    """
    spark = df.sparkSession
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server checkpoints
        sc = None
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(spark))  # raises clearly when none is configured
    return df.checkpoint(eager=eager)


def use_shared_checkpoint_dir(spark: SparkSession) -> bool:
    """Point RDD checkpoints (used by iterative ML such as ALS) at ``spark.checkpoint.dir``.

    Only a folder the session already names is used; nothing is invented.
    Returns whether a checkpoint folder is in effect.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's settings apply
        return False
    if sc.getCheckpointDir():
        return True
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        sc.setCheckpointDir(base)
        return True
    return False


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count (Spark's default of 200 if it is not a number)."""
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        return 200
