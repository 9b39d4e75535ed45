"""Reliable checkpoints for iterative jobs."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would not outlive its executor, so the setting is required there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="volspark-checkpoint-")
    context.setCheckpointDir(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` materialised in the checkpoint folder, with its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, where the driver and all executors read and write. It
    stays until whoever owns ``spark.checkpoint.dir`` clears it."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
