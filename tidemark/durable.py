"""Results that later steps read more than once, written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.errors import ContractError

_NAMED = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where none is named, a folder of our own is made in local mode only, in which driver and
    executors share one disk; on a cluster the setting is required.
    """
    context = spark.sparkContext
    folder = (
        spark.conf.get(_NAMED, None) or context.getConf().get(_NAMED)
        or context.getCheckpointDir()
    )
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-"):
            raise ContractError(f"set {_NAMED} to a shared folder")
        folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def durable(frame: DataFrame) -> DataFrame:
    """Write ``frame`` with a reliable checkpoint, so a lost executor does not replay it."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


#: Spark's own setting: what an execution has shuffled leaves the disk when it ends.
_DROPS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(
    frame: DataFrame, *, partition_by: Sequence[str] = (), drop_shuffles: bool = False
) -> DataFrame:
    """Write ``frame`` as Parquet into a new folder of the shared folder and read it back.

    Unlike a checkpoint of rows, later steps read only the columns and, with ``partition_by``,
    the partitions that they need. With ``drop_shuffles``, what the write has shuffled is removed
    after it, not when the driver next collects garbage; not for writes by several threads.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    before = spark.conf.get(_DROPS, None)
    if drop_shuffles:
        spark.conf.set(_DROPS, "true")
    try:
        frame.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    finally:
        if drop_shuffles:
            spark.conf.unset(_DROPS) if before is None else spark.conf.set(_DROPS, before)
    back = spark.read.schema(frame.schema).parquet(path)
    return back.select(*frame.columns)
