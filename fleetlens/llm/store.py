"""Tables that several passes read: written once as Parquet in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch that goes to Python, whatever the length of its texts (a longer text is a batch by itself).
BATCH_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own; a cluster without it is refused,
    as no folder of one machine would do.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not known:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        known = tempfile.mkdtemp(prefix="fleetlens-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(known)
    return known


def bound_batches(spark: SparkSession) -> None:
    """Batches of the session hold at most ``BATCH_BYTES``: a task keeps several copies of each, in the
    executor's native memory and in Python's. Frames are run after an operator has returned, so the setting
    stays; it changes no result."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/fleetlens-{uuid.uuid4().hex}/{name}"


#: With this, the shuffle files of a query go when it has ended.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str, codec: str = "zstd", tidy: bool = False) -> DataFrame:
    """Write a table and read it back: cuts the lineage, survives lost executors, and gives the
    optimizer its true size (so a join broadcasts it only below Spark's own threshold). With ``tidy``
    the shuffle files that only the table needed go with its job."""
    spark = df.sparkSession
    path = table_path(spark, name)
    before = spark.conf.get(TIDY, None)
    if tidy:
        spark.conf.set(TIDY, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        if tidy:
            spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)
