"""Session set-up and checkpoint handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app_name: str = "fleetlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings every operator relies on.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: AQE then
    coalesces from the cluster's own default.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Epoch arithmetic and day boundaries are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session that
    has none gets a temporary folder; a cluster session without one is refused,
    because a machine-local folder is lost with its machine.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    current = sc.getCheckpointDir()
    return current or os.path.join(tempfile.mkdtemp(prefix="fleetlens-"), "checkpoint")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage so that it is computed once."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint(eager=True)
