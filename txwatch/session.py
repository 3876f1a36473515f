"""Session helpers: a tuned local session for tests/bench and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale. Shuffle partitions are a starting point;
# AQE coalesces small ones and splits skewed join partitions at runtime.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "snappy",
}


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
                 shuffle_expansion: float = 1.5, max_shuffle_partitions: int = 100_000) -> dict[str, str]:
    """Starting settings for a cluster run over ``input_bytes`` of Parquet.

    Input splits of ``target_partition_bytes``; initial shuffle partitions
    sized so each shuffle partition holds about that much (the widest
    shuffle, the sender window, moves about ``shuffle_expansion`` times the
    input it reads), never fewer than 2 per core and at most
    ``max_shuffle_partitions`` (map-output tracking grows with maps x
    reducers; above the cap partitions get larger and the external sort
    spills). AQE coalesces small partitions and splits skewed join
    partitions at runtime, so these are upper bounds, not per-query settings."""
    wanted = int(input_bytes * shuffle_expansion // target_partition_bytes) + 1
    shuffle = max(2 * total_cores, min(max_shuffle_partitions, wanted))
    return {
        **BASE_CONF,
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "txwatch") -> SparkSession:
    """Local session for tests and the bench (cluster jobs bring their own)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TXWATCH_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is used
    as is. Only when it is unset in one local process (tests) do we create a
    scratch folder; on any other master an unset folder is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no SparkContext
        sc = None
    if sc is not None:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is not None and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = _LOCAL_FALLBACK.setdefault("dir", tempfile.mkdtemp(prefix="txwatch-ckpt-"))
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


_LOCAL_FALLBACK: dict[str, str] = {}


def session_key(spark: SparkSession) -> str:
    """Identity of a session for per-session caches."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return f"session-{id(spark)}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (for written tables)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


#: Rows a task of a wide shuffle should get.
ROWS_A_TASK = 250_000


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings (``_`` for ``.``) that hold within the block."""
    names = {k.replace("_", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_for(spark: SparkSession, rows: int, rows_a_task: int = ROWS_A_TASK):
    """Within the block, shuffles have partitions enough for that many rows (never
    fewer than the session's), so that a task's share does not grow with the
    input; AQE joins those that stay small."""
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_a_task))
    return settings(spark, spark_sql_shuffle_partitions=str(wanted))


def materialize(df: DataFrame, name: str = "layer", sort_within: str | None = None, codec: str | None = None) -> DataFrame:
    """Cut lineage with a Parquet table written under the shared checkpoint
    folder (survives executor loss). Reading it back keeps column pruning and
    filter pushdown, which a checkpointed RDD would lose; ``sort_within``
    orders rows inside each file so row-group statistics skip on that key."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    out = df.sortWithinPartitions(sort_within) if sort_within else df
    out.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.parquet(path)
