"""Session helpers: a local session for tests/bench, shared scratch space, table loading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "brook", rocksdb: bool = False
) -> SparkSession:
    """Session for tests and the local benchmark.

    On a cluster the session comes from ``spark-submit``; nothing here is needed there.
    Streaming state uses Spark's default (in-memory, checkpointed) store, which is the
    faster choice while state is bounded by watermarks; ``rocksdb=True`` selects the
    RocksDB store, the setting for large keyed state (running counts over a
    vocabulary) on a cluster.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    if rocksdb:
        # state off the JVM heap; changelog checkpointing commits only each batch's changes
        builder = builder.config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        ).config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the SparkContext.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset on a
    local session (tests) is a fresh temporary folder taken.  A Spark Connect session
    is remote by definition, so there the setting is required.
    """
    sc = _context(spark)
    if sc is None:  # Spark Connect: the server owns the checkpoint folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0] if _is_context_subdir(current) else current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="brook-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on Spark Connect
        return None


def _is_context_subdir(path: str) -> bool:
    # SparkContext appends a random UUID folder to the configured directory.
    tail = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(tail)
        return True
    except ValueError:
        return False


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/brook-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``; the table is columnar and the planner sees
    its real file size when it chooses a join.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
