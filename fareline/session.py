"""Session settings and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume (AQE on, UTC, no UI). On a cluster, pass
# ``master=None`` and size shuffle partitions to the data
# (~128-256 MB per partition after AQE coalescing).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime broadcast only below a measured size; otherwise sort-merge
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.parquet.compression.codec": "zstd",
    # files with nanosecond timestamps: read as integers, see ``operators.normalize.to_timestamp_ntz``
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # see ``limit_methods``
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = "local[*]", shuffle_partitions: int = 8, app: str = "fareline", **conf) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 512 << 20) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of compressed Parquet.

    * scan splits of a 100,000th of the input, between 128MB and 1GB, keep the
      task count proportional to data without tiny tasks;
    * the initial shuffle width is sized so each partition holds ~512MB of
      shuffle data at ~3x expansion of compressed Parquet, capped at 400k
      partitions to bound the driver's map-output bookkeeping; AQE then
      coalesces small partitions and splits skewed ones, so over-sizing is
      cheap and under-sizing (spills) is not;
    * e.g. 100 TB on 1,000 executors x 8 cores -> 1GB splits (~100k scan
      tasks) and 400k initial shuffle partitions (~750MB each).
    """
    split = max(128 << 20, min(1 << 30, input_bytes // 100_000))
    shuffle = max(2 * total_cores, min(400_000, (3 * input_bytes) // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's checkpoint folder (``spark.checkpoint.dir``).

    Where it is unset, a local master gets a temporary folder; any other master
    raises, as its machines share no local folder. Returns None on sessions without a driver-side context (Spark Connect),
    where the server's own setting applies.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not is_local(sc.master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that the whole cluster shares (master {sc.master})")
    local = tempfile.mkdtemp(prefix="fareline-ckpt-")
    sc.setCheckpointDir(local)
    return local


def is_local(master: str) -> bool:
    """One JVM on one machine (``local``, ``local[8]``); ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


# the JVM never compiles a method of more bytecode than this (HotSpot's HugeMethodLimit)
JVM_METHOD_LIMIT = 8000


def limit_methods(spark: SparkSession) -> None:
    """Have this session run no generated method that the JVM would only interpret.

    Spark fuses a stage's steps into one method. Bronze's has just over 8,000 bytes, and
    interpreting it costs several times the work on every row. Above the limit Spark runs
    the steps one by one instead, each compiled. The setting counts when a query runs, so it stays on.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > JVM_METHOD_LIMIT:
        spark.conf.set(key, str(JVM_METHOD_LIMIT))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# of Spark 4.1; a session that lacks it keeps shuffle files until the driver collects its garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs inside remove their shuffle files when they end: what they made is written by then.

    Otherwise the files of every write of a build lie on the executors' disks beside its layers.
    """
    old = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if old is None else spark.conf.set(CLEANUP, old)


def drop_shared(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new folder of the shared storage and read back.

    Cuts lineage, survives lost executors, and gives the planner file sizes.
    """
    path = shared_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def session_key(spark: SparkSession) -> str:
    """Identifier of the running application (for per-session memoisation)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for intermediate tables."""
    base = (ensure_checkpoint_dir(spark) or "").rstrip("/")
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{base}/{name}"


__all__ = ["DEFAULT_CONF", "cut_lineage", "drop_shared", "ensure_checkpoint_dir", "get_session", "is_local", "limit_methods", "recommended_conf", "session_key", "shared_dir", "shuffles_dropped", "write_shared"]
