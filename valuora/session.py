"""Spark session defaults and the checkpoint folder rule."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. They are defaults only: values the cluster
# already set (spark-submit --conf / spark-defaults) win.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # prices are written partitioned by ticker/market: keep pruning dynamic
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 executor_memory_gb: float, shuffle_bytes: int = 0) -> dict[str, str]:
    """Settings sized for a cluster run.

    ``shuffle_bytes`` is the largest shuffle of the job: nothing to speak of for
    the queries, which shuffle a row per ticker and task, and ``input_bytes``
    for ingest, which range-partitions all prices once.

    * scan splits of up to 256 MB, well inside a task's share of executor memory;
    * shuffle partitions of ~256 MB for that shuffle, at least 2x the cores; AQE
      coalesces smaller shuffles and splits skewed partitions;
    * runtime broadcasts of sides measured at up to 64 MB: Spark decides from
      file sizes and shuffle statistics, nothing in the library forces one.
    """
    cores = max(1, executors * cores_per_executor)
    mem_per_core = executor_memory_gb * 1024 ** 3 / max(1, cores_per_executor)
    # small inputs still get a split per core, large ones splits a task holds easily
    split = int(min(256 * 1024 ** 2, max(32 * 1024 ** 2, min(mem_per_core / 8, max(1, input_bytes / cores)))))
    shuffle = max(2 * cores, -(-shuffle_bytes // (256 * 1024 ** 2)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 ** 2),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 ** 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.broadcastTimeout": "900",
        "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    }


def get_spark(master: str | None = None, app: str = "valuora",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


class NoSharedFolder(RuntimeError):
    """A cluster session names no folder that all executors share."""


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the deployment (a shared file system
    every executor reaches); without it this raises ``NoSharedFolder``, as
    executors writing to their own disks would lose data silently. Only a local
    session (tests) gets a scratch folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session has no local SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    path = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not path:
        path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if sc is None or not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="valuora-ckpt-")
    if sc is None:
        return path
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def _tables_folder(spark: SparkSession) -> str:
    """This application's folder of written tables, under the shared folder."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - a remote session has no local SparkContext
        app = "remote"
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/valuora-tables/{app}"


def cut_lineage(df, name: str = "table"):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Used for small derived tables that several later steps reuse (the
    fundamentals, the latest dates): their plan runs once, a lost executor
    re-reads the files instead of replaying the statements, and -- unlike an RDD
    checkpoint -- the read-back table has file sizes for the join planner,
    column pruning and filter pushdown. This is an action: it runs when the plan
    is built. ``drop_tables`` removes an application's tables.
    """
    spark = df.sparkSession
    path = f"{_tables_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# (application's folder, path) -> catalog name and buckets of a table written there dealt out by a key
DEALT: dict[tuple, tuple[str, int]] = {}
BUCKET_BYTES = 1024 ** 2  # of input files a bucket: the tables made of them are a few times as large in memory


def buckets_for(spark: SparkSession, input_bytes: int | None) -> int:
    """Buckets for tables made of so many bytes of files: at most as many as a shuffle has partitions."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return most if input_bytes is None else max(2, min(most, -(-input_bytes // BUCKET_BYTES)))


def write_dealt(df, path: str, buckets: int, key: str = "ticker", compression: str = "gzip") -> None:
    """Write a Parquet table whose files are bucketed by ``key``.

    ``read_table`` gives it back with its buckets, so joins and aggregates by the
    key shuffle neither it nor what follows from it. A plan that has its rows
    dealt out so already is not shuffled here either.
    """
    spark, name = df.sparkSession, f"valuora_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.mode("overwrite").option("compression", compression).option("path", path)
        .bucketBy(buckets, key).saveAsTable(name))
    _forget(spark, path)
    DEALT[_tables_folder(spark), path] = name, buckets


def _forget(spark: SparkSession, path: str) -> None:
    """Drop a dealt table's catalog entry; its files stay."""
    found = DEALT.pop((_tables_folder(spark), path), None)
    if found is not None:
        spark.sql(f"DROP TABLE IF EXISTS {found[0]}")


def dealt_buckets(spark: SparkSession, path: str) -> int | None:
    """Buckets of the table at ``path``, if this application has written it dealt out."""
    found = DEALT.get((_tables_folder(spark), path))
    return None if found is None else found[1]


def read_table(spark: SparkSession, path: str):
    """The Parquet table at ``path``, with its buckets if this application has written it dealt out."""
    found = DEALT.get((_tables_folder(spark), path))
    return spark.read.parquet(path) if found is None else spark.table(found[0])


def together(*builds):
    """Results of functions that each run Spark jobs of their own, run side by side.

    Tables that do not depend on each other are written at the same time, so one
    that is held up by a few long tasks leaves no cores idle.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    if len(builds) < 2:
        return [b() for b in builds]
    with ThreadPoolExecutor(len(builds)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(b)) for b in builds]]


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever file system its path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


# (application's folder, ...) -> a written table that later plans of the application use again
KEPT: dict[tuple, object] = {}


def drop_tables(spark: SparkSession) -> None:
    """Remove every table this application wrote through ``cut_lineage``, and forget those it kept."""
    folder = _tables_folder(spark)
    remove_folder(spark, folder)
    for key in [k for k in KEPT if k[0] == folder]:
        del KEPT[key]
    for key in [k for k in DEALT if k[0] == folder and k[1].startswith(f"{folder}/")]:
        _forget(spark, key[1])
