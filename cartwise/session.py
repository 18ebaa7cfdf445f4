"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "cartwise", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on, so that join strategy, partition
    counts and skewed partitions are settled from run-time sizes.

    Nothing here fixes a partition count or a memory size: those belong to the
    cluster that submits the job.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Call sites of every column expression are looked up otherwise, which
        # takes longer than planning the query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Temporary folders of sessions that run in one process, by application.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's own folder in the one that all executors can reach.

    That is ``spark.checkpoint.dir`` of the session, or the checkpoint directory of its
    context. Where neither is set, a session in one process (``local``) gets a temporary
    one; on a cluster it is an error, as executors do not share their local folders.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="cartwise-")
        folder = _LOCAL[context.applicationId]
    return f"{folder.rstrip('/')}/cartwise-{context.applicationId}"


def drop_stored(spark: SparkSession) -> None:
    """Removes every table that this application stored in the shared folder."""
    delete_path(spark, shared_folder(spark))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation. Used
    before iterative work that visits the same rows many times.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def materialize_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As :func:`materialize`, in ``buckets`` files' worth of rows by a hash of ``key``: a join
    on the key leaves the stored rows where they are. One file is written for each bucket that
    a task holds, so ``df`` should be dealt by the key already."""
    spark = df.sparkSession
    unique = uuid.uuid4().hex
    path = f"{shared_folder(spark)}/{name}-{unique}"
    table = f"cartwise_{name.replace('-', '_')}_{unique}"
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(table)
    stored = spark.table(table)
    stored._stored_at = path
    return stored


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a file or directory, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(stored: DataFrame) -> None:
    """Removes a table that :func:`materialize` returned, once its last reader has ended."""
    delete_path(stored.sparkSession, stored._stored_at)


def stored_bytes(stored: DataFrame) -> int:
    """The size of the files of a table that :func:`materialize` returned."""
    context = stored.sparkSession.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(stored._stored_at)
    return target.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def broadcast_limit(spark: SparkSession) -> int:
    """The session's limit in bytes for sending a table to all tasks; below 0, none is sent."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def fan_out_partitions(df: DataFrame) -> int:
    """Partitions for a step whose output is hundreds of times its input: by the
    cores there are, as the small input would otherwise be packed into few tasks, and no
    fewer than the session's shuffle partitions."""
    spark = df.sparkSession
    stated = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * spark.sparkContext.defaultParallelism, stated)
