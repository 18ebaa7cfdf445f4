"""Tables that one step leaves for the next: features, predictions, metrics."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.session import delete_path, fan_out_partitions
from cartwise.sources.readers import path_exists

PREDICTIONS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
    ]
)
METRICS = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("k", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("feature_count", T.LongType()),
    ]
)


def _finished(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def _bucketed(spark: SparkSession, path: str, key: str, buckets: int, columns: T.StructType) -> DataFrame:
    """The files at ``path`` as a table that knows its buckets, whichever session wrote them."""
    name = f"cartwise_cache_{sha256(path.encode()).hexdigest()[:24]}"
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    location = path.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({listed}) USING parquet CLUSTERED BY (`{key}`) "
        f"SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return spark.table(name)


def features_cache(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    key: str = "customer_id",
    buckets: int | None = None,
    **options,
) -> DataFrame:
    """The feature table at ``path``; built and written first if it is not there.

    It is laid out by customer: rows of one bucket of ``key`` are one sorted file, so
    ranking, labels and joins on the customer read it without an exchange. The pairs are
    shuffled once, here, and not again by each of the models and evaluations that read
    the table; a table that is dealt by the key as it is made
    (``build_feature_label_table(by_customer=True)``) is not shuffled at all. ``buckets`` is
    the number of files (by default that of such a table's parts, else of a fan-out step); a
    table that is there keeps its own, which is part of its path.

    ``options`` (windows, candidate budget and whatever else the table depends on) are part
    of the path that is read and written, so a table made under others is not returned.

    A directory without its success marker is the rest of a failed write and is
    built again.
    """
    if options:
        stated = "\n".join(f"{k}={options[k]!r}" for k in sorted(options))
        path = f"{path.rstrip('/')}-{sha256(stated.encode()).hexdigest()[:16]}"
    prefix = f"by-{key}-"
    # Of a table without rows there are no files, nor its columns: it is built again.
    there = [n for n in folder_names(spark, path, prefix) if _finished(spark, f"{path}/{n}") and folder_names(spark, f"{path}/{n}", "part-")]
    wanted = there if buckets is None else [n for n in there if n == f"{prefix}{buckets}"]
    if wanted:
        own = f"{path}/{max(wanted)}"
        n = int(max(wanted).removeprefix(prefix))
        columns = spark.read.parquet(own).schema
    else:
        table = build()
        dealt = getattr(table, "_dealt_by", None)
        n = buckets or (dealt[1] if dealt and dealt[0] == key else fan_out_partitions(table))
        own = f"{path}/{prefix}{n}"
        delete_path(spark, own)
        name = f"cartwise_write_{sha256(own.encode()).hexdigest()[:24]}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        # One task for each bucket, hence one file. The writer sorts a task's rows by bucket and key.
        spread = table if dealt == (key, n) else table.repartition(n, key)
        writer = spread.write.format("parquet")
        writer.bucketBy(n, key).sortBy(key).option("path", own).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")
        columns = table.schema
    return _bucketed(spark, own, key, n, columns)


def write_predictions(predictions: DataFrame, path: str) -> None:
    predictions.write.mode("overwrite").parquet(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTIONS).parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """The long metric table as JSON lines. It has one row per metric and k, and the
    number of features of the model where the table states it."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path_glob: str) -> DataFrame:
    """All metric tables a glob matches, with the name of the directory of each."""
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return spark.read.schema(METRICS).json(path_glob).select(
        folder.alias("file_name"), "metric", "k", "value", "feature_count"
    )


def feature_set_metrics(metrics: DataFrame) -> DataFrame:
    """``(feature_count, metric, k, value)``: the latest file, by name, of each set."""
    sized = metrics.where("feature_count is not null")
    latest = sized.groupBy("feature_count").agg(F.max("file_name").alias("file_name"))
    return sized.join(latest, ["feature_count", "file_name"], "left_semi").select(
        "feature_count", "metric", "k", "value"
    )


def folder_names(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    """The names in a folder that start with ``prefix``; none if there is no folder."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted(n for n in names if n.startswith(prefix))


def latest_artifact(spark: SparkSession, folder: str, prefix: str) -> str | None:
    """The last name in a folder that starts with ``prefix``; None if there is none."""
    return max(folder_names(spark, folder, prefix), default=None)
