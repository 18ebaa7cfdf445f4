"""Parquet loaders and dataset exploration."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise import config
from cartwise.functions.expressions import ts
from cartwise.session import materialize
from cartwise.sources import schemas

#: The folder level of a history laid out by month: the month's first day.
MONTH = "purchase_month"


def _load(spark: SparkSession, path: str, schema, table: str, rename: dict[str, str]) -> DataFrame:
    df = spark.read.parquet(path)
    for old, new in rename.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    return schemas.conform(df, schema, table)


def load_transactions(
    spark: SparkSession,
    path: str | None = None,
    data_dir: str = ".",
    ts_col: str = "created_at",
    begin: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Purchase history from a parquet path or glob.

    ``ts_col`` names the event time in the files; it becomes ``created_date``. ``begin`` and
    ``end`` keep the rows with ``begin <= time < end``; of a table that
    :func:`write_transactions` laid out by month, only the months between are listed and read.
    """
    path = path or f"{data_dir}/{config.TRANSACTIONS_GLOB}"
    rows = spark.read.parquet(path)
    months = []
    if MONTH in rows.columns:
        if begin is not None:
            months.append(F.col(MONTH) >= F.lit(begin.date().replace(day=1)))
        if end is not None:
            months.append(F.col(MONTH) <= F.lit(end.date()))
        # Rows without a time are in no window, but in the table.
        rows = rows.where(reduce(lambda a, b: a & b, months)) if months else rows
    if ts_col in rows.columns and schemas.TS_COL not in rows.columns:
        rows = rows.withColumnRenamed(ts_col, schemas.TS_COL)
    rows = schemas.conform(rows, schemas.TRANSACTIONS, "transactions")
    time = F.col(schemas.TS_COL)
    if begin is not None:
        rows = rows.where(time >= ts(begin))
    return rows if end is None else rows.where(time < ts(end))


def write_transactions(transactions: DataFrame, path: str, ts_col: str = schemas.TS_COL) -> None:
    """Writes a purchase history with one folder per month of ``ts_col``.

    Rows are dealt by ranges of month and customer, so that a large month is written by
    several tasks and a task opens few folders.
    """
    by_month = transactions.withColumn(MONTH, F.trunc(ts_col, "month"))
    by_month.repartitionByRange(MONTH, "customer_id").write.partitionBy(MONTH).mode("overwrite").parquet(path)


def load_items(spark: SparkSession, path: str | None = None, data_dir: str = ".") -> DataFrame:
    """Item attributes from a parquet path or glob."""
    return _load(spark, path or f"{data_dir}/{config.ITEMS_GLOB}", schemas.ITEMS, "items", {})


def load_users(spark: SparkSession, path: str | None = None, data_dir: str = ".") -> DataFrame:
    """Customers from a parquet path or glob."""
    return _load(spark, path or f"{data_dir}/{config.USERS_GLOB}", schemas.USERS, "users", {})


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or directory exists on whatever file system the path names."""
    fs, target = _hadoop_fs(spark, path)
    return fs.exists(target)


def table_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per parquet file of a directory: ``file_name``, ``length``.

    The binary source lists the files; the content column is pruned, so no file
    is read.
    """
    if not path_exists(spark, data_dir):
        raise FileNotFoundError(f"Dataset directory not found: {data_dir}")
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(data_dir)
    )
    return listing.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length")
    ).orderBy("file_name")


def list_parquet_files(spark: SparkSession, data_dir: str) -> list[str]:
    """Sorted names of the parquet tables of a directory (a file listing, not data)."""
    if not path_exists(spark, data_dir):
        raise FileNotFoundError(f"Dataset directory not found: {data_dir}")
    fs, target = _hadoop_fs(spark, data_dir)
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(n for n in names if n.endswith(".parquet"))


def load_any_parquet(spark: SparkSession, file_name: str, data_dir: str) -> DataFrame:
    """A table of the dataset directory by name, with or without the extension."""
    if not file_name.endswith(".parquet"):
        file_name = f"{file_name}.parquet"
    path = f"{data_dir}/{file_name}"
    if not path_exists(spark, path):
        raise FileNotFoundError(
            f"File not found: {path}; available: {list_parquet_files(spark, data_dir)}"
        )
    return spark.read.parquet(path)


def profile_table(df: DataFrame, name: str) -> DataFrame:
    """One row per column: type, rows, nulls and null share in percent (0 if empty).

    One scan with one partial aggregate; the single result row is then unfolded.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(t).alias("dtype"),
                F.col(c).alias("null_count"),
            )
            for c, t in df.dtypes
        ]
    )
    return counts.select("__rows", F.inline(entries)).select(
        F.lit(name).alias("table_name"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.col("__rows").alias("n_rows"),
        "column_name",
        "dtype",
        "null_count",
        F.when(F.col("__rows") > 0, F.col("null_count") * F.lit(100.0) / F.col("__rows"))
        .otherwise(F.lit(0.0))
        .alias("null_pct"),
    )


def sample_rows(df: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` rows, as shown in a table preview."""
    return df.limit(n)


# --- a dataset directory ----------------------------------------------------

#: Both ends of a Parquet file.
MAGIC = b"PAR1"


def _files_of(spark: SparkSession, data_dir: str) -> list[tuple[str, str, int]]:
    """(table, path, length) of every file of every table of a directory, listed once.

    A table is a file, or a folder of files, whose name ends in .parquet.
    """
    out = []
    for name in list_parquet_files(spark, data_dir):
        fs, target = _hadoop_fs(spark, f"{data_dir}/{name}")
        found = fs.listFiles(target, True)
        while found.hasNext():
            status = found.next()
            hidden = status.getPath().getName().startswith(("_", "."))
            if not hidden:
                out.append((name.removesuffix(".parquet"), status.getPath().toString(), status.getLen()))
    return sorted(out)


def _ends_as_parquet(spark: SparkSession, path: str, length: int) -> str | None:
    """None if the file's last bytes are those of a Parquet file, else what is wrong."""
    if length < 12:
        return f"{length} bytes are no Parquet file"
    fs, target = _hadoop_fs(spark, path)
    try:
        stream = fs.open(target)
        try:
            stream.seek(length - len(MAGIC))
            end = bytes(stream.readUnsignedByte() for _ in MAGIC)
        finally:
            stream.close()
    except Py4JJavaError as error:
        return f"cannot be read: {error.java_exception.getMessage()}"
    return None if end == MAGIC else "no footer at the end: the file is cut or no Parquet file"


def _readable_schema(spark: SparkSession, data_dir: str, name: str) -> T.StructType | str:
    """A table's columns, of its first file whose footer can be read; or what is wrong with it."""
    message = "no file"
    for table, path, _ in _files_of(spark, data_dir):
        if table == name:
            try:
                return spark.read.parquet(path).schema
            except (PySparkException, Py4JJavaError) as error:
                message = str(error).splitlines()[0]
    return message


def _tables(spark: SparkSession, data_dir: str) -> dict[str, DataFrame | str]:
    """Each table of a directory, files that cannot be read left out; or what is wrong with it."""
    names = list_parquet_files(spark, data_dir)
    if not names:
        raise FileNotFoundError(f"No parquet files found in {data_dir}")
    out: dict[str, DataFrame | str] = {}
    for name in names:
        reader = spark.read.option("ignoreCorruptFiles", "true")
        try:
            # Footers alone are read for the columns.
            table = reader.parquet(f"{data_dir}/{name}")
        except (PySparkException, Py4JJavaError):
            schema = _readable_schema(spark, data_dir, name.removesuffix(".parquet"))
            table = schema if isinstance(schema, str) else reader.schema(schema).parquet(f"{data_dir}/{name}")
        out[name.removesuffix(".parquet")] = table
    return out


def explore_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per file: table_name, file_name, length, n_rows, status, message.

    Two scans, each of all files of a table: one without columns, which reads footers and so
    the number of rows that each file states; and one of all columns, which counts what can
    be read. ``status`` is ``ok``, ``unreadable`` (no footer) or ``damaged`` (fewer rows than
    stated); no file ends the exploration. Only a file without rows in either scan is
    opened by the driver, for its last four bytes.
    """
    tables = _tables(spark, data_dir)
    files = _files_of(spark, data_dir)
    listed = spark.createDataFrame(files, "table_name string, path string, length long")
    counted = []
    for name, table in tables.items():
        if isinstance(table, str):
            continue
        path = F.col("_metadata.file_path")
        stated = table.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("stated"), F.lit(0).cast("long").alias("n_rows"))
        # True of every row, but of no row that is not read: maps have no hash.
        values = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in t else F.col(f"`{c}`") for c, t in table.dtypes]
        read = F.count_if(F.xxhash64(*values) % 2 < 2)
        present = table.groupBy(path.alias("path")).agg(F.lit(0).cast("long").alias("stated"), read.alias("n_rows"))
        counted += [c.withColumn("table_name", F.lit(name)) for c in (stated, present)]
    rows = (
        reduce(DataFrame.unionByName, counted).groupBy("table_name", "path").agg(F.max("stated").alias("stated"), F.max("n_rows").alias("n_rows"))
        if counted
        else spark.createDataFrame([], "table_name string, path string, stated long, n_rows long")
    )
    # The scan's paths are URIs with another number of slashes than the listing's.
    plain = F.regexp_replace(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), "^([a-z0-9]+):/+", "$1:/")
    known = materialize(rows.withColumn("path", plain), "file-rows")
    listed = listed.withColumn("path", F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/")).join(known, ["table_name", "path"], "left")
    doubtful = listed.where("stated is null").select("table_name", "path", "length").collect()
    problems = [(r.table_name, r.path, _ends_as_parquet(spark, r.path, r.length)) for r in doubtful]
    wrong = spark.createDataFrame([p for p in problems if p[2]], "table_name string, path string, message string")
    lost = F.col("stated") > F.col("n_rows")
    told = F.concat(F.col("n_rows").cast("string"), F.lit(" of "), F.col("stated").cast("string"), F.lit(" rows can be read"))
    return listed.join(F.broadcast(wrong), ["table_name", "path"], "left").select(
        "table_name",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
        F.when(F.col("message").isNull(), F.coalesce("n_rows", F.lit(0))).alias("n_rows"),
        F.when(F.col("message").isNotNull(), "unreadable").when(lost, "damaged").otherwise("ok").alias("status"),
        F.coalesce("message", F.when(lost, told)).alias("message"),
    )


def explore_dataset(spark: SparkSession, data_dir: str) -> DataFrame:
    """The profile of every parquet table in a directory, as one table, over the files that
    can be read. A table none of whose files can be read is one row of nulls; see
    :func:`explore_files` for what is wrong with it."""
    profiles = []
    for name, table in _tables(spark, data_dir).items():
        if isinstance(table, str):
            empty = spark.range(1).select(F.lit(name).alias("table_name"))
            kinds = {"n_columns": "long", "n_rows": "long", "column_name": "string", "dtype": "string", "null_count": "long", "null_pct": "double"}
            profiles.append(empty.select("table_name", *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()]))
        else:
            profiles.append(profile_table(table, name))
    return reduce(DataFrame.unionByName, profiles)


def explore_samples(spark: SparkSession, data_dir: str, n: int = 3) -> DataFrame:
    """``(table_name, row_index, row)``: the first ``n`` rows of each table's first readable
    file by name, as JSON text. A filter on the row's place in its file, so that no more
    than the head of each file is read and no table is sorted."""
    parts = []
    for name, table in _tables(spark, data_dir).items():
        if isinstance(table, str):
            continue
        place = F.col("_metadata.row_index")
        heads = table.where(place < n).select(
            F.col("_metadata.file_path").alias("path"), place.alias("row_index"), F.to_json(F.struct("*")).alias("row")
        )
        # At most n rows of each file.
        first = heads.agg(F.min("path")).scalar()
        parts.append(heads.where(F.col("path") == first).select(F.lit(name).alias("table_name"), "row_index", "row"))
    if not parts:
        return spark.createDataFrame([], "table_name string, row_index long, row string")
    return reduce(DataFrame.unionByName, parts)
