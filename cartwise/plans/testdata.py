"""The star-schema test tables read as the three tables of the domain."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.operators.windows import time_window

BEGIN_HIST = datetime(2000, 8, 1)
END_HIST = datetime(2001, 6, 1)
BEGIN_RECENT = datetime(2001, 6, 1)
END_RECENT = datetime(2001, 7, 1)
OBSERVATION_DATE = datetime(2001, 6, 1)


# The columns used, with their types. A declared schema saves the job that would
# read a file footer to infer it.
_COLUMNS = {
    "lineitem": "l_orderkey long, l_partkey long",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "part": "p_partkey long, p_brand string, p_type string, p_size int",
    "customer": "c_custkey long",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string",
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[table]).parquet(f"{sf_dir}/{table}.parquet")


@dataclass(frozen=True)
class Domain:
    transactions: DataFrame
    items: DataFrame
    users: DataFrame

    @property
    def hist(self) -> DataFrame:
        return time_window(self.transactions, BEGIN_HIST, END_HIST)

    @property
    def recent(self) -> DataFrame:
        return time_window(self.transactions, BEGIN_RECENT, END_RECENT)


def load_domain(spark: SparkSession, sf_dir: str) -> Domain:
    """Order lines are purchases, parts are items, customers are users."""
    lines, orders = _read(spark, sf_dir, "lineitem"), _read(spark, sf_dir, "orders")
    transactions = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("o_orderdate").alias("created_date"),
        F.col("l_orderkey").alias("order_id"),
    )
    items = _read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("Step "), F.expr("(p_size + 9) div 10")).alias("age_group"),
        F.col("p_type").alias("category"),
    )
    birth = F.expr("date_add(DATE '1995-01-01', cast(c_custkey * 37 % 2400 as int))")
    users = _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_custkey") % 20 != 0, birth).alias("date_of_birth"),
    )
    return Domain(transactions, items, users)


def purchase_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with a time of day, from the event stream table."""
    events = _read(spark, sf_dir, "events").where("event_type = 'purchase'")
    return events.select(
        F.col("user_id").alias("customer_id"),
        (F.col("event_id") % 2000).alias("item_id"),
        F.col("ts").alias("created_date"),
        F.col("event_id").alias("order_id"),
    )
