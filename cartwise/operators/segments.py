"""Item and customer segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartwise.sources.schemas import TS_COL

# The category text and age group that make the segment, and its names.
SEGMENT_PATTERN = "sua"
SEGMENT_AGE_GROUP = "Step 1"
SEGMENT_NAME = "milk_step1"
OTHER_SEGMENT = "other"


def build_item_segment_step1(
    items: DataFrame, pattern: str = SEGMENT_PATTERN, age_group: str = SEGMENT_AGE_GROUP
) -> DataFrame:
    """``(item_id, category, segment)``; a null category or age group is "other"."""
    in_segment = F.col("category").contains(pattern) & (F.col("age_group") == age_group)
    segment = F.when(in_segment, F.lit(SEGMENT_NAME)).otherwise(F.lit(OTHER_SEGMENT))
    return items.select("item_id", "category", segment.alias("segment"))


def build_customer_segment_from_step1(hist: DataFrame, item_segment: DataFrame) -> DataFrame:
    """The segment each customer bought most; on equal counts the one bought last,
    then the lower name. The ranking sees one row per (customer, segment)."""
    stats = (
        hist.select("customer_id", "item_id", TS_COL)
        .join(item_segment.select("item_id", "segment"), "item_id", "left")
        .groupBy("customer_id", "segment")
        .agg(F.count(F.lit(1)).alias("n"), F.max(TS_COL).alias("latest"))
    )
    best = Window.partitionBy("customer_id").orderBy(F.desc("n"), F.desc("latest"), "segment")
    return (
        stats.withColumn("place", F.row_number().over(best))
        .where("place = 1")
        .select("customer_id", "segment")
    )
