"""Cleaning of the three input tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.sources.schemas import TS_COL

UNKNOWN = "Unknown"


def clean_transactions(transactions: DataFrame, sort: bool = False) -> DataFrame:
    """Rows with customer, item and time, without exact duplicates.

    ``sort=True`` orders by time. Order matters only where rows are written or
    shown, so it is not the default: a global sort is a full range shuffle.
    """
    rows = transactions.dropna(subset=["customer_id", "item_id", TS_COL]).distinct()
    return rows.orderBy(TS_COL, "customer_id", "item_id") if sort else rows


def _one_row_per(df: DataFrame, key: str, columns: list[Column]) -> DataFrame:
    """The least row per key in the order of ``columns`` (nulls first).

    ``min`` of a struct combines before the shuffle, so the copies of one key are
    never brought together in one task.
    """
    return (
        df.groupBy(key).agg(F.min(F.struct(*columns)).alias("__r")).select(key, "__r.*")
    )


def clean_items(items: DataFrame) -> DataFrame:
    """One row per item id, missing attributes named ``Unknown``."""
    filled = items.where(F.col("item_id").isNotNull()).fillna(
        UNKNOWN, subset=["brand", "category", "age_group"]
    )
    rest = [c for c in filled.columns if c != "item_id"]
    return _one_row_per(filled, "item_id", [F.col(c) for c in rest])


def clean_users(users: DataFrame) -> DataFrame:
    """One row per customer id."""
    known = users.where(F.col("customer_id").isNotNull())
    rest = [c for c in known.columns if c != "customer_id"]
    return _one_row_per(known, "customer_id", [F.col(c) for c in rest])
