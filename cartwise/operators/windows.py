"""Time windows over the purchase history."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.expressions import ts
from cartwise.sources.schemas import TS_COL


def time_window(
    transactions: DataFrame, begin: datetime, end: datetime, ts_col: str = TS_COL
) -> DataFrame:
    """Rows with ``begin <= time < end``."""
    return transactions.where((F.col(ts_col) >= ts(begin)) & (F.col(ts_col) < ts(end)))


def lookback_window(
    transactions: DataFrame, observation_date: datetime, days: int, ts_col: str = TS_COL
) -> DataFrame:
    """Rows of the ``days`` before the observation date, which is excluded."""
    return time_window(
        transactions, observation_date - timedelta(days=days), observation_date, ts_col
    )
