"""Declared schemas of the three input tables, and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TS_COL = "created_date"

TRANSACTIONS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField(TS_COL, T.TimestampNTZType()),
        T.StructField("order_id", T.LongType()),
    ]
)
ITEMS = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("brand", T.StringType()),
        T.StructField("age_group", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)
USERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("date_of_birth", T.DateType()),
    ]
)

# Columns each table cannot do without.
REQUIRED = {
    "transactions": ("customer_id", "item_id", TS_COL),
    "items": ("item_id", "brand", "age_group", "category"),
    "users": ("customer_id", "date_of_birth"),
}


class DataSchema:
    """Accessors for the declared schemas."""

    @staticmethod
    def transactions_schema() -> T.StructType:
        return TRANSACTIONS

    @staticmethod
    def items_schema() -> T.StructType:
        return ITEMS

    @staticmethod
    def users_schema() -> T.StructType:
        return USERS


def require_columns(df: DataFrame, columns: tuple[str, ...], table: str = "table") -> None:
    """Raise ``ValueError`` naming the absent columns. Reads the plan, runs no job."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{table}: missing required columns: {', '.join(sorted(absent))}")


def validate_transactions(df: DataFrame) -> None:
    require_columns(df, REQUIRED["transactions"], "transactions")


def validate_items(df: DataFrame) -> None:
    require_columns(df, REQUIRED["items"], "items")


def validate_users(df: DataFrame) -> None:
    require_columns(df, REQUIRED["users"], "users")


def conform(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Project and cast ``df`` to the declared schema.

    Nullable columns that are not required and not present are added as nulls.
    A cast to the type a column already has is removed by the optimizer, so a
    well-typed table keeps its pushed-down filters.
    """
    from pyspark.sql import functions as F

    require_columns(df, REQUIRED[table], table)
    return df.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
