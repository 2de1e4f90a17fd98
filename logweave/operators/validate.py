"""Record checks; the first one that fails names the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.text import is_blank


def product_error(
    product_id: str = "product_id",
    name: str = "name",
    amount: str = "price.amount",
    store_id: str = "store_id",
) -> Column:
    """Null for a valid product; a zero price is valid."""
    return (
        F.when(is_blank(product_id), F.lit("product_id is required"))
        .when(is_blank(name), F.lit("name is required"))
        .when(F.col(amount) < 0, F.lit("price.amount must not be negative"))
        .when(is_blank(store_id), F.lit("store_id is required"))
    )


def split_valid(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reject_reason``)."""
    judged = df.withColumn("reject_reason", error)
    valid = judged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, judged.filter(F.col("reject_reason").isNotNull())


def deliverable(recipient: str = "recipient_id", sender: str = "sender_id") -> Column:
    """Both ends present; white space counts as present."""
    return (F.coalesce(F.col(recipient), F.lit("")) != "") & (
        F.coalesce(F.col(sender), F.lit("")) != ""
    )


def table_row_error(currency: str = "currency", amount: str = "price_amount") -> Column:
    """What the product table would refuse: long currency codes, too large amounts."""
    return F.when(F.char_length(F.col(currency)) > 3, F.lit("currency is too long")).when(
        F.abs(F.round(F.col(amount).cast("double"), 2)) >= 1e12, F.lit("amount is out of range")
    )
