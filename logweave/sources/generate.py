"""Generated records, derived from a column of sequence numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions.times import nano_text

# Statuses by sequence modulo 3, amounts, id formats.
STATUSES = ("created", "validated", "ready-for-delivery")
BASE_AMOUNT, AMOUNT_STEP, AMOUNT_CYCLE = 100.0, 25.5, 9
CUSTOMERS = 5
FLOW_PAYLOAD = '{"source":"flow","message":"generated record"}'


def order_messages(numbers: DataFrame, instance: str, sequence: str = "sequence", now: Column | None = None) -> DataFrame:
    """One order message per sequence number, the first being 1."""
    n = F.col(sequence)
    return numbers.select(
        F.format_string("%s-msg-%06d", F.lit(instance), n).alias("message_id"),
        F.format_string("order-%06d", n).alias("order_id"),
        F.format_string("customer-%02d", n % CUSTOMERS + 1).alias("customer_id"),
        F.lit(instance).alias("producer_instance"),
        nano_text(F.current_timestamp() if now is None else now).alias("created_at"),
        F.element_at(F.array(*map(F.lit, STATUSES)), (n % len(STATUSES) + 1).cast("int")).alias("status"),
        (F.lit(BASE_AMOUNT) + (n % AMOUNT_CYCLE) * F.lit(AMOUNT_STEP)).alias("amount"),
    )


def notices(
    numbers: DataFrame,
    source: str,
    message: str = "message #%d",
    sequence: str = "sequence",
    now: Column | None = None,
) -> DataFrame:
    """One notice per sequence number, stamped in whole milliseconds."""
    n = F.col(sequence)
    stamp = F.current_timestamp() if now is None else now
    return numbers.select(
        F.format_string("event-%03d", n).alias("event_id"),
        F.lit(source).alias("source"),
        F.format_string(message, n).alias("message"),
        F.timestamp_millis(F.unix_millis(stamp)).alias("created_at"),
    )


def numbers(spark: SparkSession, count: int) -> DataFrame:
    return spark.range(1, count + 1).withColumnRenamed("id", "sequence")


def number_stream(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """Endless sequence numbers 1, 2, ... at a rate."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return rate.select((F.col("value") + 1).alias("sequence"), "timestamp")


def flow_stream(spark: SparkSession, seconds: int = 10, payload: str = FLOW_PAYLOAD) -> DataFrame:
    """The same payload every ``seconds`` seconds."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.filter(F.col("value") % seconds == 0).select(
        F.lit(payload).alias("value"), "timestamp"
    )
