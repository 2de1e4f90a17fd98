"""Framed records joined to their schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.functions.frames import frame_body, frame_error, frame_schema_id
from logweave.plans.sizing import small_side


def with_schema(frames: DataFrame, schemas: DataFrame, value: str = "value") -> DataFrame:
    """Add schema_id, schema, body and reject_reason; an unknown id is a reject.

    ``schemas`` has schema_id, schema; it goes to every executor if found small.
    """
    known = small_side(schemas.select(F.col("schema_id").alias("__id"), "schema").distinct())
    joined = (
        frames.withColumn("schema_id", frame_schema_id(value))
        .withColumn("body", frame_body(value))
        .join(known, F.col("schema_id") == F.col("__id"), "left")
    )
    unknown = F.when(F.col("__id").isNull(), F.lit("unknown schema id"))
    return joined.withColumn("reject_reason", F.coalesce(frame_error(value), unknown)).drop("__id")
