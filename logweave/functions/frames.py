"""Framed binary records: a zero byte, a 4-byte big-endian schema id, the body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweave.functions.text import col

# Fixed values of the frame layout.
MAGIC = "00"
HEADER_BYTES = 5


def frame_error(frame: Column | str) -> Column:
    """Why a frame is unusable; null when its header is sound."""
    f = col(frame)
    return (
        F.when(f.isNull(), F.lit("no payload"))
        .when(F.octet_length(f) < HEADER_BYTES, F.lit("payload is too short"))
        .when(F.hex(F.substring(f, 1, 1)) != MAGIC, F.lit("unsupported magic byte"))
    )


def frame_schema_id(frame: Column | str) -> Column:
    f = col(frame)
    number = F.conv(F.hex(F.substring(f, 2, 4)), 16, 10).cast("bigint")
    return F.when(frame_error(f).isNull(), number)


def frame_body(frame: Column | str) -> Column:
    f = col(frame)
    rest = F.substring(f, HEADER_BYTES + 1, 2**31 - 1)
    return F.when(frame_error(f).isNull(), rest)


def build_frame(schema_id: Column | str, body: Column | str) -> Column:
    """Frame of a body; null when the id is not positive."""
    number = col(schema_id).cast("bigint")
    head = F.unhex(F.concat(F.lit(MAGIC), F.lpad(F.hex(number), 8, "0")))
    return F.when(number > 0, F.concat(head, col(body)))
