"""Record schemas of the logs and tables (field names and types are fixed values)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STR, INT, LONG, DBL, TS = StringType(), IntegerType(), LongType(), DoubleType(), TimestampType()


def record(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# One row of an append-only keyed log; the column layout of Spark's log source.
LOG = record(topic=STR, partition=INT, offset=LONG, key=STR, value=STR, timestamp=TS)
LOG_BINARY = record(topic=STR, partition=INT, offset=LONG, key=STR, value=BinaryType(), timestamp=TS)

PRODUCT = record(
    product_id=STR,
    name=STR,
    description=STR,
    price=record(amount=DBL, currency=STR),
    category=STR,
    brand=STR,
    stock=record(available=INT, reserved=INT),
    sku=STR,
    tags=ArrayType(STR),
    images=ArrayType(record(url=STR, alt=STR)),
    specifications=MapType(STR, STR),
    created_at=TS,
    updated_at=TS,
    index=STR,
    store_id=STR,
)
CLIENT_EVENT = record(user_id=STR, request_id=STR, request_type=STR, query=STR, requested_at=TS)
DENY_COMMAND = record(action=STR, product_id=STR, reason=STR, updated_at=TS)
DENY_ENTRY = record(product_id=STR, reason=STR, blocked_at=TS)
DENY_FILE_ROW = record(product_id=STR, reason=STR)
RECOMMENDATION = record(user_id=STR, product_id=STR, product_name=STR, reason=STR, generated_at=TS)
CHAT_MESSAGE = record(message_id=STR, sender_id=STR, recipient_id=STR, text=STR, created_at=STR)
BLOCK_EVENT = record(user_id=STR, blocked_user_id=STR, action=STR, updated_at=STR)
BLOCK_LIST = record(blocked_user_ids=ArrayType(STR), updated_at=STR)
WORDS_UPDATE = record(words=ArrayType(STR), action=STR, updated_at=STR)
WORDS_STATE = record(words=ArrayType(STR), updated_at=STR)
ORDER_MESSAGE = record(
    message_id=STR,
    order_id=STR,
    customer_id=STR,
    producer_instance=STR,
    created_at=STR,
    status=STR,
    amount=DBL,
)
NOTICE = record(event_id=STR, source=STR, message=STR, created_at=TS)
_TEXT_MAP = MapType(STR, STR)
ALERT_PAYLOAD = record(
    status=STR,
    alerts=ArrayType(record(status=STR, labels=_TEXT_MAP, annotations=_TEXT_MAP)),
)

# Tables behind the upsert sinks.
PRODUCT_TABLE = record(
    product_id=STR,
    name=STR,
    description=STR,
    price_amount=DecimalType(14, 2),
    currency=STR,
    category=STR,
    brand=STR,
    available=INT,
    reserved=INT,
    sku=STR,
    store_id=STR,
    data=STR,
    updated_at=TS,
)
REQUEST_TABLE = record(request_id=STR, user_id=STR, request_type=STR, query=STR, requested_at=TS)
USERS_TABLE = record(id=INT, name=STR, email=STR, created_at=TS)
ORDERS_TABLE = record(id=INT, user_id=INT, product_name=STR, quantity=INT, order_date=TS)

# Neutral change record: table, primary key, operation (c, u, d, r), sequence, row as JSON.
CHANGE = record(table=STR, pk=STR, op=STR, seq=LONG, row=STR)
