"""The given tables seen as the inputs of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions.times import epoch_micros
from logweave.sources.log import placed

NOUNS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
ADJECTIVES = ("blue", "cold", "hot", "large", "new", "old", "red", "small")
MASKED = ("de", "le", "pa", "th", "the")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(words: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (index + 1).cast("int"))


def noun(index: Column) -> Column:
    return pick(NOUNS, index % 8)


def adjective(index: Column) -> Column:
    return pick(ADJECTIVES, index % 8)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``k`` out of their properties and their time as ``pos`` and ``seq``."""
    raw = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return raw.withColumns(
        {
            "k": F.get_json_object("props", "$.k").cast("int"),
            "pos": epoch_micros("ts"),
            "seq": F.col("event_id"),
        }
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").alias("available"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as full product records."""
    empty = F.lit("")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        empty.alias("description"),
        F.struct(F.col("p_retailprice").alias("amount"), F.lit("RUB").alias("currency")).alias("price"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.struct(F.col("p_size").alias("available"), F.lit(0).alias("reserved")).alias("stock"),
        F.concat(F.lit("sku-"), "p_partkey").alias("sku"),
        F.array(F.col("p_type")).alias("tags"),
        F.array(F.struct(empty.alias("url"), empty.alias("alt"))).alias("images"),
        F.create_map(F.lit("brand"), F.col("p_brand")).alias("specifications"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("updated_at"),
        F.lit("products").alias("index"),
        F.concat(F.lit("store-"), F.col("p_partkey") % 10).alias("store_id"),
    )


def client_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_view = F.col("event_type") == "view"
    return events(spark, sf_dir).select(
        F.col("event_id").alias("request_id"),
        "user_id",
        F.when(is_view, F.lit("search")).otherwise(F.col("event_type")).alias("request_type"),
        F.when(is_view, noun(F.col("k"))).alias("query"),
        F.col("ts").alias("requested_at"),
    )


def deny_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    action = F.when(kind == "signup", F.lit("add")).when(kind == "error", F.lit("remove"))
    return events(spark, sf_dir).select(
        F.col("k").alias("key"),
        F.col("k").alias("product_id"),
        action.otherwise(kind).alias("action"),
        F.concat(F.lit("r"), F.col("event_id") % 10).alias("reason"),
        F.col("pos").alias("updated_at"),
        "pos",
        "seq",
    )


def block_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    action = F.when(kind == "click", F.lit("block")).when(kind == "purchase", F.lit("unblock"))
    user = F.col("user_id").cast("string")
    return events(spark, sf_dir).select(
        user.alias("key"),
        user.alias("user_id"),
        F.col("k").cast("string").alias("blocked_user_id"),
        action.otherwise(kind).alias("action"),
        F.col("event_id").cast("string").alias("updated_at"),
        "pos",
        "seq",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws(" ", adjective(F.col("event_id")), noun(F.col("k")), F.col("event_type"))
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "view")
        .select(
            F.col("event_id").alias("message_id"),
            F.col("user_id").cast("string").alias("recipient_id"),
            F.col("k").cast("string").alias("sender_id"),
            text.alias("text"),
            "pos",
            "seq",
        )
    )


def word_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, n = F.col("event_type"), F.col("event_id")
    action = (
        F.when(n % 500 == 0, F.lit("replace"))
        .when(kind.isin("signup", "click"), F.lit("add"))
        .when(kind == "error", F.lit("remove"))
    )
    return events(spark, sf_dir).select(
        F.when(n % 7 == 0, F.lit("other")).otherwise(F.lit("global")).alias("key"),
        F.array(noun(F.col("k")), adjective(F.col("k") % 5)).alias("words"),
        action.otherwise(kind).alias("action"),
        n.cast("string").alias("updated_at"),
        "pos",
        "seq",
    )


def topic_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log: topic by type, partition by user, dense offsets in event order."""
    rows = events(spark, sf_dir).select(
        F.col("event_type").alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.col("ts").alias("timestamp"),
        "user_id",
        "event_id",
        "k",
    )
    partition = (F.col("user_id") % 3).cast("int")
    return placed(rows, 3, "event_id", partition=partition)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("k") % 3 == 0, F.lit("resolved")).otherwise(F.lit("firing")).alias("status"),
        F.col("event_type").alias("alertname"),
        (F.col("user_id") % 3).cast("string").alias("cluster"),
        F.col("user_id").cast("string").alias("instance"),
        "ts",
        "k",
    )
