"""One query per operator, over whole tables.

Times leave as whole microseconds and money as rounded doubles, so that any
engine compares them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave import schemas
from logweave.catalogue import inputs as src
from logweave.functions import frames, records, text
from logweave.functions.metric_names import BROKER_RULES, CONNECT_RULES, rename
from logweave.functions.times import epoch_micros, nano_text, stable_request_id
from logweave.operators import alerts as al
from logweave.operators import cdc, filters, keyed, logs, metrics, recommend, search
from logweave.operators import changelog as cl
from logweave.operators.frames import with_schema
from logweave.plans import pieces
from logweave.session import pin, scratch_dir
from logweave.sources import generate, lake, tables
from logweave.sources import log as log_source
from logweave.streaming import jobs, progress, sinks

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
SEQ = ("seq",)


def query(fn: Query) -> Query:
    def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin(spark), sf_dir.rstrip("/"))

    _QUERIES[fn.__name__] = pinned
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- recommendations ----------------------------------------------------------


@query
def q_recs_pruned(spark, sf):
    users = recommend.users_with_query(src.client_events(spark, sf))
    ranked = recommend.recommend(users, src.catalog(spark, sf))
    return recommend.with_labels(ranked, "rank").drop("generated_at")


@query
def q_recommendations(spark, sf):
    """The whole job on files: versions of products and searches as JSON Lines, results as a JSON folder."""
    home = scratch_dir(spark, "recommendations")
    versions = _product_versions(spark, sf)
    lake.write_json(versions.filter("version < 2").drop("version"), f"{home}/products/day=1")
    lake.write_json(versions.filter("version = 2").drop("version"), f"{home}/products/day=2")
    searches = src.client_events(spark, sf).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.format_string("%09d", "request_id").alias("request_id"),
        "request_type",
        F.col("query").substr(F.lit(1), F.lit(1) + F.col("request_id").cast("int") % 5).alias("query"),
        nano_text("requested_at").alias("requested_at"),
    )
    lake.write_json(searches, f"{home}/events")
    products = lake.read_json_lines(spark, f"{home}/products/day=*/part-*", schemas.PRODUCT)
    events = lake.read_json_lines(spark, f"{home}/events", schemas.CLIENT_EVENT)
    found = recommend.recommendations(products, events, now=F.lit("2024-05-06 07:08:09.5").cast("timestamp"))
    lake.write_json(found, f"{home}/out")
    return lake.read_results(spark, f"{home}/out", schemas.RECOMMENDATION).select(
        "user_id", "product_id", "product_name", "reason", epoch_micros("generated_at").alias("generated_us")
    )


def _product_versions(spark, sf):
    """Three versions of every part, the newest in no fixed place; names and stocks differ between them."""
    n = F.col("product_id").cast("bigint")
    each = src.products(spark, sf).withColumn("version", F.explode(F.array(*map(F.lit, range(3)))))
    day = (n + F.col("version")) % 3 + 1
    stamp = F.timestamp_seconds(F.unix_seconds("updated_at") + day * 86_400)
    stock = F.struct(((n * 7 + day * 11) % 40).cast("int").alias("available"), F.lit(0).alias("reserved"))
    return each.withColumns(
        {
            "updated_at": nano_text(stamp),
            "created_at": nano_text("created_at"),
            "stock": stock,
            "name": F.concat("name", F.lit(" v"), day),
        }
    )


@query
def q_latest_product(spark, sf):
    lines = src.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        epoch_micros("l_shipdate").alias("updated_us"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("value"),
    )
    order = ["updated_us", "l_orderkey", "l_linenumber", "value"]
    return keyed.latest(lines, ["product_id"], order)


@query
def q_latest_search(spark, sf):
    return recommend.latest_searches(src.client_events(spark, sf))


@query
def q_users(spark, sf):
    return recommend.users_with_query(src.client_events(spark, sf))


@query
def q_search(spark, sf):
    stored = keyed.product_rows(src.products(spark, sf))
    found = search.search_products(stored, " R_d R ")
    return found.select("product_id", "name", F.col("price_amount").cast("double").alias("price"))


@query
def q_user_recs(spark, sf):
    stored = src.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("product_id"),
        F.col("o_orderdate").alias("generated_at"),
    )
    found = search.user_recommendations(stored, 7)
    return found.select("user_id", "product_id", epoch_micros("generated_at").alias("generated_us"))


# --- decoding and validation --------------------------------------------------


def _mutated_lines(spark, sf):
    n = F.col("n")
    broken = src.products(spark, sf).withColumn("n", F.col("product_id").cast("bigint"))
    broken = (
        broken.withColumn("product_id", F.when(n % 17 == 0, F.lit(" ")).otherwise(F.col("product_id")))
        .withColumn("name", F.when(n % 19 == 0, F.lit("")).otherwise(F.col("name")))
        .withColumn(
            "price",
            F.col("price").withField(
                "amount", F.when(n % 13 == 0, F.lit(-1.0)).otherwise(F.col("price.amount"))
            ),
        )
        .withColumn("store_id", F.when(n % 11 == 0, F.lit("\t")).otherwise(F.col("store_id")))
    )
    line = F.to_json(F.struct(*schemas.PRODUCT.names))
    return broken.select(
        n,
        F.when(n % 23 == 0, F.lit('{"product_id": 5}'))
        .when(n % 29 == 0, F.lit("no json"))
        .when(n % 31 == 0, F.lit("  "))
        .otherwise(line)
        .alias("value"),
    )


@query
def q_validate(spark, sf):
    judged = lake.product_lines(_mutated_lines(spark, sf), on_error="raw")
    return judged.select(
        "n",
        F.col("record.product_id").alias("product_id"),
        F.col("record.price.amount").alias("amount"),
        F.coalesce("reject_reason", F.lit("ok")).alias("verdict"),
    )


def _product_files(spark, sf):
    """The broken product lines as text, in three folders by ``n % 3`` and in order of ``n``."""
    home = scratch_dir(spark, "product-files")
    lines = _mutated_lines(spark, sf).withColumn("part", F.col("n") % 3)
    spread = lines.repartition("part").sortWithinPartitions("part", "n")
    spread.select("value", "part").write.partitionBy("part").text(home)
    return home


def _part_of(file):
    return F.regexp_extract(file, r"/part=(\d+)/", 1).cast("int").alias("part")


@query
def q_product_file(spark, sf):
    """Product lines read from files, each with the number of its line; blank lines count."""
    judged = lake.read_products(spark, _product_files(spark, sf), "raw")
    verdict = F.coalesce("reject_reason", F.lit("ok")).alias("verdict")
    return judged.select(_part_of("file"), "line", "record.product_id", verdict)


@query
def q_product_stop(spark, sf):
    """The scan that stops at the first bad line of a file, and says which; earlier lines are kept."""
    kept, bad = lake.read_products(spark, _product_files(spark, sf), "stop")
    told = kept.select(_part_of("file"), "line", "record.product_id", F.lit("ok").alias("verdict"))
    return told.unionByName(
        bad.select(_part_of("file"), "line", F.lit(None).cast("string").alias("product_id"), F.col("reject_reason").alias("verdict"))
    )


@query
def q_deny_file(spark, sf):
    """A control file, one JSON array over several lines, as commands; products it names are left out."""
    home = scratch_dir(spark, "deny-file")
    listed = cl.deny_list(src.deny_commands(spark, sf), order=SEQ)
    row = F.struct(F.col("product_id").cast("string").alias("product_id"), "reason")
    # As long as a control file is: one row per denied product.
    text = listed.agg(F.array_join(F.transform(F.collect_list(row), lambda r: F.to_json(r)), ",\n").alias("rows"))
    lines = text.select(F.concat(F.lit("[\n"), "rows", F.lit("\n]")).alias("value"))
    lines.coalesce(1).write.text(home)
    commands = lake.read_deny_file(spark, home).withColumns({"key": F.col("product_id"), "offset": F.lit(0)})
    products = src.products(spark, sf).withColumn("key", (F.col("product_id") % 100).cast("string"))
    return filters.deny_filter(products, commands).select("product_id", "key")


@query
def q_chat_file(spark, sf):
    """Keyed text lines with comments and blank lines between them, decoded with their line numbers."""
    home = scratch_dir(spark, "chat-file")
    value = F.to_json(F.struct("message_id", "sender_id", "recipient_id", "text"))
    rows = src.messages(spark, sf).withColumn("message_id", F.col("message_id").cast("string"))
    line = F.concat_ws("\t", "recipient_id", value)
    three = F.array(F.concat(F.lit("# "), "seq"), line, F.lit(" "))
    lines = rows.select("seq", F.posexplode(three).alias("at", "value"))
    # One text in as many files as tasks wrote it, their names in its order.
    lines.orderBy("seq", "at").select("value").write.text(home)
    read = lake.read_keyed_text(spark, home, one_log=True)
    decoded = records.apply_policy(records.decode(read, schemas.CHAT_MESSAGE), "fail")
    return decoded.select("key", F.col("row_order").alias("line"), "record.message_id", "record.sender_id", "record.text")


@query
def q_archive_ready(spark, sf):
    """The archive written in two runs, and which data sets have files; their lines as one log again."""
    home = scratch_dir(spark, "archive")
    log = _named_log(spark, sf)
    lake.write_archive(log.filter("k % 2 = 0"), home)
    lake.write_archive(log.filter("k % 2 = 1"), home)
    wanted = ["client-events", "products", "unknown", "nothing"]
    ready = logs.ready(lake.archive_files(spark, home), wanted).select("dataset", "ready")
    lake.write_lines(log.filter("topic = 'client.events'"), f"{home}-lines")
    lake.write_lines(log.filter("topic = 'products.filtered'"), f"{home}-lines")
    lines = spark.read.text(f"{home}-lines").select(F.count(F.lit(1)).alias("lines"))
    counts = spark.read.text(home).groupBy("dataset").agg(F.count(F.lit(1)).alias("rows"))
    return ready.join(counts, "dataset", "left").join(F.broadcast(lines))


@query
def q_json_roundtrip(spark, sf):
    events = src.client_events(spark, sf).select(
        F.col("request_id").alias("n"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("request_id").cast("string").alias("request_id"),
        "request_type",
        "query",
        nano_text("requested_at").alias("requested_at"),
    )
    value = records.encode("user_id", "request_id", "request_type", "query", "requested_at")
    decoded = records.decode(events.select("n", value.alias("value")), schemas.CLIENT_EVENT)
    good = records.apply_policy(decoded, "fail")
    return good.select(
        "n",
        "record.user_id",
        "record.request_type",
        "record.query",
        epoch_micros("record.requested_at").alias("requested_us"),
    )


@query
def q_normalize(spark, sf):
    padded = F.concat(F.lit(" \t "), F.upper("source"), F.lit("\n　"))
    listed = F.concat_ws(",", F.lit(" a"), F.lit(" "), F.col("lang"), F.lit(""), padded)
    return src.table(spark, sf, "documents").select(
        "doc_id",
        text.normal_word(padded).alias("word"),
        F.concat_ws("|", text.csv_items(listed)).alias("items"),
    )


@query
def q_array_sets(spark, sf):
    k = F.col("k")
    base = F.array(src.noun(k), src.adjective(k), src.noun(k), F.lit(""))
    extra = F.array(F.concat(F.lit(" "), src.noun(k + 1), F.lit("\t")), F.lit(" "), src.adjective(k))
    return src.events(spark, sf).select(
        "event_id",
        F.concat_ws("|", text.add_items(base, extra)).alias("added"),
        F.concat_ws("|", text.remove_items(base, extra)).alias("removed"),
        text.contains_item(base, src.noun(k + 2)).alias("held"),
    )


# --- denylist -----------------------------------------------------------------


@query
def q_deny_state(spark, sf):
    return cl.deny_state(src.deny_commands(spark, sf), order=SEQ).select(
        "product_id", "reason", "blocked_at"
    )


@query
def q_deny_list(spark, sf):
    return cl.deny_list(src.deny_commands(spark, sf), order=SEQ)


@query
def q_deny_reason(spark, sf):
    """Commands without a reason or a time get the operator's reason and their log time."""
    commands = src.deny_commands(spark, sf)
    n = F.col("seq")
    rows = commands.withColumns(
        {
            "reason": F.when(n % 3 == 0, F.lit("")).when(n % 3 == 1, F.lit(None)).otherwise(F.col("reason")),
            "updated_at": F.when(n % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("t"), n)),
            "timestamp": F.timestamp_micros("pos"),
        }
    )
    filled = cl.with_default_reason(cl.with_log_time(rows))
    return filled.select("seq", "action", "reason", "updated_at")


@query
def q_deny_filter(spark, sf):
    lines = src.table(spark, sf, "lineitem").select(
        (F.col("l_partkey") % 100).cast("int").alias("key"), "l_partkey", "l_orderkey", "l_linenumber"
    )
    kept = filters.deny_filter(lines, src.deny_commands(spark, sf), order=SEQ)
    return kept.select("l_partkey", "l_orderkey", "l_linenumber")


@query
def q_deny_asof(spark, sf):
    views = src.events(spark, sf).filter(F.col("event_type") == "view")
    data = views.select(F.col("k").alias("key"), "event_id", "pos", "seq")
    return filters.deny_filter_as_of(data, src.deny_commands(spark, sf)).select("event_id", "key")


# --- chat ---------------------------------------------------------------------


@query
def q_block_state(spark, sf):
    lists = cl.block_lists(src.block_events(spark, sf), order=SEQ)
    return lists.select(
        "user",
        "updated_at",
        F.concat_ws(",", "blocked_user_ids").alias("blocked"),
    )


@query
def q_block_rows(spark, sf):
    """The block lists as they are stored, one row per user and blocked id."""
    return cl.block_pairs(src.block_events(spark, sf), order=SEQ)


@query
def q_word_rows(spark, sf):
    """The word lists as they are stored, one row per key and word in force."""
    return cl.active_words(src.word_updates(spark, sf), order=SEQ)


@query
def q_block_pages(spark, sf):
    """The lists of long keys on pages of at most about seven, each sorted, together the whole list."""
    lists = cl.block_lists(src.block_events(spark, sf), order=SEQ, page_items=7)
    each = lists.select("user", "pages", F.explode_outer("blocked_user_ids").alias("blocked"))
    sorted_pages = lists.groupBy("user").agg(F.bool_and(F.expr("blocked_user_ids = array_sort(blocked_user_ids)")).alias("sorted"))
    return each.join(sorted_pages, "user").select("user", "blocked", "sorted")


@query
def q_block_filter(spark, sf):
    kept = filters.block_filter(src.messages(spark, sf), src.block_events(spark, sf), order=SEQ)
    return kept.select("message_id", "recipient_id", "sender_id")


@query
def q_block_asof(spark, sf):
    kept = filters.block_filter_as_of(src.messages(spark, sf), src.block_events(spark, sf))
    return kept.select("message_id", "recipient_id", "sender_id")


@query
def q_word_state(spark, sf):
    lists = cl.word_lists(src.word_updates(spark, sf), order=SEQ)
    return lists.select("key", "updated_at", F.concat_ws(",", "words").alias("words"))


@query
def q_mask(spark, sf):
    docs = src.table(spark, sf, "documents")
    return docs.select("doc_id", text.mask_with("text", src.MASKED).alias("text"))


@query
def q_mask_turns(spark, sf):
    turns = src.table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", text.mask_with("text", src.MASKED).alias("text"))


def _long_words(spark, sf):
    found = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{8,})"), F.lit(1))
    return src.table(spark, sf, "benchmark").select(F.explode(found).alias("word")).distinct()


@query
def q_mask_listed(spark, sf):
    """A word list looked up within each row: the long words of ``benchmark``."""
    docs = src.table(spark, sf, "documents").select("doc_id", "text")
    return filters.mask_snapshot(docs, _long_words(spark, sf), id_col="doc_id", chain_words=0)


@query
def q_mask_lookup(spark, sf):
    """The same list treated as too long for a row: joined to the texts by run."""
    docs = src.table(spark, sf, "documents").select("doc_id", "text")
    words = _long_words(spark, sf)
    return filters.mask_snapshot(docs, words, id_col="doc_id", chain_words=0, listed_words=0)


@query
def q_mask_join(spark, sf):
    masked = filters.censor(src.messages(spark, sf), src.word_updates(spark, sf), order=SEQ)
    return masked.select("message_id", "recipient_id", "text")


@query
def q_mask_asof(spark, sf):
    masked = filters.mask_as_of(src.messages(spark, sf), src.word_updates(spark, sf))
    return masked.select("message_id", "text")


@query
def q_chat(spark, sf):
    delivered = filters.chat(
        src.messages(spark, sf), src.block_events(spark, sf), src.word_updates(spark, sf)
    )
    return delivered.select("message_id", "recipient_id", "sender_id", "text")


# --- tables by key ------------------------------------------------------------


@query
def q_upsert_products(spark, sf):
    """Line items arriving as product records: the last arrival of each part replaces it."""
    target = keyed.product_rows(src.products(spark, sf))
    part = F.col("l_partkey").cast("string")
    lines = src.table(spark, sf, "lineitem").select(
        part.alias("product_id"),
        F.concat(F.lit("part "), part).alias("name"),
        *[F.lit("").alias(c) for c in ("description", "category", "brand")],
        F.struct(F.col("l_extendedprice").alias("amount"), F.lit("RUB").alias("currency")).alias("price"),
        F.struct(
            F.col("l_quantity").cast("int").alias("available"), F.lit(1).alias("reserved")
        ).alias("stock"),
        F.concat(F.lit("sku-"), part).alias("sku"),
        F.lit("").alias("store_id"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
        "l_orderkey",
        "l_linenumber",
    )
    order = ["l_orderkey", "l_linenumber", "price.amount"]
    stored = keyed.upsert(target, lines, ["product_id"], order, keyed.product_rows)
    return stored.select(
        "product_id",
        "name",
        F.col("price_amount").cast("double").alias("price"),
        "available",
        "reserved",
        F.get_json_object("data", "$.sku").alias("data_sku"),
        epoch_micros("updated_at").alias("updated_us"),
    )


def _by_user_and_k(spark, sf, kind):
    rows = src.events(spark, sf).filter(F.col("event_type") == kind)
    return rows.select("user_id", F.col("k").alias("product_id"), F.lit(kind).alias("reason"), "seq")


@query
def q_upsert_recs(spark, sf):
    keys = ["user_id", "product_id"]
    target = keyed.latest(_by_user_and_k(spark, sf, "purchase"), keys, SEQ)
    return keyed.upsert(target, _by_user_and_k(spark, sf, "view"), keys, SEQ)


@query
def q_insert_ignore(spark, sf):
    keys = ["user_id", "product_id"]
    target = keyed.first(_by_user_and_k(spark, sf, "purchase"), keys, SEQ)
    return keyed.insert_ignore(target, _by_user_and_k(spark, sf, "view"), keys, SEQ)


@query
def q_table_rows(spark, sf):
    """Product rows the table would refuse are told apart before they are merged."""
    n = F.col("product_id").cast("bigint")
    odd = src.products(spark, sf).withColumn(
        "price",
        F.struct(
            F.when(n % 7 == 0, F.lit(999999999999.995)).otherwise(F.col("price.amount")).alias("amount"),
            F.when(n % 5 == 0, F.lit("RUBL")).otherwise(F.lit("RUB")).alias("currency"),
        ),
    )
    kept, refused = keyed.storable_products(odd)
    return kept.select("product_id", F.lit("stored").alias("verdict")).unionByName(
        refused.select("product_id", F.col("reject_reason").alias("verdict"))
    )


@query
def q_request_ids(spark, sf):
    """Ids that repeat when the same record is replayed."""
    rows = src.client_events(spark, sf).select("request_id", "user_id", "request_type")
    return rows.select("request_id", stable_request_id("user_id", "request_type").alias("stable_id"))


@query
def q_compact(spark, sf):
    log = src.topic_log(spark, sf).select("topic", "key", "value", "offset", "event_id")
    return keyed.compact(log)


def _gappy_log(spark, sf):
    """The log with null topics, times and values in it."""
    n = F.col("event_id")
    return src.topic_log(spark, sf).withColumns(
        {
            "topic": F.when(F.col("topic") != "error", F.col("topic")),
            "timestamp": F.when(n % 19 != 0, F.col("timestamp")),
            "value": F.when(n % 7 != 0, F.col("value")),
        }
    )


@query
def q_retention(spark, sf):
    return keyed.retain_recent(_gappy_log(spark, sf)).select("topic", "partition", "offset", "event_id")


@query
def q_retain_bytes(spark, sf):
    kept = keyed.retain_bytes(_gappy_log(spark, sf), limit=1000)
    return kept.select("topic", "partition", "offset", "event_id")


# --- logs ---------------------------------------------------------------------


def _named_log(spark, sf):
    kind = F.col("topic")
    name = F.when(kind == "view", F.lit("products.filtered")).when(
        kind == "click", F.lit("client.events")
    )
    return src.topic_log(spark, sf).withColumn("topic", name.otherwise(kind))


@query
def q_archive(spark, sf):
    log = _named_log(spark, sf)
    both = logs.merged(log, logs.mirror(log))
    return both.select(
        "event_id", "topic", logs.archive_folder("topic").alias("dataset"), "value"
    )


@query
def q_mirror(spark, sf):
    return logs.mirror(_named_log(spark, sf)).select("topic", "partition", "offset", "key", "event_id")


@query
def q_publish(spark, sf):
    recs = src.events(spark, sf).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("k") % 10 != 0, F.col("k").cast("string")).alias("product_id"),
        F.col("event_type").alias("product_name"),
        F.when(F.col("k") % 2 == 0, F.lit("")).otherwise(F.lit("odd")).alias("reason"),
    )
    return logs.keyed_json(recs, "recommendations", omit_empty=("reason",))


@query
def q_first_records(spark, sf):
    """A reader that stops after so many records, which is what is asked of it."""
    first = logs.first_records(src.topic_log(spark, sf), 500)
    return first.select("topic", "partition", "offset", "event_id")


@query
def q_counted(spark, sf):
    """Rows written, and how many they were as the write itself counted them."""
    home = scratch_dir(spark, "counted")
    rows, seen = logs.counted(src.topic_log(spark, sf).select("topic", "event_id"), "written")
    rows.write.parquet(home)
    told = F.lit(seen.get["rows"]).cast("bigint").alias("counted")
    return spark.read.schema("topic string, event_id bigint").parquet(home).groupBy("topic").agg(
        F.count(F.lit(1)).alias("rows")
    ).withColumn("counted", told)


@query
def q_topic_offsets(spark, sf):
    return logs.topic_offsets(src.topic_log(spark, sf))


@query
def q_lag(spark, sf):
    log = src.topic_log(spark, sf)
    seen = log.filter((F.col("k") < 50) & ((F.col("partition") < 2) | (F.col("topic") != "view")))
    commits = seen.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("committed"))
    return logs.consumer_lag(log, commits.withColumn("group", F.lit("readers")))


@query
def q_batch_gate(spark, sf):
    log = src.topic_log(spark, sf)
    return logs.batch_gate(log, F.col("k") % 37 == 0, size=10)


# --- change data capture, frames ----------------------------------------------


@query
def q_cdc_decode(spark, sf):
    value = F.when(F.col("k") % 9 == 0, F.concat(F.lit("raw "), "k")).otherwise(F.col("value"))
    view = cdc.event_view(src.topic_log(spark, sf).withColumn("value", value))
    return view.select(
        "topic",
        "partition",
        "offset",
        "key",
        "is_json",
        "shown",
    )


def _changes(spark, sf):
    log = src.topic_log(spark, sf).withColumn("topic", F.concat(F.lit("shop.public."), "topic"))
    op = F.when(F.col("k") % 10 == 0, F.lit(cdc.DELETE)).when(F.col("k") % 10 < 5, F.lit(cdc.UPDATE))
    return cdc.changes(
        cdc.captured(log, ("public.signup", "public.purchase")),
        {
            "table": "table",
            "pk": "key",
            "op": op.otherwise(F.lit(cdc.CREATE)),
            "seq": "event_id",
            "row": "value",
        },
    )


@query
def q_cdc_state(spark, sf):
    return cdc.current_rows(_changes(spark, sf))


@query
def q_fk_check(spark, sf):
    parents = src.table(spark, sf, "supplier").filter(F.col("s_acctbal") > 0)
    bad = cdc.broken_references(src.table(spark, sf, "lineitem"), parents, "l_suppkey", "s_suppkey")
    return bad.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("rows"))


@query
def q_frame_schema(spark, sf):
    n = F.col("event_id")
    whole = frames.build_frame(F.col("k") % 7, F.col("props").cast("binary"))
    value = F.when(n % 11 == 0, F.concat(F.unhex(F.lit("01")), F.substr(whole, F.lit(2))))
    value = value.when(n % 13 == 0, F.substring(whole, 1, 3)).otherwise(whole)
    rows = src.events(spark, sf).select("event_id", value.alias("value"))
    known = src.table(spark, sf, "nation").filter(F.col("n_nationkey") < 6).select(
        F.col("n_nationkey").cast("bigint").alias("schema_id"), F.col("n_name").alias("schema")
    )
    return with_schema(rows, known).select(
        "event_id",
        "schema_id",
        "schema",
        F.col("body").cast("string").alias("body"),
        F.coalesce("reject_reason", F.lit("ok")).alias("verdict"),
    )


@query
def q_pretty_records(spark, sf):
    """Typed records as indented JSON."""
    rows = src.client_events(spark, sf).select("request_id", "request_type", "query")
    record = F.struct("request_type", "query")
    return rows.select("request_id", records.pretty_record(record).alias("shown"))


@query
def q_framed_notices(spark, sf):
    """Notices as framed records with JSON bodies, there and back by way of their schema id."""
    rows = src.events(spark, sf).withColumn("sequence", F.col("event_id") - 500)
    made = generate.notices(rows, "events", "text é %d", now=F.col("ts"))
    body = records.encode("event_id", "source", "message", nano_text("created_at").alias("created_at"))
    framed = made.select("event_id", frames.build_frame(F.lit(17), F.encode(body, "UTF-8")).alias("value"))
    known = src.table(spark, sf, "nation").select(F.col("n_nationkey").alias("schema_id"), F.col("n_name").alias("schema"))
    read = with_schema(framed, known).select("event_id", F.decode("body", "UTF-8").alias("value"))
    decoded = records.apply_policy(records.decode(read, schemas.NOTICE), "fail")
    return decoded.select(
        "event_id",
        F.col("record.event_id").alias("decoded_id"),
        "record.source",
        "record.message",
        F.unix_millis("record.created_at").alias("created_ms"),
    )


# --- metrics and alerts -------------------------------------------------------


@query
def q_metric_names(spark, sf):
    kind, user, k = F.col("event_type"), F.col("user_id"), F.col("k")
    broker = F.concat(F.lit("kafka.server<type="), F.initcap(kind), F.lit(", name="), src.noun(k))
    attribute = (
        F.when(k % 6 == 0, F.concat(broker, F.lit("InPerSec><>Count")))
        .when(k % 6 == 1, F.concat(broker, F.lit("><>Value")))
        .when(
            k % 6 == 2,
            F.concat(
                F.lit("kafka.connect<type=task-error-metrics, connector="),
                kind,
                F.lit(", task="),
                user,
                F.lit("><>total-errors"),
            ),
        )
        .when(
            k % 6 == 3,
            F.concat(
                F.lit("kafka.consumer<type=consumer-fetch-manager-metrics, client-id="),
                kind,
                F.lit(", topic=t-"),
                user,
                F.lit(", partition=0><>records-lag"),
            ),
        )
        .when(
            k % 6 == 4,
            F.concat(F.lit("kafka.connect<type=app-info, client-id="), kind, F.lit("><>version")),
        )
        .otherwise(F.lit("java.lang<type=Memory><>used"))
    )
    value = F.when(k % 6 == 4, F.lit("4.1.2")).otherwise(F.col("value").cast("string"))
    rows = src.events(spark, sf).select("event_id", attribute.alias("attribute"), value.alias("value"))
    named = rename(rows, BROKER_RULES + CONNECT_RULES)
    entries = F.transform(
        F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return named.select(
        "event_id",
        "metric",
        "kind",
        F.concat_ws(",", entries).alias("labels"),
        F.round("metric_value", 4).alias("metric_value"),
    )


def _counters(spark, sf, jumps=False):
    """A counter per event type that starts anew every thousand events.

    Some samples are NaN, and on demand some jump to a number beside which all others vanish.
    """
    n = F.col("event_id")
    rows = src.events(spark, sf).select(
        "event_type",
        "event_id",
        "user_id",
        "ts",
        F.floor(n / 1000).alias("era"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )
    split = pieces.cut(rows, ["event_type", "era"], "event_id")
    total = split.running_total(["event_id"], "cents", "counter").rows()
    shown = F.when(n % 97 == 0, F.lit(float("nan"))).when((n % 1009 == 0) & F.lit(jumps), F.lit(1e17))
    return total.withColumn("counter", shown.otherwise(F.col("counter").cast("double")))


def _to(seconds):
    """Times that many rows share."""
    return F.timestamp_seconds(F.floor(F.unix_seconds("ts") / seconds) * seconds)


@query
def q_metric_rate(spark, sf):
    counters = _counters(spark, sf, jumps=True).withColumn("ts", _to(1800))
    rates = metrics.counter_rate(counters, ["event_type"], "ts", "counter", 3600, order=("event_id",))
    return rates.select("event_type", "event_id", F.round("rate", 4).alias("rate"))


@query
def q_metric_sum(spark, sf):
    rates = metrics.counter_rate(_counters(spark, sf), ["event_type"], "ts", "counter", 3600)
    hourly = rates.withColumn("hour", F.floor(epoch_micros("ts") / 3_600_000_000))
    summed = metrics.sum_by(hourly, ["hour"], "rate", "rate")
    return summed.select("hour", F.round("rate", 4).alias("rate"))


@query
def q_metric_cluster(spark, sf):
    """The newest rate of every series, summed per cluster."""
    labelled = _counters(spark, sf).withColumn("cluster", F.concat(F.lit("c"), F.col("user_id") % 4))
    rates = metrics.counter_rate(labelled, ["event_type", "cluster"], "ts", "counter", 86400)
    newest = rates.groupBy("event_type", "cluster").agg(F.max_by("rate", F.struct("ts", "event_id")).alias("rate"))
    return metrics.sum_by(newest, ["cluster"], "rate", "rate").select("cluster", F.round("rate", 4).alias("rate"))


@query
def q_metric_latest(spark, sf):
    samples = src.events(spark, sf).select(
        F.col("event_type").alias("metric"),
        F.create_map(
            F.lit("user"),
            (F.col("user_id") % 10).cast("string"),
            F.lit("cluster"),
            (F.col("k") % 3).cast("string"),
        ).alias("labels"),
        _to(86400).alias("ts"),
        "value",
        "event_id",
    )
    newest = metrics.current_values(samples, order=("event_id",))
    return newest.select(
        "metric",
        F.col("labels")["user"].alias("user"),
        F.col("labels")["cluster"].alias("cluster"),
        "value",
        epoch_micros("ts").alias("at_us"),
    )


@query
def q_connectors(spark, sf):
    """How many tasks of each of three connectors run, by the newest sample of every task."""
    labels = F.create_map(
        F.lit("connector"), F.concat(F.lit("c"), F.col("k") % 3),
        F.lit("task"), (F.col("user_id") % 20).cast("string"),
        F.lit("status"), F.when(F.col("k") % 2 == 0, F.lit("running")).otherwise(F.lit("failed")),
    )
    samples = src.events(spark, sf).select(
        F.lit("kafka_connect_connector_status").alias("metric"), labels.alias("labels"), "ts",
        (F.col("event_id") % 2).cast("double").alias("value"),
    )
    found = None
    for name in ("c0", "c1", "c2"):
        one = metrics.running_connectors(samples, name).select(F.lit(name).alias("connector"), "running")
        found = one if found is None else found.unionByName(one)
    return found


@query
def q_alert_for(spark, sf):
    samples = src.events(spark, sf).select("event_id", "event_type", _to(7200).alias("ts"), "value")
    down = metrics.held(samples, ["event_type"], F.col("value") < 30, 3600, order=("event_id",))
    return down.select("event_id", "since_us", "firing")


@query
def q_alerts_flat(spark, sf):
    k = F.col("k")
    labels = F.when(
        k % 5 != 0, F.create_map(F.lit("alertname"), F.col("alertname"), F.lit("instance"), F.col("instance"))
    ).otherwise(F.create_map(F.lit("alertname"), F.col("alertname"), F.lit("cluster"), F.col("cluster")))
    one = F.struct(
        "status", labels.alias("labels"), F.create_map(F.lit("summary"), src.noun(k)).alias("annotations")
    )
    payload = F.to_json(F.struct("status", F.array(one, one.withField("status", F.lit("firing"))).alias("alerts")))
    value = F.when(k % 17 == 0, F.lit("not-json")).otherwise(payload)
    flat = al.flatten(src.alerts(spark, sf).select("event_id", value.alias("value")))
    return flat.select(
        "event_id",
        F.col("reject_reason").isNotNull().alias("rejected"),
        "status",
        "alertname",
        "instance",
        "cluster",
        "summary",
    )


@query
def q_alert_groups(spark, sf):
    found = al.groups(src.alerts(spark, sf))
    return found.select(
        "alertname",
        "cluster",
        epoch_micros("first_ts").alias("first_us"),
        epoch_micros("last_ts").alias("last_us"),
        "alerts",
        "firing",
        "resolved",
        "instances",
    )


@query
def q_alert_changes(spark, sf):
    alerts = src.alerts(spark, sf).withColumn("ts", _to(86400))
    return al.status_changes(alerts, order=("event_id",)).select("event_id", "status", "was")


@query
def q_alert_repeats(spark, sf):
    """Changes of a group's status told at once, and repeats an hour or more after the last notice."""
    told = al.notices(src.alerts(spark, sf), order=("event_id",))
    return told.select("event_id", "alertname", "cluster", "status", "changed")


# --- generators ---------------------------------------------------------------


@query
def q_gen_orders(spark, sf):
    rows = src.table(spark, sf, "orders").select(
        (F.col("o_orderkey") + 1).alias("sequence"), F.col("o_orderdate").cast("timestamp").alias("at")
    )
    return generate.order_messages(rows, "i1", now=F.col("at"))


@query
def q_gen_events(spark, sf):
    rows = src.events(spark, sf).withColumn("sequence", F.col("event_id") + 1)
    made = generate.notices(rows, "events", now=F.col("ts"))
    return made.select("event_id", "source", "message", F.unix_millis("created_at").alias("created_ms"))


# --- streams ------------------------------------------------------------------


def _in_turn(rows, turn, path, stream):
    """Rows written once, by ``turn`` (an int column), and streamed one turn after the other.

    ``stream`` starts a query that reads ``path``; a turn becomes one micro-batch, in as
    many files as tasks wrote it: its folder is moved there when its turn has come.
    """
    waiting = f"{path}-waiting"
    rows.withColumn("__turn", turn).write.partitionBy("__turn").parquet(waiting)
    turns = rows.sparkSession.read.parquet(waiting).select("__turn").distinct().orderBy("__turn").collect()
    for found in turns:
        lake.move_folder(rows.sparkSession, f"{waiting}/__turn={found[0]}", f"{path}/turn={found[0]}")
        stream().awaitTermination()


def _range_of(rows, position, parts):
    """Which of ``parts`` ranges of a bigint ``position`` a row is in; rows without one are in the first."""
    shares = F.array(*(F.lit(k / parts) for k in range(1, parts)))
    found = rows.agg(F.percentile_approx(position, shares, F.lit(10_000))).first()[0] or []
    at = F.lit(0)
    for end in sorted(set(found)):
        at = at + F.when(position > F.lit(end), 1).otherwise(0)
    return at


def _stream_log(spark, sf):
    """The mixed log of the product filter."""
    rows = src.events(spark, sf)
    kind = F.col("event_type")
    product = F.to_json(F.struct(F.col("k").cast("string").alias("product_id"), kind.alias("name")))
    command = F.to_json(
        F.struct(
            F.when(kind == "signup", F.lit("add"))
            .when(kind == "error", F.lit("remove"))
            .otherwise(kind)
            .alias("action"),
            F.col("k").cast("string").alias("product_id"),
        )
    )
    is_view = kind == "view"
    return rows.select(
        F.when(is_view, F.lit("products.raw")).otherwise(F.lit("blacklist.commands")).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("k").cast("string").alias("key"),
        F.when(is_view, product).otherwise(command).alias("value"),
        F.col("ts").alias("timestamp"),
    )


@query
def q_stream_deny(spark, sf):
    """The denylist filter as a stream that decides every record at once; no row is held back."""
    home = scratch_dir(spark, "stream-deny")
    writer = jobs.filter_products_writer(f"{home}/out", f"{home}/state")

    def stream():
        log = log_source.read_log(spark, f"{home}/log", stream=True)
        return sinks.run(log, f"{home}/checkpoint", writer=writer)

    log = _stream_log(spark, sf)
    _in_turn(log, _range_of(log, epoch_micros("timestamp"), 4), f"{home}/log", stream)
    kept = "key string, value string, timestamp timestamp, seq long"
    return spark.read.schema(kept).parquet(f"{home}/out").select(
        F.col("seq").alias("event_id"), F.col("key").cast("int").alias("key")
    )


LATE_TURNS, LATE_EVERY, LATE_DELAY = 4, 13, "1 hour"


@query
def q_stream_late(spark, sf):
    """The denylist filter with a delay: rows that come a turn too late are told apart, none is lost.

    A last turn with nothing but a closing row lets go of what the delay still holds.
    """
    home = scratch_dir(spark, "stream-late")
    log = _stream_log(spark, sf).withColumn("key", F.concat("key", F.lit("-"), F.col("offset") % 3))
    rows = log.agg(F.max("offset")).first()[0] + 1
    own = F.floor(F.col("offset") * LATE_TURNS / rows).cast("int")
    turn = own + ((F.col("offset") % LATE_EVERY == 0) & (own < LATE_TURNS - 1)).cast("int")
    last = jobs.closing_rows(log, LATE_DELAY).withColumn("turn", F.lit(LATE_TURNS))
    schema = None

    def stream():
        nonlocal schema
        judged = jobs.judged_products(log_source.read_log(spark, f"{home}/log", stream=True), delay=LATE_DELAY, salts=2)
        schema = judged.schema
        return sinks.run(judged, f"{home}/checkpoint", f"{home}/out")

    _in_turn(log.withColumn("turn", turn).unionByName(last), F.col("turn"), f"{home}/log", stream)
    return spark.read.schema(schema).parquet(f"{home}/out").select(
        F.col("seq").alias("event_id"), "key", "late", "denied"
    )


@query
def q_stream_chat(spark, sf):
    """The chat as one chained stream, its log cut into four micro-batches."""
    home = scratch_dir(spark, "stream-chat")
    keyed_rows = {
        "messages": (src.messages(spark, sf), "recipient_id", ("message_id", "sender_id", "recipient_id", "text")),
        "blocked_users": (src.block_events(spark, sf), "key", ("user_id", "blocked_user_id", "action")),
        "banned_words": (src.word_updates(spark, sf), "key", ("words", "action")),
    }
    log = None
    for topic, (rows, key, fields) in keyed_rows.items():
        record = F.to_json(F.struct(*(F.col(f).cast("string").alias(f) if f == "message_id" else F.col(f) for f in fields)))
        part = rows.select(
            F.lit(topic).alias("topic"),
            F.lit(0).alias("partition"),
            F.col("seq").alias("offset"),
            F.col(key).alias("key"),
            record.alias("value"),
            F.timestamp_micros("pos").alias("timestamp"),
        )
        log = part if log is None else log.unionByName(part)
    writer = jobs.chat_writer(f"{home}/out", f"{home}/state")

    def stream():
        return sinks.run(log_source.read_log(spark, f"{home}/log", stream=True), f"{home}/checkpoint", writer=writer)

    _in_turn(log, _range_of(log, epoch_micros("timestamp"), 4), f"{home}/log", stream)
    out = "message_id string, recipient_id string, sender_id string, text string"
    told = spark.read.schema(out).parquet(f"{home}/out")
    return told.select(F.col("message_id").cast("bigint").alias("message_id"), "recipient_id", "sender_id", "text")


@query
def q_stream_gate(spark, sf):
    """The batch gate as a stream whose micro-batches end in the middle of batches."""
    home = scratch_dir(spark, "stream-gate")
    log = src.topic_log(spark, sf).select(*schemas.LOG.names)
    k = F.get_json_object("value", "$.k").cast("int")
    writer = sinks.gate_writer(f"{home}/good", f"{home}/bad", f"{home}/report", k % 37 == 0, size=10)

    def stream():
        return sinks.run(log_source.read_log(spark, f"{home}/log", stream=True), f"{home}/checkpoint", writer=writer)

    # Uneven cuts; a partition may have no records in a turn.
    _in_turn(log, F.least(F.floor(F.col("offset") / 37), F.lit(4)).cast("int"), f"{home}/log", stream)
    return sinks.close_gate(spark, f"{home}/report")


@query
def q_stream_archive(spark, sf):
    """Mirrored topics streamed into archive folders by the exactly-once text sink."""
    home = scratch_dir(spark, "stream-archive")
    log = _named_log(spark, sf).select(*schemas.LOG.names)
    log.write.parquet(f"{home}/log")
    lines = jobs.archived(log_source.read_log(spark, f"{home}/log", stream=True))
    run = sinks.run(lines, f"{home}/checkpoint", f"{home}/out", fmt="text", partition_by=["dataset"])
    run.awaitTermination()
    return spark.read.text(f"{home}/out").groupBy("dataset", "value").agg(
        F.count(F.lit(1)).alias("lines")
    )


@query
def q_stream_upsert(spark, sf):
    """Arrivals streamed into per-batch deltas, merged when read."""
    home = scratch_dir(spark, "stream-upsert")
    rows = _by_user_and_k(spark, sf, "view")
    keys = ["user_id", "product_id"]

    def stream():
        arrivals = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
        return sinks.run(arrivals, f"{home}/checkpoint", writer=sinks.upsert_writer(f"{home}/table", keys, SEQ))

    # Four batches in the order of arrival.
    _in_turn(rows, _range_of(rows, F.col("seq"), 4), f"{home}/in", stream)
    return sinks.read_table(spark, f"{home}/table", rows.schema, keys, SEQ)


@query
def q_stream_fold(spark, sf):
    """Arrivals kept in a table with manifests, folded while a reader holds on to an old version.

    Per key the last arrival of the last batch, and what the reader saw after two of four batches.
    """
    home = scratch_dir(spark, "stream-fold")
    rows = _by_user_and_k(spark, sf, "view")
    table = tables.table(spark, f"{home}/table", rows.schema, ["user_id", "product_id"], SEQ)
    held = {}

    def write(batch, batch_id):
        table.add(keyed.latest(batch, table.keys, SEQ), batch_id)
        if batch_id == 1:
            held["version"] = table.current()
        if batch_id % 2 == 1:
            table.fold()
        table.expire()

    def stream():
        arrivals = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
        return sinks.run(arrivals, f"{home}/checkpoint", writer=write)

    half = rows.agg(F.max("seq")).first()[0] // 2
    turn = F.when(F.col("seq") <= half, F.col("seq") % 2).otherwise(2 + F.col("seq") % 2).cast("int")
    _in_turn(rows, turn, f"{home}/in", stream)
    early = table.read(held["version"]).select("user_id", "product_id", F.col("seq").alias("seen"))
    return table.read().join(early, ["user_id", "product_id"], "left")


@query
def q_stream_requests(spark, sf):
    """Insert-or-ignore on a stream: the first arrival of every request id, however late the next."""
    home = scratch_dir(spark, "stream-requests")
    rows = src.events(spark, sf).select(
        F.concat_ws(":", "user_id", "k").alias("request_id"), F.col("event_id").alias("seq")
    )
    writer = sinks.insert_ignore_writer(f"{home}/table", ["request_id"], SEQ)

    def stream():
        arrivals = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
        return sinks.run(arrivals, f"{home}/checkpoint", writer=writer)

    _in_turn(rows, _range_of(rows, F.col("seq"), 3), f"{home}/in", stream)
    return sinks.read_first(spark, f"{home}/table", rows.schema, ["request_id"], SEQ)


@query
def q_stream_groups(spark, sf):
    """Two groups read one log; one has stopped after half of it.  Their lag comes from their checkpoints."""
    home = scratch_dir(spark, "stream-groups")
    log = src.topic_log(spark, sf).select(*schemas.LOG.names)
    turns = iter(range(4))

    def stream():
        runs = [
            sinks.run(log_source.read_log(spark, f"{home}/log", stream=True), f"{home}/{group}/checkpoint", f"{home}/{group}/out")
            for group in (("early", "late") if next(turns) < 2 else ("late",))
        ]
        for run in runs[:-1]:
            run.awaitTermination()
        return runs[-1]

    _in_turn(log, F.least(F.floor(F.col("offset") / 100), F.lit(3)).cast("int"), f"{home}/log", stream)
    written = log_source.read_log(spark, f"{home}/log")
    groups = [progress.positions(spark, written, f"{home}/{g}/checkpoint", g) for g in ("early", "late")]
    lag = logs.consumer_lag(written, groups[0].unionByName(groups[1]))
    rows = [
        log_source.read_log(spark, f"{home}/{g}/out").groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("group", F.lit(g))
        for g in ("early", "late")
    ]
    return lag.join(rows[0].unionByName(rows[1]), ["group", "topic", "partition"], "left")


@query
def q_stream_idle(spark, sf):
    """A stream that takes so many bytes a batch and ends by itself when nothing comes any more."""
    home = scratch_dir(spark, "stream-idle")
    log = src.topic_log(spark, sf).select(*schemas.LOG.names)
    log.repartition(8, "topic", "partition").write.parquet(f"{home}/log")

    def start():
        stream = log_source.read_log(spark, f"{home}/log", stream=True, max_bytes=1 << 16)
        return sinks.run(stream, f"{home}/checkpoint", f"{home}/out", trigger={"processingTime": "0 seconds"})

    progress.until_idle(spark, start, 3)
    out = log_source.read_log(spark, f"{home}/out")
    return out.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("rows"), F.max("offset").alias("last"))


@query
def q_state_rows(spark, sf):
    """Which keys a stream's state holds as denied, read from its checkpoint as a table."""
    home = scratch_dir(spark, "state-rows")
    log = _stream_log(spark, sf)
    log.unionByName(jobs.closing_rows(log, LATE_DELAY)).write.parquet(f"{home}/log")
    judged = jobs.judged_products(log_source.read_log(spark, f"{home}/log", stream=True), delay=LATE_DELAY)
    sinks.run(judged, f"{home}/checkpoint", f"{home}/out").awaitTermination()
    return progress.keyed_state(spark, f"{home}/checkpoint").filter(F.size("items") > 0).select("key")
