"""Top products per user: those matching the latest search first, then by stock.

The ranking of a user depends on the query alone, so it is computed once per
distinct query and joined to the users.  "The query is inside the name" goes by
an inverted index: distinct names, each with its top k products, under their
character trigrams.  A query is looked up by the one of its trigrams that the
fewest names have, and the names found are verified; queries of one or two
characters have grams of their own length.  Names emit as many rows as they have
characters, and no (user, product) or (query, product) product is ever formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.times import second_text
from logweave.operators import keyed
from logweave.plans.sizing import settled, small_side

# The two reason texts of a recommendation, the request type of a search.
MATCH_REASON = "Товар соответствует последнему поисковому запросу"
STOCK_REASON = "Популярный товар с высоким доступным остатком"
SEARCH = "search"

# Characters of a gram in the index of names.
GRAM = 3


def latest_products(products: DataFrame) -> DataFrame:
    """Newest version per product (ties by content, so that runs repeat)."""
    versions = products.withColumn("__tie", F.xxhash64("name", "stock.available"))
    return keyed.latest(versions, ["product_id"], ["updated_at", "__tie"]).drop("__tie")


def latest_searches(events: DataFrame) -> DataFrame:
    """(user_id, query) of each user's newest search."""
    searches = events.filter(F.col("request_type") == SEARCH)
    order = F.struct("requested_at", "request_id")
    return searches.groupBy("user_id").agg(F.max_by("query", order).alias("query"))


def users_with_query(events: DataFrame) -> DataFrame:
    """Every non-null user with the query of the newest search or null, in one shuffle.

    The aggregate equals distinct users left-joined to :func:`latest_searches`.
    """
    is_search = F.col("request_type") == SEARCH
    at = F.when(is_search, F.struct("requested_at", "request_id"))
    return (
        events.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.max_by("query", at).alias("query"))
    )


def _best() -> list[Column]:
    return [F.col("available").desc(), F.col("product_id")]


def _item(match: int) -> Column:
    return F.struct(
        F.lit(match).alias("query_match"),
        F.col("available"),
        F.col("product_id"),
        F.col("product_name"),
    )


def _ranked_array(items: Column, k: int) -> Column:
    """First k of (match, available, id) in ranking order, one entry per product."""

    def order(a: Column, b: Column) -> Column:
        def by(x: Column, y: Column, down: bool, tie: Column) -> Column:
            up, dn = (1, -1) if down else (-1, 1)
            lower = x.isNull() & y.isNotNull() | (x < y)
            higher = x.isNotNull() & y.isNull() | (x > y)
            return F.when(lower, F.lit(up)).when(higher, F.lit(dn)).otherwise(tie)

        ids = by(a["product_id"], b["product_id"], False, F.lit(0))
        stock = by(a["available"], b["available"], True, ids)
        return by(a["query_match"], b["query_match"], True, stock)

    return F.slice(F.array_sort(items, order), 1, k)


def top_by_stock(products: DataFrame, k: int) -> Column:
    """The k best products overall, as one array of exactly k or fewer entries."""
    best = products.orderBy(*_best()).limit(k)
    return best.agg(F.collect_list(_item(0))).scalar()


def grams(text: Column, size: int) -> Column:
    """The distinct runs of ``size`` characters of a text, none if it is shorter."""

    def runs(chars: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(chars) - size)
        return F.array_distinct(
            F.transform(starts, lambda at: F.concat(*(F.get(chars, at + k) for k in range(size))))
        )

    # One split for all runs, as a substring of a text is found by counting from its start.
    found = F.element_at(F.transform(F.array(F.split(text, "")), runs), 1)
    return F.when(F.char_length(text) >= size, found).otherwise(F.array().cast("array<string>"))


def needle_grams(needles: DataFrame) -> DataFrame:
    """(needle, gram): what a query may be looked up by; a short one by itself alone."""
    parts = F.when(F.char_length("needle") < GRAM, F.array("needle")).otherwise(grams(F.col("needle"), GRAM))
    return needles.select("needle", F.explode(parts).alias("gram"))


def gram_index(names: DataFrame, wanted: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(gram, hay, items): the names (hay, items) under those of their grams that are ``wanted``."""
    parts = F.flatten(F.array(*(grams(F.col("hay"), size) for size in sizes)))
    return names.select(F.explode(parts).alias("gram"), "hay", "items").join(wanted, "gram", "left_semi")


def rarest_grams(by_gram: DataFrame, index: DataFrame) -> DataFrame:
    """(needle, gram): of every query the gram that the fewest names have; none if one is in no name."""
    counts = small_side(index.groupBy("gram").agg(F.count(F.lit(1)).alias("names")))
    judged = by_gram.join(counts, "gram", "left").groupBy("needle")
    least = F.min_by("gram", F.struct("names", "gram")).alias("gram")
    return judged.agg(least, F.bool_and(F.col("names").isNotNull()).alias("found")).filter("found").drop("found")


def query_matches(products: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(needle, items): for each lower-cased query its k best matching products.

    Queries that match nothing have no row.
    """
    needles = queries.select(F.lower("query").alias("needle")).filter("needle <> ''").distinct()
    by_gram = settled(needle_grams(needles), "needle-grams")
    found = by_gram.agg(F.collect_set(F.least(F.char_length("needle"), F.lit(GRAM))).alias("sizes")).first()
    sizes = sorted(found["sizes"]) or [GRAM]
    named = products.withColumn("hay", F.lower("product_name"))
    measured = keyed.top_k(named, ["hay"], _best(), k).drop("rank")
    names = measured.groupBy("hay").agg(F.collect_list(_item(1)).alias("items"))
    wanted = small_side(by_gram.select("gram").distinct())
    index = settled(gram_index(names, wanted, sizes), "gram-index")
    lookups = small_side(rarest_grams(by_gram, index))
    verified = index.join(lookups, "gram").filter(F.contains("hay", "needle"))
    each = verified.select("needle", F.explode("items").alias("item")).select("needle", "item.*")
    best = keyed.top_k(each, ["needle"], _best(), k)
    return best.groupBy("needle").agg(F.collect_list(_item(1)).alias("items"))


def recommend(users: DataFrame, products: DataFrame, k: int = 3) -> DataFrame:
    """(user_id, rank, product_id, product_name, query_match) for users (user_id, query).

    ``products`` has product_id, product_name, available, one row per product.
    With m < k matches the k best by stock hold at least k - m others, so the two
    short lists together always contain the answer.
    """
    users = settled(users, "users")
    popular = top_by_stock(products, k)
    matches = small_side(settled(query_matches(products, users, k), "matches"))
    joined = (
        users.withColumn("__needle", F.lower("query"))
        .join(matches, F.col("__needle") == F.col("needle"), "left")
        .withColumn("popular", popular)
    )
    taken = F.transform("items", lambda i: i["product_id"])
    # An empty query is contained in every name: the best by stock all match.
    fill = F.when(
        F.col("__needle") == "",
        F.transform("popular", lambda i: i.withField("query_match", F.lit(1))),
    ).otherwise(F.col("popular"))
    others = F.filter(fill, lambda i: ~F.array_contains(taken, i["product_id"]))
    merged = F.when(F.col("items").isNull(), fill).otherwise(F.concat("items", others))
    return joined.select(
        "user_id", F.posexplode(_ranked_array(merged, k)).alias("pos", "item")
    ).select(
        "user_id",
        (F.col("pos") + 1).alias("rank"),
        "item.product_id",
        "item.product_name",
        "item.query_match",
    )


def with_labels(ranked: DataFrame, *keep: str, now: Column | None = None) -> DataFrame:
    """Recommendation records: reason text and one time stamp for the whole run."""
    reason = F.when(F.col("query_match") == 1, F.lit(MATCH_REASON)).otherwise(F.lit(STOCK_REASON))
    return ranked.select(
        "user_id",
        "product_id",
        "product_name",
        reason.alias("reason"),
        second_text(F.current_timestamp() if now is None else now).alias("generated_at"),
        *keep,
    )


def recommendations(products: DataFrame, events: DataFrame, k: int = 3, now: Column | None = None) -> DataFrame:
    """From product and client-event records to recommendation records."""
    items = latest_products(products).select(
        "product_id", F.col("name").alias("product_name"), F.col("stock.available").alias("available")
    )
    return with_labels(recommend(users_with_query(events), items, k), now=now)
