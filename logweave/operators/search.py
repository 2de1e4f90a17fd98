"""Lookups over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.functions.text import WHITE_SPACE


def search_products(products: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """Products whose name contains the trimmed query, whatever the case, by name.

    ``%`` and ``_`` in the query act as wildcards.
    """
    query = query.strip(WHITE_SPACE)
    if not query:
        raise ValueError("the query must not be blank")
    found = products.filter(F.col("name").ilike(f"%{query}%"))
    return found.orderBy("name", "product_id").limit(limit)


def user_recommendations(recommendations: DataFrame, user_id) -> DataFrame:
    """Stored recommendations of one user, newest first."""
    return recommendations.filter(F.col("user_id") == F.lit(user_id)).orderBy(
        F.col("generated_at").desc(), "product_id"
    )
