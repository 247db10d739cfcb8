"""Content affinity: users and the product they last touched against all products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.vectors import blend
from clickloom.operators.skew import hot_keys, skew_join
from clickloom.operators.topn import top_n

CONTEXT_WEIGHT = 0.7
TEMPERATURE = 2.0


def affinity_queries(
    users: DataFrame,
    products: DataFrame,
    context: DataFrame | None,
    weight: float = CONTEXT_WEIGHT,
) -> DataFrame:
    """One vector per user whose dot product with a product is the affinity.

    ``w * <context, p> + (1 - w) * <user, p>`` is linear, so the context product
    and the user are blended before any product is scored. Without a (known)
    context product the user vector stands alone.
    """
    if context is None:
        return users.select("user_id", F.col("features").alias("factor"))
    vectors = products.select("product_id", F.col("features").alias("_context"))
    found = skew_join(
        context.select("user_id", "product_id"),
        vectors,
        "product_id",
        "inner",
        hot_keys(context, "product_id"),
    ).select("user_id", "_context")
    mixed = F.coalesce(blend(F.col("_context"), F.col("features"), weight), F.col("features"))
    return users.join(found, "user_id", "left").select("user_id", mixed.alias("factor"))


def affinity_top_k(
    users: DataFrame,
    products: DataFrame,
    context: DataFrame | None = None,
    weight: float = CONTEXT_WEIGHT,
    temperature: float = TEMPERATURE,
    k: int = 10,
    exclude: DataFrame | None = None,
    digits: int | None = None,
) -> DataFrame:
    """The ``k`` products a user is most likely to pick, with softmax probabilities.

    ``users`` and ``products`` carry ``features``; ``context`` has one row per
    user with the product last touched. Excluded pairs are not candidates.
    """
    queries = affinity_queries(users, products, context, weight)
    items = products.select("product_id", F.col("features").alias("factor"))
    return top_n(queries, items, k, exclude, temperature=temperature, digits=digits)
