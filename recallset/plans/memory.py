"""Semantic memory: recall earlier messages of the same conversation that resemble the current one."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import distance_to_score
from ..operators.nearest import nearest
from ..spec import DEFAULT_THRESHOLD, check_search_bounds


def recall(
    messages: DataFrame,
    embed: Callable[[Column], Column],
    dimensions: int,
    scope: Sequence[str],
    order: str,
    text: str = "text",
    limit: int = 3,
    threshold: float = DEFAULT_THRESHOLD,
    digits: int | None = 9,
    **how: Any,
) -> DataFrame:
    """Per message the nearest earlier ones in its scope, with ``rank``, ``distance`` and ``score``.

    ``scope`` are the columns a message must share with what it recalls, such as user and
    conversation; ``order`` is a whole number. Messages are both sides of the search, and no pair of
    messages becomes a row, so one huge conversation costs arithmetic but neither memory nor shuffle.
    Equal distances go to the earlier message.
    """
    check_search_bounds(limit, threshold)
    identity = F.struct(*scope, F.col(order).cast("bigint").alias(order))
    known = messages.filter(F.lit(True))
    for name in (*scope, order):
        known = known.filter(F.col(name).isNotNull())
    rows = known.select(
        identity.alias("message"),
        F.to_json(identity).alias("doc_key"),
        F.col(order).cast("string").alias("id"),
        embed(F.col(text)).alias("vector"),
        *scope,
        F.col(order).cast("bigint").alias("ord"),
    )
    queries = rows.select(
        F.col("message").alias("q_id"),
        F.col("vector").alias("qv"),
        F.lit(limit).alias("limit"),
        *[F.col(c).alias(c) for c in (*scope, "ord")],
    )
    found = nearest(rows, queries, dimensions, scope, before="ord", digits=digits, **how)
    return (
        found.rows.withColumn("score", distance_to_score(F.col("distance")))
        .filter(F.col("score") >= threshold)
        .select(
            *[F.col("q_id").getField(c).alias(c) for c in scope],
            F.col("q_id").getField(order).alias(order),
            "rank",
            F.col("id").cast("bigint").alias(f"recalled_{order}"),
            "distance",
            "score",
        )
    )
