"""Checks of items and ids before anything is written."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import ValidationError
from ..functions.vectors import id_error, vector_error
from ..spec import StoreSpec


class Checked(NamedTuple):
    valid: DataFrame
    rejects: DataFrame


def check_items(items: DataFrame, spec: StoreSpec) -> Checked:
    """Split items into usable ones and rejects with a ``reason``."""
    reason = F.coalesce(id_error(F.col("id")), vector_error(F.col("vector"), spec.dimensions))
    marked = items.withColumn("reason", reason)
    return Checked(
        marked.filter(F.col("reason").isNull()).drop("reason"),
        marked.filter(F.col("reason").isNotNull()),
    )


def check_ids(ids: DataFrame) -> Checked:
    marked = ids.withColumn("reason", id_error(F.col("id")))
    return Checked(
        marked.filter(F.col("reason").isNull()).drop("reason"),
        marked.filter(F.col("reason").isNotNull()),
    )


def require_valid(rejects: DataFrame) -> None:
    """Raise with the first reason; stops at the first reject found."""
    first = rejects.select("reason").take(1)
    if first:
        raise ValidationError(first[0]["reason"])
