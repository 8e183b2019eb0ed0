"""From messages to query text, hits, references and one text context per query."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import (
    EMPTY_MESSAGE,
    HIT_SEPARATOR,
    hit_title,
    json_message_text,
    parts_text,
    render_hit,
)
from ..operators.nearest import Hits
from ..operators.search import search_hits, with_payload
from ..session import checkpointed
from ..spec import DEFAULT_THRESHOLD, DEFAULT_TOP_K, StoreSpec

DEFAULT_SOURCE = "Vector store"


class Retrieved(NamedTuple):
    """``context`` is ``(q_id, context)`` with every query; ``references`` has one row per hit."""

    context: DataFrame
    references: DataFrame


def message_text(content: Column, data_type: T.DataType, is_json: bool = False) -> Column:
    """The searchable text of one message: its string, or the texts of its parts, or ``""``."""
    if isinstance(data_type, T.ArrayType):
        return parts_text(content)
    if is_json:
        return json_message_text(content)
    return F.coalesce(content, F.lit(""))


def last_message_text(
    messages: DataFrame, by: str, order: str, content: str = "content", is_json: bool = False
) -> DataFrame:
    """``(by, text)``: the text of the last message of each conversation, found by partial aggregation.

    The content is wrapped, so a last message without content gives ``""``, not an earlier message.
    """
    last = F.max_by(F.struct(F.col(content).alias("content")), F.col(order)).getField("content")
    kind = messages.schema[content].dataType
    return (
        messages.groupBy(by)
        .agg(last.alias("last"))
        .select(by, message_text(F.col("last"), kind, is_json).alias("text"))
    )


def references(hits: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """One row per hit, with or without content; untitled hits are numbered by their rank."""
    return hits.select(
        "q_id",
        "rank",
        "id",
        hit_title(F.col("metadata").getField("title"), F.col("rank")).alias("title"),
        F.lit(source).alias("source"),
        "score",
        "metadata",
        "metadata_json",
    )


def contexts(hits: DataFrame) -> DataFrame:
    """``(q_id, context)`` of the hits that have content, numbered among themselves in rank order.

    A group never holds more than the query's limit of hits.
    """
    with_content = hits.filter(F.length("content") > 0)
    number = F.row_number().over(Window.partitionBy("q_id").orderBy("rank"))
    piece = render_hit(F.col("n"), F.col("id"), F.col("score"), F.col("content"))
    return (
        with_content.withColumn("n", number)
        .groupBy("q_id")
        .agg(F.array_sort(F.collect_list(F.struct("n", piece.alias("piece")))).alias("pieces"))
        .select("q_id", F.array_join(F.col("pieces.piece"), HIT_SEPARATOR).alias("context"))
    )


def retrieve(
    store: DataFrame,
    inputs: DataFrame,
    embed: Callable[[Column], Column],
    spec: StoreSpec,
    top_k: int = DEFAULT_TOP_K,
    threshold: float = DEFAULT_THRESHOLD,
    filters: Mapping[str, Any] | Callable[[DataFrame], DataFrame] | None = None,
    source: str = DEFAULT_SOURCE,
    empty_message: str = EMPTY_MESSAGE,
    search: Callable[..., Hits] | None = None,
    **how: Any,
) -> Retrieved:
    """Embed ``inputs(q_id, text, …)``, search, and render.

    ``embed`` turns a text column into a vector column: built-in functions or a vectorised UDF.
    ``filters`` are common conditions, or a function that adds filter columns to the inputs. Columns of
    ``inputs`` named like a filter field are conditions too. ``search`` replaces the exact search, e.g.
    by an index. A query without content-bearing hits gets ``empty_message``.
    """
    queries = inputs.withColumn("qv", embed(F.coalesce("text", F.lit(""))))
    common = filters
    if callable(filters):
        queries, common = filters(queries), None
    queries = checkpointed(queries)  # texts are embedded once, whatever the search reads its queries for
    find = search or (lambda q, **kw: search_hits(store, q, spec, **kw))
    found = find(queries, limit=top_k, threshold=threshold, filters=common, **how)
    hits = checkpointed(with_payload(found, store, spec, ("metadata", "metadata_json", "content")))
    context = inputs.select("q_id").join(contexts(hits), "q_id", "left")
    return Retrieved(
        context.select("q_id", F.coalesce("context", F.lit(empty_message)).alias("context")),
        references(hits, source),
    )
