"""Column functions for query text, keyword embeddings and rendered hits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vectors import let, normalize

# The text layout callers parse.
HIT_FORMAT = "Document %d (ID: %s, Score: %.4f):\n%s"
HIT_SEPARATOR = "\n\n---\n\n"
TITLE_PREFIX = "Document "
EMPTY_MESSAGE = "No relevant documents found in the knowledge base."


def parts_text(parts: Column) -> Column:
    """Texts of an ``array<struct<type, text>>`` message joined by a blank; parts without text are skipped."""
    texts = F.transform(parts, lambda p: p.getField("text"))
    return F.coalesce(F.array_join(texts, " "), F.lit(""))


def json_message_text(content: Column) -> Column:
    """Like :func:`parts_text` for content held as JSON: a string, a list of parts, or anything else."""
    value = F.try_parse_json(content)
    string = _json_string(value)
    parts = F.try_variant_get(value, "$", "array<variant>")
    texts = F.transform(
        parts,
        lambda p: _json_string(F.try_variant_get(p, "$.text", "variant")),
    )
    return F.coalesce(string, F.array_join(texts, " "), F.lit(""))


def _json_string(value: Column) -> Column:
    """The value of a JSON string; NULL for every other JSON type, never a conversion."""
    return F.when(
        F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")
    )


def keyword_count_embedding(text: Column, groups: Sequence[Sequence[str]]) -> Column:
    """Per group, how many of its terms occur in the text; unit length, uniform if none occurs."""
    counts = let(
        F.lower(text), lambda lowered: F.array(*[_occurring(lowered, terms) for terms in groups])
    )
    uniform = F.array(*[F.lit(1.0) for _ in groups])
    return F.coalesce(normalize(counts), normalize(uniform))


def _occurring(lowered: Column, terms: Sequence[str]) -> Column:
    total = F.lit(0.0)
    for term in terms:
        total = total + F.contains(lowered, F.lit(term)).cast("double")
    return total


def keyword_flag_embedding(text: Column, groups: Sequence[Sequence[str]]) -> Column:
    """Per group 1 if any of its terms occurs, else 0.1; unit length."""
    flags = let(
        F.lower(text), lambda lowered: F.array(*[_flag(lowered, terms) for terms in groups])
    )
    return normalize(flags)


def _flag(lowered: Column, terms: Sequence[str]) -> Column:
    found = F.lit(False)
    for term in terms:
        found = found | F.contains(lowered, F.lit(term))
    return F.when(found, F.lit(1.0)).otherwise(F.lit(0.1))


def hit_title(metadata_title: Column, number: Column) -> Column:
    return F.coalesce(metadata_title, F.concat(F.lit(TITLE_PREFIX), number.cast("string")))


def render_hit(number: Column, id_: Column, score: Column, content: Column) -> Column:
    return F.format_string(HIT_FORMAT, number, id_, score, content)
