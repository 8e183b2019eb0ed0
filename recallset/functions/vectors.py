"""Column functions over embedding arrays. All arithmetic is double precision, summed left to right."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def literal_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def squared_norm(v: Column) -> Column:
    return F.aggregate(
        v, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )


def cosine_distance(a: Column, b: Column) -> Column:
    """``1 - cos(a, b)``, within 0..2; NULL when either side has no direction."""
    return _from_cosine(F.try_divide(dot(a, b), F.sqrt(squared_norm(a) * squared_norm(b))))


def cosine_distance_to(a: Column, values: Sequence[float]) -> Column:
    """:func:`cosine_distance` to a vector known when the plan is made."""
    square = 0.0
    for v in values:
        square += float(v) * float(v)
    product = dot(a, literal_vector(values))
    return _from_cosine(F.try_divide(product, F.sqrt(squared_norm(a) * F.lit(square))))


def _from_cosine(cosine: Column) -> Column:
    return let(
        cosine,
        lambda c: F.when(F.isnan(c), c).when(
            c.isNotNull(), F.lit(1.0) - F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))
        ),
    )


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INFINITY)


def distance_to_score(distance: Column, strict: bool = True) -> Column:
    """Map a distance of 0..2 to a score of 1..0, clamped.

    A distance that is not a finite number fails the job, or becomes NULL when not ``strict``.
    """
    bad = (
        F.raise_error(F.lit("the vector distance is not a finite number")).cast("double")
        if strict
        else F.lit(None).cast("double")
    )
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(1.0) - distance / F.lit(2.0)))
    return F.when(is_finite(distance), clamped).otherwise(bad)


def vector_error(v: Column, dimensions: int) -> Column:
    """NULL for a usable vector, else what is wrong with it."""
    bad_value = F.exists(v, lambda x: ~is_finite(x.cast("double")))
    return (
        F.when(v.isNull(), F.lit("there is no vector"))
        .when(
            F.size(v) != dimensions,
            F.format_string(
                "dimension mismatch: the vector has %d values, the store %d", F.size(v), F.lit(dimensions)
            ),
        )
        .when(bad_value, F.lit("every value of a vector must be a finite number"))
    )


def id_error(id_: Column) -> Column:
    return F.when(F.coalesce(F.length(id_), F.lit(0)) == 0, F.lit("the id must not be empty"))


def has_direction(v: Column) -> Column:
    return let(squared_norm(v), lambda n: is_finite(n) & (n > 0))


def normalize(v: Column) -> Column:
    """The vector at unit length; NULL when it has no direction."""
    return let(
        v,
        lambda a: let(
            F.sqrt(squared_norm(a)),
            lambda norm: F.when(norm > 0, F.transform(a, lambda x: x.cast("double") / norm)),
        ),
    )
