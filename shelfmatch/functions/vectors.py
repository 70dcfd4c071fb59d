"""Vector and set scores over ``array<double>`` and ``array<string>`` columns, all native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubles(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y))


def norm(a: Column | str) -> Column:
    return F.sqrt(_total(F.transform(_doubles(a), lambda x: x * x)))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity, null when a vector is all zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def euclidean(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(
        _total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y)))
    )


def sparse_euclidean(a: Column, b: Column) -> Column:
    """Euclidean distance of two sparse vectors given as ``struct<indices, values>``.

    Touches stored entries only: ``|a|^2 + |b|^2 - 2 a.b``.
    """
    shared = F.zip_with(
        a["indices"],
        a["values"],
        lambda i, x: x
        * F.coalesce(
            F.get(b["values"], (F.array_position(b["indices"], i) - 1).cast("int")), F.lit(0.0)
        ),
    )
    squares = [_total(F.transform(v["values"], lambda x: x * x)) for v in (a, b)]
    return F.sqrt(F.greatest(squares[0] + squares[1] - 2 * _total(shared), F.lit(0.0)))


def jaccard_distance(a: Column | str, b: Column | str) -> Column:
    """One minus shared over all distinct terms; null when both sides are empty."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    shared = F.size(F.array_intersect(a, b)).cast("double")
    either = F.size(F.array_union(a, b)).cast("double")
    return 1 - F.try_divide(shared, either)


def threshold(score: Column | str, cut: float, direction: str = "at_least") -> Column:
    """1 where a similarity is at least ``cut``, or a distance "at_most" ``cut``, else 0."""
    s = F.col(score) if isinstance(score, str) else score
    if direction == "at_least":
        return (s >= cut).cast("int")
    if direction == "at_most":
        return (s <= cut).cast("int")
    raise ValueError(f"unknown direction {direction!r}")


def bin_label(relevance: Column | str, cuts: list[float]) -> Column:
    """Class number: how many cut points the relevance has reached (null stays null)."""
    r = F.col(relevance) if isinstance(relevance, str) else relevance
    reached = F.lit(0.0)
    for cut in cuts:
        reached = reached + (r >= cut).cast("double")
    return reached
