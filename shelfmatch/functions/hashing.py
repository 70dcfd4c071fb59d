"""Term numbers, MinHash signatures and random-projection buckets as native expressions."""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmatch.functions.vectors import dot

# A prime above the 28-bit term numbers; keeps (1 + id) * a + b within 64 bits.
PRIME = 2038074743


def term_id(term: Column, how: str = "md5") -> Column:
    """28-bit number of a term. "md5" is the same in every engine, "xxhash64" is faster."""
    if how == "md5":
        return F.conv(F.substring(F.md5(term), 1, 7), 16, 10).cast("long")
    if how == "xxhash64":
        return F.pmod(F.xxhash64(term), F.lit(1 << 28))
    raise ValueError(f"unknown term number {how!r}")


def hash_coefficients(n: int, seed: int = 42) -> list[tuple[int, int]]:
    r = random.Random(seed)
    return [(r.randint(1, PRIME - 1), r.randint(0, PRIME - 1)) for _ in range(n)]


def minhash_signature(terms: Column | str, n: int = 5, seed: int = 42, how: str = "md5") -> Column:
    """``n`` MinHash values of a set of terms; null for the empty set."""
    t = F.col(terms) if isinstance(terms, str) else terms
    ids = F.transform(F.array_distinct(t), lambda x: term_id(x, how))
    functions = F.array(
        *[
            F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))
            for a, b in hash_coefficients(n, seed)
        ]
    )
    signature = F.get(
        F.transform(
            F.array(ids),
            lambda xs: F.transform(
                functions,
                lambda h: F.array_min(
                    F.transform(xs, lambda x: ((1 + x) * h["a"] + h["b"]) % PRIME)
                ),
            ),
        ),
        F.lit(0),
    )
    return F.when(F.size(t) > 0, signature)


def unit_directions(n: int, dim: int, seed: int = 42) -> list[list[float]]:
    r = random.Random(seed)
    out = []
    for _ in range(n):
        v = [r.gauss(0.0, 1.0) for _ in range(dim)]
        size = sum(x * x for x in v) ** 0.5
        out.append([round(x / size, 6) for x in v])
    return out


def projection_buckets(
    vec: Column | str, dim: int, n: int = 3, bucket_length: float = 2.0, seed: int = 42
) -> Column:
    """Bucket numbers of a vector along ``n`` random directions."""
    return F.array(
        *[
            F.floor(dot(vec, F.array(*[F.lit(x) for x in d])) / bucket_length).cast("long")
            for d in unit_directions(n, dim, seed)
        ]
    )
