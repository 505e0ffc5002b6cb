"""Vector functions on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import _c, let


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column | str) -> Column:
    return F.sqrt(_sum(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double"))))


def cosine_distance_unit(a: Column | str, b: Column | str) -> Column:
    """Y2: 1 - dot; takes unit vectors."""
    return 1 - dot(a, b)


def euclidean(a: Column | str, b: Column | str) -> Column:
    """Y3."""
    return F.sqrt(_sum(F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Y4, Y5, X77."""
    return dot(a, b) / (norm(a) * norm(b) + 1e-8)


def hash_embedding(text: Column | str, dim: int = 768) -> Column:
    """The bits of the text's sha256, lowest bit of each byte first, zeros after 256, at unit length."""
    own = lambda digest: F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.conv(F.substring(digest, i * 2 + 1, F.lit(2)), 16, 10).cast("long"))
    place = F.sequence(F.lit(0), F.lit(dim - 1))
    bits = lambda b: F.transform(place, lambda i: F.when(i < 256, F.getbit(F.get(b, F.shiftright(i, 3)), i % 8).cast("double")).otherwise(F.lit(0.0)))
    unit = lambda x: let(norm(x), lambda n: F.transform(x, lambda v: F.when(n > 0, v / n).otherwise(v)))
    # Each step is bound once a row.
    return let(F.sha2(_c(text).cast("binary"), 256), lambda d: let(own(d), lambda b: let(bits(b), unit)))
