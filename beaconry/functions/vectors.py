"""Vector maths on array columns, all JVM-side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from beaconry.functions.columns import as_col


def dot(a, b) -> Column:
    """Dot product over the shorter of the two lengths."""
    a, b = as_col(a), as_col(b)
    n = F.least(F.size(a), F.size(b))

    def summed(x: Column, y: Column) -> Column:
        pairs = F.zip_with(x, y, lambda x, y: x.cast("double") * y.cast("double"))
        return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)

    # vectors of one length, the usual case, are not copied
    return F.when(F.size(a) == F.size(b), summed(a, b)).otherwise(
        summed(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n)))


def magnitude(a) -> Column:
    return F.sqrt(F.aggregate(as_col(a), F.lit(0.0),
                              lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a=None, b=None, norms: Column | str | None = None, product: Column | str | None = None) -> Column:
    """Cosine: dot over the shorter length, norms over the full vectors, 0 for a zero norm.

    ``norms``, the product of both magnitudes, may be given where vectors are met many times; with ``product``, their dot product
    (see ``operators.pairs``), the vectors themselves are not needed.
    """
    norms = magnitude(a) * magnitude(b) if norms is None else as_col(norms)
    product = dot(a, b) if product is None else as_col(product)
    return F.when(norms == 0, F.lit(0.0)).otherwise(product / norms)


def bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed once per row, even if ``fn`` names it inside a lambda."""
    return F.transform(F.array(value), fn)[0]


def block_mean(a, dim: int) -> Column:
    """Average of the ``dim``-long blocks of a concatenated vector."""
    def averaged(v: Column) -> Column:
        blocks = F.greatest((F.size(v) / F.lit(dim)).cast("int"), F.lit(1))
        parts = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.slice(v, b * dim + 1, F.lit(dim)))
        total = F.aggregate(parts, F.array_repeat(F.lit(0.0), dim),
                            lambda s, p: F.zip_with(s, p, lambda x, y: x + F.coalesce(y, F.lit(0.0))))
        return F.transform(total, lambda x: x / blocks)

    return bound(as_col(a), averaged)


def is_nonzero(a) -> Column:
    return F.coalesce(F.exists(as_col(a), lambda x: x != 0), F.lit(False))


def hashed_words(text, dim: int) -> Column:
    """Unit vector of hashed word counts.

    Words are what lies between blanks. Each word's bucket comes from its md5, so any
    engine can repeat it. The counts are read off one sort: word buckets are odd
    numbers, ``dim + 1`` even marks enclose them, and the distance between neighbouring
    marks is the count. Cost is one sort per text, whatever ``dim`` is.
    """
    words = F.filter(F.split(F.lower(as_col(text)), "\\s+"), lambda w: w != "")
    buckets = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10)
                          .cast("bigint") % dim * 2 + 1)
    marks = F.transform(F.sequence(F.lit(0), F.lit(dim)), lambda d: d.cast("bigint") * 2)
    line = F.sort_array(F.concat(F.coalesce(buckets, F.array().cast("array<bigint>")), marks))
    at = F.filter(F.transform(line, lambda x, i: F.when(x % 2 == 0, i)), lambda i: i.isNotNull())
    return unit(bound(at, lambda p: F.zip_with(F.slice(p, 1, dim), F.slice(p, 2, dim),
                                               lambda lo, hi: (hi - lo - 1).cast("double"))))


def unit(a) -> Column:
    """Vector over its length; a zero vector stays as it is."""
    def scaled(pair: Column) -> Column:
        return F.transform(pair["v"], lambda x: F.when(pair["n"] == 0, F.lit(0.0)).otherwise(x / pair["n"]))

    return bound(bound(as_col(a), lambda v: F.struct(v.alias("v"), magnitude(v).alias("n"))), scaled)
