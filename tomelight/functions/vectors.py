"""Vector expressions over ``array<float>`` or ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import let, term_counts


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(as_double(a), as_double(b), lambda x, y: x * y),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; a zero vector has similarity 0 with everything."""
    scale = norm(a) * norm(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.coalesce(F.try_divide(dot(a, b), scale), F.lit(0.0)))


def l2_normalize(v: Column) -> Column:
    """Scale to unit length; a zero vector stays zero."""
    return let(
        as_double(v),
        lambda x: let(
            norm(x), lambda n: F.when(n == 0, x).otherwise(F.transform(x, lambda e: F.try_divide(e, n)))
        ),
    )


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def sums(vector: Column, dim: int, weight: Column | None = None) -> Column:
    """Aggregate: the (weighted) sum of vectors, one plain sum per coordinate.

    Plain sums combine inside the map tasks in fixed-width buffers. Null vectors
    are ignored; without any the result is zeros.
    """

    def total(i: int) -> Column:
        x = F.get(vector, F.lit(i)).cast("double")
        return F.coalesce(F.sum(x if weight is None else x * weight), F.lit(0.0))

    return F.array(*[total(i) for i in range(dim)])


def means(vector: Column, dim: int) -> Column:
    """Aggregate: the mean of vectors, null coordinates when there are none."""
    n = F.count(vector)
    return F.array(
        *[F.try_divide(F.sum(F.get(vector, F.lit(i)).cast("double")), n) for i in range(dim)]
    )


def maxima(vector: Column, dim: int, keep: Column, masked: float) -> Column:
    """Aggregate: the largest value per coordinate, ``masked`` where not kept."""
    values = [F.get(vector, F.lit(i)).cast("double") for i in range(dim)]
    return F.array(*[F.max(F.when(keep, x).otherwise(masked)) for x in values])


def dimension(df: DataFrame, vector: str) -> int:
    """Length of the vectors of a table, from its first row."""
    row = df.select(F.size(vector).alias("n")).first()
    return 0 if row is None else row["n"]


def hash_code(word: Column, dim: int) -> Column:
    """Bucket and sign of a token: ``2 * bucket + (1 when negative)``.

    md5 is used because it gives the same digits in every engine and language.
    """
    digest = F.md5(word)
    bucket = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long") % F.lit(dim)
    negative = (F.substring(digest, 9, 1) >= "8").cast("long")
    return bucket * 2 + negative


def hashed(words: Column, dim: int) -> Column:
    """Signed bucket counts of an array of tokens as a dense vector."""
    codes = F.transform(words, lambda t: hash_code(t, dim))
    nothing = F.lit(0).cast("long")

    def dense(counts: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0).cast("long"), F.lit(dim - 1).cast("long")),
            lambda d: (
                F.coalesce(F.try_element_at(counts, d * 2), nothing)
                - F.coalesce(F.try_element_at(counts, d * 2 + 1), nothing)
            ).cast("double"),
        )

    return let(F.map_from_entries(term_counts(codes)), dense)
