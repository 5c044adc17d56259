"""Column expressions for words, shingles and fingerprints, made of built-in functions only.

Arrays that a lambda reads by position are bound to a lambda variable of their own, so they are evaluated once a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: ASCII white space.
SPACE = "[\\x20\\x09-\\x0D]+"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with value evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_hashes(text: Column) -> Column:
    """XXH64 of each lower-cased word, as a long array."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SPACE), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(hashes: Column, size: int, whole: bool = True) -> Column:
    """A hash of every run of `size` words; of fewer words, one of them all (or, without `whole`, none)."""

    def runs(a: Column) -> Column:
        first = F.sequence(F.lit(0), F.size(a) - size)
        return F.transform(first, lambda i: F.xxhash64(*[a[i + k] for k in range(size)]))

    def of(a: Column) -> Column:
        short = F.array(F.xxhash64(a)) if whole else F.array().cast("array<long>")
        return F.when(F.size(a) >= size, runs(a)).when(F.size(a) > 0, short).otherwise(F.array().cast("array<long>"))

    return bound(hashes, of)


def simhash(hashes: Column) -> Column:
    """64-bit fingerprint: a bit is set where it is in over half of the hashes (repeats count)."""

    def of(a: Column) -> Column:
        def bit(b: Column) -> Column:
            ones = F.aggregate(a, F.lit(0), lambda n, h: n + F.call_function("shiftright", h, b).bitwiseAND(F.lit(1)).cast("int"))
            return F.when(ones * 2 > F.size(a), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

        return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), bit), F.lit(0).cast("long"), lambda x, y: x.bitwiseOR(y))

    return bound(hashes, of)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def numbered(hashes: Column) -> Column:
    """An array as a set of as many elements: the second and further ones of equal hashes are hashed with their number."""

    def of(a: Column) -> Column:
        number = lambda x, i: i + 2 - F.array_position(a, x)
        return F.transform(a, lambda x, i: F.when(number(x, i) == 1, x).otherwise(F.xxhash64(x, number(x, i))))

    return bound(F.sort_array(hashes), lambda a: F.when(F.size(F.array_distinct(a)) == F.size(a), a).otherwise(of(a)))


def shared_share(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct elements; 0 of two empty ones. Of numbered() arrays: that of the multisets."""

    def of(p: Column) -> Column:
        both = F.size(F.array_intersect(p.x, p.y))
        every = F.size(p.x) + F.size(p.y)
        return bound(both, lambda n: F.when(every > 0, n / (every - n)).otherwise(F.lit(0.0)))

    return bound(F.struct(a.alias("x"), b.alias("y")), of)


def small_side(df: DataFrame, rows: int, most: int) -> DataFrame:
    """`df`, with a broadcast hint if its counted `rows` are at most `most`; else the join is left to shuffle."""
    return F.broadcast(df) if rows <= most else df
