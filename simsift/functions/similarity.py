"""The Tanimoto coefficient, from set sizes or bit counts, and the bounds it implies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def tanimoto(both: Column, left: Column, right: Column) -> Column:
    """both / (left + right - both): 1 for two empty fingerprints, 0 if only one is empty."""
    union = left + right - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both.cast("double") / union)


def set_tanimoto(bits: Column, query: list[int]) -> Column:
    """Of an array of distinct positions and a query's positions; the intersection is made once."""
    asked = F.array(*[F.lit(int(b)) for b in sorted(query)]).cast("array<int>")
    both = F.array(F.size(F.array_intersect(bits, asked)))
    return F.get(F.transform(both, lambda n: tanimoto(n, F.size(bits), F.lit(len(query)))), F.lit(0))


def popcount(words: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, (F.bit_count(w) for w in words))


def word_tanimoto(words: list[Column], query: list[int], count: Column | None = None) -> Column:
    """Of packed words and a query's packed words, unrolled into one generated expression; words in
    which the query has no bit aren't looked at if the record's count of bits is given."""
    both = [F.bit_count(w.bitwiseAND(F.lit(q).cast("bigint"))) for w, q in zip(words, query) if q]
    total = F.lit(sum((q & (1 << 64) - 1).bit_count() for q in query))
    return tanimoto(reduce(lambda a, b: a + b, both, F.lit(0)), popcount(words) if count is None else count, total)


def popcount_bounds(query_bits: int, cutoff: float) -> tuple[int, int]:
    """Least and greatest popcount that a fingerprint at or above the cutoff can have, widened by a
    part in a thousand million so that rounding loses no row; the exact predicate stays above it."""
    if cutoff <= 0:
        return 0, 1 << 62
    low, high = cutoff * query_bits, query_bits / cutoff
    return max(0, int(low * (1 - 1e-9))), int(high * (1 + 1e-9)) + 1
