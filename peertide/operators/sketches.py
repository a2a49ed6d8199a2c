"""256-byte Bloom filters of live channels: union and cardinality."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the filter format: bits, hash functions, and what a full filter counts as.
BITS, HASHES, FULL = 2048, 2, 50_000


def merged(filters: Column) -> Column:
    """Bitwise union of filters within a group (padded with zero bytes, which no count sees)."""
    return F.call_function("bitmap_or_agg", filters)


def estimate(filter_: Column) -> Column:
    """Distinct members of a filter from its number of zero bits: ln(zeros / bits) / (hashes * ln(1 - 1 / bits)), truncated; 0 for an
    empty filter, null for null."""
    on = F.call_function("bitmap_count", filter_)
    n = F.log((F.lit(BITS) - on) / F.lit(float(BITS))) / F.lit(HASHES * math.log(1 - 1 / BITS))
    return F.when(on >= BITS, F.lit(FULL)).when(on == 0, F.lit(0)).otherwise(F.floor(n).cast("int"))
