"""Distinct counts from the k smallest hash values of each group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash values lie in [0, SPACE).
SPACE = float(1 << 60)
#: Normal quantile of the confidence bounds: 95 %.
Z = 1.959964
#: Rows gathered before a task reduces what it holds.
FLUSH = 1 << 19


def hash60(c: Column) -> Column:
    """The first 60 bits of MD5: the same number in any engine, so that sketches made elsewhere can be merged."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("bigint")


def smallest(df: DataFrame, group: list[str], k: int) -> DataFrame:
    """(group..., h): of each partition's rows the k smallest distinct h per group. A task holds at most k values per group
    and FLUSH rows."""

    def reduce(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        code = np.zeros(t.num_rows, np.int64)
        for g in group:
            d = t.column(g).combine_chunks().dictionary_encode(null_encoding="encode")
            d = d.combine_chunks() if isinstance(d, pa.ChunkedArray) else d
            code = code * len(d.dictionary) + d.indices.to_numpy(zero_copy_only=False)
        h = t.column("h").to_numpy()
        order = np.lexsort((h, code))
        c, x = code[order], h[order]
        new = np.r_[True, (c[1:] != c[:-1]) | (x[1:] != x[:-1])]
        order, c = order[new], c[new]
        first = np.r_[0, np.flatnonzero(c[1:] != c[:-1]) + 1]
        rank = np.arange(len(c)) - np.repeat(first, np.diff(np.r_[first, len(c)]))
        return t.take(pa.array(order[rank < k]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = base = 0
        for b in it:
            if b.num_rows:
                held.append(b)
                rows += b.num_rows
            if rows > max(FLUSH, 2 * base):
                t = reduce(pa.Table.from_batches(held))
                held, rows = t.to_batches(), t.num_rows
                base = rows
        if held:
            yield from reduce(pa.Table.from_batches(held)).to_batches(max_chunksize=1 << 16)

    src = df.select(*group, "h")
    return src.mapInArrow(run, src.schema)


def kmv(df: DataFrame, group: list[str], member: Column, k: int = 1024, fan_in: int = 64) -> DataFrame:
    """A sketch per group as rows (group..., h): the k smallest hash values of its distinct members.

    Each task reduces its own rows before the exchange; partial sketches are merged in two steps (fan_in buckets, then the
    group), so no task reads more than about k values of the square root of all partitions. Sketches of this form can be
    stored and merged again with `merge`. Null members are not counted; null group values are a group; repeats change nothing.
    """
    rows = df.select(*group, hash60(member).alias("h")).where("h is not null")
    part = smallest(rows, group, k).withColumn("bucket", F.pmod(F.spark_partition_id(), F.lit(fan_in)))
    level1 = smallest(part.repartition(*group, "bucket").drop("bucket"), group, k)
    return merge(level1, group, k)


def merge(sketches: DataFrame, group: list[str], k: int) -> DataFrame:
    """Union of sketches: the k smallest values of each (coarser) group."""
    return smallest(sketches.select(*group, "h").repartition(*group), group, k)


def estimates(sketches: DataFrame, group: list[str], k: int) -> DataFrame:
    """(group..., kept, theta, estimate, lower, upper): with fewer than k values the count is exact, else (k-1)/theta, with a
    relative standard error of 1/sqrt(k-2) and bounds at 95 %."""
    g = sketches.groupBy(*group).agg(F.count(F.lit(1)).alias("kept"), F.max("h").alias("top"))
    full = F.col("kept") >= k
    est = F.when(full, F.lit(k - 1.0) / ((F.col("top") + 1) / F.lit(SPACE))).otherwise(F.col("kept").cast("double"))
    err = F.when(full, F.lit(Z / float(np.sqrt(k - 2)))).otherwise(F.lit(0.0))
    return g.select(
        *group,
        "kept",
        F.when(full, (F.col("top") + 1) / F.lit(SPACE)).otherwise(F.lit(1.0)).alias("theta"),
        est.alias("estimate"),
        (est * (1 - err)).alias("lower"),
        (est * (1 + err)).alias("upper"),
    )


def set_operations(left: DataFrame, right: DataFrame, key: list[str], k: int) -> DataFrame:
    """Union, intersection and both differences of two sketches with the same key, estimated with bounds.

    The values below the smaller theta of the two are a uniform sample of the union; the share of the sample on each side
    gives the parts, with Wilson bounds at 95 % for the share and the union's own error added. A key missing on one side
    counts as an empty set there.
    """
    a = left.select(*key, "h").withColumn("in_a", F.lit(1)).withColumn("in_b", F.lit(0))
    b = right.select(*key, "h").withColumn("in_a", F.lit(0)).withColumn("in_b", F.lit(1))
    both = a.unionByName(b)
    th = both.groupBy(*key).agg(
        F.when(F.sum("in_a") >= k, F.max(F.when(F.col("in_a") == 1, F.col("h")))).alias("ta"),
        F.when(F.sum("in_b") >= k, F.max(F.when(F.col("in_b") == 1, F.col("h")))).alias("tb"),
    )
    theta = th.select(*[F.col(c).alias(f"_{c}") for c in key], F.least("ta", "tb").alias("top"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    once = both.groupBy(*key, "h").agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    s = once.join(theta, same).where("top is null or h <= top").groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("in_a") * F.col("in_b")).alias("n_both"),
        F.sum(F.col("in_a") * (1 - F.col("in_b"))).alias("n_left"),
        F.sum((1 - F.col("in_a")) * F.col("in_b")).alias("n_right"),
        F.max("top").alias("top"),
    )
    share = F.when(F.col("top").isNull(), F.lit(1.0)).otherwise((F.col("top") + 1) / F.lit(SPACE))
    exact = F.col("top").isNull()
    union = F.when(exact, F.col("n").cast("double")).otherwise(F.greatest(F.col("n") - 1, F.lit(0)) / share)
    rel = F.when(exact, F.lit(0.0)).otherwise(F.lit(Z) / F.sqrt(F.greatest(F.col("n") - 2, F.lit(1)).cast("double")))

    def wilson(x: Column, sign: int) -> Column:
        n, p, zz = F.col("n").cast("double"), x / F.col("n"), Z * Z
        mid = (p + zz / (2 * n)) / (1 + zz / n)
        half = Z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
        return F.when(exact, p).otherwise(mid + sign * half)

    cols = [union.alias("union_est"), (union * (1 - rel)).alias("union_lower"), (union * (1 + rel)).alias("union_upper")]
    for name, x in (("both", F.col("n_both")), ("left", F.col("n_left")), ("right", F.col("n_right"))):
        cols += [
            (union * x / F.col("n")).alias(f"{name}_est"),
            (union * (1 - rel) * wilson(x, -1)).alias(f"{name}_lower"),
            (union * (1 + rel) * wilson(x, 1)).alias(f"{name}_upper"),
        ]
    return s.select(*key, F.col("n").alias("sample"), *cols)
