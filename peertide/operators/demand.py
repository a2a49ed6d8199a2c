"""Demand as a set union: who was seen on any hash of a title, by any source, on a day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed order of sources: the first known country in this order wins.
SOURCE_ORDER = ("dht", "harv", "pex")


def tagged_union(sources: dict[str, DataFrame | None], tag: str = "src") -> DataFrame:
    """UNION ALL of the sources that exist, each with its name as a column; filters on top reach every branch's scan."""
    present = [df.withColumn(tag, F.lit(name)) for name, df in sources.items() if df is not None]
    if not present:
        raise ValueError("no source exists")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def source_rank(src: Column) -> Column:
    rank = F.lit(len(SOURCE_ORDER))
    for i, s in reversed(list(enumerate(SOURCE_ORDER))):
        rank = F.when(src == s, F.lit(i)).otherwise(rank)
    return rank


def per_observer(obs: DataFrame, keys: list[str]) -> DataFrame:
    """Phase one of the union: one row per (keys, ip) with one country and a flag per source.

    obs: keys, hash, ip, country (null if unknown), src. The country is the first known one by (source order, hash, country), a
    total order. Grouping by the observer spreads hot titles over all tasks and combines before the exchange.
    """
    order = F.struct(F.col("country").isNull().alias("u"), source_rank(F.col("src")).alias("r"), F.col("hash").alias("h"), F.col("country").alias("c"))
    flags = [F.max((F.col("src") == s).cast("int")).alias(f"in_{s}") for s in SOURCE_ORDER]
    return obs.groupBy(*keys, "ip").agg(F.min(order).alias("o"), *flags).select(*keys, "ip", F.col("o.c").alias("country"), *[f"in_{s}" for s in SOURCE_ORDER])


def union_demand(obs: DataFrame, keys: list[str], unknown: str = "??") -> DataFrame:
    """(keys, country, ip_count, ip_count_<source>...): distinct observers and the overlapping part each source saw."""
    sums = [F.sum(f"in_{s}").alias(f"ip_count_{s}") for s in SOURCE_ORDER]
    one = per_observer(obs, keys).withColumn("country", F.coalesce("country", F.lit(unknown)))
    return one.groupBy(*keys, "country").agg(F.count(F.lit(1)).alias("ip_count"), *sums)


def floor_other(demand: DataFrame, keys: list[str], floor: int, other: str = "Other") -> DataFrame:
    """Countries under the floor pool into one row per key; a pool under the floor goes. Since one observer has one country,
    sums are unions."""
    measures = [c for c in demand.columns if c.startswith("ip_count")]
    pooled = demand.withColumn("country", F.when(F.col("ip_count") >= floor, F.col("country")).otherwise(F.lit(other)))
    return pooled.groupBy(*keys, "country").agg(*[F.sum(m).alias(m) for m in measures]).where(F.col("ip_count") >= floor)
