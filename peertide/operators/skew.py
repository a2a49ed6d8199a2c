"""Per-key results when a few keys hold most rows: two-stage salted aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peertide.session import durable

#: Rows of one key that one task takes; a key of more is split. On large tables the share of a task grows with the table.
PART_ROWS = 50_000
#: Keys that can be over that: what is broadcast is bounded by it, whatever the size of the table.
MOST_HEAVY = 50_000


def heavy_keys(counts: DataFrame, keys: list[str], *, part_rows: int = PART_ROWS, most_heavy: int = MOST_HEAVY) -> DataFrame:
    """(keys..., parts) of the keys whose rows need more than one part.

    counts: keys and `n`, one row per key. A part holds max(part_rows, rows / most_heavy) rows, so at most most_heavy keys
    qualify; each gets as many parts as its rows fill. Null is a key like any other.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    part = max(part_rows, -(-total // most_heavy))
    return counts.where(F.col("n") > part).select(*keys, F.ceil(F.col("n") / F.lit(part)).cast("int").alias("parts"))


def with_parts(df: DataFrame, keys: list[str], heavy: DataFrame, alias: str = "parts") -> DataFrame:
    """df with the number of parts of each row's key, 1 where it is not heavy. `heavy` is bounded (see heavy_keys), so it is
    broadcast and no row moves; null keys meet null."""
    side = heavy.select(*[F.col(k).alias(f"_heavy_{i}") for i, k in enumerate(keys)], F.col("parts").alias("_heavy_parts"))
    same = [F.col(k).eqNullSafe(F.col(f"_heavy_{i}")) for i, k in enumerate(keys)]
    out = df.join(F.broadcast(side), same, "left").withColumn(alias, F.coalesce("_heavy_parts", F.lit(1)))
    return out.drop("_heavy_parts", *[f"_heavy_{i}" for i in range(len(keys))])


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], *, heavy: DataFrame | None = None, part_rows: int = PART_ROWS, most_heavy: int = MOST_HEAVY) -> DataFrame:
    """Inner join on equal non-null keys whose hot keys are split: rows of `left` of a key with more rows than a part get a salt, a
    hash of the row, and the rows of `right` of that key are repeated once per salt.

    Without `heavy`, left is read twice (its keys are counted first): hand over a stored table. Equal rows of left share a salt."""
    if heavy is None:
        heavy = heavy_keys(durable(left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))), keys, part_rows=part_rows, most_heavy=most_heavy)
    row = F.xxhash64(*[F.col(c) for c, kind in left.dtypes if not kind.startswith("map")])
    a = with_parts(left, keys, heavy, "_parts").withColumn("_salt", F.pmod(row, F.col("_parts")).cast("int")).drop("_parts")
    b = with_parts(right, keys, heavy, "_parts").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    return a.join(b, [*keys, "_salt"]).drop("_salt")


def salted_counts(
    df: DataFrame,
    key: Column,
    member: Column | None = None,
    counted: Column | None = None,
    *,
    part_rows: int = PART_ROWS,
    most_heavy: int = MOST_HEAVY,
) -> DataFrame:
    """Rows, and distinct members, per key: (key, n_rows, n_members, parts, n_total), n_total being the rows of all keys.

    One pass counts rows per key, combined before its exchange, so that no key is hot in it. Distinct members of keys with
    more rows than a part are counted in two stages: a salt sends their rows to as many parts as the rows fill, partial counts
    per (key, salt) are merged by the key. The salt is a hash of the member, not a random number: a member falls into one
    part, so distinct counts add up, and a task that runs again after a lost executor makes the same rows. One exchange
    carries the data; both aggregations over (key, salt) use its partitioning, and the merge moves one row per (key, salt).
    Rows of one key and one member stay together, however many they are; they are counted as they are read and not held.

    `counted` restricts which members count as distinct (rows always count). Null keys are one key of their own, salted like
    any other; null members are rows but no members; without `member` there is nothing to count but rows; an empty input gives
    no rows; repeated rows each count; other columns, whatever their names, are ignored.
    """
    counts_as = F.lit(False) if member is None else member.isNotNull() & (F.lit(True) if counted is None else F.coalesce(counted, F.lit(False)))
    rows = df.select(key.alias("key"), (F.lit(None).cast("string") if member is None else member).alias("member"), counts_as.alias("counted"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("counted"), 1)).alias("n"))
    counts = durable(counts)
    total = counts.agg(F.sum("n_rows")).first()[0] or 0
    heavy = heavy_keys(counts, ["key"], part_rows=part_rows, most_heavy=most_heavy)
    counts = with_parts(counts, ["key"], heavy)
    salted = with_parts(rows.where("counted").select("key", "member"), ["key"], heavy).withColumn("salt", F.pmod(F.xxhash64("member"), F.col("parts")))
    once = salted.repartition("key", "salt").select("key", "salt", "member").distinct()
    per_salt = once.groupBy("key", "salt").agg(F.count(F.lit(1)).alias("m"))
    members = per_salt.groupBy(F.col("key").alias("_key")).agg(F.sum("m").alias("m"))
    out = counts.join(members, F.col("key").eqNullSafe(F.col("_key")), "left")
    return out.select("key", "n_rows", F.coalesce("m", F.lit(0)).alias("n_members"), "parts", F.lit(total).cast("bigint").alias("n_total"))
