"""Canonical ids: which of several ids for one work stands for all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def canonical_map(df: DataFrame, key: list[Column], id_: str, order: list[Column]) -> DataFrame:
    """(old, new): within groups of equal non-null key the first id in a total order stands for the others; groups of one id
    give no rows. A minimum per group and a join back: no group is gathered."""
    keys = {f"_k{i}": k for i, k in enumerate(key)}
    ids = df.select(F.col(id_).alias("old"), *[k.alias(n) for n, k in keys.items()], F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(id_).alias("id")).alias("_o"))
    for n in keys:
        ids = ids.where(F.col(n).isNotNull())
    best = ids.groupBy(*keys).agg(F.min("_o").alias("m")).select(*keys, F.col("m.id").alias("new"))
    return ids.join(best, list(keys)).where("old != new").groupBy("old").agg(F.min("new").alias("new"))


def chained_map(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two maps applied one after the other, so that no old id points at an id that is itself replaced."""
    a, b = first.alias("a"), second.alias("b")
    through = a.join(b, F.col("a.new") == F.col("b.old"), "left").select(F.col("a.old").alias("old"), F.coalesce("b.new", "a.new").alias("new"))
    rest = second.join(first.select("old"), "old", "left_anti")
    return through.unionByName(rest).where("old != new")


def resolve(df: DataFrame, by_imdb: DataFrame, known: DataFrame, *, id_: str = "ip_id", imdb: str = "imdb") -> DataFrame:
    """df with `resolved` and `unmapped`: the catalogue id of the imdb number, else the id itself if the catalogue knows it, else
    null and unmapped = 1."""
    a = df.join(by_imdb.select(F.col("imdb").alias("_i"), F.col("id").alias("_by")), F.col(imdb) == F.col("_i"), "left").drop("_i")
    b = a.join(known.select(F.col("id").alias("_k")).distinct(), F.col(id_) == F.col("_k"), "left")
    r = F.coalesce("_by", "_k")
    return b.withColumn("resolved", r).withColumn("unmapped", r.isNull().cast("int")).drop("_by", "_k")


def strict_best(df: DataFrame, by: list[str], score: str, pick: str) -> DataFrame:
    """The best candidate per group, none where two different candidates share the best score."""
    w = Window.partitionBy(*by)
    top = df.withColumn("_m", F.max(score).over(w)).where(F.col(score) == F.col("_m"))
    return top.groupBy(*by).agg(F.min(pick).alias(pick), F.count_distinct(pick).alias("_n"), F.max(score).alias(score)).where("_n = 1").drop("_n")


def canonical_by_authority(meta: DataFrame, compatible) -> DataFrame:
    """(old, new) from meta(ip_id, title, imdb, anime, resolved), one row per id.

    Ids of one imdb number are one work, else ids of one anime id; the first resolved id, then the first id, stands for them. Ids
    without either that nothing resolves fold into the id of their title's one resolved id, followed to what stands for it, if
    `compatible(old, new)`. Equal titles of different numbers stay apart. No new id is itself replaced."""
    key = F.when(F.col("imdb").isNotNull(), F.concat(F.lit("i"), "imdb")).otherwise(F.concat(F.lit("a"), "anime"))
    known = meta.select("ip_id", F.col("resolved").isNull().alias("late"), key.alias("key")).where("key is not null")
    best = known.groupBy("key").agg(F.min(F.struct("late", "ip_id")).alias("m")).select("key", F.col("m.ip_id").alias("new"))
    hard = known.join(best, "key").select(F.col("ip_id").alias("old"), "new")
    resolved = meta.where("resolved is not null")
    lone = resolved.where("title is not null").groupBy("title").agg(F.min("resolved").alias("resolved"), F.max("resolved").alias("most")).where("resolved = most").drop("most")
    home = resolved.groupBy("resolved").agg(F.min("ip_id").alias("home"))
    loose = meta.where("imdb is null and anime is null and resolved is null").select(F.col("ip_id").alias("old"), "title")
    soft = loose.join(lone, "title").join(home, "resolved").join(hard.select(F.col("old").alias("home"), "new"), "home", "left").select("old", F.coalesce("new", "home").alias("new"))
    return hard.unionByName(soft.where(compatible(F.col("old"), F.col("new")))).where("old != new")
