"""Joins beyond equality: prefix ranges, containment of word sets, latest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_lookup(df: DataFrame, value: Column, ranges: DataFrame, *, lo: str = "lo", hi: str = "hi", payload: str = "label", width: int = 65536) -> DataFrame:
    """df with the payload of the narrowest range [lo, hi] that holds `value` (longest prefix first), null if none.

    Both sides meet on blocks of `width`: a range is listed once per block it touches, a value falls into one block, so the join is
    an equi-join and not a nested loop. Ranges wider than 4096 blocks meet on a coarser level of width * 4096.
    """
    wide = (F.col(hi) - F.col(lo)) / width > 4096
    big = width * 4096

    def blocks(w: int) -> Column:
        return F.explode(F.sequence(F.floor(F.col(lo) / w), F.floor(F.col(hi) / w)))

    cols = [F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), F.col(payload)]
    listed = ranges.where(~wide).select(*cols, blocks(width).alias("_b"), F.lit(0).alias("_l")).unionByName(
        ranges.where(wide).select(*cols, blocks(big).alias("_b"), F.lit(1).alias("_l"))
    )
    keyed = df.withColumn("_v", value)
    distinct = keyed.select("_v").where("_v is not null").distinct()  # each value is looked up once
    levels = F.array(F.struct(F.floor(F.col("_v") / width).alias("b"), F.lit(0).alias("l")), F.struct(F.floor(F.col("_v") / big).alias("b"), F.lit(1).alias("l")))
    probes = distinct.withColumn("_p", F.explode(levels)).select("_v", F.col("_p.b").alias("_b"), F.col("_p.l").alias("_l"))
    hit = probes.join(listed, ["_b", "_l"]).where("_v between _lo and _hi")
    best = hit.groupBy("_v").agg(F.min(F.struct((F.col("_hi") - F.col("_lo")).alias("w"), F.col("_lo"), F.col(payload))).alias("m"))
    return keyed.join(best.select("_v", F.col("m")[payload].alias(payload)), "_v", "left").drop("_v")


def contained(names: DataFrame, aliases: DataFrame, frequency: DataFrame) -> DataFrame:
    """(name_id, alias_id, n_words) of aliases whose word set lies within a name's word set.

    names(name_id, words), aliases(alias_id, words), frequency(word, n). An alias is posted under its rarest word only, so that
    each containing name meets it once and frequent words are never join keys unless an alias has nothing else.
    """
    rare = (
        aliases.select("alias_id", F.col("words").alias("alias_words"), F.explode("words").alias("word"))
        .join(frequency, "word", "left")
        .groupBy("alias_id", "alias_words")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word")).alias("m"))
        .select("alias_id", "alias_words", F.col("m.word").alias("word"))
    )
    posted = names.select("name_id", "words", F.explode("words").alias("word")).join(rare, "word")
    inside = F.size(F.array_except("alias_words", "words")) == 0
    return posted.where(inside).select("name_id", "alias_id", F.size("alias_words").alias("n_words"))


def sharing(left: DataFrame, right: DataFrame, probe: str, listed: str) -> DataFrame:
    """Pairs of rows whose word sets `probe` and `listed` meet, each pair once: at the first probed word that both have. The pair is
    settled where it is found, so pairs are not shuffled to make them distinct."""
    met = left.withColumn("_w", F.explode(probe)).join(right.withColumn("_w", F.explode(listed)), "_w")
    return met.where(F.array_intersect(probe, listed)[0] == F.col("_w")).drop("_w")


def rarest_first(df: DataFrame, key: str, words: str, frequency: DataFrame) -> DataFrame:
    """df with the words of each row in order of rarity, from frequency(word, n); words that are not in it come first. key is unique."""
    w = df.select(key, F.explode(words).alias("word")).join(frequency, "word", "left")
    order = w.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word"))).alias("_o"))
    return df.join(order.select(key, F.col("_o.word").alias("_o")), key).withColumn(words, F.col("_o")).drop("_o")


def latest_before(df: DataFrame, key: list[str], at: str, as_of: Column, payload: list[str]) -> DataFrame:
    """Of each key the newest row not after as_of; rows of one time are settled by their payload."""
    pick = F.max(F.struct(F.col(at), *payload)).alias("m")
    return df.where(F.col(at) <= as_of).groupBy(*key).agg(pick).select(*key, F.col("m")[at].alias(at), *[F.col("m")[p].alias(p) for p in payload])
