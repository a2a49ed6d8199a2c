"""Overlap sizes between many large sets: galloping intersection on delta-encoded sorted runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peertide.operators.skew import heavy_keys, salted_join
from peertide.session import durable

#: Identifiers a run holds about; sets are cut into ranges of the identifier space so that no run is much longer.
RUN = 4096
#: Partners met by one copy of a run; a set with more partners is copied to several tasks.
PARTNERS = 1024


def encode(x: np.ndarray) -> bytes:
    """A sorted run of unsigned 64-bit identifiers: first value, width in bytes of the largest gap, gaps at that width."""
    if not len(x):
        return b""
    gaps = np.diff(x)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    body = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    return int(x[0]).to_bytes(8, "little") + bytes([width]) + body


def decode(b: bytes) -> np.ndarray:
    if not b:
        return np.zeros(0, np.uint64)
    width = b[8]
    body = np.frombuffer(b, np.uint8, offset=9).reshape(-1, width)
    out = np.zeros((len(body) + 1, 8), np.uint8)
    out[1:, :width] = body
    out = out.view("<u8").ravel()
    out[0] = int.from_bytes(b[:8], "little")
    return np.cumsum(out, dtype=np.uint64)


def gallop(small: np.ndarray, big: np.ndarray) -> np.ndarray:
    """Which values of `small` are in `big`: exponential search, all values in lock step.

    Each search starts at a fence (every 64th value of big), doubles its step until it passes its value and bisects the
    last bracket.
    """
    n = len(big)
    if not n or not len(small):
        return np.zeros(len(small), bool)
    fences = big[::64]
    lo = (np.maximum(np.searchsorted(fences, small, "right"), 1) - 1) * 64
    step = 1
    while True:
        nxt = np.minimum(lo + step, n - 1)
        on = (big[nxt] <= small) & (nxt > lo)
        if not on.any():
            break
        lo = np.where(on, nxt, lo)
        step *= 2
    hi = np.minimum(lo + step, n - 1)
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        up = big[mid] <= small
        lo, hi = np.where(up, mid, lo), np.where(up, hi, mid - 1)
    return big[lo] == small


def linear(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted runs by one merge."""
    x = np.concatenate((a, b))
    x.sort(kind="stable")
    return int(np.count_nonzero(x[1:] == x[:-1]))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Linear merge for runs of like size, exponential search where one is much shorter."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) * max(1, int(len(b)).bit_length()) < len(a) + len(b):
        return int(np.count_nonzero(gallop(a, b)))
    return linear(a, b)


def _ranges(n: Column) -> Column:
    """Bits of the identifier that number the ranges of a set of n."""
    return F.greatest(F.lit(0), F.ceil(F.log2(n / F.lit(float(RUN))))).cast("int")


def _range_of(i: Column, bits: Column) -> Column:
    return F.when(bits == 0, F.lit(0).cast("bigint")).otherwise(F.call_function("shiftrightunsigned", i, (F.lit(64) - bits).cast("int")))


def overlaps(df: DataFrame, set_key: Column, member: Column, *, min_size: int = 40, min_share: float = 0.5) -> DataFrame:
    """(set_a, set_b, n_a, n_b, n_shared) for pairs of sets of at least `min_size` distinct members that share at least
    `min_share` of the smaller one's members; set_a < set_b.

    Members and sets are handled as 64-bit hash values (at 10^9 distinct members 0.03 colliding pairs are expected).

    Candidates lose nothing: to share t of its n members with a larger set, the smaller one must share at least
    p - n + t of any p of its members. The p members taken are its rarest, up to a rarity level at which p > n - t, so
    members seen nearly everywhere are not probed unless a set has little else. The level comes from a histogram per set;
    no set is sorted or gathered. Whole octaves are probed: fewer members would do, but the more are probed, the more of them a
    candidate has to share. A set of nothing but common members still meets every set that holds one of those it probes.

    Joins on a set or a member split hot sets and hot members by rows (see operators.skew).

    Each candidate pair is then counted by its runs: a set is cut into ranges of the identifier space of about 4,096 members,
    each a delta-encoded sorted run. A pair's fragments of the smaller set travel to the ranges of the larger one, a run meets
    at most about 1,024 partners per task, and the counts per pair and range are summed.

    Null keys and members take no part, repeats count once, sets under min_size give no rows, an empty table none.
    """
    named = df.select(set_key.alias("name"), member.alias("m")).where("name is not null and m is not null")
    rows = named.select(F.xxhash64("name").alias("s"), F.xxhash64("m").alias("i"))
    elements = durable(rows.distinct())
    sizes = durable(elements.groupBy("s").agg(F.count(F.lit(1)).cast("int").alias("n")).where(F.col("n") >= min_size))
    hot_sets = heavy_keys(sizes, ["s"])  # as it is, for every join on a set below
    e = salted_join(elements, sizes, ["s"], heavy=hot_sets)
    # members of one set only cannot be shared; the others get a level of rarity by the number of their sets
    sets_of = durable(e.groupBy("i").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    level = F.floor(F.log2("n")).cast("int")
    common = salted_join(e, sets_of.select("i", level.alias("level")), ["i"], heavy=heavy_keys(sets_of, ["i"]))
    common = durable(common.select("s", "i", "n", "level"))
    need = F.ceil(F.col("n") * F.lit(min_share))
    hist = common.groupBy("s", "n", "level").agg(F.count(F.lit(1)).alias("c"))
    total = Window.partitionBy("s")
    upto = total.orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        hist.withColumn("t", need)
        .withColumn("single", F.col("n") - F.sum("c").over(total))
        .withColumn("p", F.col("single") + F.sum("c").over(upto))
        .where("p > n - t and n - single >= t")
        .groupBy("s", "t")
        .agg(F.min(F.struct("level", "p", "n")).alias("m"))
        .select(F.col("s"), F.col("m.level").alias("top"), (F.col("m.p") - F.col("m.n") + F.col("t")).alias("k"))
    )
    probe = salted_join(common, cut, ["s"], heavy=hot_sets).where("level <= top").select("i", F.col("s").alias("a"), F.col("n").alias("n_a"), "k")
    other = common.select("i", F.col("s").alias("b"), F.col("n").alias("n_b"))
    larger = (F.col("n_b") > F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("b") > F.col("a")))
    cand = (
        salted_join(other, probe, ["i"], heavy=heavy_keys(sets_of, ["i"])).where(larger).groupBy("a", "b", "n_a", "n_b", "k").agg(F.count(F.lit(1)).alias("c")).where("c >= k")
    )
    cand = durable(cand)
    cand = cand.withColumn("bits", _ranges(F.col("n_b"))).select("a", "b", "n_a", "n_b", "bits")
    partners = cand.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / F.lit(PARTNERS)).cast("int").alias("copies"))
    cand = cand.join(partners, "b").withColumn("copy", F.pmod(F.xxhash64("a"), F.col("copies")))

    # runs of the larger side, and the fragments of the smaller side cut at the larger side's ranges
    wanted = cand.select(F.col("b").alias("s"), "copies").distinct()
    big = salted_join(common, wanted, ["s"], heavy=hot_sets).withColumn("bits", _ranges(F.col("n")))
    runs = big.groupBy(F.col("s").alias("b"), _range_of(F.col("i"), F.col("bits")).alias("r"), "copies").agg(F.collect_list("i").alias("ids"))
    runs = runs.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies").cast("bigint") - 1)))
    fragments = (
        salted_join(common.select("s", "i"), cand.select(F.col("a").alias("s"), "b", "bits", "copy"), ["s"], heavy=hot_sets)
        .withColumnRenamed("s", "a")
        .groupBy("b", _range_of(F.col("i"), F.col("bits")).alias("r"), "copy", "a")
        .agg(F.collect_list("i").alias("ids"))
    )

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorts and delta-encodes each list, so that runs travel compressed."""
        for x in it:
            ids = x.column("ids")
            flat, off = ids.flatten().to_numpy().view(np.uint64), ids.offsets.to_numpy()
            out = [encode(np.sort(flat[off[j] - off[0] : off[j + 1] - off[0]])) for j in range(x.num_rows)]
            keep = [n for n in x.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays([*[x.column(n) for n in keep], pa.array(out, pa.binary())], [*keep, "run"])

    fragments = fragments.mapInArrow(pack, "b bigint, r bigint, copy bigint, a bigint, run binary")
    fragments = fragments.groupBy("b", "r", "copy").agg(F.collect_list(F.struct("a", "run")).alias("f"))
    runs = runs.select("b", "r", "copy", "ids").mapInArrow(pack, "b bigint, r bigint, copy bigint, run binary")
    work = runs.join(fragments, ["b", "r", "copy"]).select("b", "run", F.col("f.a").alias("a"), F.col("f.run").alias("runs"))

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in it:
            a_names, a_runs = x.column("a"), x.column("runs")
            off = a_names.offsets.to_numpy()
            frag = a_runs.flatten().to_pylist()
            names, bs, cs = [], [], []
            for j, (b, run) in enumerate(zip(x.column("b").to_pylist(), x.column("run").to_pylist(), strict=True)):
                big_run = decode(run)
                for f in range(off[j] - off[0], off[j + 1] - off[0]):
                    c = shared(decode(frag[f]), big_run)
                    if c:
                        names.append(f)
                        bs.append(b)
                        cs.append(c)
            yield pa.RecordBatch.from_arrays(
                [a_names.flatten().take(pa.array(names, pa.int64())), pa.array(bs, pa.int64()), pa.array(cs, pa.int64())], ["a", "b", "c"]
            )

    counts = work.mapInArrow(count, "a bigint, b bigint, c bigint").groupBy("a", "b").agg(F.sum("c").alias("n_shared"))
    out = counts.join(cand.select("a", "b", "n_a", "n_b"), ["a", "b"]).where(F.col("n_shared") >= F.ceil(F.col("n_a") * F.lit(min_share)))
    out = durable(out)
    wanted_names = out.select(F.explode(F.array("a", "b")).alias("s")).distinct()
    names = named.select("name", F.xxhash64("name").alias("s")).join(wanted_names, "s", "left_semi").distinct()
    out = out.join(names.select(F.col("s").alias("a"), F.col("name").alias("name_a")), "a")
    out = out.join(names.select(F.col("s").alias("b"), F.col("name").alias("name_b")), "b")
    swap = F.col("name_a") > F.col("name_b")
    return out.select(
        F.least("name_a", "name_b").alias("set_a"),
        F.greatest("name_a", "name_b").alias("set_b"),
        F.when(swap, F.col("n_b")).otherwise(F.col("n_a")).cast("bigint").alias("n_a"),
        F.when(swap, F.col("n_a")).otherwise(F.col("n_b")).cast("bigint").alias("n_b"),
        "n_shared",
    )
