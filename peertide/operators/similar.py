"""Pairs of similar strings without a key that could lose one."""

from __future__ import annotations

import difflib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peertide.session import durable

#: Counters that the pairs of neighbouring characters of a string are hashed to, and rows of a block: a block of counters has 16 MB.
WIDTH, BLOCK = 512, 8192
#: Cells of the matrix of shared pairs held at once.
CELLS = 4_000_000


def bounds(least: float, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """For each sum s of two lengths up to `longest`: how many characters a ratio (2 * matches / s) of `least` needs to match, and how many
    pairs of neighbours two such strings share at least. m matched characters leave s - 2m unmatched; with a mark at both ends there
    are m + 1 neighbours among the matched, and each unmatched character parts at most one of them."""
    s = np.arange(longest + 1)
    m = np.ceil(least * s / 2 - 1e-9).astype(int)
    return m, m + 1 - (s - 2 * m)


def neighbours(strings: list[str]) -> np.ndarray:
    """Counts of each string's pairs of neighbouring characters with a mark at both ends, hashed to WIDTH counters. The product of two
    rows is at least the number of pairs the strings share, whatever falls on one counter."""
    out = np.zeros((len(strings), WIDTH), np.float32)
    for i, s in enumerate(strings):
        c = np.array([1, *map(ord, s), 2], np.uint64)
        np.add.at(out[i], (((c[:-1] * np.uint64(1_000_003) + c[1:]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(55)).astype(np.int64), 1)
    return out


def compared(left: list[str], right: list[str], least: float) -> Iterator[tuple[int, int, float]]:
    """(i, j, ratio) of all pairs with a difflib ratio of at least `least`."""
    if not left or not right:
        return
    n, k = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    need, shared = bounds(least, int(n.max() + k.max()))
    shared = shared.astype(np.float32)
    b, step = neighbours(right).T.copy(), max(1, CELLS // len(right))
    same = difflib.SequenceMatcher(None)
    for at in range(0, len(left), step):
        part = n[at : at + step, None]
        total = part + k[None, :]
        may = (neighbours(left[at : at + step]) @ b >= shared[total]) & (np.minimum(part, k[None, :]) >= need[total])
        j, i = np.nonzero(may.T)  # by right string: what the matcher prepares for it serves all its pairs
        last = -1
        for x, y in zip((i + at).tolist(), j.tolist(), strict=True):
            if y != last:
                same.set_seq2(right[y])
                last = y
            same.set_seq1(left[x])
            if same.quick_ratio() >= least and (r := same.ratio()) >= least:
                yield x, y, r


def similar_pairs(left: DataFrame, right: DataFrame, a: str, key: str, b: str, *, least: float) -> DataFrame:
    """(a, key, ratio) of each row of left(a) and each row of right(key, b) whose difflib ratio is `least` or more.

    Rows meet in bands of length whose neighbours are as far apart as the ratio allows, each side cut into blocks of about BLOCK rows.
    Within two blocks all pairs are bounded from above at once by a matrix product, and only those that the bound lets pass are
    compared. Nothing is lost, but the products grow with the square of the rows.
    """
    left, right = durable(left), durable(right)
    parts, others = (max(1, math.ceil(x.count() / BLOCK)) for x in (left, right))
    width = math.log((2 - least) / least) + 1e-6

    def band(c: str) -> Column:
        return F.floor(F.log(F.greatest(F.length(c), F.lit(1)).cast("double")) / width).cast("int")

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    x = left.select(a, F.pmod(F.xxhash64(a), F.lit(parts)).cast("int").alias("_p"), F.explode(F.sequence(band(a) - 1, band(a) + 1)).alias("_b")).select("*", numbers(others).alias("_q"))
    y = right.select(key, b, F.pmod(F.xxhash64(key, b), F.lit(others)).cast("int").alias("_q"), band(b).alias("_b")).select("*", numbers(parts).alias("_p"))
    fields = {f.name: f.dataType.simpleString() for f in right.schema}

    def pairs(_, p: pa.Table, q: pa.Table) -> pa.Table:
        s, ids = p.column(a).to_pylist(), q.column(key).to_pylist()
        found = list(compared(s, q.column(b).to_pylist(), least))
        return pa.table(
            {a: pa.array([s[i] for i, _, _ in found], pa.string()), key: pa.array([ids[j] for _, j, _ in found], q.schema.field(key).type), "ratio": pa.array([r for _, _, r in found], pa.float64())}
        )

    by = ["_p", "_q", "_b"]
    return x.groupBy(*by).cogroup(y.groupBy(*by)).applyInArrow(pairs, f"{a} string, {key} {fields[key]}, ratio double")
