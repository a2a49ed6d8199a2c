"""Readings that cannot be true for their series: Hampel filter, stuck values, physical bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rolling_median(x: np.ndarray, series: np.ndarray, half: int) -> np.ndarray:
    """Median over the 2*half+1 readings around each one, cut at the ends of its series. x is grouped by series."""
    n = len(x)
    if not n:
        return x
    at = np.arange(n)[:, None] + np.arange(-half, half + 1)
    inside = (at >= 0) & (at < n)
    at = np.clip(at, 0, n - 1)
    inside &= series[at] == series[:, None]
    w = np.sort(np.where(inside, x[at], np.inf), axis=1)
    k = inside.sum(axis=1)
    rows = np.arange(n)
    return (w[rows, (k - 1) // 2] + w[rows, k // 2]) / 2


def median_by_series(x: np.ndarray, series: np.ndarray) -> np.ndarray:
    """The median of each reading's whole series, one value per reading."""
    order = np.lexsort((x, series))
    s, y = series[order], x[order]
    first = np.r_[0, np.flatnonzero(s[1:] != s[:-1]) + 1]
    size = np.diff(np.r_[first, len(s)])
    mid = (y[first + (size - 1) // 2] + y[first + size // 2]) / 2
    out = np.empty(len(x))
    out[order] = np.repeat(mid, size)
    return out


def run_lengths(same_as_before: np.ndarray) -> np.ndarray:
    """The length of the run each position belongs to; a run ends where the flag is false."""
    if not len(same_as_before):
        return np.zeros(0, int)
    flag = same_as_before.copy()
    flag[0] = False
    run = np.cumsum(~flag) - 1
    return np.bincount(run)[run]


def flag_readings(
    v: np.ndarray, series: np.ndarray, upper: float, half: int, deviations: float, factor: float, longest: int, stuck: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three flags per reading: out of bounds, spike, stuck. v is in time order within series and holds no nulls."""
    bound = (v < 0) | (v > upper)
    ok = ~bound & (v > 0)
    spike = np.zeros(len(v), bool)
    if ok.any():
        x, s = np.log(v[ok]), series[ok]
        r = x - rolling_median(x, s, half)
        usual = 1.4826 * median_by_series(np.abs(r), s)
        apart = (np.abs(r) > np.log(factor)) & (np.abs(r) > deviations * usual)
        side = np.where(apart, np.sign(r), 0)
        again = np.r_[False, (side[1:] == side[:-1]) & (s[1:] == s[:-1])]
        spike[ok] = apart & (run_lengths(again) <= longest)
    same = np.r_[False, (v[1:] == v[:-1]) & (series[1:] == series[:-1])][: len(v)]
    held = (run_lengths(same) >= stuck) & (v != 0)
    return bound, spike, held


def implausible(
    df: DataFrame,
    series: Column,
    at: Column,
    value: Column,
    *,
    upper: float,
    half: int = 7,
    deviations: float = 6.5,
    factor: float = 2.0,
    longest: int = 3,
    stuck: int = 6,
) -> DataFrame:
    """(series, at, value, out_of_bounds, spike, stuck): the readings of df that cannot be true, one reading per series and
    time expected.

    Out of bounds: negative or over `upper`. Spike: on the log scale a reading lies further than log(factor) and
    `deviations` times the series' usual deviation (1.4826 x median absolute residual) from the rolling median of the
    2*half+1 readings around it, in a run of at most `longest` such readings on one side. Impossible and zero readings take
    no part in levels. Stuck: `stuck` or more successive present readings of one non-zero value.

    The time series of one source is gathered as two arrays on the JVM side, its length is bounded by the number of time
    slots, and whole batches of series are filtered at once in numpy. Null series, times and values take no part; an empty
    table gives no rows; a series shorter than the window is compared with what there is.
    """
    arrays = (
        df.select(series.alias("series"), at.cast("timestamp_ntz").alias("at"), value.cast("double").alias("value"))
        .where("series is not null and at is not null and value is not null")
        .groupBy("series")
        .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("r"))
        .select("series", F.col("r.at").alias("at"), F.col("r.value").alias("value"))
    )

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            times, values = b.column("at"), b.column("value")
            if not b.num_rows:
                continue
            size = np.diff(values.offsets.to_numpy())
            code = np.repeat(np.arange(b.num_rows), size)
            v = values.flatten().to_numpy(zero_copy_only=False)
            bound, spike, held = flag_readings(v, code, upper, half, deviations, factor, longest, stuck)
            hit = np.flatnonzero(bound | spike | held)
            take = pa.array(hit)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("series").take(pa.array(code[hit])),
                    times.flatten().take(take),
                    pa.array(v[hit]),
                    pa.array(bound[hit]),
                    pa.array(spike[hit]),
                    pa.array(held[hit]),
                ],
                ["series", "at", "value", "out_of_bounds", "spike", "stuck"],
            )

    return arrays.mapInArrow(
        batches, "series string, at timestamp_ntz, value double, out_of_bounds boolean, spike boolean, stuck boolean"
    )
