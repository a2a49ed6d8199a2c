"""Streams of observations: counts per day, state of the upsert, alerts with a pause."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def daily_distinct(stream: DataFrame, at: str = "ingested_at", late: str = "2 days") -> DataFrame:
    """Distinct observers per hash, country and event day: repeats within the watermark are dropped, so state stays bounded by the
    lateness allowed."""
    once = stream.withWatermark(at, late).withColumn("day", F.window(at, "1 day")).dropDuplicates(["hash", "ip", "country", "day"])
    return once.groupBy("day", "hash", "country").agg(F.count(F.lit(1)).alias("n_ips")).select(F.to_date("day.start").alias("day"), "hash", "country", "n_ips")


def last_seen_state(stream: DataFrame, at: str = "ingested_at", late: str = "4 days") -> DataFrame:
    """First and last sighting per (hash, ip) and day of arrival: a day's state goes when the watermark has passed it, so state is bounded by the
    lateness allowed. `settled_last_seen` merges the days; an old replay changes nothing."""
    day = F.window(at, "1 day").alias("w")
    return stream.withWatermark(at, late).groupBy(day, "hash", "ip").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")).select(F.to_date("w.start").alias("day"), "hash", "ip", "first_seen", "last_seen")


def settled_last_seen(days: DataFrame) -> DataFrame:
    """The state of (hash, ip) over all days written so far."""
    return days.groupBy("hash", "ip").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def first_in_retention(stream: DataFrame, key: list[str], at: str = "ingested_at", keep: str = "4 days") -> DataFrame:
    """Each key once while it is remembered: a key is forgotten `keep` after its sighting, and then counts as new."""
    return stream.withWatermark(at, keep).dropDuplicatesWithinWatermark(key)


def throttled(events: DataFrame, key: str, at: str, pause_s: int, late: str = "1 hour", recovery: bool = False) -> DataFrame:
    """(key, at, kind): `alert` for the first event per key and again only `pause_s` seconds after the last alert; with `recovery` also
    `recovered` when none came for `pause_s` seconds. Upon that the key's state ends either way.

    Events of one second are one event, dropped before they reach the keyed state: however many there are, a key brings at
    most 86,400 a day to its task."""
    once = events.select(key, F.date_trunc("second", at).alias(at)).withWatermark(at, late).dropDuplicates([key, at])

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (_, seen) = state.get
            state.remove()
            if recovery:
                yield pd.DataFrame({key: [k[0]], at: [pd.Timestamp(seen + pause_s, unit="s")], "kind": ["recovered"]})
            return
        last, seen = state.get if state.exists else (-(1 << 62), 1 << 62)
        out = []
        for s in np.unique(np.concatenate([f[at].to_numpy("datetime64[s]").astype(np.int64) for f in frames])).tolist():
            if recovery and s - seen >= pause_s:
                out.append((seen + pause_s, "recovered"))
            if s - last >= pause_s:
                out.append((s, "alert"))
                last = s
            seen = s if seen == 1 << 62 else max(seen, s)
        state.update((last, seen))
        state.setTimeoutTimestamp(max((seen + pause_s) * 1000, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame({key: [k[0]] * len(out), at: pd.to_datetime([s for s, _ in out], unit="s"), "kind": [x for _, x in out]})

    return once.groupBy(key).applyInPandasWithState(run, f"{key} string, {at} timestamp, kind string", "last long, seen long", "append", GroupStateTimeout.EventTimeTimeout)


def upsert_batches(stream: DataFrame, path: str, checkpoint: str):
    """Micro-batches appended with their batch id, exact repeats once; a batch that runs again replaces its own partition, so the
    log holds each batch once. The state is the view `latest_view` over the log."""

    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.dropDuplicates().withColumn("batch", F.lit(batch_id))
        b.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
