"""Evaluation passages inside training text: CGK embedding, bit sampling, exact verification."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peertide.operators.skew import salted_join
from peertide.session import durable, spread

_TAG = re.compile(r"<!--.*?-->|</?[a-zA-Z][^<>]*>", re.S)
_INLINE = re.compile(r"</?(?:a|abbr|b|big|code|del|em|font|i|ins|kbd|mark|s|small|span|strike|strong|sub|sup|tt|u|wbr)\b[^<>]*>", re.I)
_UNSEEN = re.compile("[­​-‏⁠﻿]")
#: Windows embedded at a time; bounds what a task holds.
PIECE = 1 << 15
#: Bits of the filters of the items' keys and words: 8 MB each at most, whatever the number of items.
FILTER_BITS = 26
#: Item windows on which recall is measured, those of the smallest hashes.
MEASURED = 2000
#: Words remembered by a task with their hashes.
MEMO = 1 << 20
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case. Tags go (inline ones without a gap), character references stand for their
    character, characters that take no room go. Null and blank texts have none."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", text))
    if "&" in text:
        text = html.unescape(text)
    return _WORD.findall(_UNSEEN.sub("", text).casefold())


def hashes(w: list[str], memo: dict[str, int]) -> np.ndarray:
    """64-bit hashes of words: what windows are made of. At 10^9 different words 0.03 equal pairs are expected."""
    if len(memo) > MEMO:
        memo.clear()
    out = np.empty(len(w), np.int64)
    get = memo.get
    for i, x in enumerate(w):
        h = get(x)
        if h is None:
            h = memo[x] = xxhash.xxh3_64_intdigest(x) - (1 << 63)
        out[i] = h
    return out


class Embedding:
    """CGK random walks over windows of symbols, each with one sample of its positions.

    A walk copies a window of w symbols to 2w positions; at each position a random bit of (position, symbol) says whether it
    moves on. Windows within edit distance e end within Hamming distance O(e^2) with constant probability, equal windows
    always coincide. Every table has a walk of its own: a near window that one walk tears apart may still meet in the next.
    Symbols are any 64-bit numbers but 0, which pads; the random bit is the top one of a product with an odd number.
    """

    def __init__(self, window: int, tables: int, sampled: int, seed: int = 7):
        self.window, self.tables = window, tables
        each = [np.random.default_rng((seed, t)) for t in range(tables)]  # the first tables are the same however many there are
        self.moves = np.array([r.integers(-(1 << 62), 1 << 62, 2 * window, dtype=np.int64) * 2 + 1 for r in each])
        self.at = np.sort(np.array([r.permutation(2 * window)[:sampled] for r in each]), axis=1)
        self.mix = np.array([r.integers(1, 1 << 62, sampled, dtype=np.int64) | 1 for r in each])

    def keys(self, w: np.ndarray, only: range | None = None) -> np.ndarray:
        """(tables, n) hash values of n windows, of all tables or some."""
        n = len(w)
        padded = np.concatenate((w, np.zeros((n, 1), np.int64)), axis=1).ravel()
        base = np.arange(n) * (self.window + 1)
        only = range(self.tables) if only is None else only
        keys = np.empty((len(only), n), np.int64)
        with np.errstate(over="ignore"):
            for row, t in enumerate(only):
                at, h = base.copy(), np.full(n, t + 1, np.int64)
                end = base + self.window
                mix = dict(zip(self.at[t].tolist(), self.mix[t], strict=True))
                for j in range(int(self.at[t][-1]) + 1):
                    symbol = padded[at]
                    if j in mix:
                        h = (h ^ (symbol * mix[j])) * np.int64(-7046029254386353131)
                        h ^= h >> 29
                    at += (symbol * self.moves[t, j]) < 0
                    np.minimum(at, end, out=at)
                keys[row] = h
        return keys


KINDS_OF_EDIT = ("exchanged", "dropped", "inserted")


def edited(w: np.ndarray, edits: int, kind: str) -> np.ndarray:
    """Copies of windows with words exchanged, dropped or inserted at random places; cut to the window or filled up with a strange
    word, as at the end of a passage."""
    rng = np.random.default_rng(3)
    n, size = w.shape
    col = np.arange(size)
    for _ in range(edits):
        p, strange = rng.integers(0, size, n)[:, None], rng.integers(1, 1 << 62, n)[:, None]
        if kind == "exchanged":
            w = np.where(col == p, strange, w)
        elif kind == "dropped":
            w = np.where(col < p, w, np.concatenate((w[:, 1:], strange), axis=1))
        else:
            w = np.where(col < p, w, np.where(col == p, strange, np.roll(w, 1, axis=1)))
    return w


def _met(w: np.ndarray, edits: int, e: Embedding, tables: range) -> dict[str, np.ndarray]:
    mine = e.keys(w, tables)
    return {k: (mine == e.keys(edited(w, edits, k), tables)).any(axis=0) for k in KINDS_OF_EDIT}


def recall_of(w: np.ndarray, edits: int, tables: int, sampled: int) -> dict[str, float]:
    """Measured share of the given windows that meet an edited copy of themselves in some table, by kind of edit."""
    found = _met(w, edits, Embedding(w.shape[1], tables, sampled), range(tables))
    return {k: float(v.mean()) if len(w) else 1.0 for k, v in found.items()}


def tables_for(w: np.ndarray, edits: int, recall: float, sampled: int, most: int = 128) -> int:
    """The fewest tables whose measured recall, less two standard errors, reaches the target for every kind of edit; one for equal windows only."""
    if not edits or not len(w):
        return 1
    e = Embedding(w.shape[1], most, sampled)
    found = {k: np.zeros(len(w), bool) for k in KINDS_OF_EDIT}
    for t in range(most):
        for k, v in _met(w, edits, e, range(t, t + 1)).items():
            found[k] |= v
        worst = min(v.mean() for v in found.values())
        if worst - 2 * np.sqrt(worst * (1 - worst) / len(w)) >= recall:  # more surely than the sample alone
            return t + 1
    return most


def _bits(keys: DataFrame, name: str) -> np.ndarray:
    """The filter of the top FILTER_BITS bits of a column, put together from 4 kB pieces: a fixed size for any number of keys."""
    at = F.shiftrightunsigned(name, 64 - FILTER_BITS)
    pieces = keys.select(at.alias("at")).groupBy(F.floor(F.col("at") / 32768).alias("bucket"))
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in pieces.agg(F.bitmap_construct_agg(F.col("at") % 32768).alias("bits")).collect():
        out[r.bucket * 4096 : (r.bucket + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def _in(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    at = x.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _lists(a: np.ndarray) -> pa.ListArray:
    n, w = a.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * w), pa.array(a.ravel()))


def edit_distances(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Word edits between row i of a and row i of b, exact up to `most` (most + 1 beyond it); all rows at once, in a band."""
    n, w = a.shape
    far = most + 1
    band = {d: np.full(n, min(abs(d), far), np.int16) for d in range(-most, most + 1)}  # cost at (0, d)
    for i in range(1, w + 1):
        new = {}
        for d in range(-most, most + 1):
            j = i + d
            if j < 0 or j > w:
                continue
            best = np.full(n, far, np.int16) if j else np.full(n, min(i, far), np.int16)
            if j and 0 <= j - 1 and d in band:
                best = np.minimum(best, band[d] + (a[:, i - 1] != b[:, j - 1]))
            if d + 1 in band:
                best = np.minimum(best, band[d + 1] + 1)
            if d - 1 in new:
                best = np.minimum(best, new[d - 1] + 1)
            new[d] = np.minimum(best, far).astype(np.int16)
        band = new
    return band[0]


def common_run(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    """Longest run of equal words of row i of a and row i of b, set against each other at most `shift` words apart."""
    n, w = a.shape
    best = np.zeros(n, np.int32)
    for d in range(-shift, shift + 1):
        same = a[:, max(0, d) : w + min(0, d)] == b[:, max(0, -d) : w - max(0, d)]
        run = np.zeros(n, np.int32)
        for c in range(same.shape[1]):
            run = np.where(same[:, c], run + 1, 0).astype(np.int32)
            np.maximum(best, run, out=best)
    return best


def _windows(df: DataFrame, id_: str, text: str, window: int) -> DataFrame:
    """(uid, id, at, w) of all windows of the items; uid tells repeated items apart."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        uid = TaskContext.get().partitionId() << 40
        for b in it:
            for r, t in enumerate(b.column(1)):
                h = hashes(words(t.as_py()), memo)
                uid += 1
                n = len(h) - window + 1
                if n > 0:
                    w = np.lib.stride_tricks.sliding_window_view(h, window)
                    own = b.column(0).take(pa.array(np.full(n, r)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, uid)), own, pa.array(np.arange(n, dtype=np.int32)), _lists(w)], ["item", "item_id", "j", "v"])

    kind = df.schema[id_].dataType.simpleString()
    return df.select(id_, text).where(F.col(text).isNotNull()).mapInArrow(run, f"item bigint, item_id {kind}, j int, v array<bigint>")


def _keyed(windows: DataFrame, e: Embedding) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                w = b.column("v").flatten().to_numpy().reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*b.columns, _lists(np.ascontiguousarray(e.keys(w).T))], [*b.schema.names, "item_keys"])

    return windows.mapInArrow(run, f"item bigint, item_id {windows.schema['item_id'].dataType.simpleString()}, j int, v array<bigint>, item_keys array<bigint>")


def leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    window: int = 12,
    max_edits: int = 1,
    recall: float = 0.95,
    sampled: int = 7,
) -> DataFrame:
    """(doc_id, item_id, edits, longest_run): documents with a window of `window` words within `max_edits` word edits of a
    window of an item; edits is the smallest distance found, longest_run the longest exact common run of words: in equal
    windows that follow one another, else within the nearest windows.

    Windows start at every word of documents and items, and are embedded by as many random walks as it takes to meet a window
    at max_edits with the wanted `recall`, measured on up to MEASURED windows of the items for every kind of edit; equal
    windows meet in every table, so recall at distance 0 is 1. The items' keys are a stored table; the documents are read once,
    whatever the number of items: windows with fewer than window - max_edits words that items have, and keys that no item
    has, fall to two bit filters of fixed size. Of what is left each different window is joined by key and verified by the
    exact edit distance once; a window that a large part of the corpus shares is split when documents take up the result.

    Null, empty and blank texts and items shorter than the window give no rows; very long texts are cut into no pieces;
    repeated documents each report, repeated items count once; null ids are kept as they are, ids may be of any type.
    """
    item_windows = durable(_windows(items, item_id, text, window))
    some = item_windows.select(F.xxhash64("v").alias("h"), "v").distinct().orderBy("h").limit(MEASURED).collect()
    tables = tables_for(np.array([r.v for r in some], np.int64).reshape(-1, window), max_edits, recall, sampled)
    e = Embedding(window, tables, sampled)
    listed = durable(_keyed(item_windows, e))
    exploded = listed.select("*", F.explode("item_keys").alias("key"))
    filters = docs.sparkSession.sparkContext.broadcast((_bits(item_windows.select(F.explode("v").alias("x")), "x"), _bits(exploded.select("key"), "key")))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_words, of_keys = filters.value
        memo: dict[str, int] = {}
        uid = TaskContext.get().partitionId() << 40
        own: list[np.ndarray] = []
        row, doc, pos = [], [], []

        def flush(ids: pa.Array) -> Iterator[pa.RecordBatch]:
            w = np.concatenate(own)
            for lo in range(0, len(w), PIECE):
                keys = e.keys(w[lo : lo + PIECE]).T
                met = _in(of_keys, np.ascontiguousarray(keys).ravel()).reshape(keys.shape)
                hit = np.flatnonzero(met.any(axis=1))
                if len(hit):
                    at = hit + lo
                    off = np.r_[0, np.cumsum(met[hit].sum(axis=1))].astype(np.int32)
                    of = np.concatenate(row)[at], np.concatenate(doc)[at], np.concatenate(pos)[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(of[1]), ids.take(pa.array(of[0])), pa.array(of[2].astype(np.int32)), _lists(w[at]), pa.ListArray.from_arrays(pa.array(off), pa.array(keys[hit][met[hit]]))],
                        ["doc", "doc_id", "i", "w", "doc_keys"],
                    )
            for x in (own, row, doc, pos):
                x.clear()

        for b in it:
            held = 0
            for r, t in enumerate(b.column(1)):
                uid += 1
                w = words(t.as_py())
                if len(w) < window:
                    continue
                h = hashes(w, memo)
                known = np.r_[0, np.cumsum(_in(of_words, h))]
                at = np.flatnonzero(known[window:] - known[:-window] >= window - max_edits)
                if len(at):
                    own.append(np.lib.stride_tricks.sliding_window_view(h, window)[at])
                    row.append(np.full(len(at), r))
                    doc.append(np.full(len(at), uid))
                    pos.append(at)
                    held += len(at)
                    if held >= PIECE:
                        yield from flush(b.column(0))
                        held = 0
            if own:
                yield from flush(b.column(0))

    kind = docs.schema[doc_id].dataType.simpleString()
    found = spread(docs.select(doc_id, text).where(F.col(text).isNotNull())).mapInArrow(run, f"doc bigint, doc_id {kind}, i int, w array<bigint>, doc_keys array<bigint>")
    found = durable(found.withColumn("window", F.xxhash64("w")))
    # each different window is looked up and verified once, however many documents hold it
    different = found.groupBy("window").agg(F.first("w").alias("w"), F.first("doc_keys").alias("doc_keys"))
    met = different.withColumn("key", F.explode("doc_keys")).join(exploded, "key")
    met = met.where(F.array_intersect("doc_keys", "item_keys")[0] == F.col("key"))  # each pair once, where it first meets

    def verify(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if not b.num_rows:
                continue
            x, y = (b.column(c).flatten().to_numpy().reshape(b.num_rows, window) for c in ("w", "v"))
            dist = edit_distances(x, y, max_edits)
            ok = np.flatnonzero(dist <= max_edits)
            take = pa.array(ok)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c).take(take) for c in ("window", "item", "item_id", "j")], pa.array(dist[ok].astype(np.int32)), pa.array(common_run(x[ok], y[ok], max_edits))],
                ["window", "item", "item_id", "j", "edits", "run"],
            )

    kinds = f"window bigint, item bigint, item_id {items.schema[item_id].dataType.simpleString()}, j int, edits int, run int"
    equal = met.select("window", "item", "item_id", "j", "w", "v").mapInArrow(verify, kinds)
    pairs = salted_join(found.select("doc", "doc_id", "i", "window"), equal, ["window"])
    diagonal = Window.partitionBy("doc", "doc_id", "item", "item_id", F.col("i") - F.col("j")).orderBy("i")
    pairs = pairs.withColumn("island", F.when(F.col("edits") == 0, F.col("i") - F.sum((F.col("edits") == 0).cast("int")).over(diagonal)))
    lengths = pairs.groupBy("doc", "doc_id", "item", "item_id", F.col("i") - F.col("j"), "island").agg(F.min("edits").alias("edits"), F.max("run").alias("run"), F.count(F.lit(1)).cast("int").alias("n"))
    run_: Column = F.when(F.col("island").isNotNull(), F.lit(window - 1) + F.col("n")).otherwise(F.col("run"))
    out = lengths.groupBy("doc", "doc_id", "item_id").agg(F.min("edits").alias("edits"), F.max(run_).alias("longest_run"))
    return out.select(F.col("doc_id").alias(doc_id), F.col("item_id").alias(item_id), "edits", "longest_run")
