"""Encoding of whole texts with a public byte-level BPE vocabulary, through a compiled lexicon of frequent words."""

from __future__ import annotations

import base64
import heapq
import os
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peertide.session import spread

#: Where the vocabulary lies unless the caller says otherwise.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words remembered per task process.
MEMO = 300_000
#: Distinct words a task counts before it passes its counts on.
COUNTED = 500_000


def splitter() -> Callable[[str], list[str]]:
    """A function that cuts a text into the words of PATTERN.

    The standard library's expressions run twice as fast as those that know Unicode properties and mean the same by letters,
    decimal digits and white space. Texts with a character on which they differ (numbers that are no decimals, the four
    separators that only Python takes for white space) go the exact way.
    """
    # \p{White_Space} is what the vocabulary's own library means by \s
    exact = regex.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
    fast = re.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]+", r"(?:[^\s\w]+|_+)+").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")).findall
    alike: set[str] = set()

    def split(text: str) -> list[str]:
        new = set(text) - alike
        if new:
            # letters are letters in both, also those that count as numbers; marks are neither
            good = {c for c in new if c not in "\x1c\x1d\x1e\x1f" and (c.isalpha() or c.isdecimal() or not c.isalnum())}
            alike.update(good)
            if len(good) < len(new):
                return exact(text)
        return fast(text)

    return split


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The exact merges of one word: always the pair of lowest rank, the leftmost of equals. A heap over a linked list, so that
    very long words take n log n steps."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))  # where the part that starts here ends
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, j, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, j, e = heapq.heappop(heap)
        if not alive[i] or j >= n or not alive[j] or end[i] != j or end[j] != e:
            continue
        end[i], alive[j] = e, False
        if e < n:
            prev[e] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Lexicon:
    """A minimal acyclic transducer from words to ids: equal suffixes share their states; the number of words passed on the
    way to a word is its index into the ids. Arrays only, so that it can be memory-mapped."""

    FIELDS = ("arc_key", "arc_to", "arc_skip", "final", "offset", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        for f in self.FIELDS:
            setattr(self, f, arrays[f])

    @classmethod
    def build(cls, words: dict[bytes, list[int]]) -> Lexicon:
        ordered = sorted(words)
        register: dict[tuple, int] = {}
        states: list[tuple] = []  # (final, ((byte, target), ...))
        path: list[list] = [[False, []]]  # open states along the last word
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                key = (final, tuple(arcs))
                if key not in register:
                    register[key] = len(states)
                    states.append(key)
                path[-1][1][-1] = (path[-1][1][-1][0], register[key])

        for w in ordered:
            common = len(os.path.commonprefix([w, last]))
            close(common)
            for b in w[common:]:
                path[-1][1].append((b, -1))
                path.append([False, []])
            path[-1][0] = True
            last = w
        close(0)
        root = (path[0][0], tuple(path[0][1]))
        states.append(root)
        order = [len(states) - 1, *range(len(states) - 1)]  # the root becomes state 0
        number = {s: i for i, s in enumerate(order)}
        below = [0] * len(states)
        for i, (final, arcs) in enumerate(states):  # children are numbered before their parents
            below[i] = int(final) + sum(below[t] for _, t in arcs)
        key, to, skip, finals = [], [], [], np.zeros(len(states), np.int64)
        for new, s in enumerate(order):
            final, arcs = states[s]
            finals[new] = int(final)
            passed = int(final)
            for b, t in arcs:
                key.append(new * 256 + b)
                to.append(number[t])
                skip.append(passed)
                passed += below[t]
        ids = [words[w] for w in ordered]
        return cls(
            {
                "arc_key": np.array(key, np.int64),
                "arc_to": np.array(to, np.int64),
                "arc_skip": np.array(skip, np.int64),
                "final": finals,
                "offset": np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int64),
                "ids": np.array([y for x in ids for y in x], np.int32),
            }
        )

    def save(self, path: str) -> None:
        """One file: a header of lengths, then the arrays, eight-byte aligned."""
        arrays = [getattr(self, f) for f in self.FIELDS]
        with open(path, "wb") as f:
            f.write(np.array([len(a) for a in arrays], np.int64).tobytes())
            for a in arrays:
                f.write(a.tobytes() + b"\0" * (-a.nbytes % 8))

    @classmethod
    def load(cls, path: str) -> Lexicon:
        raw = np.memmap(path, np.uint8, "r")
        sizes = raw[: 8 * len(cls.FIELDS)].view(np.int64)
        at, arrays = 8 * len(cls.FIELDS), {}
        for f, n in zip(cls.FIELDS, sizes, strict=True):
            kind = np.dtype(np.int32 if f == "ids" else np.int64)
            arrays[f] = raw[at : at + n * kind.itemsize].view(kind)
            at += (n * kind.itemsize + 7) // 8 * 8
        return cls(arrays)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Index of each word, -1 where it is not in the lexicon; all words walk at once."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.arc_key):
            return out
        size = np.array([len(w) for w in words])
        row = np.flatnonzero((size > 0) & (size <= 64))
        width = int(size[row].max()) if len(row) else 0
        text = np.zeros((len(row), width), np.int64)
        for i, r in enumerate(row):
            text[i, : size[r]] = np.frombuffer(words[r], np.uint8)
        state, index, size = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64), size[row]
        for j in range(width + 1):
            done = size == j
            hit = done & (self.final[state] == 1)
            out[row[hit]] = index[hit]
            go = ~done
            row, text, state, index, size = row[go], text[go], state[go], index[go], size[go]
            if not len(row):
                break
            key = state * 256 + text[:, j]
            at = np.minimum(np.searchsorted(self.arc_key, key), len(self.arc_key) - 1)
            on = self.arc_key[at] == key
            row, text, size, at, index = row[on], text[on], size[on], at[on], index[on]
            index = index + self.arc_skip[at]
            state = self.arc_to[at]
        return out

    def output(self, i: int) -> list[int]:
        return self.ids[self.offset[i] : self.offset[i + 1]].tolist()


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, n) over all texts. Tasks pass on partial counts, at most COUNTED distinct words at a time."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, c = splitter(), Counter()

        def flush() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["word", "n"])
            c.clear()
            return b

        for b in it:
            for t in b.column(0):
                s = t.as_py()
                if s:
                    c.update(split(s))
            if len(c) > COUNTED:
                yield flush()
        yield flush()

    part = spread(docs.select(text).where(f"{text} is not null")).mapInArrow(run, "word string, n bigint")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


def encode_texts(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, frequent: int = 50_000
) -> DataFrame:
    """(doc_id, ids): each text by the byte-level BPE vocabulary, without special tokens.

    The `frequent` most frequent words of the whole corpus (a bounded number; ties by the word) are merged once on the driver
    and compiled into a minimal acyclic transducer, which each task memory-maps; all other words are merged exactly where they
    occur. Null, empty texts get an empty list; white space is text like any other; strings of special tokens are ordinary
    text; very long texts and words are encoded whole; repeated rows each give a row.
    """
    spark = docs.sparkSession
    ranks = read_ranks(vocabulary)
    top = word_counts(docs, text).orderBy(F.desc("n"), "word").limit(frequent).collect()
    lex = Lexicon.build({(w := r.word.encode()): merge_word(w, ranks) for r in top})
    folder = tempfile.mkdtemp(prefix="lexicon-")  # only where the driver hands the file out from
    name = f"lexicon-{uuid.uuid4().hex}.bin"  # a name of its own: files of a session are known by their names
    lex.save(f"{folder}/{name}")
    spark.sparkContext.addFile(f"{folder}/{name}")
    spark.sparkContext.addFile(vocabulary)
    vocabulary_name = os.path.basename(vocabulary)
    state: dict = {}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.update(lex=Lexicon.load(SparkFiles.get(name)), ranks=read_ranks(SparkFiles.get(vocabulary_name)), split=splitter(), memo={})
        lex, ranks, memo, split = state["lex"], state["ranks"], state["memo"], state["split"]
        for b in it:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                cut = [split(t) if t else [] for t in part.column(1).to_pylist()]
                new = list({w for c in cut for w in c if w not in memo})
                if len(memo) + len(new) > MEMO:
                    memo.clear()
                    new = list({w for c in cut for w in c})
                raw = [w.encode() for w in new]
                for w, x, at in zip(new, raw, lex.find(raw).tolist(), strict=True):
                    memo[w] = lex.output(at) if at >= 0 else merge_word(x, ranks)
                flat: list[int] = []
                ends = [0]
                for c in cut:
                    for w in c:
                        flat += memo[w]
                    ends.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], [doc_id, "ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return spread(docs.select(doc_id, text)).mapInArrow(run, f"{doc_id} {kind}, ids array<int>")
