"""Personal information inside free text: a character BiLSTM with CRF transitions in numpy, then an exact check of form."""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peertide.llm import pii_forms as forms
from peertide.session import spread

KINDS = forms.KINDS
#: Tags: 0 outside, 1 + 2k begins a span of kind k, 2 + 2k continues it.
TAGS = 1 + 2 * len(KINDS)
#: Characters of a window and the step between windows; spans up to WINDOW - STEP characters lie whole in some window.
WINDOW, STEP = 512, 432
#: Windows decoded at once; bounds what a task holds.
BATCH = 512
MODEL = os.path.join(os.path.dirname(__file__), "pii_model.npz")

_PRINT = 32, 127


def char_table() -> np.ndarray:
    """Class of each code point: ASCII as itself, accented letters as their base letter, all else by kind of character."""
    t = np.zeros(0x110000, np.uint8)
    t[_PRINT[0] : _PRINT[1]] = np.arange(_PRINT[1] - _PRINT[0]) + 8
    t[ord("\n")], t[ord("\r")], t[ord("\t")] = 1, 1, 2
    for c in range(0xA0, 0x3000):
        ch = chr(c)
        base = unicodedata.normalize("NFKD", ch)[0]
        if _PRINT[0] <= ord(base) < _PRINT[1]:
            t[c] = ord(base) - _PRINT[0] + 8
        elif ch.isalpha():
            t[c] = 4 if ch.islower() else 5
        elif ch.isdigit():
            t[c] = 6
        else:
            t[c] = 7
    t[0x3000:0xFB00] = 3
    for a, b in (("ß", "s"), ("Ł", "L"), ("ł", "l"), ("Ø", "O"), ("ø", "o"), ("æ", "a"), ("ı", "i"), ("’", "'"), ("–", "-"), ("—", "-")):
        t[ord(a)] = ord(b) - _PRINT[0] + 8
    return t


CHARS = 8 + _PRINT[1] - _PRINT[0]


def start_and_moves() -> tuple[np.ndarray, np.ndarray]:
    """Transitions that spans forbid: a tag inside k follows only its own begin or inside."""
    first, move = np.zeros(TAGS, np.float32), np.zeros((TAGS, TAGS), np.float32)
    for k in range(len(KINDS)):
        first[2 + 2 * k] = -1e4
        for a in range(TAGS):
            if a not in (1 + 2 * k, 2 + 2 * k):
                move[a, 2 + 2 * k] = -1e4
    return first, move


class Tagger:
    """w: wx (2, CHARS, 4H) input rows of the gates per character and direction, wh (2, H, 4H), b (2, 4H), wo (2H, TAGS),
    bo (TAGS), move (TAGS, TAGS). Gates in the order input, forget, output, candidate."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = {k: np.ascontiguousarray(v, np.float32) for k, v in w.items()}
        self.h = self.w["wh"].shape[1]
        self.first, self.barred = start_and_moves()
        # sigmoid(x) = (1 + tanh(x / 2)) / 2: one tanh serves all gates
        half = np.concatenate([np.full(3 * self.h, 0.5), np.ones(self.h)]).astype(np.float32)
        self.wx = self.w["wx"] * half
        self.wx += (self.w["b"] * half)[:, None, :]
        # hidden states are kept doubled, which saves a pass over the gates; the weights that read them are halved
        self.wh = np.ascontiguousarray(self.w["wh"] * half * np.float32(0.5))
        self.wo = self.w["wo"] * np.float32(0.5)

    @classmethod
    def load(cls, path: str) -> Tagger:
        with np.load(path) as z:
            return cls({k: z[k] for k in z.files})

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """(n, T, TAGS) for n windows of T character classes."""
        n, t = codes.shape
        h = self.h
        out = np.empty((2, t, n, h), np.float32)
        at = np.ascontiguousarray(codes.T).astype(np.intp)
        g, back, add = np.empty((n, 4 * h), np.float32), np.empty((n, 4 * h), np.float32), np.empty((n, h), np.float32)
        for d in (0, 1):
            hs, cs = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
            for step in range(t) if d == 0 else range(t - 1, -1, -1):
                np.take(self.wx[d], at[step], axis=0, out=g, mode="clip")
                np.matmul(hs, self.wh[d], out=back)
                g += back
                np.tanh(g, out=g)
                g[:, : 3 * h] += 1  # twice the sigmoid
                cs *= g[:, h : 2 * h]
                np.multiply(g[:, :h], g[:, 3 * h :], out=add)
                cs += add
                cs *= 0.5
                hs = out[d, step]
                np.tanh(cs, out=hs)
                hs *= g[:, 2 * h : 3 * h]
        e = out[0].reshape(-1, h) @ self.wo[:h]
        e += out[1].reshape(-1, h) @ self.wo[h:]
        e += self.w["bo"]
        return e.reshape(t, n, TAGS).transpose(1, 0, 2)

    def surely_outside(self, e: np.ndarray, lean: float) -> np.ndarray:
        """Windows whose best path is certainly all outside: no span of any kind from any position on scores more than tag 0 over
        the same characters, even with the best gain of a transition at each of its ends and characters."""
        gain = 2 * max(0.0, float((self.w["move"] + self.barred - self.w["move"][0, 0]).max()))
        begin = e[:, :, 1::2] - e[:, :, :1] + (lean + gain)
        inside = np.ascontiguousarray((e[:, :, 2::2] - e[:, :, :1] + gain).transpose(1, 0, 2))
        best = begin.transpose(1, 0, 2).copy()
        rest = np.zeros_like(inside[0])
        for t in range(e.shape[1] - 1, 0, -1):
            rest = np.maximum(inside[t] + rest, 0)
            best[t - 1] += rest
        return (best <= 0).all(axis=(0, 2))

    def decode(self, e: np.ndarray, size: np.ndarray, lean: float = 0.0) -> np.ndarray:
        """As viterbi, which only runs where it may find something."""
        open_ = ~self.surely_outside(e, lean)
        tags = np.zeros(e.shape[:2], np.uint8)
        if open_.any():
            tags[open_] = self.viterbi(e[open_], size[open_], lean)
        return tags

    def viterbi(self, e: np.ndarray, size: np.ndarray, lean: float = 0.0) -> np.ndarray:
        """Best tags of n windows; positions from size on are outside. `lean` is added once per span, for recall."""
        n, t, _ = e.shape
        e = e.copy()
        e[:, :, 1::2] += lean
        e[np.arange(t) >= size[:, None]] = np.r_[0, np.full(TAGS - 1, -1e4)]
        move = self.w["move"] + self.barred
        score = e[:, 0] + self.first
        back = np.empty((t, n, TAGS), np.uint8)
        for step in range(1, t):
            all_ = score[:, :, None] + move
            back[step] = all_.argmax(axis=1)
            score = np.take_along_axis(all_, back[step][:, None, :].astype(np.int64), 1)[:, 0] + e[:, step]
        tags = np.empty((n, t), np.uint8)
        tags[:, t - 1] = score.argmax(axis=1)
        rows = np.arange(n)
        for step in range(t - 1, 0, -1):
            tags[:, step - 1] = back[step][rows, tags[:, step]]
        return tags


def windows_of(n: int) -> list[int]:
    """Starts of the overlapping windows over n characters."""
    return list(range(0, max(1, n - WINDOW + STEP), STEP)) if n > WINDOW else [0]


def spans_of(tags: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(window, start, end, kind) of decoded spans of many windows."""
    row, col = np.nonzero(tags)
    i = 0
    while i < len(row):
        kind = (tags[row[i], col[i]] - 1) // 2
        j = i + 1
        while j < len(row) and row[j] == row[i] and col[j] == col[j - 1] + 1 and tags[row[j], col[j]] == 2 + 2 * kind:
            j += 1
        yield int(row[i]), int(col[i]), int(col[j - 1]) + 1, int(kind)
        i = j


def reconcile(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """One set of spans of a document from those of its overlapping windows, given as (start, end, kind, distance to the
    nearest inner edge of its window). Spans cut by an edge are joined with what they overlap of their kind, so a span may be longer
    than any window; then spans seen further from an edge win over those they overlap; ties go to the longer."""
    joined: list[tuple[int, int, int, int]] = []
    for s, e, k, d in sorted(found):
        if joined and joined[-1][2] == k and s <= joined[-1][1] and (d == 0 or joined[-1][3] == 0) and e > joined[-1][1]:
            a, _, _, d0 = joined[-1]
            joined[-1] = (a, e, k, max(d, d0, 1))
        else:
            joined.append((s, e, k, d))
    kept: list[tuple[int, int, int]] = []
    for s, e, k, _ in sorted(joined, key=lambda x: (-x[3], x[0] - x[1], x[0])):
        if all(e <= a or s >= b for a, b, _ in kept):
            kept.append((s, e, k))
    return sorted(kept)


_FORMS = {0: forms.EMAIL, 1: forms.PHONE, 2: forms.ID_NUMBER, 3: forms.ADDRESS, 4: forms.NAME}


def checked(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Ends and veto: a span that a written form of its kind covers for the most part takes that form's ends; any other keeps its own,
    widened to whole words, and goes if it cannot be of its kind (see forms.possible)."""
    out: list[tuple[int, int, int]] = []
    for s, e, k in spans:
        best = None
        reach = 48 if k in (0, 3) else 24 if k == 1 else 12
        lo, hi = max(0, s - reach), min(len(text), e + reach)
        if k == 4:  # a name is cut from the words it touches and not from its surroundings
            while s > 0 and text[s - 1].isalnum():
                s -= 1
            while e < len(text) and text[e].isalnum():
                e += 1
            title = forms.BEFORE_NAME.match(text, s, e)
            s = title.end() if title else s
            m = forms.NAME.search(text, s, min(len(text), e + 1))
            best = (m.start(), m.end()) if m and m.end() <= e + 1 and forms.plausible_name(m.group()) else None
        else:
            for m in _FORMS[k].finditer(text, lo, hi):
                common = min(e, m.end()) - max(s, m.start())
                if 2 * common > e - s and (best is None or common > best[2]):
                    best = (m.start(), m.end(), common)
        if best is None:
            own = forms.possible(text, s, e, k)
            best = own if own and all(own[1] <= a or own[0] >= b for a, b, _ in spans if (a, b) != (s, e)) else None
        if best and (not out or best[0] >= out[-1][1]):
            out.append((best[0], best[1], k))
    return out


def tag_texts(tagger: Tagger, table: np.ndarray, texts: list[str | None], lean: float) -> dict[int, list[tuple[int, int, int]]]:
    """Checked spans of each text, by its place in the list; windows of many texts are tagged together."""
    found: dict[int, list] = {}
    lengths: dict[int, int] = {}
    jobs: list[tuple[int, int, np.ndarray]] = []
    for d, t in enumerate(texts):
        if t and not t.isspace():
            code = table[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)]
            lengths[d] = len(code)
            jobs += [(d, at, code[at : at + WINDOW]) for at in windows_of(len(code))]
    jobs.sort(key=lambda j: len(j[2]))
    for lo in range(0, len(jobs), BATCH):
        parts = jobs[lo : lo + BATCH]
        codes = np.zeros((len(parts), max(len(c) for _, _, c in parts)), np.uint8)
        for r, (_, _, c) in enumerate(parts):
            codes[r, : len(c)] = c
        size = np.array([len(c) for _, _, c in parts])
        for r, s, e, k in spans_of(tagger.decode(tagger.emissions(codes), size, lean)):
            d, at, c = parts[r]
            left = s if at else WINDOW
            right = len(c) - e if at + len(c) < lengths[d] else WINDOW
            found.setdefault(d, []).append((at + s, at + e, k, min(left, right)))
    return {d: checked(texts[d], reconcile(spans)) for d, spans in found.items()}


def find_personal(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", model: str = MODEL, lean: float = 1.0) -> DataFrame:
    """(doc_id, start, end, kind, value) for each piece of personal information in each text; offsets in code points.

    Whole texts are cut into overlapping windows, windows of many documents are tagged together by the BiLSTM and decoded by the
    CRF, spans of overlapping windows are reconciled over the document, and each surviving span is checked against the
    written form of its kind, which also fixes its exact ends. The form alone gives no row.

    One pass; texts are moved only where there are fewer partitions than cores (see spread). The model is one small file sent to the executors. Null, empty and blank texts give no rows; very long
    texts are tagged in as many windows as they need; repeated documents each report; null ids are kept.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(model)
    name = os.path.basename(model)
    state: dict = {}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.update(tagger=Tagger.load(SparkFiles.get(name)), table=char_table())
        for whole in it:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                texts = b.column(1).to_pylist()
                row, start, end, kind, value = [], [], [], [], []
                for d, spans in sorted(tag_texts(state["tagger"], state["table"], texts, lean).items()):
                    for s, e, k in spans:
                        row.append(d)
                        start.append(s)
                        end.append(e)
                        kind.append(KINDS[k])
                        value.append(texts[d][s:e])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(kind, pa.string()), pa.array(value, pa.string())],
                    [doc_id, "start", "end", "kind", "value"],
                )

    id_kind = docs.schema[doc_id].dataType.simpleString()
    return spread(docs.select(doc_id, text).where(f"{text} is not null")).mapInArrow(run, f"{doc_id} {id_kind}, start int, end int, kind string, value string")


def redact(docs: DataFrame, spans: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) with each span replaced by its kind in brackets, the rest unchanged; documents without spans, null texts
    included, pass as they are. doc_id must be unique."""
    s = spans.groupBy(doc_id).agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("_s"))
    step = (
        "aggregate(_s, struct('' as done, 0 as at), (a, x) -> struct(concat(a.done, substring({t}, a.at + 1, x.start - a.at), '[', upper(x.kind), ']') as done, x.end as at), "
        "a -> concat(a.done, substring({t}, a.at + 1)))"
    ).format(t=text)
    return docs.select(doc_id, text).join(s, doc_id, "left").select(doc_id, F.when(F.col("_s").isNull(), F.col(text)).otherwise(F.expr(step)).alias(text))
