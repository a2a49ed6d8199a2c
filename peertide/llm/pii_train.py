"""Trains the tagger of personal information: python -m peertide.llm.pii_train DOCUMENTS.parquet OUT.npz [SECONDS [START.npz]]

One of three windows is put together by `pii_synth`, whose labels are known by construction and owe nothing to the written forms
that check the tagger. The others come from a bounded sample of documents (SAMPLE rows, a parameter), labelled by form and
context; names are exchanged for drawn ones in half of these, so that the tagger learns where names stand and not which
there are. Each step averages the gradients of WORKERS processes.
"""

from __future__ import annotations

import multiprocessing as mp
import sys
import time

import numpy as np
import pyarrow.parquet as pq

from peertide.llm import pii_forms as forms
from peertide.llm import pii_synth as synth
from peertide.llm.pii import CHARS, TAGS, Tagger, char_table, start_and_moves

SAMPLE, HIDDEN, T, B, WORKERS = 20_000, 32, 128, 40, 8


def invent(name: str, rng: np.random.Generator) -> str:
    """Another name of the same build."""
    out = []
    for w in forms.re.split(r"([^\W\d_]+)", name):
        if w.isalpha() and len(w) > 1 and w.lower() not in ("van", "von", "de", "la", "mac"):
            new = "".join(rng.choice(list("bdfghjklmnprstvwz")) + rng.choice(list("aeiouy")) for _ in range(rng.integers(1, 4))) + rng.choice(["", "n", "r", "s", "sson", "berg", "ley"])
            w = new.upper() if w.isupper() else new if w.islower() else new.capitalize()
        out.append(w)
    return "".join(out)


def windows(texts: list[str], seed: int = 1):
    """Endless batches of (codes, tags) of B windows of T characters, half of them around a span."""
    rng, table, draw = np.random.default_rng(seed), char_table(), synth.Draw(seed)
    labelled = [(t, forms.labelled_spans(t)) for t in texts]
    around = [(i, j) for i, (_, s) in enumerate(labelled) for j in range(len(s))]
    while True:
        codes, tags = np.zeros((B, T), np.uint8), np.zeros((B, T), np.int64)
        for r in range(B):
            if r % 3 == 1:
                text, spans = synth.document(draw, 2 * T)
                lo = int(rng.integers(0, T)) if r % 2 else 0
                cut = text[lo : lo + T]
                codes[r, : len(cut)] = table[np.frombuffer(cut.encode("utf-32-le"), np.uint32)]
                for a, b, k in spans:
                    a, b = max(0, a - lo), min(len(cut), b - lo)
                    if a < b:
                        tags[r, a:b] = 2 + 2 * k
                        tags[r, a] = 1 + 2 * k
                continue
            if r % 3 == 0 and around:
                i, j = around[rng.integers(len(around))]
                text, spans = labelled[i]
                s, e, _ = spans[j]
                lo = int(rng.integers(max(0, e - T) if e - T < s else s - 8, s + 1)) if s else 0
            else:
                i = int(rng.integers(len(labelled)))
                text, spans = labelled[i]
                lo = int(rng.integers(0, max(1, len(text) - T)))
            hi = min(len(text), lo + 2 * T)
            parts, marks, at = [], [], lo
            swap = rng.random() < 0.5
            for s, e, k in spans:
                if s < lo or e > hi:
                    continue
                parts.append(text[at:s])
                marks.append(np.zeros(s - at, np.int64))
                v = invent(text[s:e], rng) if k == 4 and swap else text[s:e]
                parts.append(v)
                marks.append(np.r_[1 + 2 * k, np.full(len(v) - 1, 2 + 2 * k)].astype(np.int64))
                at = e
            parts.append(text[at:hi])
            marks.append(np.zeros(max(0, hi - at), np.int64))
            cut = "".join(parts)[:T]
            n = len(cut)
            codes[r, :n] = table[np.frombuffer(cut.encode("utf-32-le"), np.uint32)]
            tags[r, :n] = np.concatenate(marks)[:n]
            for s, e, k in spans:  # a span that begins before the window leaves unlabelled characters: mark what is seen
                if s < lo < e:
                    tags[r, : min(n, e - lo)] = 2 + 2 * k
                    tags[r, 0] = 1 + 2 * k
        yield codes, tags


def loss_and_grads(w: dict[str, np.ndarray], codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    n, t = codes.shape
    h = w["wh"].shape[1]
    x = np.stack([codes.T, codes.T[::-1]])  # (2, T, n): the second direction reads backwards
    gates, cell, hid, tc = (np.empty((t, 2, n, s), np.float32) for s in (4 * h, h, h, h))
    hs, cs = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
    d2 = np.arange(2)[:, None]
    for s in range(t):
        g = w["wx"][d2, x[:, s]] + hs @ w["wh"] + w["b"][:, None, :]
        g[..., : 3 * h] = 0.5 + 0.5 * np.tanh(0.5 * g[..., : 3 * h])
        g[..., 3 * h :] = np.tanh(g[..., 3 * h :])
        cs = g[..., h : 2 * h] * cs + g[..., :h] * g[..., 3 * h :]
        tc[s] = np.tanh(cs)
        hs = g[..., 2 * h : 3 * h] * tc[s]
        gates[s], cell[s], hid[s] = g, cs, hs
    both = np.concatenate([hid[:, 0], hid[::-1, 1]], axis=2)  # (T, n, 2H)
    e = both @ w["wo"] + w["bo"]
    # CRF
    first, barred = start_and_moves()
    move = w["move"] + barred
    alpha = np.empty((t, n, TAGS), np.float32)
    alpha[0] = e[0] + first
    for s in range(1, t):
        a = alpha[s - 1][:, :, None] + move
        m = a.max(axis=1, keepdims=True)
        alpha[s] = np.log(np.exp(a - m).sum(axis=1)) + m[:, 0] + e[s]
    m = alpha[-1].max(axis=1, keepdims=True)
    z = np.log(np.exp(alpha[-1] - m).sum(axis=1)) + m[:, 0]
    beta = np.zeros((n, TAGS), np.float32)
    de, dmove = np.empty_like(e), np.zeros((TAGS, TAGS), np.float32)
    for s in range(t - 1, -1, -1):
        de[s] = np.exp(alpha[s] + beta - z[:, None])
        if s:
            b = e[s] + beta
            p = np.exp(alpha[s - 1][:, :, None] + move + b[:, None, :] - z[:, None, None])
            dmove += p.sum(axis=0)
            a = move[None] + b[:, None, :]
            m = a.max(axis=2, keepdims=True)
            beta = np.log(np.exp(a - m).sum(axis=2)) + m[..., 0]
    rows = np.arange(n)
    gold = e[0, rows, tags[:, 0]] + first[tags[:, 0]]
    de[0, rows, tags[:, 0]] -= 1
    for s in range(1, t):
        gold = gold + e[s, rows, tags[:, s]] + move[tags[:, s - 1], tags[:, s]]
        de[s, rows, tags[:, s]] -= 1
        np.add.at(dmove, (tags[:, s - 1], tags[:, s]), -1)
    loss = float((z - gold).mean())
    de /= n
    grads = {"move": dmove / n, "bo": de.sum(axis=(0, 1)), "wo": np.einsum("tnh,tnk->hk", both, de, optimize=True)}
    dboth = de @ w["wo"].T
    dh_out = np.stack([dboth[..., :h], dboth[::-1, :, h:]], axis=1)  # (T, 2, n, H) in each direction's own order
    dg_all = np.empty_like(gates)
    dh, dc = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
    wht = w["wh"].transpose(0, 2, 1)
    for s in range(t - 1, -1, -1):
        g = gates[s]
        dh = dh + dh_out[s]
        i, f, o, c = g[..., :h], g[..., h : 2 * h], g[..., 2 * h : 3 * h], g[..., 3 * h :]
        dc = dc + dh * o * (1 - tc[s] ** 2)
        prev = cell[s - 1] if s else np.zeros_like(dc)
        dg = dg_all[s]
        dg[..., :h] = dc * c * i * (1 - i)
        dg[..., h : 2 * h] = dc * prev * f * (1 - f)
        dg[..., 2 * h : 3 * h] = dh * tc[s] * o * (1 - o)
        dg[..., 3 * h :] = dc * i * (1 - c**2)
        dc = dc * f
        dh = dg @ wht
    grads["b"] = dg_all.sum(axis=(0, 2))
    grads["wh"] = np.stack([np.tensordot(hid[:-1, d], dg_all[1:, d], axes=([0, 1], [0, 1])) for d in (0, 1)])
    grads["wx"] = np.zeros_like(w["wx"])
    for d in (0, 1):
        flat, c = dg_all[:, d].reshape(-1, 4 * h), x[d].ravel()
        order = np.argsort(c, kind="stable")
        starts = np.r_[0, np.flatnonzero(np.diff(c[order])) + 1]
        grads["wx"][d, c[order][starts]] = np.add.reduceat(flat[order], starts, axis=0)
    return loss, grads


def _worker(pipe, texts: list[str], seed: int) -> None:
    for codes, tags in windows(texts, seed):
        w = pipe.recv()
        if w is None:
            return
        pipe.send(loss_and_grads(w, codes, tags))


def train(texts: list[str], out: str, seconds: float, start: str | None = None) -> None:
    rng = np.random.default_rng(0)
    h = HIDDEN
    w = {
        "wx": rng.normal(0, 0.3, (2, CHARS, 4 * h)), "wh": rng.normal(0, 1 / np.sqrt(h), (2, h, 4 * h)), "b": np.zeros((2, 4 * h)),
        "wo": rng.normal(0, 0.2, (2 * h, TAGS)), "bo": np.r_[2.0, np.zeros(TAGS - 1)], "move": np.zeros((TAGS, TAGS)),
    }
    w["b"][:, h : 2 * h] = 1
    w = {k: v.astype(np.float32) for k, v in w.items()}
    if start:
        with np.load(start) as z:
            w = {k: z[k] for k in z.files}
    pipes, context = [], mp.get_context("fork")
    for i in range(WORKERS):
        mine, theirs = context.Pipe()
        context.Process(target=_worker, args=(theirs, texts, 100 + i), daemon=True).start()
        pipes.append(mine)
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    began, shown, step, part = time.time(), 0.0, 0, 0.0
    while part < 1:
        for p in pipes:
            p.send(w)
        got = [p.recv() for p in pipes]
        loss, g = float(np.mean([x[0] for x in got])), {k: sum(x[1][k] for x in got) / WORKERS for k in w}
        step += 1
        norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
        part = (time.time() - began) / seconds
        rate = 0.004 * min(1, step / 50) * (0.5 * (1 + np.cos(np.pi * min(part, 1))) + 0.01)
        for k, v in g.items():
            v = v * min(1, 5 / norm)
            m1[k] = 0.9 * m1[k] + 0.1 * v
            m2[k] = 0.99 * m2[k] + 0.01 * v * v
            w[k] = w[k] - rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-7)
        shown = 0.95 * shown + 0.05 * loss if step > 1 else loss
        if step % 100 == 0:
            print(step, round(shown, 3), round(time.time() - began), flush=True)
    for p in pipes:
        p.send(None)
    np.savez_compressed(out, **{k: v.astype(np.float32) for k, v in w.items()})
    Tagger.load(out)


if __name__ == "__main__":
    t = [x for x in pq.read_table(sys.argv[1], columns=["text"]).slice(0, SAMPLE).column("text").to_pylist() if x]
    train(t, sys.argv[2], float(sys.argv[3]) if len(sys.argv) > 3 else 900.0, sys.argv[4] if len(sys.argv) > 4 else None)
