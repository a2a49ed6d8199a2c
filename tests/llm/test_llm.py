"""Operators of the llm subpackage against brute force, exact round trips and held-out accuracy."""

import os
import random
import re
from collections import Counter, defaultdict
from datetime import date
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from peertide.functions import release
from peertide.llm import kmv, leak, overlap, pii, pii_forms, pii_train, queries, resolve, tokens, topn

D = "/root/testdata/sf0.001"
VOCABULARY = pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary")


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(D):
        con.execute(f"create view {f.split('.')[0]} as select * from '{D}/{f}'")
    df = queries.QUERIES[name](spark, D)
    cols = sorted(df.columns)
    plain = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    cur = con.execute(queries.ORACLE[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    assert Counter(str([plain(r[c]) for c in cols]) for r in df.collect()) == Counter(str([plain(r[names.index(c)]) for c in cols]) for r in cur.fetchall())


# --- problem 1


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Old.Grey.Harbor.III.1994.1080p.WEB-DL.x264-ABC", ("old grey harbor", 3, 1994, None)),
        ("[GRP]_Old_Harbor_-_07v2_[480p][FA16A041].mkv", ("old harbor", 1, None, "anime")),
        ("1995 S02 - The Old Harbor [WEBRip, HEVC]", ("old harbor", 1, 1995, "series")),
        ("S03E07 - The Old Harbor [WEBRip, HEVC]", ("old harbor", 1, None, "series")),
        ("óld_hárbor_2x10_hdtv", ("old harbor", 1, None, "series")),
        ("[ grp.example ] - Old & the Harbor 1985 480p AV1", ("old harbor", 1, 1985, None)),
        ("42c17eb6d35d08df7f552f68e994a783", (None, None, None, None)),
        ("", (None, None, None, None)),
        (None, (None, None, None, None)),
    ],
)
def test_parse_release(raw, want):
    assert release.parse_release(raw) == want


def test_match(spark):
    rng = random.Random(0)
    syl = ["ba", "do", "ki", "lu", "ma", "ne", "po", "ra", "su", "ti", "vo", "ze"]
    works = [("".join(rng.choice(syl) for _ in range(4)).capitalize() + " " + rng.choice(["Lantern", "River", "Ghost"]), rng.randrange(1980, 2020)) for _ in range(120)]
    catalog = [(f"film-{i}", t, f"tt9{i:07d}" if i % 2 else None, f"{y}-01-01") for i, (t, y) in enumerate(works)]
    catalog += [("film-twin", works[3][0].upper(), None, str(works[3][1])), ("film-remake", works[5][0], None, str(works[5][1] + 20)), ("film-null", None, None, None)]
    hashes, truth = [], set()
    for k in range(500):
        i = rng.randrange(120)
        t, y = works[i]
        name = t if k % 5 else t[:3] + t[4:]
        hashes.append((f"h{k}", f"{name.replace(' ', '.')}.{y}.720p.HDTV.x264-GRP", t if k % 3 else None, f"tt9{i:07d}" if k % 4 == 0 else None, "Movies", 7))
        truth.add((f"h{k}", f"film-{i}"))
        if i == 3:
            truth.add((f"h{k}", "film-twin"))
    hashes += hashes[:20] + [("noise", "IMG_20160716_5970.zip", None, "nan", "Unknown", 0), ("none", None, None, None, None, 0), (None, works[0][0], None, None, None, 0)]
    h = spark.createDataFrame(hashes, "hash string, raw_name string, title string, imdb_id string, category string, cid int")
    c = spark.createDataFrame(catalog, "ip_id string, ip string, imdb_id string, release_date string")
    got = [(r.hash, r.catalog_ip_id) for r in resolve.match(h, c).collect()]
    assert len(got) == len(set(got))
    hit = len(set(got) & truth)
    assert hit / len(truth) > 0.95 and hit / len(got) > 0.97, [(x, works[int(x[1][5:])] if x[1][5:].isdigit() else x[1], [r[1] for r in hashes if r[0] == x[0]]) for x in set(got) - truth]
    assert not any(x[1] == "film-remake" for x in got)
    assert resolve.match(h.limit(0), c).count() == 0 and resolve.match(h, c.limit(0)).count() == 0


def _names(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    common = ["silent", "letter", "garden", "lantern", "of", "golden", "river"]
    rare = ["".join(rng.choice("abdegiklmnoprstuvz") for _ in range(rng.randrange(4, 10))) for _ in range(60)]
    out = set()
    for _ in range(n):
        w = rng.sample(common, rng.randrange(0, 4)) + rng.sample(rare, rng.randrange(0, 3))
        if w and rng.random() < 0.5:
            k = rng.randrange(len(w))
            at = rng.randrange(len(w[k]))
            w[k] = w[k][:at] + rng.choice(["", "x", w[k][at] * 2]) + w[k][at + 1 :]
        out.add(" ".join(x for x in w if x))
    return sorted(out - {""})


def test_candidates(spark):
    """Against all pairs: every word of the shorter name is found in the other, equal, one edit or one exchange away."""

    def one(a: str, b: str) -> bool:
        if a == b:
            return True
        if len(a) < 5 or len(b) < 4:
            return False
        cut = lambda x: {x[:i] + x[i + 1 :] for i in range(len(x))}
        edits = (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1) or a in cut(b) or b in cut(a)
        turned = len(a) == len(b) and sorted(a) == sorted(b) and any(a[:i] + a[i + 1] + a[i] + a[i + 2 :] == b for i in range(len(a) - 1))
        return edits or turned

    names, catalog = _names(150, 1), _names(150, 2)
    got = {tuple(r) for r in resolve.candidates(*[spark.createDataFrame([(x,) for x in n], "name string") for n in (names, catalog)]).collect()}
    want = set()
    for a in names:
        for b in catalog:
            p, q = set(a.split()), set(b.split())
            if all(any(one(x, y) for y in q) for x in p) if len(p) < len(q) else all(any(one(x, y) for x in p) for y in q):
                want.add((a, b))
    assert want <= got
    assert len(got) <= 1.2 * len(want)  # an exchange of letters further apart may meet as well
    assert resolve.candidates(*[spark.createDataFrame([], "name string")] * 2).count() == 0


def test_mixture_rises_and_hardly_depends_on_its_prior():
    rng = np.random.default_rng(4)
    match = rng.random(4000) < 0.3
    levels = [np.where(match, rng.choice([8, 9, 10], 4000), rng.integers(0, 8, 4000)), np.where(match, rng.choice([10, 10, 10, 0], 4000), rng.integers(0, 7, 4000))]
    levels += [np.where(match, 4, rng.choice([0, 0, 3, 4], 4000)), np.where(match, 1, rng.integers(0, 2, 4000)), np.where(match, 1, rng.integers(0, 2, 4000)), np.where(match, rng.choice([1, 1, 1, 0], 4000), 0)]
    x = np.stack(levels, 1).astype(float)
    x[rng.random(x.shape) < 0.3] = -1
    x[(x < 0).all(axis=1), 0] = 5
    kept = []
    for weight in (0.03, 0.1, 0.3):
        for spread in (0.25, 0.5):
            m = resolve.Mixture(x, np.ones(4000), resolve.Prior(weight, spread))
            m.fit_step(m.g)
            values = []
            for _ in range(30):
                m.fit_step(m.posterior())
                values.append(m.objective())
            assert all(b >= a - 1e-6 * abs(a) for a, b in zip(values, values[1:]))
            kept.append(((m.posterior() >= 0.5) == match).mean())
    assert min(kept) > 0.92
    v = resolve.vectors_of(np.arange(12 * 12 * 6 * 27))
    assert len(np.unique(v, axis=0)) == len(v) and v.min() == -1 and v[:, 2].max() == 4


# --- problem 5


def test_kmv_bounds_and_merging(spark):
    rng = random.Random(1)
    data = [(g, f"m{rng.randrange(n)}") for g, n in (("a", 40), ("b", 4000), ("c", 20000)) for _ in range(3 * n)] + [("a", None), (None, "m1")]
    df = spark.createDataFrame(data, "g string, m string").repartition(7)
    k = 256
    sk = kmv.kmv(df, ["g"], F.col("m"), k).cache()
    exact = defaultdict(set)
    for g, m in data:
        if m is not None:
            exact[g].add(m)
    for r in kmv.estimates(sk, ["g"], k).collect():
        n = len(exact[r.g])
        assert r.kept == min(n, k) and (r.estimate == n if n < k else abs(r.estimate / n - 1) < 4 / np.sqrt(k))
    halves = kmv.kmv(df.where("m < 'm5'"), ["g"], F.col("m"), k).unionByName(kmv.kmv(df.where("m >= 'm5'"), ["g"], F.col("m"), k))
    assert sorted(map(tuple, kmv.merge(halves, ["g"], k).collect()), key=str) == sorted(map(tuple, sk.collect()), key=str)
    b = sk.where("g = 'b'").select(F.lit(1).alias("x"), "h")
    c = sk.where("g = 'c'").select(F.lit(1).alias("x"), "h")
    s = kmv.set_operations(b, c, ["x"], k).first()
    assert s.both_lower <= len(exact["b"] & exact["c"]) <= s.both_upper and s.union_lower <= len(exact["b"] | exact["c"]) <= s.union_upper
    assert s.right_lower <= len(exact["c"] - exact["b"]) <= s.right_upper
    assert kmv.kmv(df.limit(0), ["g"], F.col("m"), k).count() == 0


# --- problem 6


def test_top_n(spark):
    rng = random.Random(2)
    data = [(rng.choice(["x", "x", "x", "y", None]), f"i{k}", rng.choice([None, 1, 2, 3, 4]), k % 2) for k in range(400)]
    df = spark.createDataFrame(data, "g string, item string, score int, rank int")
    want = set()
    for g in ("x", "y", None):
        best = sorted((r for r in data if r[0] == g), key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))[:5]
        want |= {(r[0], r[1], i + 1) for i, r in enumerate(best)}
    for heavy in (0, 100, 10**6):  # all groups hot, some, none
        got = topn.top_n(df, ["g"], "score", ["item"], 5, heavy_rows=heavy).collect()
        assert {(r.g, r.item, r["rank"]) for r in got} == want and len(got) == len(want)
    assert topn.top_n(df.limit(0), ["g"], "score", ["item"], 5).count() == 0


# --- problem 7


def test_runs():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 100, 5000):
        for top in (2**12, 2**64 - 1):
            x = np.unique(rng.integers(0, top, n, dtype=np.uint64))
            assert (overlap.decode(overlap.encode(x)) == x).all()
    big = np.unique(rng.integers(0, 2**40, 5000, dtype=np.uint64))
    for m in (1, 10, 500, 5000):
        a = np.unique(np.concatenate([rng.choice(big, min(m, len(big)) // 2, replace=False), rng.integers(0, 2**40, m, dtype=np.uint64)]))
        n = len(np.intersect1d(a, big))
        assert overlap.gallop(a, big).sum() == n == overlap.linear(a, big) == overlap.shared(a, big) == overlap.shared(big, a)


def test_overlaps(spark, monkeypatch):
    monkeypatch.setattr(overlap, "RUN", 16)
    monkeypatch.setattr(overlap, "PARTNERS", 3)
    rng = random.Random(4)
    sets = {"hot": {f"m{i}" for i in range(600)}}
    for k in range(25):
        base = rng.choice([{f"m{rng.randrange(700)}" for _ in range(30)}, {f"s{k}_{i}" for i in range(30)}])
        sets[f"k{k}"] = base | {"everyone"}
        sets[f"copy{k}"] = set(list(base)[: len(base) // 2 + rng.randrange(8)]) | {f"c{k}_{i}" for i in range(12)} | {"everyone"}
    data = [(s, m) for s, ms in sets.items() for m in ms] * 2 + [(None, "m1"), ("k1", None)]
    df = spark.createDataFrame(data, "s string, member string")
    got = {(r.set_a, r.set_b): (r.n_a, r.n_b, r.n_shared) for r in overlap.overlaps(df, F.col("s"), F.col("member"), min_size=20).collect()}
    want = {}
    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            if a < b and min(len(sets[a]), len(sets[b])) >= 20 and 2 * n >= min(len(sets[a]), len(sets[b])):
                want[a, b] = (len(sets[a]), len(sets[b]), n)
    assert got == want and len(want) > 10
    assert overlap.overlaps(df.limit(0), F.col("s"), F.col("member")).count() == 0


# --- problem 8


def slow_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


@VOCABULARY
def test_tokens(spark, tmp_path):
    import tiktoken

    ranks = tokens.read_ranks(tokens.VOCABULARY)
    enc = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    pool = "abcdefgh ABC  123\n\t.,'’é🧲x日本\x85\x1c　ßÅ"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(300)] + ["", "   ", "<|endoftext|> x", "a" * 5000, "é" * 3000, "it's we'll", None, "dup", "dup"]
    for w in ("hello", "aaaaaaaaaaaa", "ünïcödé", " the"):
        assert tokens.merge_word(w.encode(), ranks) == slow_merge(w.encode(), ranks)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    for frequent in (5, 1000):
        got = {r.doc_id: r.ids for r in tokens.encode_texts(df, frequent=frequent).collect()}
        assert got == {i: enc.encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    assert tokens.encode_texts(df.limit(0)).count() == 0
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["tap", "taps", "top", "tops", "é", "a", "walking", "talking"])}
    lex = tokens.Lexicon.build(words)
    lex.save(str(tmp_path / "l"))
    again = tokens.Lexicon.load(str(tmp_path / "l"))
    assert [again.output(i) for i in again.find(list(words)).tolist()] == list(words.values())
    assert (again.find([b"ta", b"tapss", b"", b"zz", b"walkin"]) == -1).all()
    assert len(again.final) < sum(len(w) for w in words)  # suffixes are shared


# --- problem 9


def test_edit_distances():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 4, (200, 8)), rng.integers(0, 4, (200, 8))

    def plain(x, y):
        d = list(range(len(y) + 1))
        for i, p in enumerate(x, 1):
            last, d[0] = d[0], i
            for j, q in enumerate(y, 1):
                last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (p != q))
        return d[-1]

    for most in (0, 1, 2, 3):
        assert list(leak.edit_distances(a, b, most)) == [min(plain(x, y), most + 1) for x, y in zip(a, b, strict=True)]


def test_leaks(spark):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(40))) for i in range(20)] + [(90, None), (91, ""), (92, "too short")]
    docs, want = [], set()
    for d in range(120):
        text = [rng.choice(vocab) for _ in range(50)]
        if d % 3 == 0:
            i = rng.randrange(20)
            n = rng.choice([11, 12, 13, 30])
            at = rng.randrange(41 - n)
            part = items[i][1].split()[at : at + n]
            text[10:10] = ["zzz", *[f"<b>{x.upper()}</b>," if k % 5 == 0 else x for k, x in enumerate(part)], "zzz"]
            if n >= 12:
                want.add((d, i))
        docs.append((d, "&nbsp;".join(text[:5]) + " \n> " + " ".join(text[5:])))
    docs += [(500, None), (501, ""), (502, "  "), (503, docs[0][1]), (504, "x " * 50000 + docs[0][1])]
    want |= {(503, i) for d, i in want if d == 0} | {(504, i) for d, i in want if d == 0}
    dd = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int").select("doc_id", "text")
    ii = spark.createDataFrame(items, "item_id long, text string")
    got = leak.leaks(dd, ii).where("longest_run >= 12").collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    named = ii.select(F.concat(F.lit("i"), F.col("item_id").cast("string")).alias("item_id"), "text")
    assert {(r.doc_id, r.item_id) for r in leak.leaks(dd, named.union(named)).where("longest_run >= 12").collect()} == {(d, f"i{i}") for d, i in want}
    assert leak.leaks(dd.limit(0), ii).count() == 0 and leak.leaks(dd, ii.limit(0)).count() == 0


def test_leak_runs_and_repeats(spark):
    item = [f"w{i}" for i in range(40)]
    texts = {1: item[3:33], 2: [*item[3:14], "x", *item[14:30]], 3: ["y", *item[5:16], "z"], 4: item, 5: item}
    docs = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()] + [(None, " ".join(item[:12]))] * 2, "doc_id int, text string")
    got = sorted(((r.doc_id or 0, r.edits, r.longest_run) for r in leak.leaks(docs, spark.createDataFrame([("a", " ".join(item))], "item_id string, text string")).collect()))
    assert got == [(0, 0, 12), (0, 0, 12), (1, 0, 30), (2, 0, 16), (3, 1, 11), (4, 0, 40), (5, 0, 40)]


def test_leak_recall(spark):
    """Tables are taken until every kind of edit is met; checked on windows of the evaluation items."""
    d = "/root/testdata/sf0.01/eval_items.parquet"
    if not os.path.exists(d):
        pytest.skip("no test tables")
    texts = [r.text for r in spark.read.parquet(d).collect() if r.text]
    h = [leak.hashes(leak.words(t), {}) for t in texts]
    w = np.concatenate([np.lib.stride_tricks.sliding_window_view(x, 12) for x in h if len(x) >= 12])
    rng = np.random.default_rng(1)
    n = leak.tables_for(w[rng.permutation(len(w))[:1000]], 1, 0.95, 7)
    other = leak.recall_of(w[rng.permutation(len(w))[:1000]], 1, n, 7)
    print(n, other)
    assert min(other.values()) >= 0.93 and leak.tables_for(w, 0, 0.95, 7) == 1


# --- problem 10


def test_gradients():
    rng = np.random.default_rng(8)
    h = 4
    w = {"wx": rng.normal(0, 0.3, (2, pii.CHARS, 4 * h)), "wh": rng.normal(0, 0.4, (2, h, 4 * h)), "b": np.zeros((2, 4 * h)), "wo": rng.normal(0, 0.5, (2 * h, pii.TAGS)), "bo": np.zeros(pii.TAGS), "move": np.zeros((pii.TAGS, pii.TAGS))}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    codes, tags = rng.integers(1, pii.CHARS, (3, 9)).astype(np.uint8), np.zeros((3, 9), int)
    tags[:, 3:5] = [1, 2]
    _, g = pii_train.loss_and_grads(w, codes, tags)
    for k in ("wh", "wo", "move", "b"):
        i = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        loss = []
        for step in (0.01, -0.01):
            x = {a: b.copy() for a, b in w.items()}
            x[k][i] += step
            loss.append(pii_train.loss_and_grads(x, codes, tags)[0])
        assert abs((loss[0] - loss[1]) / 0.02 - g[k][i]) < 0.02 * max(1, abs(g[k][i]))


def test_viterbi_brute():
    import itertools

    rng = np.random.default_rng(9)
    t = pii.Tagger.load(pii.MODEL)
    e = rng.normal(size=(3, 4, pii.TAGS)).astype(np.float32)
    move, first = t.w["move"] + t.barred, t.first
    got = t.viterbi(e, np.array([4, 4, 4]))
    for n in range(3):
        score = lambda p, n=n: first[p[0]] + sum(e[n, i, p[i]] for i in range(4)) + sum(move[a, b] for a, b in itertools.pairwise(p))
        best = max(itertools.product(range(pii.TAGS), repeat=4), key=score)
        assert abs(score(tuple(got[n])) - score(best)) < 1e-3


def test_personal(spark):
    body = "Seeders jumped from 22 to 60 overnight. Signed off by Mira Calderwick on the second pass. Reach the uploader under mira.c@example.org before the next run.\nRegistered office: 16 Ferrymans Road, Osterfelde 64929\nSSN on the form: 666-87-2785\nCall (212) 555-0184 after the midnight rollover. "
    want = {("name", "Mira Calderwick"), ("email", "mira.c@example.org"), ("address", "16 Ferrymans Road, Osterfelde 64929"), ("id_number", "666-87-2785"), ("phone", "(212) 555-0184")}
    filler = "The backlog holds 5659 hashes; at this pace it clears in 2 days. " * 60
    docs = [(1, body), (2, filler + body + filler), (3, None), (4, ""), (5, " \n "), (6, body), (7, filler), (None, body)]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, kind string").select("doc_id", "text")
    found = pii.find_personal(df).collect()
    by = defaultdict(set)
    for r in found:
        by[r.doc_id].add((r.kind, r.value))
        assert dict(docs)[r.doc_id][r.start : r.end] == r.value
    assert by[1] == want and by[2] == want and by[6] == want and by[None] == want and set(by) == {1, 2, 6, None}
    some = df.where("doc_id is not null")
    red = {r.doc_id: r.text for r in pii.redact(some, pii.find_personal(some)).collect()}
    assert red[7] == filler and red[3] is None and red[4] == ""
    assert "[NAME]" in red[2] and "Mira" not in red[2] and red[2].startswith(filler) and red[2].endswith(filler)
    assert pii.find_personal(df.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_personal_held_out(spark):
    """On rows the tagger was not trained on it agrees with the labelled spans."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r.doc_id, r.start, r.end, r.kind) for r in pii.find_personal(docs).collect()}
    want = {(r.doc_id, s, e, pii.KINDS[k]) for r in docs.select("doc_id", "text").collect() if r.text for s, e, k in pii_forms.labelled_spans(r.text)}
    hit = len(got & want)
    assert hit / len(want) > 0.95 and hit / len(got) > 0.93


def test_windows_and_reconciling():
    for n in (0, 1, 255, 256, 257, 1000, 5000):
        at = pii.windows_of(n)
        assert at[0] == 0 and at[-1] + pii.WINDOW >= n and all(b - a == pii.STEP for a, b in zip(at, at[1:], strict=False))
    assert pii.reconcile([(10, 20, 1, 5), (8, 20, 1, 50), (30, 40, 2, 256)]) == [(8, 20, 1), (30, 40, 2)]


def test_personal_data_in_ordinary_sentences():
    """Sentences written by hand, of no template the tagger has seen: precision and recall over all kinds."""
    mark = re.compile(r"\{(name|email|phone|id_number|address):([^}]*)\}")
    lines = (Path(__file__).parent / "pii_sentences.txt").read_text().splitlines()
    want = [Counter(mark.findall(x)) for x in lines]
    texts = [mark.sub(r"\2", x) for x in lines]
    got = pii.tag_texts(pii.Tagger.load(pii.MODEL), pii.char_table(), texts, 1.0)
    found = [Counter((pii.KINDS[k], texts[i][s:e]) for s, e, k in got.get(i, [])) for i in range(len(texts))]
    both = sum(sum((f & w).values()) for f, w in zip(found, want, strict=True))
    assert both / sum(sum(f.values()) for f in found) >= 0.9
    assert both / sum(sum(w.values()) for w in want) >= 0.8


def test_spans_cut_by_a_window_are_joined():
    assert pii.reconcile([(400, 512, 3, 0), (432, 560, 3, 0)]) == [(400, 560, 3)]
    assert pii.reconcile([(10, 20, 4, 100), (432, 440, 4, 5)]) == [(10, 20, 4), (432, 440, 4)]
    assert pii_forms.possible("ID AB 12 34 56 C here", 3, 16, 2) == (3, 16) and pii_forms.possible("at noon", 0, 7, 2) is None
