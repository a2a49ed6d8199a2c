"""Queries do the whole job: against plain Python on the test tables, and on cases that an earlier version lost."""

import difflib
import os
import re
import unicodedata
from collections import Counter, defaultdict
from datetime import datetime
from statistics import median

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from peertide.functions import text
from peertide.operators.similar import compared
from peertide.plans import identity, lines, relational, series

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with the given rows as hashes and catalogue (columns not given are null) and the other tables of the smallest size."""

    def make(hashes=(), catalog=(), **others):
        for name, given in (("hashes", hashes), ("catalog_info", catalog), *others.items()):
            schema = spark.read.parquet(f"{D}/{name}.parquet").schema
            rows = [tuple(r.get(c) for c in schema.names) for r in given]
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make


def hashes(*titles, **more):
    return [{"hash": f"{i:040x}", "ip_id": f"film-t{i}", "title": t, "source": "tpb", **{k: v[i] for k, v in more.items()}} for i, t in enumerate(titles)]


def catalog(*names):
    return [{"ip_id": f"film-c{i}", "ip": n} for i, n in enumerate(names)]


def both(spark):
    from peertide.plans.common import bridge

    titles = sorted({r.title for r in bridge(spark, D).where("title is not null").select("title").collect()})
    return titles, [(r.ip_id, r.ip) for r in spark.read.parquet(f"{D}/catalog_info.parquet").where("ip is not null").collect()]


def split(s):
    return {w for w in re.split("[^a-z0-9]+", s.lower()) if w}


def content(s):
    return split(s) - set(text.LITTLE_WORDS) or split(s)


def test_reverse_short_words(spark, tables, rows):
    d = tables(hashes("Crooked Machine and the Weary Island", "The Of", "A Harbor of Stone", "The Pale One"), catalog("Crooked Machine and the Weary Island", "Of the", "The Fall of Rome"))
    assert rows(lines.er13_reverse(spark, d)) == [("film-c0", "Crooked Machine and the Weary Island"), ("film-c1", "The Of"), ("film-c2", "The Of")]


def test_reverse_brute_force(spark, rows):
    titles, entries = both(spark)
    want = []
    for t in titles:
        a = content(t)
        for i, name in entries:
            b = split(name) if a <= set(text.LITTLE_WORDS) else content(name)
            if a and b and len(a & b) * 2 >= len(a) and len(a & b) / len(b) >= 0.3:
                want.append((i, t))
    assert rows(lines.er13_reverse(spark, D)) == sorted(want, key=str)


def test_every_json_record(spark, tables, rows):
    one, two = '{"ip_id": "film-c1", "year": 1999, "seeders": 5, "dc": true}', '{"ip_id": "film-c2", "year": 2001, "seeders": 7, "dc": false}'
    d = tables(documents=[{"doc_id": k, "text": x} for k, x in ((1, f"a {one} b\n{two} c {one}"), (2, f"x{two}"), (3, "none"), (4, None))])
    first, second = (True, "film-c1", 5, 1999), (False, "film-c2", 7, 2001)
    assert rows(lines.fn_j01_json(spark, d).drop("doc_id")) == sorted([first, first, second, second], key=str)
    assert [tuple(r) for r in lines.fn_j01_json(spark, d).groupBy("doc_id").count().orderBy("doc_id").collect()] == [(1, 3), (2, 1)]


def test_fuzzy_first_word(spark, tables):
    d = tables(hashes("A Candle for Rirenavax", "Gaoegask Carnival", "Brittle Island of Karimo"), catalog("Candle for Rirenavax, A", "Gakegask Carnival", "The Brittle Island of Karimo", "Another One"))
    got = {(r.title, r.ip_id) for r in identity.er07_fuzzy(spark, d).collect()}
    assert got == {("a candle for rirenavax", "film-c0"), ("gaoegask carnival", "film-c1"), ("brittle island of karimo", "film-c2")}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab c", max_size=12), max_size=12), st.lists(st.text("ab c", max_size=12), max_size=12))
def test_compared_loses_nothing(left, right):
    want = {(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if difflib.SequenceMatcher(None, a, b).ratio() >= 0.82}
    assert {(i, j) for i, j, _ in compared(left, right, 0.82)} == want


def test_fuzzy_brute_force(spark):
    fold = lambda s: re.sub(r"\s+", " ", "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).lower()).strip()
    titles, entries = both(spark)
    want = Counter((a, i, round(r, 6)) for a in {fold(t) for t in titles} for i, n in entries if (r := difflib.SequenceMatcher(None, a, fold(n)).ratio()) >= 0.82)
    assert Counter((r.title, r.ip_id, r.ratio) for r in identity.er07_fuzzy(spark, D).collect()) == want


def test_block_short_titles(spark, tables, rows):
    d = tables(hashes("Kigozagim", "The Of", "One Two Six Ten Red Sky", "Pale Ox"), catalog("Kigozagim", "Of the", "The Red Lamp", "The Ox of Rome", "Red Sky"))
    assert rows(relational.jn14_token_block(spark, d)) == sorted([("film-c0", "film-t0", 1), ("film-c1", "film-t1", 2), ("film-c2", "film-t1", 1), ("film-c3", "film-t1", 2), ("film-c2", "film-t2", 1), ("film-c4", "film-t2", 2), ("film-c3", "film-t3", 1)], key=str)


def test_block_brute_force(spark, rows):
    from peertide.plans.common import bridge

    best = Counter()
    entries = both(spark)[1]
    for i, title in {(r.ip_id, r.title) for r in bridge(spark, D).where("ip_id is not null and title is not null").collect()}:
        t = content(title)
        shared = {c: len(t & split(n)) for c, n in entries if t & split(n)}
        least = max(1, len(t) // 2)
        for c, n in shared.items():
            if n >= least or max(shared.values()) < least:
                best[c, i] = max(best[c, i], n)
    assert rows(relational.jn14_token_block(spark, D)) == sorted([(c, i, n) for (c, i), n in best.items()], key=str)


def test_containment_sequels(spark, tables):
    names = ["A Ghost for Krisenigim 1999 720p", "Pegosajik.Letter.3.1080p", "Up.1080p", "Ghost.of.it.and.the.9"]
    d = tables(hashes(*names, raw_name=names), catalog("A Ghost for Krisenigim 3", "Pegosajik Letter", "The Pegosajik Letter 3", "Up", "Of the", "Ghost 10"))
    assert {(int(r.hash, 16), r.catalog_id, r.n_words) for r in relational.jn15_containment(spark, d).collect()} == {(1, "film-c2", 3), (2, "film-c3", 1), (3, "film-c4", 2)}


def test_containment_brute_force(spark, rows):
    from peertide.plans.common import bridge

    entries = [(content(n), i) for i, n in both(spark)[1] if content(n)]
    want = []
    for r in bridge(spark, D).where("raw_name is not null").collect():
        inside = [(-len(c), i) for c, i in entries if c <= split(r.raw_name)]
        if inside:
            want.append((min(inside)[1], r.hash, -min(inside)[0]))
    assert rows(relational.jn15_containment(spark, D)) == sorted(want, key=str)


def test_wrong_year_median(spark, tables):
    names = ["A 1950", "A 2000", "A 2000", "A 2001", "B 1990", "B 1990", "B 2000", "B 2002", "C 1990", "C 2000"]
    given = hashes(*"AAAABBBBCC", raw_name=names)
    d = tables([{**h, "ip_id": f"film-{h['title'].lower()}"} for h in given])
    assert {r.ip_id: (r.wrong, r.n) for r in lines.agg18_wrong_year(spark, d).collect()} == {"film-a": (0.25, 4), "film-b": (1.0, 4)}


def test_wrong_year_brute_force(spark):
    from peertide.plans.common import bridge

    years = defaultdict(list)
    for r in bridge(spark, D).where("ip_id is not null and raw_name is not null").collect():
        if y := re.search("(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", r.raw_name):
            years[r.ip_id].append(int(y[1]))
    want = {i: (sum(abs(y - median(x)) > 2 for y in x) / len(x), len(x)) for i, x in years.items() if len(x) >= 3}
    assert want and {r.ip_id: (r.wrong, r.n) for r in lines.agg18_wrong_year(spark, D).collect()} == want


def test_pass_totals(spark, tables, rows):
    one, two = datetime(2026, 4, 1), datetime(2026, 4, 2)
    given = [(one, "a", "US", 1, 0), (one, "a", "IN", 1, 0), (one, "b", None, None, 300), (one, "c", None, 0, None), (two, "a", None, None, None)]
    d = tables(acestream_demand=[{"run_ts": t, "infohash": h, "peer_country": c, "bep33_seeders": s, "bep33_leechers": n} for t, h, c, s, n in given])
    assert rows(series.skt03_pass_totals(spark, d)) == [(0, 0, two, 0), (50_000, 2, one, 4)]
