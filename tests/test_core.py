"""Operators of the core on small fixtures: nulls, empties, repeats, ties, clashing names."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from peertide.functions import text
from peertide.functions.ids import is_observer, norm_country, norm_id
from peertide.operators import dedup, joins, series, sketches
from peertide.operators.anomaly import flag_readings, implausible, rolling_median
from peertide.operators.demand import floor_other, union_demand
from peertide.operators.rolling import trailing_totals
from peertide.operators.skew import heavy_keys, salted_counts, with_parts
from peertide.sources import feeds, sinks
from peertide.streaming import announce


def test_worked_example(spark, rows):
    obs = spark.createDataFrame(
        [("h1", "a", "US", "dht", 1), ("h1", "b", "US", "harv", 1), ("h2", "a", None, "harv", 1), ("h2", "c", "IN", "pex", 1), ("h3", "d", "IN", "harv", 1), ("h3", "e", "US", "dht", 1), ("h3", "a", "GB", "pex", 1)],
        "hash string, ip string, country string, src string, id int",
    )
    d = {r.country: (r.ip_count, r.ip_count_dht, r.ip_count_harv, r.ip_count_pex) for r in union_demand(obs, ["id"]).collect()}
    assert d == {"US": (3, 2, 2, 1), "IN": (2, 0, 1, 1)}
    assert floor_other(union_demand(obs, ["id"]), ["id"], 3).count() == 1
    assert floor_other(union_demand(obs, ["id"]), ["id"], 9).count() == 0


def test_norms(spark):
    df = spark.createDataFrame([(" Film-Q1\t", "us ", "ip-1"), (None, "??", "_queried_"), ("x", "Other", None), ("y", "na", "_marker_US")], "i string, c string, ip string")
    r = df.select(norm_id("i"), norm_country("c"), is_observer("ip")).collect()
    assert [tuple(x) for x in r] == [("film-q1", "US", True), (None, None, False), ("x", None, False), ("y", "NA", False)]


@pytest.mark.parametrize("part_rows", [5, 50, 500, 5000])
def test_salted_counts(spark, part_rows):
    rng = random.Random(1)
    data = [("hot", f"m{rng.randrange(50)}", 1) for _ in range(400)] + [(f"k{i % 20}", f"m{i % 3}", 2) for i in range(100)] + [(None, "x", 3), ("k0", None, 4)]
    data += [(None, f"n{rng.randrange(90)}", 5) for _ in range(500)] + [("gone", None, 6)] * 3  # null holds half of the rows
    df = spark.createDataFrame(data, "key string, member string, n_rows int")
    got = {r.key: (r.n_rows, r.n_members) for r in salted_counts(df, F.col("key"), F.col("member"), part_rows=part_rows).collect()}
    want = defaultdict(lambda: [0, set()])
    for k, m, _ in data:
        want[k][0] += 1
        want[k][1] |= {m} - {None}
    assert got == {k: (n, len(m)) for k, (n, m) in want.items()}
    assert {r.key: r.n_rows for r in salted_counts(df, F.col("key"), part_rows=part_rows).collect()} == {k: n for k, (n, _) in want.items()}
    assert salted_counts(df.limit(0), F.col("key"), F.col("member")).count() == 0


def test_heavy_keys_are_split_by_rows(spark):
    counts = spark.createDataFrame([(None, 500), ("a", 99), ("b", 100), ("c", 101)], "key string, n bigint")
    assert {r.key: r.parts for r in heavy_keys(counts, ["key"], part_rows=100).collect()} == {None: 5, "c": 2}
    assert {r.key: r.parts for r in heavy_keys(counts, ["key"], part_rows=1, most_heavy=2).collect()} == {None: 2}  # parts of 400 rows
    # the largest part of a null key of half the rows is within twice the mean
    df = spark.range(20_000).selectExpr("case when id % 2 = 0 then null else cast(id % 50 as string) end as key", "cast(id as string) as member")
    heavy = heavy_keys(df.groupBy("key").agg(F.count(F.lit(1)).alias("n")), ["key"], part_rows=400)
    parts = with_parts(df, ["key"], heavy).withColumn("salt", F.pmod(F.xxhash64("member"), F.col("parts")))
    sizes = [r.n for r in parts.groupBy("key", "salt").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) <= 2 * np.median(sizes)


def test_trailing_totals(spark):
    rng = random.Random(2)
    start, data, last = date(2026, 1, 1), [], {}
    for i in range(200):
        e, day = rng.choice("ab"), start + timedelta(rng.randrange(60))
        v = rng.choice([None, 0, 5, 7])
        at = datetime(2026, 5, 1) + timedelta(seconds=i)
        data.append((e, day, v, at))
        last[e, day] = v
    data += [(None, start, 9, datetime(2026, 1, 1)), ("c", start, None, datetime(2026, 1, 1))]
    last["c", start] = None
    df = spark.createDataFrame(data, "entity string, day date, value long, loaded timestamp")
    got = {(r.entity, r.day): (r.total_7, r.total_30, r.avg_7) for r in trailing_totals(df, F.col("entity"), F.col("day"), F.col("value"), F.col("loaded")).collect()}
    want = {}
    for e in "abc":
        days = sorted(d for x, d in last if x == e)
        for k in range((days[-1] - days[0]).days + 1):
            d = days[0] + timedelta(k)
            t = [sum(last.get((e, d - timedelta(j))) or 0 for j in range(w)) for w in (7, 30)]
            want[e, d] = (t[0], t[1], t[0] / 7)
    assert got == want
    assert trailing_totals(df.limit(0), F.col("entity"), F.col("day"), F.col("value"), F.col("loaded")).count() == 0


def test_rolling_median_brute():
    rng = np.random.default_rng(0)
    s = np.repeat([0, 1, 2], [40, 3, 17])
    x = rng.normal(size=60)
    for half in (1, 7):
        want = [np.median(x[[j for j in range(max(0, i - half), min(60, i + half + 1)) if s[j] == s[i]]]) for i in range(60)]
        assert np.allclose(rolling_median(x, s, half), want)


def test_flags():
    base = [100.0, 103, 98, 101, 99, 102, 97, 100, 104, 96, 101, 99, 103, 98, 100, 102, 99, 101, 97, 103]
    v = np.array([*base, 900, 950, *base, -1, *base, 60000, *base])
    bound, spike, stuck = flag_readings(v, np.zeros(len(v), int), 50000, 7, 6.5, 2, 3, 6)
    assert list(np.flatnonzero(bound)) == [42, 63] and list(np.flatnonzero(spike)) == [20, 21] and not stuck.any()
    shift = np.array([*base, *[x * 5 for x in base]])
    assert not np.any(flag_readings(shift, np.zeros(40, int), 50000, 7, 6.5, 2, 3, 6))
    held = np.array([*base, *[77.0] * 6, *base, 0, 0, 0, 0, 0, 0, 0])
    assert flag_readings(held, np.zeros(len(held), int), 50000, 7, 6.5, 2, 3, 6)[2].sum() == 6


def test_implausible_edges(spark):
    df = spark.createDataFrame([("a", date(2026, 1, 1), 5.0), ("a", date(2026, 1, 2), None), (None, date(2026, 1, 1), -3.0), ("b", None, -1.0), ("c", date(2026, 1, 1), -1.0)], "series string, at date, value double")
    r = implausible(df, F.col("series"), F.col("at"), F.col("value"), upper=10.0).collect()
    assert [(x.series, x.out_of_bounds) for x in r] == [("c", True)]
    assert implausible(df.limit(0), F.col("series"), F.col("at"), F.col("value"), upper=10.0).count() == 0


def test_upserts(spark, rows):
    t = lambda s: datetime(2026, 1, 1, 0, 0, s)
    df = spark.createDataFrame(
        [("h", "i", "US", date(2026, 1, 2), date(2026, 1, 5), t(1)), ("h", "i", "GB", date(2026, 1, 1), date(2026, 1, 3), t(2)), ("h", "j", None, None, None, t(3))],
        "hash string, ip string, country string, first_seen date, last_seen date, ingested_at timestamp",
    )
    v = {r.ip: r for r in dedup.latest_view(df, ["hash", "ip"]).collect()}
    assert (v["i"].country, v["i"].first_seen, v["i"].last_seen) == ("US", date(2026, 1, 1), date(2026, 1, 5)) and v["j"].country is None
    assert {r.ip: r.country for r in dedup.keep_country_view(df, ["hash", "ip"]).collect()} == {"i": "GB", "j": None}
    a = spark.createDataFrame([("x", 5, ""), ("y", None, "t")], "k string, n int, s string")
    b = spark.createDataFrame([("x", 3, "new"), ("z", 1, "q")], "k string, n int, s string")
    assert rows(dedup.merge_upsert(a, b, ["k"], {"n": "max", "s": "fill"})) == [("x", 5, "new"), ("y", None, "t"), ("z", 1, "q")]
    assert rows(dedup.update_if_better(a, b, "k", "n", ["s"])) == [("x", 5, ""), ("y", None, "t"), ("z", 1, "q")]
    assert rows(dedup.insert_ignore(a, b.union(b), ["k"])) == [("z", 1, "q")]
    with pytest.raises(ValueError):
        dedup.remap(a, spark.createDataFrame([("x", "w")], "old string, new string"), "k", most=0)


def test_range_lookup(spark):
    rng = random.Random(5)
    ranges = [(0, 10_000_000, "all"), (100, 199, "a"), (150, 160, "b"), (5000, 5000, "c")]
    vals = [rng.randrange(0, 11_000_000) for _ in range(50)] + [100, 155, 199, 200, 5000, 150, None, -5]
    r = spark.createDataFrame(ranges, "lo long, hi long, label string")
    v = spark.createDataFrame([(x,) for x in vals], "v long")
    got = {x.v: x.label for x in joins.range_lookup(v, F.col("v"), r, width=64).collect()}
    for x in vals:
        fit = [q for q in ranges if x is not None and q[0] <= x <= q[1]]
        assert got[x] == (min(fit, key=lambda q: q[1] - q[0])[2] if fit else None)


def test_contained(spark):
    n = spark.createDataFrame([("n1", ["a", "b", "c"]), ("n2", ["a"])], "name_id string, words array<string>")
    a = spark.createDataFrame([("x", ["a", "c"]), ("y", ["a"]), ("z", ["d"])], "alias_id string, words array<string>")
    f = spark.createDataFrame([("a", 2), ("c", 1)], "word string, n long")
    got = joins.contained(n, a, f).collect()
    assert {(r.name_id, r.alias_id, r.n_words) for r in got} == {("n1", "x", 2), ("n1", "y", 1), ("n2", "y", 1)} and len(got) == 3


def test_bloom(spark):
    df = spark.createDataFrame([(bytes([255] * 128 + [0] * 128),), (bytes(256),), (bytes([255] * 256),), (None,)], "f binary")
    assert [r[0] for r in df.select(sketches.estimate(F.col("f"))).collect()] == [709, 0, 50000, None]


def test_text(spark):
    df = spark.createDataFrame([("  A  b\tC ", "Émile Ø", "1.2.3.4", "Movie IV"), (None, None, None, None)], "s string, a string, ip string, t string")
    r = df.select(text.squash(F.col("s")), text.fold_accents("a"), text.is_global_ip("ip"), text.ipv4_number(F.col("ip")), text.sequel(F.col("t"))).collect()
    assert tuple(r[0]) == ("a b c", "Emile Ø", True, 16909060, 4) and r[1][0] is None
    assert df.select(text.sequence_ratio("s", "s")).first()[0] == 1.0


def test_series(spark):
    df = spark.createDataFrame([("a", date(2026, 1, 1), 4), ("a", date(2026, 1, 3), 6), ("b", date(2026, 1, 2), 1)], "k string, day date, v long")
    assert {r.k: list(r.series) for r in series.dense(df, "k", "day", "v", 14).collect()} == {"a": [4, 0, 6], "b": [0, 1, 0]}
    d = {(r.k, r.day.day): r.delta for r in series.day_delta(df, ["k"], "day", "v").collect()}
    assert d == {("a", 1): 4, ("a", 3): 6, ("b", 2): 1}


def test_torn_csv(spark, tmp_path):
    head = "date,run_time,hash,ip_id,title,category,seeders,country,peer_count,bep33_seeders,bep33_leechers\n"
    (tmp_path / "2026-01-01_w1.csv").write_text(head + "2026-01-01,10:00,h,i,t,Movies,3,NA,7,1,2\n2026-01-01,10:00,h,i,t,Mov2026-01-01,x\n")
    (tmp_path / "2026-01-01_w2.csv").write_text(head + "2026-01-01,11:00,h,i,t,Movies,3,US,7,1,2\n")
    df = feeds.scan_log(spark, str(tmp_path), "2026-01-01").cache()
    assert {r.file: (r.n_rows, r.n_torn, r.warn) for r in feeds.torn(df).collect()} == {"2026-01-01_w1.csv": (2, 1, True), "2026-01-01_w2.csv": (1, 0, False)}
    assert sorted(r.country for r in feeds.good(df).collect()) == ["NA", "US"]
    with pytest.raises(FileNotFoundError):
        feeds.scan_log(spark, str(tmp_path), "2026-01-02")


def test_compact_peers(spark):
    df = spark.createDataFrame([(bytes([1, 2, 3, 4, 0, 80, 9, 8, 7, 6, 1, 0]),), (b"",)], "p binary")
    r = df.select(feeds.compact_peers(F.col("p"))).collect()
    assert [(x.ip, x.port) for x in r[0][0]] == [("1.2.3.4", 80), ("9.8.7.6", 256)] and r[1][0] == []


def test_sinks(spark, tmp_path):
    p = str(tmp_path / "t")
    a = spark.createDataFrame([(date(2026, 1, 1), "x"), (date(2026, 1, 2), "y")], "date date, k string")
    sinks.write_days(a, p)
    sinks.write_days(spark.createDataFrame([(date(2026, 1, 2), "z")], "date date, k string"), p)
    assert sorted(r.k for r in spark.read.parquet(p).collect()) == ["x", "z"]
    with pytest.raises(PermissionError):
        sinks.guard_past(spark, p, "2026-01-01", "2026-01-02")
    sinks.guard_past(spark, p, "2026-01-02", "2026-01-02")


def test_throttle(spark, tmp_path):
    src = str(tmp_path / "in")
    t0 = datetime(2026, 1, 1)
    spark.createDataFrame([("a", t0), ("a", t0 + timedelta(hours=1)), ("a", t0 + timedelta(hours=7)), ("b", t0)], "k string, at timestamp").write.parquet(src)
    s = spark.readStream.schema("k string, at timestamp").parquet(src)
    q = announce.throttled(s, "k", "at", 6 * 3600).writeStream.format("memory").queryName("alerts").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("alerts").groupBy("k").count().orderBy("k").collect() == [("a", 2), ("b", 1)]


def test_wire_formats(spark, tmp_path):
    assert feeds.bencode(b"d1:ai-3e1:bl3:xyzi0eee") == {b"a": -3, b"b": [b"xyz", 0]}
    for broken in (b"", b"i3", b"5:abc", b"l", b"i1ei2e", b"x"):
        with pytest.raises(ValueError):
            feeds.bencode(broken)
    df = spark.createDataFrame([(b"d1:a2:\xff\xfee",), (b"le",), (b"zz",), (None,)], "b binary")
    assert [r[0] for r in df.select(feeds.bencode_json("b")).collect()] == ['{"a": "fffe"}', "[]", None, None]
    v6 = spark.createDataFrame([(bytes([0x20, 1] + [0] * 13 + [1, 0, 80]),)], "p binary").select(feeds.compact_peers_v6(F.col("p"))).first()[0]
    assert [(x.ip, x.port) for x in v6] == [("2001:0000:0000:0000:0000:0000:0000:0001", 80)]
    h = "ab" * 20
    page = spark.createDataFrame([(f'<a href="magnet:?xt=urn:btih:{h.upper()}&dn=x">m</a> urn:btih:{h}', "VPK3XK53XOV3XK53XOV3XK53XOV3XK53")], "p string, b string")
    r = page.select(feeds.magnet_hashes(F.col("p")), text.base32_hex("b")).first()
    assert list(r[0]) == [h] and len(r[1]) == 40
    (tmp_path / "log.txt").write_text("a done=1\nb\nc done=2\nd\n")
    assert feeds.last_mark(spark, str(tmp_path / "log.txt"), r"done=(\d+)").first()[0] == "2"


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"items": [{"k": "x", "n": 1}, {"k": null, "n": 2}]}')
    assert [tuple(r) for r in feeds.json_rows(spark, str(tmp_path / "a.json"), "items array<struct<k:string,n:int>>", "items").collect()] == [("x", 1), (None, 2)]
    (tmp_path / "a.xml").write_text("<rss><item><title>t</title><n>3</n></item><item><title>u</title></item></rss>")
    assert sorted(tuple(r) for r in feeds.xml_rows(spark, str(tmp_path / "a.xml"), "item", "title string, n int").collect()) == [("t", 3), ("u", None)]
    assert feeds.previous_day(spark, str(tmp_path), "2026-01-01", "k string, n int") is None
    (tmp_path / "2026-01-01.csv").write_text("k,n\nx,1\ny,z,z\n")
    assert [r.k for r in feeds.previous_day(spark, str(tmp_path), "2026-01-01", "k string, n int").collect()] == ["x"]
    spark.createDataFrame([("7", "a")], "n string, k string").write.parquet(str(tmp_path / "2026-01-02.parquet"))
    assert [tuple(r) for r in feeds.previous_day(spark, str(tmp_path), "2026-01-02", "k string, n int, m long").collect()] == [("a", 7, 0)]
    assert feeds.optional(spark, {"a": str(tmp_path / "none.parquet")}) == {"a": None}
    sinks.ordered_csv(spark.createDataFrame([("b", 1), ("a", 2)], "k string, n int"), str(tmp_path / "o"), ["k"], ["n", "k"])
    assert next((tmp_path / "o").glob("*.csv")).read_text().split() == ["n,k", "2,a", "1,b"]
