"""Rules about names and ids, tolerant reads, and streams whose states end, on small fixtures."""

import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from peertide.functions import release, rules
from peertide.operators import identity
from peertide.plans import serve
from peertide.session import durable, scratch
from peertide.sources import feeds
from peertide.streaming import announce

#: Release name, title, its year, category, whether the name may stand for the title.
GUARD_CASES = [
    ("Michael.2026.1080p.HDTS.h264.Dual.YG", "Michael", None, "Movies", True),
    ("Sinners 2025 1080p WEBRip x265-DH", "Sinners", None, "Movies", True),
    ("Michael Clayton (2007) (1080p BluRay x265 Silence)", "Michael", None, "Movies", False),
    ("Fantastic Four (2015) [Michael B. Jordan] 1080p", "Michael", None, "Movies", False),
    ("Beast Of War 2025 1080p WEB-DL HEVC x265", "Beast", None, "Movies", False),
    ("Lilo & Stitch (2025) [1080p]", "Lilo & Stitch", None, "Movies", True),
    ("Masters of the Universe.2026.1080p.TeleCine", "Masters of the Universe", 2026, "Movies", True),
    ("Masters.Of.The.Universe.1987.1080p.BluRay.HEVC", "Masters of the Universe", 2026, "Movies", False),
    ("Michael 1996 1080p BluRay HEVC x265 5.1 BONE", "Michael", 2026, "Movies", False),
    ("Michael.2026.1080p.TELESYNC.V2.x264-SyncUP", "Michael", 2026, "Movies", True),
    ("Toy Story 3 (2010) 1080p BrRip x264 - YIFY", "Toy Story 5", 2026, "Movies", False),
    ("Toy.Story.5.2026.1080p.WEB-DL", "Toy Story 5", 2026, "Movies", True),
    ("Despicable Me 2 (2013) 1080p BrRip x264", "Despicable Me 4", 2024, "Movies", False),
    ("The Running Man 1987 REMASTERED 1080p BluRay", "The Running Man", 2025, "Movies", False),
    ("The Running Man (2025) [1080p] [WEBRip] [5.1]", "The Running Man", 2025, "Movies", True),
    ("How to Train Your Dragon (2010) 1080p BrRip x264", "How to Train Your Dragon", 2025, "Movies", False),
    ("How to Train Your Dragon 2025 1080p WEB", "How to Train Your Dragon", 2025, "Movies", True),
    ("Lisa Frankenstein 2024 1080p WEBRip", "Frankenstein", 2025, "Movies", False),
    ("Frankenstein.2025.1080p.NF.WEB-DL", "Frankenstein", 2025, "Movies", True),
    ("Sinners 2025 1080p", "Sinners", 2025, "Movies", True),
    ("Lilo & Stitch (1789) weird", "Lilo & Stitch", None, "Movies", True),
    ("The Boys S05E06 1080p WEB h264-ETHEL", "The Boys", 2019, "Series", True),
    ("Euphoria US S03E05 1080p AMZN WEB", "Euphoria", 2019, "Series", True),
    ("Jurassic World Rebirth 2025 1080p WEB", "Jurassic World Rebirth", 2025, "Movies", True),
]


def test_guard_cases(spark):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(GUARD_CASES)], "i int, n string, t string, y int, c string, want boolean")
    got = df.select("i", "want", rules.stands_for(F.col("n"), F.col("t"), F.col("y"), F.col("c")).alias("got")).collect()
    assert [GUARD_CASES[r.i] for r in got if r.got != r.want] == []
    odd = spark.createDataFrame([(None, "t", 1, "Movies"), ("n", None, 1, "Movies"), ("", "", None, None), ("the", "the", None, "Series")], df.select("n", "t", "y", "c").schema)
    assert [r[0] for r in odd.select(rules.stands_for(F.col("n"), F.col("t"), F.col("y"), F.col("c"))).collect()] == [False] * 4


def test_divergence(spark):
    pairs = [("Silent Garden", "Silent Letter", True), ("Silent Garden", "Silent Garden 2", False), ("Spider Man Story", "Spiderman Story", False), ("Clarksons Farm", "Clarkson's Farm", False), ("", "x", False), (None, "Silent", False)]
    df = spark.createDataFrame(pairs, "a string, b string, want boolean")
    assert [(r.a, r.b) for r in df.withColumn("got", rules.diverges(F.col("a"), F.col("b"))).collect() if bool(r.got) != r.want] == []


def test_rules_of_names(spark):
    df = spark.createDataFrame([("Criterion Collection Film 1961",), ("The Matrix Trilogy",), ("Show S01-S03",), ("[SubsPlease] Name - 01",), ("Show.S01E02.720p",), ("Film.2020.1080p",), ("Clip XXX 1080p",), (None,)], "n string")
    got = df.select(rules.is_pack(F.col("n")).alias("p"), rules.category_by_rules(F.col("n")).alias("c")).collect()
    assert [r.p for r in got] == [False, True, True, False, False, False, False, False]
    assert [r.c for r in got][3:] == ["Anime", "Series", "Movies", "Adult", "Unknown"]
    who = spark.createDataFrame([("Sky Sport", "UK"), ("Sky Sport", "AU"), ("News Film", "US"), ("Blue Sky Arena", "GB,US"), (None, None)], "n string, c string")
    o = rules.owner(F.col("n"), F.col("c"), [("A", ("film",)), ("B", ("news", "arena"))], ("sky", "S", ("AU",)))
    assert [r[0] for r in who.select(o).collect()] == ["S", "Other", "A", "S", "Other"]
    like = spark.createDataFrame([("LANtern",), ("lantÈrn",), ("lanTErn 5",), (None,)], "t string")
    assert [r[0] for r in like.select(rules.like_any_case(F.col("t"), "LAN_er%")).collect()] == [True, False, True, None]
    urls = spark.createDataFrame([("/a.jpg",), ("http://x/y",), ("b",), (" ",), (None,)], "p string")
    assert [r[0] for r in urls.select(rules.poster_url(F.col("p"), "B")).collect()] == ["B/a.jpg", "http://x/y", "B/b", None, None]


def test_canonical_by_authority(spark):
    meta = [
        ("film-1", "robin hood", None, None, None), ("series-2", "robin hood", "222", None, "c2"), ("series-3", "robin hood tv", "222", None, "c2"),
        ("film-a", "beautiful boy", "10", None, "ca"), ("film-b", "beautiful boy", "18", None, "cb"), ("film-x", "beautiful boy", None, None, None),
        ("anime-5", "one piece", None, "21", "anime-21"), ("anime-6", "one piece!", None, "21", "anime-21"), ("series-q", "one piece", None, None, None),
        ("ip-9", "robin hood", None, None, None), ("z", None, None, None, None),
    ]
    df = spark.createDataFrame(meta, "ip_id string, title string, imdb string, anime string, resolved string")
    got = {r.old: r.new for r in identity.canonical_by_authority(df, rules.compatible).collect()}
    # the film stays out of the series; two films of one title stay apart; an anime takes in the series of its title; unknown kinds fold
    assert got == {"series-3": "series-2", "anime-6": "anime-5", "series-q": "anime-5", "ip-9": "series-2"}
    assert identity.canonical_by_authority(df.limit(0), rules.compatible).count() == 0


def test_torn_lines_are_seen_whatever_is_read(spark, tmp_path):
    (tmp_path / "2026-01-01_w0.csv").write_text("a,b\nx,1\ny\nz,3\n")
    (tmp_path / "2026-01-01_w1.csv").write_text("a,b\nq,4\n")
    rows = feeds.scan_log(spark, str(tmp_path), "2026-01-01", "a string, b int")
    assert {r.file: (r.n_rows, r.n_torn, r.warn) for r in feeds.torn(rows).collect()} == {"2026-01-01_w0.csv": (3, 1, True), "2026-01-01_w1.csv": (1, 0, False)}
    assert sorted(r.a for r in feeds.good(rows).select("a").collect()) == ["q", "x", "z"] and feeds.good(rows).groupBy().count().first()[0] == 3


def _feed(spark, folder, batches, columns="hash string, ip string, country string, first_seen date, last_seen date, ingested_at timestamp"):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("overwrite").json(f"{folder}/tmp")
        part = next((folder / "tmp").glob("part-*"))
        shutil.move(part, folder / f"{i}.json")
        shutil.rmtree(folder / "tmp")
    return spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).json(str(folder / "*.json"))


def _run(df, mode, base):
    out = []
    q = df.writeStream.outputMode(mode).foreachBatch(lambda b, i: out.extend(tuple(r) for r in b.collect())).option("checkpointLocation", str(base)).trigger(availableNow=True).start()
    q.awaitTermination()
    return out


def test_late_rows_and_states_that_end(spark, tmp_path):
    day = lambda d, h=1: datetime(2026, 1, d, h)
    row = lambda h, ip, d: (h, ip, "US", None, None, day(d))
    batches = [[row("h", "a", 1), row("h", "a", 1)], [row("h", "b", 9)], [row("h", "c", 9)], [row("h", "late", 2), row("h", "a", 10)]]
    got = {(str(r[0]), r[3]) for r in _run(announce.daily_distinct(_feed(spark, tmp_path, batches), late="2 days"), "update", tmp_path / "c1")}
    assert ("2026-01-01", 1) in got and ("2026-01-09", 2) in got and not any(d == "2026-01-02" for d, _ in got)  # the late row is dropped
    seen = [(r[0], r[1]) for r in _run(announce.first_in_retention(_feed(spark, tmp_path, batches), ["hash", "ip"], keep="4 days").select("hash", "ip"), "append", tmp_path / "c2")]
    assert sorted(seen) == [("h", "a"), ("h", "a"), ("h", "b"), ("h", "c")]  # a is forgotten after four days and counts as new


def test_alerts_pause_and_recover(spark, tmp_path):
    at = lambda h, m=0: datetime(2026, 1, 1, h, m)
    batches = [[("k", at(1)), ("k", at(1)), ("k", at(2))], [("k", at(7, 30))], [("x", at(23))], [("k", datetime(2026, 1, 2, 5))]]
    stream = _feed(spark, tmp_path, batches, "key string, at timestamp")
    got = sorted((r[0], r[2], r[1].day, r[1].hour) for r in _run(announce.throttled(stream, "key", "at", 6 * 3600, recovery=True), "append", tmp_path / "c"))
    assert [g for g in got if g[1] == "alert"] == [("k", "alert", 1, 1), ("k", "alert", 1, 7), ("k", "alert", 2, 5), ("x", "alert", 1, 23)]
    assert ("k", "recovered", 1, 13) in got


def test_report_page_and_scratch(spark):
    rows = spark.createDataFrame([("a", "<x>", 1234), ("a", "y", None), ("b", "z", 5)], "section string, label string, value long")
    assert serve.report_html(rows).first().html == "<h2>a</h2><table><tr><td>y</td><td></td></tr><tr><td>&lt;x&gt;</td><td>1,234</td></tr></table><h2>b</h2><table><tr><td>z</td><td>5</td></tr></table>"
    assert scratch(spark) != scratch(spark) and durable(rows).count() == 3


@pytest.mark.parametrize(
    "raw, want",
    [("Silent.Letter.2021.1080p.WEB.x264-GRP", ("silent letter", 1, 2021, None)), ("Show.S01E02.720p", ("show", 1, None, "series")), (None, (None, None, None, None)), ("Garden III (1999)", ("garden", 3, 1999, None))],
)
def test_release_names(raw, want):
    assert release.parse_release(raw)[:4] == want
