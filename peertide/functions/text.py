"""Text normal forms and extractions as Column builders; Arrow UDFs only where Spark has no built-in."""

from __future__ import annotations

import base64
import difflib
import ipaddress
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, DoubleType, StringType

#: Words that say nothing about a title.
STOP_WORDS = ("the", "and", "for", "with", "from", "season", "episode", "complete", "multi")
#: Words that do not count when titles are compared word by word (articles, prepositions, conjunctions).
LITTLE_WORDS = ("the", "a", "an", "of", "in", "and", "to", "is", "for", "on", "with", "at", "by", "from", "or")
#: Technical words of release names.
TECH_WORDS = ("480p", "720p", "1080p", "2160p", "x264", "x265", "hevc", "xvid", "av1", "web", "webrip", "bdrip", "hdtv", "hdrip", "dvdrip", "bluray", "mkv")
#: Roman numerals of sequels.
ROMAN = {"ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}


def squash(c: Column) -> Column:
    """Lower case, single blanks, trimmed."""
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def word_list(c: Column) -> Column:
    """Runs of ASCII letters and digits in lower case, in order."""
    return F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda x: x != "")


def words(c: Column) -> Column:
    """The distinct ones of them."""
    return F.array_distinct(word_list(c))


def content_words(c: Column) -> Column:
    """The distinct words without little ones; all of them where a title has no others. Short words and numbers stay."""
    w = words(c)
    kept = F.filter(w, lambda x: ~x.isin(*LITTLE_WORDS))
    return F.when(F.size(kept) > 0, kept).otherwise(w)


def name_tokens(c: Column) -> Column:
    """Words of a name without stop words and technical words; numbers stay when they may be sequels (2 to 99)."""
    drop = F.array(*[F.lit(w) for w in (*STOP_WORDS, *TECH_WORDS)])
    number = lambda x: x.try_cast("int")
    kept = F.filter(words(c), lambda x: ~F.array_contains(drop, x) & (~x.rlike("^[0-9]+$") | number(x).between(2, 99)))
    return F.array_sort(kept)


def title_key(c: Column) -> Column:
    """Site title without markup leftovers, years and punctuation."""
    s = F.regexp_replace(F.lower(c), r"&[a-z]+;|&#[0-9]+;", " ")
    s = F.regexp_replace(s, r"\b(19|20)[0-9]{2}\b", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"[^a-z0-9]+", " "), r"\s+", " "))


def sequel(c: Column) -> Column:
    """Number of a work in its series from a trailing number (2 to 20) or Roman numeral, 1 without."""
    last = F.regexp_extract(F.lower(c), r"\s([0-9]{1,2}|[ivx]+)\s*$", 1)
    roman = F.lit(None).cast("int")
    for r, n in ROMAN.items():
        roman = F.when(last == r, F.lit(n)).otherwise(roman)
    digits = F.when(last.rlike("^[0-9]+$"), last.cast("int"))
    return F.when(digits.between(2, 20), digits).when(roman.isNotNull(), roman).otherwise(1)


def first_year(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1), F.lit("")).cast("int")


def category_guess(c: Column) -> Column:
    """Kind of a release by ordered rules; the first that holds wins."""
    s = F.lower(c)
    return (
        F.when(s.rlike(r"^\[[^\]]+\].* - [0-9]{1,3}"), F.lit("Anime"))
        .when(s.rlike(r"s[0-9]{2}(e[0-9]{2})?|[0-9]x[0-9]{2}|season [0-9]"), F.lit("Series"))
        .when(s.rlike(r"(19|20)[0-9]{2}.*(480|720|1080|2160)p"), F.lit("Movies"))
        .otherwise(F.lit("Unknown"))
    )


def html_texts(c: Column, tag: str) -> Column:
    """Texts of all elements of one tag, distinct, in order."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(rf"<{tag}[^>]*>([^<]*)</{tag}>"), F.lit(1)))


def html_links(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r'<a href="([^"]+)"'), F.lit(1)))


def processing_date(at: Column) -> Column:
    """Before six in the morning (UTC) the day is still yesterday."""
    return F.when(F.hour(at) < 6, F.date_sub(F.to_date(at), 1)).otherwise(F.to_date(at))


@pandas_udf(StringType())
def fold_accents(s: pd.Series) -> pd.Series:
    """NFKD without combining marks: Spark has no such function."""
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)))


@pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp similarity of two strings."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


@pandas_udf(BooleanType())
def is_global_ip(s: pd.Series) -> pd.Series:
    """Whether an address is public; null where it is no address."""

    def one(x: str | None) -> bool | None:
        try:
            return ipaddress.ip_address(x).is_global
        except ValueError:
            return None

    return s.map(one)


def ipv4_number(c: Column) -> Column:
    p = F.split(c, r"\.")
    part = lambda i: F.element_at(p, i).cast("bigint")
    return F.when(F.size(p) == 4, part(1) * 16777216 + part(2) * 65536 + part(3) * 256 + part(4))


@pandas_udf(StringType())
def base32_hex(s: pd.Series) -> pd.Series:
    """A base32 content hash as 40 hex digits; hex ones in lower case; null for anything else."""

    def one(x: str | None) -> str | None:
        if x is None:
            return None
        if len(x) == 40:
            return x.lower() if all(c in "0123456789abcdefABCDEF" for c in x) else None
        try:
            raw = base64.b32decode(x.upper())
        except ValueError:
            return None
        return raw.hex() if len(raw) == 20 else None

    return s.map(one)


def name_guard(name: Column, title: Column, *, year_gap: int = 1, name_year: Column | None = None, title_year: Column | None = None) -> Column:
    """Whether a release name may stand for a title. Years further apart than `year_gap` refuse. Short titles must be met whole:
    up to three words all of them, of four words three, of longer ones 60 %."""
    w = F.array_distinct(F.filter(words(title), lambda x: ~x.isin(*STOP_WORDS)))
    n = F.size(w)
    met = F.size(F.array_intersect(w, words(name)))
    enough = F.when(n == 0, F.lit(False)).when(n <= 3, met == n).when(n == 4, met >= 3).otherwise(met / n >= 0.6)
    if name_year is None or title_year is None:
        return enough
    return enough & F.coalesce(F.abs(name_year - title_year) <= year_gap, F.lit(True))


def organisation_is_datacenter(org: Column, keywords: tuple[str, ...] = ("hosting", "server", "cloud", "datacenter", "vpn")) -> Column:
    return F.coalesce(F.lower(org).rlike("|".join(keywords)), F.lit(False))


def clean_release(name: Column) -> Column:
    """A release name up to its first quality, episode or year mark, separators as blanks."""
    s = F.regexp_replace(F.lower(name), r"[._]+", " ")
    s = F.regexp_replace(s, r"^\s*\[[^\]]*\]\s*(-\s*)?", "")
    s = F.regexp_replace(s, r"(\(|\[|\b(19|20)[0-9]{2}\b|\bs[0-9]{2}|\b[0-9]+x[0-9]{2}|\bseason\b|\bepisode\b|\b[0-9]{3,4}p\b).*$", "")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def has_letters(words_: Column) -> Column:
    """Whether any word is not a number."""
    return F.exists(words_, lambda x: ~x.rlike("^[0-9]+$"))


def degraded(words_: Column) -> Column:
    """Whether a word of fifteen or more characters holds a digit: a name that was not cut well."""
    return F.exists(words_, lambda x: (F.length(x) >= 15) & x.rlike("[0-9]"))


def ambiguous(title: Column) -> Column:
    """Whether a title alone says too little: at most three characters, or nothing but stop words."""
    w = words(title)
    return (F.length(F.trim(title)) <= 3) | (F.size(F.filter(w, lambda x: ~x.isin(*STOP_WORDS))) == 0)


def id_family(id_: Column) -> Column:
    """Kind of work an id belongs to by its prefix, null for other ids."""
    f = F.split_part(F.lower(id_), F.lit("-"), F.lit(1))
    return F.when(f.isin("film", "series", "anime"), f)


def category_of_numbers(numbers: Column) -> Column:
    """Category by the number ranges of an indexer: anime numbers first, then 2000 to 2999 films, 5000 to 5999 series."""
    return (
        F.when(F.exists(numbers, lambda x: x.isin(5070, 2070)), "Anime")
        .when(F.exists(numbers, lambda x: x.between(2000, 2999)), "Movies")
        .when(F.exists(numbers, lambda x: x.between(5000, 5999)), "Series")
    )
