"""Rules about names, titles and channels: packs, guards, owners, categories. Column builders; word lists are parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from peertide.functions import text

#: Marks of releases that hold several works.
PACKS = (
    r"\b\d+\s+to\s+\d+\s+films?\b", r"\bfilms?\s+\d+[-–]\d+\b", r"\b\d+\s+films?\b", r"\bcomplete\s+series\b", r"\bcomplete\s+seasons?\b",
    r"\bseasons?\s+\d+[-–]\d+\b", r"\bs\d{2}[-–]s?\d{2}\b", r"\btrilogy\b", r"\bquadrilogy\b", r"\bpentalogy\b", r"\bbox\s+set\b",
    r"\ball\s+\d+\s+(episodes?|films?|movies?)\b", r"\d{4}[-–]\d{4}\b", r"\b\d+\s*[-–&+]\s*\d+\s*(pack|film|movie)\b", r"\bcollection\b",
)
#: Labels of pages that are no titles.
PAGE_LABELS = (
    "popular latest trending ongoing recent top home genres genre schedule upcoming completed featured random search login register new list "
    "contact disclaimer about dmca privacy terms help faq news menu more movies series action adventure comedy drama fantasy horror thriller "
    "romance mystery music sports supernatural historical animation crime war western documentary biography musical next prev previous page "
    "special specials faqs open close play comments related server mirror mirrors trailer trailers cast report request download subtitles "
    "quality episodes seasons recommended dubbed"
).split()
#: Words of adult releases; any of them refuses a name.
ADULT_WORDS = "xxx onlyfans pornhub xhamster xnxx xvideos brazzers bangbros hardcore".split()
#: What a title's distinctive words do not include.
GUARD_STOP = "the a an of in and to is for on with at by from or".split()
GUARD_SUFFIX = "us uk ca au nz ie gb complete uncut extended remastered proper repack internal limited dubbed subbed multi dual hdr".split()
#: Ordered category rules; the first that holds decides.
CATEGORY_RULES = (
    ("Anime", r"\b(anime|crunchyroll|funimation|subsplease|horriblesubs|erai-raws)\b|\[(asw|dkb|nc-raws)\]"),
    ("Series", r"\bs\d{1,2}e\d{1,2}\b|\bseason[\s._]*\d+\b|\bepisode[\s._]*\d+\b|\b\d+x\d+\b|\bcomplete[\s._]series\b|\btv[\s._]series\b|\bs\d{2,}[\s._]"),
    ("Movies", r"\b(1080p|2160p|4k|720p|480p|bluray|blu-ray|bdrip|brrip|web-dl|webrip|hdrip|dvdrip|hdcam|cam|ts|x264|x265|hevc|avc|xvid|divx|dts|atmos|aac|ac3)\b|\(\d{4}\)"),
)


def is_pack(name: Column) -> Column:
    """Whether a release holds several works. A film of the label named after its collection is one work."""
    s = F.regexp_replace(F.lower(name), r"criterion collection", "criterion")
    return F.coalesce(s.rlike("|".join(PACKS)), F.lit(False))


def is_adult(name: Column, words: list[str] | tuple[str, ...] = ADULT_WORDS) -> Column:
    return F.coalesce(F.lower(name).rlike(rf"\b({'|'.join(words)})\b"), F.lit(False))


def category_by_rules(name: Column) -> Column:
    """Adult names first, then the ordered rules; Unknown where none holds or there is no name."""
    out = F.lit("Unknown")
    for label, rule in reversed(CATEGORY_RULES):
        out = F.when(F.lower(name).rlike(rule), F.lit(label)).otherwise(out)
    return F.when(is_adult(name), F.lit("Adult")).otherwise(F.coalesce(out, F.lit("Unknown")))


def is_page_label(heading: Column, labels: list[str] | tuple[str, ...] = PAGE_LABELS) -> Column:
    """Whether a heading is navigation and no title."""
    return F.array_contains(F.array(*[F.lit(x) for x in labels]), F.trim(F.regexp_replace(F.lower(heading), r"[^a-z0-9]+", " ")))


def like_any_case(c: Column, pattern: str) -> Column:
    """LIKE in which ASCII letters match in either case and others only themselves, and % and _ of the asked text stay wildcards."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(c, upper, lower).like(pattern.translate(str.maketrans(upper, lower)))


def guard_tokens(title: Column) -> Column:
    """Distinctive words: without little words, edition marks, numbers and episode marks; a final s of longer words goes, so that a
    possessive meets its name."""
    drop = F.array(*[F.lit(w) for w in (*GUARD_STOP, *GUARD_SUFFIX)])
    kept = F.filter(text.word_list(title), lambda w: (F.length(w) >= 2) & ~F.array_contains(drop, w) & ~w.rlike(r"^(\d+p?|s\d+|e\d+|s\d+e\d+)$"))
    return F.array_sort(F.array_distinct(F.transform(kept, lambda w: F.when((F.length(w) > 3) & w.endswith("s"), F.substr(w, F.lit(1), F.length(w) - 1)).otherwise(w))))


def diverges(query: Column, matched: Column) -> Column:
    """Whether two titles are too unlike for a fuzzy match to stand: each has distinctive words of its own and fewer than two are
    shared, unless they read nearly the same without blanks (0.90)."""
    q, m = guard_tokens(query), guard_tokens(matched)
    apart = (F.size(q) > 0) & (F.size(m) > 0) & (F.size(F.array_except(q, m)) > 0) & (F.size(F.array_except(m, q)) > 0) & (F.size(F.array_intersect(q, m)) < 2)
    flat = lambda c: F.array_join(text.word_list(c), "")
    return F.when(apart, text.sequence_ratio(flat(query), flat(matched)) < 0.90).otherwise(F.lit(False))


def listing_title(name: Column) -> Column:
    """A name as listings show it: cut at its episode mark, at its first quality mark; dots as blanks; without a last bracket, a last
    group and a year in brackets; lower case."""
    s = F.regexp_replace(name, r"[._\s][Ss]\d{1,2}[Ee]\d{1,2}.*$", "")
    s = F.regexp_replace(s, r"(?i)[._\s\[(]+(480p|720p|1080p|2160p|4k|bluray|blu-ray|bdrip|brrip|web-dl|webrip|hdtv|hdrip|dvdrip|x264|x265|hevc|xvid).*$", "")
    s = F.regexp_replace(s, r"[._]+", " ")
    s = F.regexp_replace(s, r"\s*[\[(][^\])]*[\])]\s*$", "")
    s = F.regexp_replace(s, r"\s+-\w+$", "")
    return F.lower(F.trim(F.regexp_replace(s, r"\s*\(\d{4}\)\s*", "")))


def stands_for(name: Column, title: Column, year: Column, category: Column, *, gap: int = 1) -> Column:
    """Whether a release name may stand for a title. A film whose release names a year more than `gap` from the title's is another
    film. A film of one or two words must be the whole cleaned name and not lie within it. Otherwise the words found decide: up
    to three all of them, of four three, of more 60 %. A name or title without words stands for nothing."""
    w = F.filter(text.words(F.regexp_replace(title, "['’]", "")), lambda x: ~x.isin(*text.STOP_WORDS))
    have = text.words(F.regexp_replace(name, "['’]", ""))
    cleaned = F.filter(text.words(F.regexp_replace(text.clean_release(name), "['’]", "")), lambda x: ~x.isin(*text.STOP_WORDS))
    named = F.nullif(F.regexp_extract(name, r"^.+?(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1), F.lit("")).cast("int")
    film, n, met = category == "Movies", F.size(w), F.size(F.array_intersect(w, have))
    another = film & (F.abs(named - year) > gap)
    whole = (F.size(cleaned) == n) & (F.size(F.array_intersect(cleaned, w)) == n)
    most = F.when(n <= 3, met == n).when(n == 4, met >= 3).otherwise(met / n >= 0.6)
    return F.coalesce(F.when(n == 0, F.lit(False)).when(F.coalesce(another, F.lit(False)), F.lit(False)).when(film & (n <= 2), whole).otherwise(most), F.lit(False))


def compatible(source: Column, target: Column) -> Column:
    """Whether an id may be folded into another: one family, or a series into an anime; families that are not known do not bar."""
    a, b = text.id_family(source), text.id_family(target)
    return F.coalesce((a == b) | ((a == "series") & (b == "anime")), F.lit(True))


def owner(name: Column, country: Column, rules: list[tuple[str, tuple[str, ...]]], brand: tuple[str, str, tuple[str, ...]]) -> Column:
    """The group a channel belongs to. `brand` = (word, owner, countries where it is another's) is looked at first, as a whole word at the
    start or inside; then the ordered rules (owner, keywords), the first with a keyword in the name decides; else Other."""
    n = F.lower(F.coalesce(name, F.lit("")))
    first = F.replace(F.split_part(F.upper(F.coalesce(country, F.lit(""))), F.lit(","), F.lit(1)), F.lit("UK"), F.lit("GB"))
    out = F.lit("Other")
    for who, keys in reversed(rules):
        hit = F.lit(False)
        for k in keys:
            hit = hit | n.contains(k)
        out = F.when(hit, F.lit(who)).otherwise(out)
    word, who, not_in = brand
    branded = n.startswith(f"{word} ") | n.contains(f" {word} ")
    return F.when(branded, F.when(first.isin(*not_in), F.lit("Other")).otherwise(F.lit(who))).otherwise(out)


def poster_url(path: Column, base: str = "https://image.example/t/p/w342") -> Column:
    """A whole address as it is, a path under `base`, nothing for blanks."""
    p = F.nullif(F.trim(path), F.lit(""))
    return F.when(p.rlike("^https?://"), p).when(p.startswith("/"), F.concat(F.lit(base), p)).when(p.isNotNull(), F.concat(F.lit(f"{base}/"), p))


def same_site_links(html: Column, site: str, most: int = 2) -> Column:
    """The first links of a page that stay on its site, relative ones made absolute, distinct, in order."""
    links = F.transform(text.html_links(html), lambda x: F.when(x.startswith("/"), F.concat(F.lit(f"https://{site}"), x)).otherwise(x))
    here = F.filter(links, lambda x: x.startswith(f"https://{site}/") | x.startswith(f"http://{site}/"))
    return F.slice(F.array_distinct(here), 1, most)
