"""Release names: what work, number, year and kind they speak of."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: Words that carry no identity in a title.
STOP = frozenset("the a an and of for in on to at by film series tv anime movie".split())
#: Technical words of release names; where the first one stands, the title has ended.
TECH = re.compile(
    r"\b(?:\d{3,4}[pi]|4k|uhd|web|webrip|webdl|web dl|hdtv|hdrip|dvdrip|bdrip|brrip|bluray|blu ray|dvd|remux|cam|amz|nf|multi|"
    r"dual|x26[45]|h ?26[45]|hevc|avc|xvid|divx|av1|aac|dts|ac3|flac|10bit|repack|proper)\b"
)
_YEAR = re.compile(r"\b(?:19[3-9]\d|20[0-4]\d)\b")
_EPISODE = re.compile(r"\bs\d{1,2}(?: ?e\d{1,3})?\b|\b\d{1,2}x\d{1,3}\b|\bseason \d{1,2}\b|\bepisode \d{1,4}\b|\bep ?\d{1,4}\b")
_FANSUB = re.compile(r" - \d{1,4}(?:v\d)?\b")
_NOISE = re.compile(r"^[0-9a-f]{16,}$|^img[ _]\d|\bcollection \d+ files\b|\bfiles pack\b|\bdiscography\b|\bsetup v?\d")
_SUFFIX = re.compile(r"\.(?:mkv|mp4|avi|ts|zip|rar|iso|exe|mov|wmv)$")
_ROMAN = {r: i for i, r in enumerate("ii iii iv v vi vii viii ix x".split(), 2)}


def fold(s: str) -> str:
    """Lower case without accents."""
    s = unicodedata.normalize("NFKD", s)
    return "".join(c for c in s if not unicodedata.combining(c)).casefold()


def title_key(s: str) -> tuple[str, int]:
    """(content words, number in its series): words without articles and joining words; a number or Roman numeral at the end
    is the work's number, 1 if there is none."""
    w = [x for x in re.findall(r"[^\W_]+", fold(s))]
    number = 1
    if len(w) > 1:
        if w[-1] in _ROMAN:
            number = _ROMAN[w.pop()]
        elif w[-1].isdigit() and len(w[-1]) <= 2:
            number = max(1, int(w.pop()))
    return " ".join(x for x in w if x not in STOP), number


def parse_release(raw: str | None) -> tuple[str | None, int | None, int | None, str | None]:
    """(content words, number, year, kind) of a release name; nulls where it is noise or says nothing."""
    if not raw or not raw.strip():
        return None, None, None, None
    s = _SUFFIX.sub("", fold(raw).strip())
    flat = re.sub(r"[._]+", " ", s)
    if _NOISE.search(flat):
        return None, None, None, None
    kind = None
    fansub = re.match(r"\s*\[[^\]]*\][ _]*", s)
    if fansub:
        flat = re.sub(r"[._]+", " ", s[fansub.end() :]).lstrip(" -")
        if _FANSUB.search(flat) and "." not in fansub.group():
            kind = "anime"
    ends = []
    year = None
    lead = re.match(r"\s*(\d{4})?\s?(s\d{1,2}(?: ?e\d{1,3})?|\d{1,2}x\d{1,3}|season \d{1,2})?\s?- ", flat)
    if lead and (lead.group(1) or lead.group(2)) and (not lead.group(1) or _YEAR.fullmatch(lead.group(1))):
        year = int(lead.group(1)) if lead.group(1) else None
        kind = "series" if lead.group(2) else kind
        flat = flat[lead.end() :]
    flat = re.sub(r"[\[\](){},]", " | ", flat)
    spaced = re.sub(r"-", " ", flat)  # same length, so that places agree
    if m := TECH.search(spaced):
        ends.append(m.start())
    if m := _EPISODE.search(flat):
        ends.append(m.start())
        if kind is None:
            kind = "anime" if flat[m.start() : m.start() + 2] == "ep" else "series"
    if kind == "anime" and (m := _FANSUB.search(flat)):
        ends.append(m.start())
    if year is None:
        for m in _YEAR.finditer(flat):
            if flat[: m.start()].strip(" |-"):
                year = int(m.group())
                ends.append(m.start())
                break
    bar = flat.find("|", 1)
    if bar > 0 and flat[:bar].strip():
        ends.append(bar)
    name, number = title_key(flat[: min(ends)] if ends else flat)
    if not name or re.fullmatch(r"[0-9a-f]{8,}", name.replace(" ", "")) and any(c.isdigit() for c in name):
        return None, None, year, kind
    return name, number, year, kind


def clean_title(t: str | None) -> tuple[str | None, int | None]:
    if not t or not t.strip():
        return None, None
    s = fold(t).strip()
    if _NOISE.search(s):
        return None, None
    name, number = title_key(s)
    return (name, number) if name else (None, None)


def with_parsed(df: DataFrame, raw_name: str = "raw_name", title: str = "title") -> DataFrame:
    """df without both columns and with r_name, r_no, year and r_kind of the release name and t_name, t_no of the title, nulls
    where they say nothing."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            r = [parse_release(x) for x in b[raw_name]]
            t = [clean_title(x) for x in b[title]]
            b["r_name"], b["t_name"] = [x[0] for x in r], [x[0] for x in t]
            b["r_no"] = pd.array([x[1] for x in r], "Int32")
            b["t_no"] = pd.array([x[1] for x in t], "Int32")
            b["year"] = pd.array([x[2] for x in r], "Int32")
            b["r_kind"] = [x[3] for x in r]
            yield b.drop(columns=[raw_name, title])

    rest = [f"{c} {k}" for c, k in df.dtypes if c not in (raw_name, title)]
    return df.mapInPandas(run, ", ".join([*rest, "r_name string", "t_name string", "r_no int", "t_no int", "year int", "r_kind string"]))
