"""Written forms of personal data: the exact check behind the tagger, and the labelled spans it is trained on."""

from __future__ import annotations

import re

KINDS = ("email", "phone", "id_number", "address", "name")

_LOCAL = r"[A-Za-z0-9](?:[\w.+\-]*[A-Za-z0-9_])?"
_PART = r"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?"
_AT = r"(?:@| ?\(at\) ?| ?\[at\] ?| ?\{at\} ?)"
_DOT = r"(?:\.| ?\[dot\] ?| ?\(dot\) ?| dot )"
EMAIL = re.compile(rf"(?<![\w.+\-]){_LOCAL}(?:{_AT}{_PART}(?:{_DOT}{_PART})+|\sat\s{_PART}(?:\sdot\s{_PART})+)", re.I)

PHONE = re.compile(
    r"(?<![\w.+\-/(])(?:"
    r"\(\d{3}\) ?\d{3}[- .]\d{4}|\+1[ .\-]\d{3}[ .\-]\d{3}[ .\-]\d{4}|1-\d{3}-\d{3}-\d{4}|"
    r"\+\d{2,3} \(0\)\d{1,4}(?: \d{2,6}){2,3}|\+\d{2,3} \d(?: \d{2}){4}|\+\d{2,3}[ \d]{8,14}\d|"
    r"0\d{3,4} \d{3} \d{3}|0\d{2,4}/\d{5,9}|00\d{9,13}|\d{3}-\d{3}-\d{4}|\d{3}-\d{4}(?= ?(?:ext|x))|\d{3}-\d{4}"
    r")(?: ?(?:ext\.?|x|extension|Durchwahl|poste) ?\d{1,5})?(?![\w\-/]|\.\d)"
)
ID_NUMBER = re.compile(
    r"(?<![\w\-./])(?:QQ ?\d{2} ?\d{2} ?\d{2} ?[A-D]|[XYZ]\d{7}[A-Z]|\d{8}[A-Z]|\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4}|\d{6}-\d{4})(?![\w\-/]|\.\d)"
)

_CAP = r"[^\W\d_a-z][\w'’\-]*"
_TOWN = rf"{_CAP}(?:[ \-]{_CAP}){{0,2}}?"
_POST = r"(?:ZZ ?\d{5}|ZZ\d{1,2} \d[A-Z]{2}|[A-Z]{1,2}\d{1,2}[A-Z]? \d[A-Z]{2}|[A-Z]{2} \d{5}|\d{5})"
_GAP = r"(?:,[ ]?\r?\n?|[ ]?\r?\n|[ ])"
ADDRESS = re.compile(
    r"(?<![\w\-])(?:"
    rf"(?:Flat \d+[A-Za-z]?,{_GAP})?\d{{1,4}}[A-Za-z]? (?:{_CAP} ){{1,3}}(?:St|Street|Road|Rd|Lane|Ln|Ave|Avenue|Court|Row|Way|Close|Drive)\b\.?(?:,{_GAP[:0]}[ ](?:Apt|Unit|Suite|Flat)\.? \w+)?{_GAP}{_TOWN}{_GAP}{_POST}|"
    rf"(?:PO Box|P\.O\. Box|Postfach|Apartado) \d+{_GAP}(?:{_TOWN}{_GAP}{_POST}|{_POST}{_GAP}{_TOWN})|"
    rf"(?:{_CAP} )?{_CAP}(?:straße|strasse|weg|gasse|allee|platz) \d{{1,4}}(?: ?[a-z]\b)?{_GAP}{_POST}{_GAP}{_TOWN}|"
    rf"\d{{1,4}}(?: (?:bis|ter))?,? (?:rue|avenue|boulevard|quai|chemin|place) (?:[\w'’\-]+ ?){{1,5}}{_GAP}{_POST}{_GAP}{_TOWN}|"
    rf"(?:Calle|Avenida|Plaza|Paseo|Camino|Rua|Travessa) (?:[\w'’\-]+ ){{1,5}}\d{{1,4}}(?:,{_GAP[:0]}[ ]\d{{1,2}}[ºª] ?\w?)?{_GAP}{_POST}{_GAP}{_TOWN}"
    r")(?![\w'’])"
)

_LETTERS = r"[^\W\d_](?:[\w'’\-]*\w)?"
_PARTICLE = r"(?:van|von|de la|de|del|da|di|le|Mac|Mc|van der|VAN|VON|DE LA|DE|MAC)"
_FAMILY = rf"(?:{_PARTICLE} )?{_LETTERS}"
NAME = re.compile(rf"(?:{_FAMILY}, {_LETTERS}(?: [^\W\d_]\.)?|(?:[^\W\d_]\.|{_LETTERS})(?: [^\W\d_]\.)* {_FAMILY})(?![\w'’])")



#: Words before a name that are no part of it.
BEFORE_NAME = re.compile(
    r"(?:(?:Professor|Prof|Doctor|Dr|Mr|Mrs|Ms|Miss|Sir|Herr|Herrn|Frau|Madame|Monsieur|Señora?|Sra?|Signora?|Signed|Both|Dear|Hi|Hello|Thanks|Regards)\b\.?,?\s+)+"
)


def plausible_name(s: str) -> bool:
    """Every word in capitals or capitalised, or every word in lower case; particles apart; no single letters but initials."""
    w = [x for x in re.findall(r"[^\W\d_][\w'’\-]*\.?", s) if x.lower() not in ("van", "von", "de", "la", "del", "da", "di", "le", "der")]
    if any(len(x) == 1 for x in w):
        return False
    long = [x for x in w if not x.endswith(".")]
    if not long:
        return False
    return all(x[0].isupper() for x in long) or all(x.islower() for x in long)


def possible(text: str, s: int, e: int, kind: int) -> tuple[int, int] | None:
    """The ends of a tagged span without a known form: widened to whole words and trimmed of blanks and punctuation; None if it cannot
    be of its kind. This is a veto over what the tagger found; it finds nothing by itself."""
    while s > 0 and text[s - 1].isalnum() and text[s].isalnum():
        s -= 1
    while e < len(text) and text[e].isalnum() and text[e - 1].isalnum():
        e += 1
    while s < e and text[s] in " \t\r\n,;:.!?\"'<>[]{}|-–=/":
        s += 1
    while s < e and text[e - 1] in " \t\r\n,;:.!?\"'<>[]{}|-–=/(":
        e -= 1
    v = text[s:e]
    digits = sum(c.isdigit() for c in v)
    letters = sum(c.isalpha() for c in v)
    if kind == 0:
        ok = re.search(r"@|\bat\b|\(at\)|\[at\]", v) is not None and re.search(r"\.\w|\bdot\b", v) is not None
    elif kind == 1:
        ok = 7 <= digits <= 18 and re.fullmatch(r"\+?[\d() .\-/]+(?: ?(?:ext\.?|x|extension) ?\d+)?", v) is not None
        ok = ok and (re.search(r"\d[ \-/)]+\(?\d|\d\.\d+\.\d", v) is not None or v[0] in "+0") and not re.search(r"\d{4}-\d{2}-\d{2}", v)
    elif kind == 2:
        ok = digits >= 5 and 8 <= digits + letters and len(v) <= 40 and letters <= digits + 2 and not re.search(r"[a-z\n]", v)
        ok = ok and (letters > 0 or re.search(r"\d[ .\-]\d", v) is not None)
    elif kind == 3:
        ok = digits >= 1 and letters >= 6 and len(v.split()) >= 3
    else:
        ok = False  # names have but one form
    return (s, e) if ok and e > s else None


#: Words before a person's name in texts of this kind, and what follows; used to label spans for training.
CUES = [
    (r"Signed off by ", r" on the"), (r"Dear (?:Dr|Mr|Mrs|Ms|Prof)\. ", r",\s|,$"), (r"reviewer: ", r"\s|$"), (r"According to M(?:s|r) ", r" the listing"),
    (r"Spoke to ", r", who"), (r"My name is ", r" and I hold"), (r"real name seems to be ", r"\.(?:\s|$)"), (r"Sehr geehrte Frau ", r",\s|,$"),
    (r"Sehr geehrter Herr ", r",\s|,$"), (r"Freigabe durch ", r"\.(?:\s|$)"), (r"Prüfer: ", r"\s|$"), (r"Cordialement,\r?\n", r"\s|$"),
    (r"Validé par ", r"\.(?:\s|$)"), (r"Atentamente,\r?\n", r"\s|$"), (r"Revisado por ", r"\.(?:\s|$)"), (r"-- \r?\n", r"\r?\n"),
    (r"Mit freundlichen Grüßen,?\r?\n", r"\s|$"), (r"Estimad[oa] Sr[a]?\. ", r",\s|,$"), (r"Chère Madame ", r",\s|,$"), (r"Madame ", r",\s|,$"),
]
_CUED = [(re.compile(a + rf"({NAME.pattern})(?={b})")) for a, b in CUES]
_ID_CUE = re.compile(r"(?:passport|tax id|national ID|SSN|insurance|Ausweis|Steuer-ID|identidad|identité|DNI|NIR|sécurité|reisepass|número)[^\n\d]{0,30}$", re.I)


def labelled_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) by form and context."""
    out: list[tuple[int, int, int]] = []
    for kind, form in enumerate((EMAIL, None, ID_NUMBER, ADDRESS)):
        for m in form.finditer(text) if form else ():
            out.append((m.start(), m.end(), kind))
    for m in PHONE.finditer(text):
        s = m.group()
        if re.fullmatch(r"\d{3}-\d{4}", s):
            continue
        if not _ID_CUE.search(text[max(0, m.start() - 40) : m.start()]):
            out.append((m.start(), m.end(), 1))
    for form in _CUED:
        for m in form.finditer(text):
            out.append((m.start(1), m.end(1), 4))
    out.sort(key=lambda x: (x[0], -x[1]))
    kept: list[tuple[int, int, int]] = []
    for s in out:
        if not kept or s[0] >= kept[-1][1]:
            kept.append(s)
    return kept
