"""Personal information in free text, found under disguises and replaced by typed placeholders.

Three transducers normalise the text one after the other, each with a map back to source positions: look-alike
characters to their one form, spelled digits to digits, written-out signs of mail addresses to the signs.
Identifiers are found in the normalised text, names by one automaton over all known names, and their spans are
mapped back and cut out of the source.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.textform import with_offsets

TYPES = ("EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "NAME")

# Spelled digits, in English and Hindi.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "shunya": "0", "ek": "1", "do": "2", "teen": "3", "chaar": "4", "paanch": "5", "chhah": "6", "saat": "7", "aath": "8", "nau": "9",
}
# Words that end the name of a street, titles before a name.
STREETS = "road rd street st avenue ave lane ln drive boulevard blvd close court ct crescent terrace square sq place pl marg nagar path gali row walk way parkway".split()
TITLES = "mr mrs ms miss dr prof shri smt herr frau senor senora".split()
MEDIA = re.compile(r"<[^<>\n]{1,40} omitted>")

_D = "|".join(DIGIT_WORDS)
_SPELLED = re.compile(rf"\b(?:(?:double|triple)\s+)?(?:{_D})\b(?:[\s,-]+(?:(?:double|triple)\s+)?(?:{_D})\b){{5,}}", re.I)
_SPELLED_ONE = re.compile(rf"(?:(double|triple)\s+)?({_D})\b", re.I)

# A sign of a mail address: written out in brackets or as a word, or the sign itself.
_SIGN = re.compile(r"\s*\[(at|dot)\]\s*|\s*\((at|dot)\)\s*|\s+(at|dot)\s+|\s*(@)\s*|(\.)", re.I)
_PART, _HOST, _TOP = re.compile(r"[\w+-]+"), re.compile(r"[a-z0-9-]+", re.I), re.compile(r"[a-z]{2,}(?![\w-])", re.I)
_LAST_PART = re.compile(r"[\w+-]+$")
EMAIL = re.compile(r"(?<![\w.+-])[\w+-]+(?:\.[\w+-]+)*@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}(?![\w-])", re.I)
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")

ID_NUMBER = re.compile(
    r"(?<![\w.,/-])(?:\d{3}-\d{2}-\d{4}|\d{4}([ -])\d{4}\1\d{4}|\d{12}|[a-z]{5}\d{4}[a-z]|[a-z]\d{7})(?![\w/-]|[.,]\d)", re.I
)
PHONE = re.compile(
    r"(?<![\w.,/+(-])(?:"
    r"(?:\+|00)\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,5}(?:[ .-]?\d{2,8}){1,4}"
    r"|\(\d{3}\)\s?\d{3}[ .-]?\d{4}"
    r"|\d{3}[.-]\d{3}[.-]\d{4}"
    r"|0?[6-9]\d{4}[ -]?\d{5}"
    r"|0\d{4}[ -]\d{6}|0\d{2,3}[ -]\d{3,4}[ -]\d{4}"
    r")(?![\w/-]|[.,]\d)"
)

_ST = "|".join(STREETS)
_NO = r"\d{1,4}[a-z]?"
_CITY = r"(?:,\s*(?-i:[A-Z][\w'-]+(?: [A-Z][\w'-]+)?)(?: \d{5,6})?)?"
_LOW_CITY = r",\s*[\w'-]+(?: nagar| city| town| pur)?(?: \d{5,6})?"
_STREET = rf"(?:[a-z][\w'.-]*\s+){{1,3}}(?:{_ST})\b\.?"
ADDRESS = re.compile(
    r"(?<![\w/-])(?:"
    rf"(?:flat|apt|apartment|unit|suite)\.?\s*(?:no\.?\s*)?\d+[a-z]?,\s*{_NO},?\s+{_STREET}{_CITY}"
    rf"|(?:h\.?\s?no\.?|house no\.?)\s*\d+[\w/-]*,\s*{_STREET}{_CITY}"
    rf"|plot no\.?\s*\d+\w?,\s*sector \d+\w?{_LOW_CITY}"
    rf"|{_NO},\s*{_STREET}{_LOW_CITY}"
    rf"|{_NO}\s+{_STREET}{_CITY}"
    r"|(?:calle|avenida|plaza|paseo|rue|via|camino)\s+(?:[a-zà-ÿ][\w'-]*\s+){1,4}\d{1,4}(?:,\s*\d{1,2}\s?[º°o]\s*[a-z]\b)?"
    r"|(?:(?:[a-zà-ÿ]+-)+|(?:[a-zà-ÿ]+-)*[a-zà-ÿ]{3,})(?:stra(?:ß|ss)e|str\.?|weg|gasse|allee|platz|ring|damm)\s+\d{1,4}[a-z]?(?![\w.])"
    r")",
    re.I,
)

_ANY = re.compile(r"[\d@]")


class Names:
    """Given and family names and the speakers they came from, in one automaton."""

    def __init__(self, given: set[str], family: set[str], speakers: set[str]):
        self.given, self.family, self.speakers = given, family, speakers
        self.titled = re.compile(rf"(?<![\w@.+-])(?i:{'|'.join(TITLES)})\.?\s+[A-Z][a-z]+(?:-[A-Z][a-z]+)?(?![\w@-])")
        # the same automaton tells whether a text is worth a closer look, and for what
        kinds: dict[str, set[str]] = {}
        for kind, words in (("digit", DIGIT_WORDS), ("title", TITLES), ("dot", ["dot"]), ("given", given), ("family", family)):
            for w in words:
                if w:
                    kinds.setdefault(w, set()).add(kind)
        self.quick = ahocorasick.Automaton()
        for w, k in kinds.items():
            self.quick.add_word(w, (len(w), frozenset(k)))
        self.quick.make_automaton()

    def hints(self, low: str) -> set[str]:
        """Kinds of words met: name, title and dot once, digit only when six or more are there."""
        out, digits = set(), 0
        for _, (_, kinds) in self.quick.iter(low):
            digits += "digit" in kinds
            out |= kinds
        out -= {"digit"}
        if digits >= 6:
            out.add("digit")
        return out

    def spans(self, form: str) -> list[tuple[int, int]]:
        """Places of names, from left to right: title and family name, initial and family name, given name alone or with a family name."""
        low = _lower(form)
        at: dict[int, list[tuple[int, frozenset[str]]]] = {}  # whole words by start, the longest first
        for last, (n, kinds) in self.quick.iter(low):
            a, b = last - n + 1, last + 1
            if not _inner(low, a - 1) and not _inner(low, b) and kinds & {"given", "family", "title"}:
                at.setdefault(a, []).append((b, kinds))
        words = {a: sorted(v, key=lambda x: -x[0]) for a, v in at.items()}
        found: list[tuple[int, int]] = []
        starts = set(words) | {k for a in words for k in (a - 2, a - 3) if k >= 0 and _INITIAL.fullmatch(low[k:a])}
        for a in sorted(starts):
            if (found and a < found[-1][1]) or (a and (_inner(low, a - 1) or low[a - 1] in "@.+-")):
                continue
            end = next((e for e in self._ends(low, words, a) if not (_inner(low, e) or low[e : e + 1] == "@" or (low[e : e + 1] in ("+", "-") and _inner(low, e + 1)))), None)
            if end:
                found.append((a, end))
        return found

    def _ends(self, low: str, words: dict[int, list[tuple[int, frozenset[str]]]], a: int) -> Iterator[int]:
        """Where a name that starts at a place may end, in order of preference."""
        here = words.get(a, [])
        for b, kinds in here:
            if "title" in kinds:
                m = _AFTER_TITLE.match(low, b)
                if m:
                    for e, k in words.get(m.end(), []):
                        if "given" in k and (g := _GAP.match(low, e)):
                            yield from (x for x, y in words.get(g.end(), []) if "family" in y)
                    yield from (e for e, k in words.get(m.end(), []) if "family" in k)
        m = _INITIAL.match(low, a)
        if m:
            yield from (e for e, k in words.get(m.end(), []) if "family" in k)
        for b, kinds in here:
            if "given" in kinds:
                g = _GAP.match(low, b)
                if g:
                    yield from (e for e, k in words.get(g.end(), []) if "family" in k)
                yield b


_GAP, _AFTER_TITLE, _INITIAL = re.compile(r"\s+"), re.compile(r"\.?\s+"), re.compile(r"[a-z]\.\s?")


def _inner(t: str, k: int) -> bool:
    """Whether a word goes on at a place."""
    return 0 <= k < len(t) and (t[k].isalnum() or t[k] == "_")


def _lower(t: str) -> str:
    """Lower case, character by character, so that places stay."""
    low = t.lower()
    return low if len(low) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t)


def _name_words(s: str, owner: str) -> tuple[str, list[str]]:
    """(given name or nothing, family names) of a speaker: the first word, and capitalised ones after it."""
    w = s.split()
    if not w or s == owner or not w[0].replace("-", "").isalpha() or not w[0][0].isupper():
        return "", []
    return w[0].lower(), [x.lower() for x in w[1:] if x.replace("-", "").isalpha() and x[0].isupper() and not x.isupper()]


def learn_names(speakers: list[str], owner: str = "You") -> Names:
    """Names from speaker columns: the first word of a speaker, and a capitalised second one as family name."""
    given, family = set(), set()
    for s in speakers:
        g, f = _name_words(s, owner)
        given |= {g} - {""}
        family.update(f)
    return Names(given, family - given, set(speakers) | {owner})


def names_of(columns: list[tuple[DataFrame, str]], owner: str = "You") -> Names:
    """Names from all speakers of (table, column) pairs, however few their rows.

    Speakers are reduced to distinct name words before they travel; whole ones only where no given name stands at
    their start, since a speaker label is known by its given name otherwise.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = set()
            for s in pdf["s"]:
                g, f = _name_words(s, owner)
                out |= {("given", g)} if g else set()
                out |= {("family", x) for x in f}
                if not g or s.split(" ")[0].lower() != g:
                    out.add(("speaker", s))
            yield pd.DataFrame(sorted(out), columns=["kind", "word"])

    found: dict[str, set[str]] = {"given": set(), "family": set(), "speaker": {owner}}
    speakers = reduce(DataFrame.unionByName, (df.select(F.col(c).cast("string").alias("s")) for df, c in columns)).where(F.col("s").isNotNull()).distinct()
    for r in speakers.mapInPandas(run, "kind string, word string").distinct().toLocalIterator():
        found[r["kind"]].add(r["word"])
    return Names(found["given"], found["family"] - found["given"], found["speaker"])


@functools.lru_cache(maxsize=4096)
def _digits(words: str) -> str:
    return "".join(DIGIT_WORDS[m[2].lower()] * {"double": 2, "triple": 3}.get((m[1] or "").lower(), 1) for m in _SPELLED_ONE.finditer(words))


def _spoken(words: str) -> tuple[int, str]:
    """(where the number starts, its digits): a leading word that does not belong to a number of known form is left out."""
    starts = [m.start() for m in _SPELLED_ONE.finditer(words)]
    for a in starts[:3]:
        d = _digits(words[a:])
        if PHONE.fullmatch(d) or ID_NUMBER.fullmatch(d):
            return a, d
    return 0, _digits(words)


Form = tuple[str, list[int] | None]


def _rewritten(form: Form, edits: list[tuple[int, int, str]]) -> Form:
    """A form with places replaced; what comes in for a place starts at its start in the source."""
    text, at = form
    if not edits:
        return form
    src = at or range(len(text) + 1)
    out, pos, last = [], [], 0
    for a, b, to in edits:
        out += (text[last:a], to)
        pos.extend(src[last:a])
        pos.extend([src[a]] * len(to))
        last = b
    out.append(text[last:])
    pos.extend(src[last : len(text) + 1])
    return "".join(out), pos


def same_letters(form: Form) -> Form:
    """Look-alike characters to their one form."""
    text, _ = form
    if text.isascii():
        return form
    new, where = with_offsets(text)
    return (new, where) if new != text else form


def digits_for_words(form: Form) -> Form:
    """Six or more spelled digits in a row to digits."""
    edits = []
    for m in _SPELLED.finditer(form[0]):
        skip, d = _spoken(m[0])
        edits.append((m.start() + skip, m.end(), d))
    return _rewritten(form, edits)


def signs_for_words(form: Form) -> Form:
    """Written-out signs of mail addresses to the signs: parts, a sign for at, hosts and signs for dots, up to a last part of letters.

    A chain counts if its at is a sign or in brackets, or one of its dots is written out.
    """
    text = form[0]
    signs = [(m.start(), m.end(), "@" if (w := next(g for g in m.groups() if g).lower()) in ("at", "@") else ".", m[3] is None or w == "dot", m[5] is None) for m in _SIGN.finditer(text)]
    joined = [i > 0 and _PART.fullmatch(text, signs[i - 1][1], signs[i][0]) is not None for i in range(len(signs))]
    edits = []
    for k, (start, end, sign, _, _) in enumerate(signs):
        if sign != "@" or not _LAST_PART.search(text, max(0, start - 64), start):
            continue
        first, last = k, k
        while joined[first] and signs[first - 1][2] == ".":
            first -= 1
        if first < k and not _LAST_PART.search(text, max(0, signs[first][0] - 64), signs[first][0]):
            first += 1
        while last + 1 < len(signs) and signs[last + 1][2] == "." and _HOST.fullmatch(text, signs[last][1], signs[last + 1][0]):
            last += 1
        while last > k and not _TOP.match(text, signs[last][1]):
            last -= 1
        chain = signs[first : last + 1]
        if last > k and any(sure and (c == "@" or written) for _, _, c, sure, written in chain):
            edits += [(a, b, c) for a, b, c, _, _ in chain if not edits or a >= edits[-1][1]]
    return _rewritten(form, [e for e in edits if text[e[0] : e[1]] != e[2]])


def detect(text: str | None, names: Names, labels: bool = False) -> list[tuple[int, int, str]]:
    """(start, end, type) of each occurrence in the source text, in order and without overlap.

    Lines without any hint of an identifier are passed over; lines with one are looked at together with the lines
    beside them. With labels, the speaker before a turn is no occurrence.
    """
    if not text:
        return []
    if "\n" not in text:
        body = _label(text, names) if labels else 0
        return _in_span(text, body, len(text), [], names)
    found, hot, spans, pos = [], [], [], 0
    for line in text.split("\n"):
        body = _label(line, names) if labels else 0
        spans.append((pos, pos + body, pos + len(line)))
        hot.append(bool(_hints(line[body:], names)))
        pos += len(line) + 1
    k = 0
    while k < len(hot):
        if not hot[k]:
            k += 1
            continue
        end = k
        while end + 1 < len(hot) and hot[end + 1]:
            end += 1
        a, b = max(0, k - 1), min(len(hot) - 1, end + 1)
        if found and spans[a][0] < found[-1][1]:
            a = k
        inner = [(spans[j][0], spans[j][1]) for j in range(a, b + 1) if spans[j][1] > spans[j][0]]
        found += _in_span(text, spans[a][0], spans[b][2], inner, names)
        k = b + 1 if b > end and not hot[b] else end + 1
    return found


def _label(line: str, names: Names) -> int:
    """Length of the speaker label at the start of a line, 0 without one."""
    i = line.find(":")
    if not 0 < i <= 60 or line[i + 1 : i + 2] not in ("", " "):
        return 0
    who = line[:i]
    known = who in names.speakers or who.split(" ")[0].lower() in names.given or re.fullmatch(r"\+[\d -]{8,18}", who)
    return i + 1 if known else 0


def _hints(part: str, names: Names) -> set[str]:
    h = names.hints(part.lower())
    if _ANY.search(part):
        h.add("number")
    if not part.isascii() and (with_offsets(part)[0] != part or re.search(r"[a-zà-ÿ](?:ß|º)", part)):
        h.add("form")
    return h


def _in_span(text: str, start: int, stop: int, skip: list[tuple[int, int]], names: Names) -> list[tuple[int, int, str]]:
    part = text[start:stop]
    hints = _hints(part, names)
    if not hints:
        return []
    # look-alikes and spelled digits may show what the hints of the source do not
    f = same_letters((part, None))
    if "digit" in hints or "form" in hints:
        f = digits_for_words(f)
    if "@" in f[0] or "dot" in hints or ("form" in hints and "dot" in f[0].lower()):
        f = signs_for_words(f)
    form, at = f
    taken: list[tuple[int, int, str]] = []

    def free(a: int, b: int) -> bool:
        return all(b <= x or a >= y for x, y, _ in taken)

    if at is None:
        taken += [(a - start, b - start, "") for a, b in skip]
    elif skip:
        back = {p: i for i, p in reversed(list(enumerate(at)))}
        taken += [(back.get(a - start, 0), back.get(b - start, 0), "") for a, b in skip]
    if "omitted>" in form:
        taken += [(*m.span(), "") for m in MEDIA.finditer(form)]
    if "@" in form:
        for m in EMAIL.finditer(form):
            if free(*m.span()):
                taken.append((*m.span(), "EMAIL"))
    if "number" in hints or at is not None:
        for m in IBAN.finditer(form):
            if _checked(m[0]) and free(*m.span()):
                taken.append((*m.span(), "ID_NUMBER"))
        for kind, rx in (("ADDRESS", ADDRESS), ("ID_NUMBER", ID_NUMBER), ("PHONE", PHONE)):
            for m in rx.finditer(form):
                k = kind
                if kind == "PHONE" and not 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    continue
                if kind == "ID_NUMBER" and re.fullmatch(r"91[6-9]\d{9}", m[0]):
                    k = "PHONE"
                if free(*m.span()):
                    taken.append((*m.span(), k))
    if hints & {"given", "family", "title", "form"}:
        taken += [(*x, "NAME") for x in names.spans(form) if free(*x)]
    if "title" in hints or "form" in hints:
        for m in names.titled.finditer(form):
            if free(*m.span()):
                taken.append((*m.span(), "NAME"))
    found = sorted(t for t in taken if t[2])
    if at is None:
        return [(a + start, b + start, k) for a, b, k in found]
    return [(at[a] + start, _end(at, b) + start, k) for a, b, k in found]


def _checked(iban: str) -> bool:
    """Whether the check digits of an account number hold (ISO 13616)."""
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _end(at: list[int], b: int) -> int:
    """Source end of a span: where the next character's source starts, or after the last of several sources."""
    return at[b] if b < len(at) else at[-1]


def mask(text: str | None, names: Names, labels: bool = False) -> str | None:
    """text with each occurrence replaced by [TYPE]; null stays null."""
    return _masked(text, names, labels)[0]


def _masked(text: str | None, names: Names, labels: bool) -> tuple[str | None, int]:
    found = detect(text, names, labels)
    if not found:
        return text, 0
    out, last = [], 0
    for a, b, k in found:
        out += [text[last:a], f"[{k}]"]
        last = b
    return "".join(out) + text[last:], len(found)


def occurrences(rows: DataFrame, record_id: str, texts: dict[str, tuple[str, bool]], names: Names) -> DataFrame:
    """record_id, field_name, pii_type, ordinal: one row per occurrence, each once.

    texts maps a column to its field name and whether its turns begin with speaker labels. Null ids and texts
    give no rows.
    """
    sent = rows.sparkSession.sparkContext.broadcast((names.given, names.family, names.speakers))
    columns = list(texts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = Names(*sent.value)
        for pdf in batches:
            out = []
            ids = pdf.iloc[:, 0].tolist()
            for j, c in enumerate(columns, 1):
                field, labels = texts[c]
                for i, t in zip(ids, pdf.iloc[:, j].tolist()):
                    if t:
                        seen: dict[str, int] = {}
                        for _, _, k in detect(t, n, labels):
                            seen[k] = seen.get(k, 0) + 1
                            out.append((i, field, k, seen[k]))
            yield pd.DataFrame(out, columns=["record_id", "field_name", "pii_type", "ordinal"])

    d = rows.where(F.col(record_id).isNotNull()).select(F.col(record_id).cast("string"), *columns)
    return d.mapInPandas(run, "record_id string, field_name string, pii_type string, ordinal int")


def masked(rows: DataFrame, texts: dict[str, tuple[str, bool]], names: Names, suffix: str = "_masked") -> DataFrame:
    """rows with a masked copy of each text column (and a count of its occurrences); columns of these names are replaced."""
    sent = rows.sparkSession.sparkContext.broadcast((names.given, names.family, names.speakers))
    out = rows

    def masker(labels: bool):
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            n = Names(*sent.value)
            for s in batches:
                yield pd.DataFrame([_masked(t, n, labels) for t in s], columns=["text", "n"])

        return F.pandas_udf(run, "text string, n int").asNondeterministic()

    for c, (_, labels) in texts.items():
        r = masker(labels)(F.col(c))
        out = out.withColumn("__m", r).withColumn(c + suffix, F.col("__m.text")).withColumn(c + "_pii_count", F.col("__m.n")).drop("__m")
    return out
