"""One form for text that looks the same: widths, accents, blanks, line ends, invisible marks and look-alikes.

A table of replacements is worked out by rule and from fixed lists, checked for conflicts, and compiled into a
longest-match transducer (an Aho-Corasick automaton over single characters, letters with their accents and line
ends) that walks a text once. Two ways of use: one_form() maps every look-alike, so that equal-looking texts
compare equal whatever they are made of; readable() maps a look-alike only inside a word that is otherwise Latin,
so that text in another script stays in that script.
"""

from __future__ import annotations

import functools
import hashlib
import sys
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.runtime import persisted

# Letters of other scripts whose print shape is that of a Latin letter.
CYRILLIC = dict(zip("аеорсухіѕјһԁԛԝӏАВЕКМНОРСТХІЅЈУѴԌ", "aeopcyxisjhdqwlABEKMHOPCTXISJYVG", strict=True))
GREEK = dict(zip("οΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲ", "oABEZHIKMNOPTYXc", strict=True))
ARMENIAN = dict(zip("օհոսցՕՍՏ", "ohnugOUS", strict=True))
CHEROKEE = dict(zip("ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ", "ABCDEHJKLMPRSTVWZ", strict=True))
LOOK_ALIKES = CYRILLIC | GREEK | ARMENIAN | CHEROKEE
# Joined letters, hyphens that print as the plain one.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
HYPHENS = {"\u2010": "-", "\u2011": "-"}
LINE_ENDS = {"\r\n": "\n", "\r": "\n", "\x85": "\n", "\u2028": "\n", "\u2029": "\n", "\x0b": "\n", "\x0c": "\n"}
JOINER, PICTURE_MARK = "\u200d", "\ufe0f"
#: Blocks of the scripts that look-alikes come from.
SCRIPTS = {"Greek": (0x370, 0x3FF), "Cyrillic": (0x400, 0x52F), "Armenian": (0x530, 0x58F), "Cherokee": (0x13A0, 0x13FF)}

_PICTURE = regex.compile(r"[\p{Extended_Pictographic}\U0001F3FB-\U0001F3FF\uFE0F]")
_ACCENTED = regex.compile(r"\P{M}\p{M}+")


@functools.cache
def mapping() -> dict[str, str]:
    """Replacement of every character or cluster that has one; the joiner and the picture mark depend on what is beside them."""
    out: dict[str, str] = {}

    def put(a: str, b: str) -> None:
        if out.get(a, b) != b:
            raise ValueError(f"conflict for {a!r}: {out[a]!r} and {b!r}")
        out[a] = b

    for cp in range(sys.maxunicode + 1):
        c = chr(cp)
        kind, how = unicodedata.category(c), unicodedata.decomposition(c)
        if how.startswith(("<wide>", "<narrow>")):
            put(c, unicodedata.normalize("NFKC", c))
        elif kind == "Zs" and c != " ":
            put(c, " ")
        elif kind == "Cf" and not 0xE0020 <= cp <= 0xE007F and not 0x600 <= cp <= 0x8E2:
            put(c, "")
        elif how and not how.startswith("<"):
            whole = unicodedata.normalize("NFC", c)
            if whole != c:
                put(c, whole)
            else:
                put(unicodedata.normalize("NFD", c), c)
    put("\t", " ")
    for t in (LOOK_ALIKES, LIGATURES, HYPHENS, LINE_ENDS):
        for a, b in t.items():
            put(a, b)
    del out[JOINER]
    for a, b in out.items():
        if any(x in out and out[x] != x for x in b):
            raise ValueError(f"{a!r} goes to {b!r}, which is itself replaced")
    return out


@functools.cache
def _machine() -> ahocorasick.Automaton:
    """The compiled table; an entry has the length of what it replaces, the replacement, and whether that depends on its surroundings."""
    a = ahocorasick.Automaton()
    for k, v in mapping().items():
        a.add_word(k, (len(k), v, k in LOOK_ALIKES))
    for c in (JOINER, PICTURE_MARK):
        a.add_word(c, (1, c, True))
    a.make_automaton()
    return a


def _script(c: str) -> str | None:
    return next((k for k, (a, b) in SCRIPTS.items() if a <= ord(c) <= b), None)


class _Words:
    """Whether the look-alikes of a word are Latin letters in disguise, for words of one text from left to right."""

    def __init__(self, text: str):
        self.text, self.end, self.says, self.own = text, 0, False, {}

    def latin(self, at: int) -> bool:
        if at < self.end:
            return self.says
        t, a, b = self.text, at, at + 1
        part = lambda c: c.isalpha() or unicodedata.category(c) in ("Mn", "Cf")
        while a and part(t[a - 1]):
            a -= 1
        while b < len(t) and part(t[b]):
            b += 1
        word = t[a:b]
        foreign = {s for c in word if c.isalpha() and c not in LOOK_ALIKES and (s := _script(c))}
        scripts = {_script(c) for c in word if c in LOOK_ALIKES}
        plain = any(c.isalpha() and unicodedata.name(c, "").startswith("LATIN") for c in word)
        self.end = b
        self.says = not foreign and (plain or not any(self._used(s) for s in scripts))
        return self.says

    def _used(self, script: str) -> bool:
        """Whether the text has letters of a script that look like no Latin ones."""
        if script not in self.own:
            a, b = SCRIPTS[script]
            self.own[script] = any(a <= ord(c) <= b and c.isalpha() and c not in LOOK_ALIKES for c in self.text)
        return self.own[script]


def _beside(text: str, at: int) -> str:
    """What becomes of a joiner or picture mark at a place."""
    before, after = text[at - 1 : at], text[at + 1 : at + 2]
    if text[at] == JOINER:
        return JOINER if _PICTURE.match(before) and _PICTURE.match(after) else ""
    return "" if before.isalpha() else PICTURE_MARK


def _steps(text: str, every: bool) -> Iterator[tuple[int, int, str]]:
    """(start, end, replacement) of all that changes in a text, in one walk."""
    words = None
    for last, (n, to, depends) in _machine().iter_long(text):
        start = last - n + 1
        if depends:
            if to in (JOINER, PICTURE_MARK):
                to = _beside(text, start)
                if to:
                    continue
            elif not every:
                words = words or _Words(text)
                if not words.latin(start):
                    continue
        yield start, last + 1, to


def _walked(text: str, every: bool) -> str:
    if text.isascii() and not any(c in text for c in "\r\t\x0b\x0c"):
        return text
    out, last = [], 0
    for a, b, to in _steps(text, every):
        out += (text[last:a], to)
        last = b
    text = "".join(out) + text[last:] if last else text
    # accents that met their letter only when something between them was dropped
    return text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)


def _trimmed(text: str) -> str:
    if " \n" in text:
        text = "\n".join(line.rstrip(" ") for line in text.split("\n"))
    return text.rstrip(" \n")


def one_form(text: str) -> str:
    """text in the form used to compare looks; blanks at the ends of lines and of the text do not print and are dropped."""
    return _trimmed(_walked(text, True))


def readable(text: str) -> str:
    """text in one form that stays readable: look-alikes only change inside words that are otherwise Latin."""
    return _trimmed(_walked(text, False))


def with_offsets(text: str) -> tuple[str, list[int]]:
    """(readable form without trimming, source position of each of its characters and of its end)."""
    out, at, last = [], [], 0
    for a, b, to in _steps(text, False):
        out += (text[last:a], to)
        at.extend(range(last, a))
        at.extend([a] * len(to))
        last = b
    out.append(text[last:])
    at.extend(range(last, len(text) + 1))
    form = "".join(out)
    if unicodedata.is_normalized("NFC", form):
        return form, at
    done, where, last = [], [], 0
    for m in _ACCENTED.finditer(form):
        whole = unicodedata.normalize("NFC", m[0])
        done += (form[last : m.start()], whole)
        where += at[last : m.start()] + [at[m.start()]] * len(whole)
        last = m.end()
    return "".join(done) + form[last:], where + at[last:]


def digest(s: str) -> bytes:
    return hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def text_forms(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, form, raw: digests of the one form and of the text itself. Null, empty and blank texts are left out."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            forms = [None if t is None else one_form(t) for t in s]
            yield pd.DataFrame({"form": [None if not f or not f.strip() else digest(f) for f in forms], "raw": [None if t is None else digest(t) for t in s]})

    d = docs.select(F.col(key).alias("k"), F.pandas_udf(run, "form binary, raw binary").asNondeterministic()(F.col(text)).alias("r"))
    return d.select(F.col("k").alias(key), "r.form", "r.raw").where(F.col("form").isNotNull())


def normalised(docs: DataFrame, text: str = "text", out: str = "text_form") -> DataFrame:
    """docs with a column of texts in their readable form; null stays null, blank texts become empty. A column of that name is replaced."""
    f = F.pandas_udf(lambda s: s.map(lambda t: None if t is None else readable(t)), "string")
    return docs.withColumn(out, f(F.col(text)))


def same_look_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key_a, key_b), key_a < key_b: rows whose texts look the same and are not the same string.

    Exact copies are folded into one variant before variants of one look are paired, so a text copied any number
    of times costs nothing unless it also has a variant.
    """
    f = persisted(text_forms(docs, key, text).distinct(), "forms")  # read several times
    variants = f.select("form", "raw").distinct()
    many = variants.groupBy("form").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("form")
    v = variants.join(many, "form", "left_semi")
    pairs = v.select("form", F.col("raw").alias("raw_a")).join(v.select("form", F.col("raw").alias("raw_b")), "form").where("raw_a < raw_b")
    m = f.join(many, "form", "left_semi")
    j = pairs.join(m.select(F.col("raw").alias("raw_a"), F.col(key).alias("a")), "raw_a").join(m.select(F.col("raw").alias("raw_b"), F.col(key).alias("b")), "raw_b")
    return j.select(F.least("a", "b").alias(f"{key}_a"), F.greatest("a", "b").alias(f"{key}_b")).distinct()


def look_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, class_id (smallest key of the look), class_size, variants: one row per document with text."""
    f = persisted(text_forms(docs, key, text).distinct(), "forms")  # read several times
    c = f.groupBy("form").agg(F.min(key).alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.count_distinct("raw").alias("variants"))
    return f.join(c, "form").select(key, "class_id", "class_size", "variants")
