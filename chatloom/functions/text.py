"""Text views, tokens and marks of style as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters dropped on cleaning, boilerplate, and the token pattern.
ZERO_WIDTH = "​‌‍﻿‎‏"
FORWARDED = r"(?i)^\[forwarded\]\s*"
PLACEHOLDER = r"(?i)<[^>]+omitted>"
EMOJI = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}]"
TOKEN = r"\[[A-Za-z0-9_]+\]|[\p{L}\p{N}_]+(?:['-][\p{L}\p{N}_]+)*|[!?.]{2,}|[!?,.:;()\"']|[^\p{L}\p{N}_\s]"
WORD = r"[\p{L}\p{M}\p{N}_']+"


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def nfc(c: Column) -> Column:
    """Canonical composition; text in ASCII never leaves the JVM's fast path of the UDF's null branch."""
    compose = F.pandas_udf(lambda s: s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t)), "string")
    return F.when(c.rlike(r"^\p{ASCII}*$"), c).otherwise(compose(F.when(~c.rlike(r"^\p{ASCII}*$"), c)))


def normalize(c: Column) -> Column:
    """No invisible characters, plain blanks and line ends, one blank in a row, two line ends at most, lines trimmed."""
    c = F.regexp_replace(c, f"[{ZERO_WIDTH}]", "")
    c = F.regexp_replace(F.regexp_replace(c, " ", " "), r"\r\n?", "\n")
    c = F.regexp_replace(F.regexp_replace(c, r"[ \t\f\x0B]+", " "), r" *\n *", "\n")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def analysis(c: Column) -> Column:
    """A normalized text for analysis: boilerplate removed, emoji and clusters set apart, lengthened letters cut to two."""
    c = F.regexp_replace(F.regexp_replace(c, FORWARDED, ""), PLACEHOLDER, "")
    c = F.regexp_replace(F.regexp_replace(c, f"({EMOJI})", " $1 "), r"([!?.]{2,})", " $1 ")
    return strip(F.regexp_replace(F.regexp_replace(c, r"([a-zA-Z])\1{2,}", "$1$1"), r"\s+", " "))


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0))


def words(c: Column) -> Column:
    """Lower-case words with digits and apostrophes."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def split_words(c: Column) -> Column:
    """Pieces between white space."""
    return F.filter(F.split(c, r"\s+"), lambda x: x != "")


def word_count(c: Column) -> Column:
    return F.size(split_words(F.coalesce(c, F.lit(""))))


def emojis(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(EMOJI), F.lit(0))


def elongated(toks: Column) -> Column:
    """Structs word, base, char, count of tokens with a letter three times or more."""
    hit = F.filter(toks, lambda t: t.rlike(r"([a-zA-Z])\1{2,}"))
    run = lambda t: F.regexp_extract(t, r"(([a-zA-Z])\2{2,})", 1)
    return F.transform(hit, lambda t: F.struct(t.alias("word"), F.regexp_replace(t, r"([a-zA-Z])\1{2,}", "$1").alias("base"), F.left(run(t), F.lit(1)).alias("char"), F.length(run(t)).alias("count")))


def shouted(toks: Column) -> Column:
    """Tokens of two or more capitals."""
    return F.filter(toks, lambda t: t.rlike(r"^[A-Z]{2,}$"))


def clusters(toks: Column) -> Column:
    return F.filter(toks, lambda t: t.rlike(r"^[!?.]{2,}$"))


def views(text: Column) -> Column:
    """raw_text, normalized_text, analysis_text and tokenized_text with counts and marks of style."""
    n = normalize(text)
    t = tokens(n)
    marks = F.struct(emojis(n).alias("emojis"), elongated(t).alias("elongated_words"), shouted(t).alias("all_caps_words"), clusters(t).alias("punctuation_clusters"))
    return F.struct(text.alias("raw_text"), n.alias("normalized_text"), analysis(n).alias("analysis_text"), F.struct(t.alias("tokens"), F.size(t).alias("token_count"), F.length(n).alias("character_count"), marks.alias("style_markers")).alias("tokenized_text"))


def any_of(toks: Column, terms: list[str]) -> Column:
    """Whether any token is one of the terms."""
    return F.arrays_overlap(toks, F.array(*[F.lit(t) for t in sorted(terms)]))


def hits(toks: Column, terms: list[str]) -> Column:
    """Tokens that are one of the terms."""
    known = sorted(terms)
    return F.filter(toks, lambda t: t.isin(known))
