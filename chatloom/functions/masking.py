"""Ordered masking of links, addresses, payment ids, credentials, cards, codes and phone numbers, inside the JVM.

What is looked for is put together from tables of public formats: characters of links (RFC 3986), dotted local parts
and domain labels (RFC 5321, RFC 1035), published shapes of keys and tokens, groups of digits of cards and mobile
numbers, international numbers of ten to fifteen digits (E.164). A category sees what the ones before it have left.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------------------------------------
#: The mark of each category, in the order in which they are looked for.
MARKS = {"url": "[URL]", "email": "[EMAIL]", "upi_id": "[UPI_ID]", "credential": "[CREDENTIAL]", "financial_id": "[FINANCIAL_ID]", "otp": "[OTP]", "phone_number": "[PHONE_NUMBER]"}
#: Last parts of domains by which a link without a scheme is known.
DOMAINS = "com org net edu gov io ai me app co in dev ly be gl is".split()
#: Banks and apps after the sign of a payment id.
PAYMENT_APPS = "okaxis okhdfcbank okicici oksbi paytm ybl axl ibl apl upi postbank federal icici hdfcbank sbi kotak".split()
#: Keys: how they begin, the characters that follow, the least and the most of these.
KEYS = [
    ("sk-", "a-zA-Z0-9", 20, None), ("AIza", "a-zA-Z0-9_-", 30, 45),
    *((f"gh{x}_", "a-zA-Z0-9", 36, 36) for x in "oprsu"), *((f"xox{x}-", "a-zA-Z0-9", 10, 48) for x in "abprs"),
]
#: Words before a secret, words and phrases before a code, and what may stand between.
SECRET_WORDS = ["password", "passwd", "pwd", "passcode"]
CODE_WORDS = ["otp", "one time password", "one-time password", "verification code", "auth code", "security code", "passcode"]
CODE_VERBS, CODE_NOUNS = ["use", "enter", "your"], ["code", "otp", "pin"]
LINKS = ["is", ":", "=", "-"]
#: Sizes of the groups in which cards and mobile numbers are written, and the first digits of the latter.
CARD_GROUPS, MOBILE_GROUPS, MOBILE_FIRST = (4, 4, 4, 4), ((5, 5), (3, 3, 4)), "6-9"
#: Digits of an international number.
LEAST_DIGITS, MOST_DIGITS = 10, 15
# -------------------------------------------------------------------------------------------------------------------

_UNSAFE = r"\s<>\"'{}|\\^`"  # characters that a link cannot hold
_TRAILING = r".,!?:;)\]"  # characters that belong to the sentence when they end a link


class Step(NamedTuple):
    category: str
    pattern: str
    keeps: bool = False  # whether the first group stays


def _one_of(words: list[str]) -> str:
    """Any of the words; a blank stands for any white space."""
    return "(?:" + "|".join(re.escape(w).replace(r"\ ", r"\s*") for w in words) + ")"


def _link(start: str) -> str:
    return rf"(?i){start}[^{_UNSAFE}]*[^{_UNSAFE}{_TRAILING}]"


def _groups(sizes: tuple[int, ...], between: str, first: str = "0-9") -> str:
    """Groups of digits with at most one character between two of them."""
    parts = [rf"\d{{{n}}}" for n in sizes]
    parts[0] = f"[{first}]" + (rf"\d{{{sizes[0] - 1}}}" if sizes[0] > 1 else "")
    return f"{between}?".join(parts)


def _key(start: str, letters: str, least: int, most: int | None) -> str:
    return rf"\b{re.escape(start)}[{letters}]{{{least},{most or ''}}}\b"


def steps() -> list[Step]:
    """All that is looked for, in order."""
    label, coded = r"(?:[a-z0-9-]+\.)+", r"eyJ[a-zA-Z0-9_-]{10,}"  # a token's first two parts are encoded objects
    links, blank = _one_of(LINKS), r"[\s-]"
    return [
        Step("url", _link(r"(?:(?:https?|ftp)://|www\.)")),
        Step("url", _link(label + _one_of(DOMAINS) + "/")),
        Step("email", r"(?i)\b[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}\b"),
        Step("upi_id", rf"(?i)upi://pay\?[^{_UNSAFE}]+"),
        Step("upi_id", rf"(?i)\b[a-z0-9._-]{{2,}}@{_one_of(PAYMENT_APPS)}\b"),
        *(Step("credential", _key(*k)) for k in KEYS),
        Step("credential", rf"\b{coded}\.{coded}\.[a-zA-Z0-9_-]{{10,}}\b"),
        Step("credential", rf"(?i)(\b{_one_of(SECRET_WORDS)}\s*{links}\s*)[^\s,.]+", True),
        Step("credential", rf"({re.escape(MARKS['email'])}\s*\n\s*)[A-Za-z0-9!@#$%^&*()_+=-]{{6,}}\b", True),
        Step("financial_id", rf"\b{_groups(CARD_GROUPS, '[ -]')}\b"),
        Step("otp", rf"(?i)(\b{_one_of(CODE_WORDS)}\s*{links}?\s*)\d{{4,8}}\b", True),
        Step("otp", rf"(?i)(\b{_one_of(CODE_VERBS)}\s+{_one_of(CODE_NOUNS)}\s*[:=-]?\s*(?:is\s+)?)\d{{4,8}}\b", True),
        Step("phone_number", rf"\+\d(?:[\s()-]{{0,2}}\d){{{LEAST_DIGITS - 1},{MOST_DIGITS - 1}}}\b"),
        *(Step("phone_number", rf"(?:\+91{blank}?)?(?:\b0)?{_groups(g, blank, MOBILE_FIRST)}\b") for g in MOBILE_GROUPS),
    ]


STEPS = steps()


def mask(text: Column) -> Column:
    """text with every step applied; null stays null."""
    for s in STEPS:
        text = F.regexp_replace(text, s.pattern, ("$1" if s.keeps else "") + MARKS[s.category])
    return text


def categories(masked: Column, text: Column) -> Column:
    """Sorted categories of what was masked: marks that the masked text has more of than the text."""
    count = lambda c, mark: F.size(F.split(c, rf"\[{mark[1:-1]}\]"))
    more = [F.when(count(masked, m) > count(text, m), F.lit(c)) for c, m in sorted(MARKS.items())]
    return F.array_sort(F.array_compact(F.array(*more)))


def sanitized(messages: DataFrame, text: str = "text") -> DataFrame:
    """messages with text masked, original_text_masked and pii_detected; senders are never touched."""
    m = messages.withColumn("__m", mask(F.col(text)))
    m = m.withColumn("original_text_masked", F.coalesce(F.col("__m") != F.col(text), F.lit(False))).withColumn("pii_detected", F.coalesce(categories(F.col("__m"), F.col(text)), F.array().cast("array<string>")))
    return m.withColumn(text, F.col("__m")).drop("__m")


#: What must not occur in anything that is given away.
BLOCKED = {s.category: s.pattern for s in STEPS if s.category in ("email", "financial_id")} | {"mobile_number": rf"\b{_groups((10,), '', MOBILE_FIRST)}\b"}


def audit(artifacts: DataFrame, name: str, content: str, blocked: dict[str, str] | None = None) -> DataFrame:
    """name, expression, hits: how often each blocked expression occurs in each artifact; null content has none."""
    found = [F.struct(F.lit(k).alias("expression"), F.coalesce(F.regexp_count(F.col(content), F.lit(b)), F.lit(0)).cast("long").alias("hits")) for k, b in sorted((blocked or BLOCKED).items())]
    return artifacts.select(name, F.explode(F.array(*found)).alias("a")).select(name, "a.expression", "a.hits")
