"""Held-out texts that appear, wholly or in long passages, in a corpus, also when lightly altered.

One Aho-Corasick automaton over the normalised items, whole and in phrases of a few words, scans each normalised
document once. An item found whole is a leak. A band of diagonals of document and item position in which phrases
cover enough words of the item is looked at word by word: chains of hits are grown in both directions over altered,
lost, doubled and added words. Positions are mapped back to the original text.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.runs import osa
from chatloom.llm.textform import SCRIPTS, readable, with_offsets

GRAM = 4  # words in a phrase
LEAST = 36  # successive words of an item that make a leak
BAND = 16  # width of a band of diagonals; bands overlap by half
COVER, SPAN = 14, 20  # item words in phrases found near each other in one band, and words from the first to the last of them, in a leak of the least length
WINDOW, GAP = 40, 20  # item words in which these are counted, and words between two phrases of them
CHUNK = 10_000  # document words looked at together, few enough for the arrays to stay in the cache
ITEM_CHARS = 200_000_000  # the automaton of more text would not fit a worker

_WORD = re.compile(r"[^\W_]+")
# Letters written as others where accents are left out.
_FOLD = {"ß": "ss", "œ": "oe", "æ": "ae", "ø": "o", "ł": "l", "đ": "d", "ı": "i"}
_DISGUISE = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in SCRIPTS.values()) + "]")
_ASCII = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in (ord(chr(k).lower()) if k < 128 else 32 for k in range(256)))


class _Folded(dict):
    """Each character in lower case without accents; blanks for signs, nothing for what does not print. Filled as characters come."""

    def __missing__(self, code: int) -> str:
        c = readable(chr(code) + ".")[:-1].lower()
        c = "".join(_FOLD.get(x, x) for x in c)
        c = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        # a mark by itself belongs to the letter before it
        self[code] = out = "".join(x if x.isalnum() else " " for x in c)
        return out


_FOLDED = _Folded()


def words_of(text: str) -> list[str]:
    """Words in lower case without accents, in one form."""
    if text.isascii():
        return text.encode().translate(_ASCII).decode().split()
    return (readable(text) if _DISGUISE.search(text) else text).translate(_FOLDED).split()


class Items:
    """Normalised words of the items, without their stock sentence, with the place of each word among the printed words.

    A last sentence that ends several items is a stock sentence.
    """

    def __init__(self, rows: list[tuple[int, str]]):
        split = {i: re.split(r"(?<=[.!?])\s+", t.strip()) for i, t in rows if t and t.strip()}
        ends = Counter(" ".join(words_of(s[-1])) for s in split.values() if len(s) > 1)
        self.ids: list = []
        self.words: list[list[str]] = []
        self.place: list[list[int]] = []
        self.printed: list[int] = []
        for i, s in split.items():
            if len(s) > 1 and ends[" ".join(words_of(s[-1]))] > 1:
                s = s[:-1]
            words, place, n = [], [], 0
            for token in " ".join(s).split():
                w = words_of(token)
                words += w
                place += [n] * len(w)
                n += bool(w)
            if words:
                self.ids.append(i)
                self.words.append(words)
                self.place.append(place)
                self.printed.append(n)
        size = np.array([len(w) for w in self.words], "int64")
        self.cover, self.span = (np.clip(size * x // LEAST, 1, x) for x in (COVER, SPAN))

    def automaton(self) -> ahocorasick.Automaton:
        """Entries are numbers: k of a phrase, whose items and places are rows first[k] to first[k + 1], or of a whole item after those."""
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        whole: dict[str, list[int]] = defaultdict(list)
        for i, w in enumerate(self.words):
            n = min(GRAM, len(w))
            for p in range(len(w) - n + 1):
                where[" " + " ".join(w[p : p + n]) + " "].append((i, p))
            whole[" " + " ".join(w) + " "].append(i)
        # an item no longer than a phrase is the whole of it
        self.whole = [whole.pop(g, []) for g in where] + list(whole.values())
        self.length = np.array([len(g) for g in (*where, *whole)], "int64")
        a = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, g in enumerate((*where, *whole)):
            a.add_word(g, k)
        self.sole = np.array([bool(x) for x in self.whole], bool)
        at = np.array([x for v in where.values() for x in v], "int64").reshape(-1, 2)
        self.first = np.concatenate([[0], np.cumsum([len(v) for v in where.values()], dtype="int64")]).astype("int64")
        self.item, self.at = at[:, 0].astype("int32"), at[:, 1].astype("int32")
        if len(a):
            a.make_automaton()
        return a


@functools.lru_cache(maxsize=1 << 16)
def alike(a: str, b: str) -> bool:
    return a == b or (min(len(a), len(b)) >= 2 and max(len(a), len(b)) >= 3 and not (a.isdigit() and b.isdigit()) and osa(a, b, 1) <= 1)


def grow(doc: list[str], item: list[str], d: int, q: int, step: int) -> tuple[int, int, int]:
    """(document words, item words, item words found) passed from (d, q) in one direction, up to the last sure match."""
    x, y, found, miss, nd, nq = d, q, 0, 0, len(doc), len(item)
    best = (0, 0, 0)
    while True:
        run = x
        while 0 <= x < nd and 0 <= y < nq and doc[x] == item[y]:
            x, y = x + step, y + step
        if x != run:
            n = abs(x - run)
            found, miss = found + n, max(0, miss - n)
            best = (abs(x - d), abs(y - q), found)
        if not (0 <= x < nd and 0 <= y < nq):
            return best
        if alike(doc[x], item[y]):
            x, y, found = x + step, y + step, found + 1
            best = (abs(x - d), abs(y - q), found)
            continue
        near = (doc[x : x + 6], item[y : y + 6]) if step > 0 else (doc[max(0, x - 5) : x + 1], item[max(0, y - 5) : y + 1])
        if set(near[0]).isdisjoint(near[1]):
            return best  # no shift can make two words agree
        # resume at the nearest pair of shifts after which two words (or the last one) agree
        for s, t in _SHIFTS:
            u, v = x + step * s, y + step * t
            if 0 <= u < nd and 0 <= v < nq and doc[u] == item[v]:
                u2, v2 = u + step, v + step
                if not (0 <= v2 < nq) or (0 <= u2 < nd and alike(doc[u2], item[v2])):
                    break
        else:
            return best
        miss += max(s, t)
        if miss > 8:
            return best
        x, y = u, v


# Nearest first: a doubled or added word in the document, a lost word, a changed one, longer ones after them.
_SHIFTS = sorted(((s, t) for s in range(6) for t in range(6) if s or t), key=lambda x: (max(x), x[0] + x[1]))


def _counts(keys: np.ndarray) -> np.ndarray:
    """How often each key occurs, or a little more."""
    bits = max(10, int(len(keys)).bit_length() + 1)
    slot = (keys.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    slot = slot.astype("int64")
    return np.bincount(slot, minlength=1 << bits)[slot]


def _promising(doc: np.ndarray, d: np.ndarray, item: np.ndarray, q: np.ndarray, items: Items) -> np.ndarray:
    """Which hits (document, word, item, place) lie in a band of diagonals that has what a leak cannot do without."""
    keep = np.zeros(len(doc), bool)
    doc = doc - doc.min()
    pair = doc.astype("int64") * len(items.words) + item
    # so many hits cover at most GRAM words each; counted by hash, where a clash can only keep more
    many = _counts(pair)
    some = np.flatnonzero(many * GRAM >= items.cover[item])
    if not len(some):
        return keep
    pair, lane, item, q = pair[some], (d - q)[some], item[some], q[some]
    for shift in (0, BAND // 2):
        band = (lane + shift) // BAND
        band -= band.min()
        # the same for a band
        k = pair * (int(band.max()) + 1) + band
        few = np.flatnonzero(_counts(k) * GRAM >= items.cover[item])
        if not len(few):
            continue
        order = few[np.lexsort((q[few], k[few]))]
        k = k[order]
        at = q[order]
        start = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (np.diff(at) > GAP + GRAM)]))
        n = np.diff(np.append(start, len(k)))
        fresh = np.clip(np.diff(at, prepend=0), 0, GRAM)  # words a hit covers that the one before does not
        fresh[start] = GRAM
        i = item[order][start]
        width = at[start + n - 1] - at[start] + GRAM
        # words covered in the last so many of the item
        group = np.repeat(np.arange(len(start)), n)
        place = group * (int(at.max()) + WINDOW + 1) + at
        back = np.maximum(np.searchsorted(place, place - WINDOW), start[group])
        total = np.cumsum(fresh)
        near = np.maximum.reduceat(total - total[back] + GRAM, start)
        ok = (near >= items.cover[i]) & (width >= items.span[i])
        keep[some[order[np.repeat(ok, n)]]] = True
    return keep


def leaks_in(docs: list[list[str]], items: Items, machine: ahocorasick.Automaton) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, item, printed item words covered, first and last document word) of each leak, the longest of each pair."""
    part, size = 0, 0
    for k in range(len(docs) + 1):
        if k == len(docs) or size > CHUNK:
            if k > part:
                yield from _leaks_of(docs, range(part, k), items, machine)
            part, size = k, 0
        if k < len(docs):
            size += len(docs[k])


def _leaks_of(docs: list[list[str]], part: range, items: Items, machine: ahocorasick.Automaton) -> Iterator[tuple[int, int, int, int, int]]:
    sure: dict[tuple[int, int], tuple[int, int, int]] = {}
    # one walk over all documents, kept apart by a word that no item has
    text = [w for k in part for w in (*docs[k], "\n")]
    begin = np.cumsum([0, *(len(docs[k]) + 1 for k in part)])
    starts = np.cumsum(np.fromiter(map(len, ["", *text]), "int64", len(text) + 1) + 1)
    end, p = np.fromiter(chain.from_iterable(machine.iter(" " + " ".join(text) + " ")), "int64").reshape(-1, 2).T
    at = np.searchsorted(starts, end - items.length[p] + 2)
    row = np.searchsorted(begin, at, "right") - 1
    word = at - begin[row]
    for r, d, x in zip(*(v[items.sole[p]].tolist() for v in (row, word, p))):
        for i in items.whole[x]:
            sure.setdefault((part[r], i), (items.printed[i], d, d + len(items.words[i]) - 1))
    phrase = p < len(items.first) - 1
    row, word, p = row[phrase], word[phrase], p[phrase]
    if len(p):
        n = items.first[p + 1] - items.first[p]
        at = np.repeat(items.first[p] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
        hits = np.repeat(row.astype("int32"), n), np.repeat(word.astype("int32"), n), items.item[at], items.at[at]
        good = _promising(*hits, items)
        pairs: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for r, d, i, q in zip(*(x[good].tolist() for x in hits)):
            if (part[r], i) not in sure:
                pairs[part[r], i].append((d, q))
        for (k, i), h in pairs.items():
            best = _longest(docs[k], items, i, sorted(h))
            if best[0] >= min(LEAST, items.printed[i]):
                sure[k, i] = best
    for (k, i), best in sure.items():
        yield (k, i, *best)


def _longest(doc: list[str], items: Items, i: int, hits: list[tuple[int, int]]) -> tuple[int, int, int]:
    """(printed item words covered, first and last document word) of the longest passage grown from hits (word, place)."""
    w, place, best, done = items.words[i], items.place[i], (0, 0, 0), []
    for d, q in hits:
        if any(d0 <= d <= d1 and q0 <= q <= q1 for d0, d1, q0, q1 in done):
            continue
        rd, rq, rf = grow(doc, w, d, q, 1)
        ld, lq, lf = grow(doc, w, d - 1, q - 1, -1)
        q0, q1 = q - lq, q + rq - 1
        done.append((d - ld, d + rd - 1, q0, q1))
        if q1 < q0 or (rf + lf) < 0.7 * (q1 - q0 + 1):
            continue
        covered = place[q1] - place[q0] + 1
        if covered > best[0]:
            best = (covered, d - ld, d + rd - 1)
    return best


@functools.lru_cache(maxsize=2)
def _built(rows: tuple) -> tuple[Items, ahocorasick.Automaton]:
    """Items and their automaton, once per process."""
    items = Items(list(rows))
    return items, items.automaton()


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """key, item key, words, start, end: each document with the items leaked into it, the longest passage of each.

    start and end are positions in the original text. An item without text leaks nowhere, a document without text
    holds nothing; an item shorter than the least length counts when it appears whole. Items are a held-out set, which
    does not grow with the corpus: they travel to the workers, up to ITEM_CHARS characters of them; a larger set is
    refused and has to be given in parts.
    """
    spark = docs.sparkSession
    given = items.select(item_key, item_text).where(F.col(item_text).isNotNull() & F.col(item_key).isNotNull()).distinct()
    size = given.agg(F.sum(F.length(item_text))).first()[0] or 0
    if size > ITEM_CHARS:
        raise ValueError(f"{size} characters of items; give parts of at most {ITEM_CHARS}")
    sent = spark.sparkContext.broadcast(tuple(sorted((r[0], r[1]) for r in given.toLocalIterator())))
    kind, item_kind = dict(docs.dtypes)[key], dict(items.dtypes)[item_key]
    schema = f"`{key}` {kind}, `{item_key}` {item_kind}, words int, start int, end int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        its, machine = _built(sent.value)
        for pdf in batches:
            got = []
            if len(machine):
                keys, texts = pdf.iloc[:, 0].tolist(), pdf.iloc[:, 1].tolist()
                for k, i, n, w0, w1 in leaks_in([words_of(t) for t in texts], its, machine):
                    got.append((keys[k], its.ids[i], n, *original_span(texts[k], w0, w1)))
            yield pd.DataFrame(got, columns=[key, item_key, "words", "start", "end"])

    return docs.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(key, text).mapInPandas(run, schema)


def original_span(text: str, first: int, last: int) -> tuple[int, int]:
    """Place in the original text of the normalised words first to last."""
    form, at = with_offsets(text)
    n, start = 0, 0
    for m in _WORD.finditer(form):
        w = words_of(m[0])
        if not w:
            continue
        if n <= first < n + len(w):
            start = at[m.start()]
        n += len(w)
        if n > last:
            return start, at[m.end()]
    return start, len(text)
