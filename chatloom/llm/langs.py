"""Language of documents, of their one-language stretches and of mixed chat turns, by cross-parsing.

For each language a suffix automaton of labelled text is built. A text is parsed greedily into the longest pieces
that occur in a language's text; the language that needs the fewest pieces, each at the price of naming a place in
its text, wins. Stretches of a document are the cheapest parse in which sentences may change language at a price;
a chat turn is parsed in the same way by words. The automata are walked for many texts at once, one byte of each
per step, as look-ups in one table; texts are letters of any script in UTF-8, languages are those of the labels.

The labelled text is a bounded sample (SAMPLE_DOCS documents a language, SAMPLE_TURNS turns, all of their text) and
is cleaned first, since labels may be wrong: a part is kept only where the automata of another part of the sample
agree with its label.
"""

from __future__ import annotations

import functools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm import pii
from chatloom.llm.textform import readable

#: Labelled documents of each language that are read, of a length between the two; with many languages fewer of each.
SAMPLE_DOCS, SAMPLE_LENGTH = 80, (100, 4000)
#: Documents of all languages together, and the least number that makes a language.
SAMPLE_ALL, LEAST_DOCS = 1280, 5
#: Labelled turns that are read.
SAMPLE_TURNS = 12_000
#: A word that mixed turns have more than so many times as often as pure ones tells nothing about the latter's language.
MIXED_RATIO = 6
PIECE = 240  # longer sentences are walked in pieces of about this length
#: Pieces that a change of language inside a document costs.
CHANGE = 3.0
#: Pieces that a change costs inside a turn, at a word the language holds whole and at another one.
WORD_CHANGE, PART_CHANGE = 0.3, 1.2
#: Pieces that a word costs more in a language that does not hold it whole.
BROKEN = 0.5
#: Pieces that a word saves after a word it has in the labelled text before it.
FOLLOWS = 0.2
#: A text is in no known language where its pieces are shorter than so much of those of labelled text, and than so many bytes.
SHORTEST, SHORTEST_BYTES = 0.6, 3.2
#: Labelled text that another language reads nearly as well as its own text is wrongly labelled.
READ_AS_WELL = 0.85

# Languages by their codes, labels of turns, utterances without a language.
CODES = dict(c.split("=") for c in """ara=ar ben=bn bul=bg cat=ca ces=cs cze=cs dan=da deu=de ger=de ell=el gre=el eng=en est=et fas=fa per=fa fin=fi fra=fr fre=fr guj=gu heb=he hin=hi hrv=hr hun=hu
    ind=id ita=it jpn=ja kan=kn kor=ko lav=lv lit=lt mal=ml mar=mr nld=nl dut=nl nor=no pan=pa pol=pl por=pt ron=ro rum=ro rus=ru slk=sk slo=sk slv=sl spa=es srp=sr swe=sv tam=ta tel=te tha=th tur=tr ukr=uk urd=ur vie=vi zho=zh chi=zh""".split())  # fmt: skip
NO_CODE = ("und", "unk", "mis", "mul", "zxx", "nan")
CLASSES = ("pure_english", "pure_hindi", "code_switched", "neutral")
FILLERS = set("ok okk okay k kk lol lmao rofl haha hahaha hehe hmm hm mm mmm uh um oh ah wow omg yay ugh xd".split())

_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_ASCII = bytes(ord(chr(c).lower()) if chr(c).isascii() and chr(c).isalpha() else 32 for c in range(256))
_SPLIT = re.compile(r"(?<=[.!?…])[\"'»”)]*\s+|(?<=[。！？।])\s*|\s*\n+\s*")
_MARK = re.compile(r"^\s*(?:[-*•‣–·]\s+)?(?:[^\W\d_][\w'’.-]*(?: [\w'’.-]+){0,2}:\s)?")


def code_of(label: str | None) -> str | None:
    """Language code of a label in any spelling, None for a missing or unknown one."""
    c = re.split(r"[-_\s]", label.strip().lower())[0] if label else ""
    return CODES.get(c, c) if re.fullmatch(r"[a-z]{2,3}", c) and c not in NO_CODE else None


def _code_column(label: str) -> Column:
    """The same as a column."""
    c = F.split(F.lower(F.trim(F.col(label))), r"[-_\s]")[0]
    known = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])
    return F.when(c.rlike("^[a-z]{2,3}$") & ~c.isin(*NO_CODE), F.coalesce(known[c], c))


def letters(text: str) -> bytes:
    """Lower-case letters of a text in UTF-8, anything else as single blanks, with a blank at either end."""
    if text.isascii():
        return b" " + b" ".join(text.encode().translate(_ASCII).split()) + b" "
    return b" " + _OTHER.sub(" ", text.lower()).strip().encode() + b" "


def sentences(text: str) -> list[str]:
    """Sentences of a text in its readable form, without bullets and speaker labels."""
    return [s for s in (_MARK.sub("", p) for p in _SPLIT.split(readable(text)) if p) if s]


class Automata:
    """Suffix automata of one text per language, as one table of transitions.

    Entry v >= 0 is the next state; v < 0 ends a piece and starts the next one in state ~v. typical is the mean
    length of a piece of each language's own text that its automaton has not seen.
    """

    def __init__(self, texts: dict[str, bytes], typical: dict[str, float] | None = None):
        self.names = list(texts)
        self.texts = tuple(texts.values())
        self.typical = typical or dict.fromkeys(texts, 0.0)
        self.price = np.log2([max(2, len(t)) for t in self.texts])
        self.codes, self.width, self.table, self.roots = _joined(self.texts)
        self.clean: dict[str, list[bytes]] = {}  # the sentences behind the texts, where they are known

    def __reduce__(self):
        # the texts travel, each process builds the table once
        return Automata, (dict(zip(self.names, self.texts)), self.typical)

    def pieces(self, texts: list[bytes]) -> np.ndarray:
        """Number of pieces of each text (row) in each language (column)."""
        out = np.zeros((len(texts), len(self.roots)), "int64")
        if not texts:
            return out
        cut, owner = [], []
        for i, t in enumerate(texts):
            while len(t) > 2 * PIECE:
                k = t.find(b" ", PIECE)
                if k < 0 or k > 2 * PIECE:
                    k = PIECE
                cut.append(t[: k + 1])
                owner.append(i)
                t = t[k:]
            cut.append(t)
            owner.append(i)
        length = np.fromiter(map(len, cut), "int64", len(cut))
        order = np.argsort(-length, kind="stable")
        flat = self.codes[np.frombuffer(b"".join(cut[j] for j in order), "uint8")]
        length = length[order]
        start = np.concatenate([[0], np.cumsum(length)[:-1]])
        state = np.tile(np.array(self.roots, "int32"), (len(cut), 1))
        count = np.ones((len(cut), len(self.roots)), "int32")
        alive = np.searchsorted(-length, -np.arange(length[0]), "left")
        for t in range(int(length[0])):
            k = alive[t]
            v = self.table[state[:k] * self.width + flat[start[:k] + t][:, None]]
            end = v >> 31
            count[:k] -= end
            state[:k] = v ^ end
        np.add.at(out, np.array(owner)[order], count)
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Pieces at the price of naming a place in the language's text, a letter: lower is nearer."""
        n = np.maximum(1, np.fromiter((len(t) - 2 for t in texts), "int64", len(texts)))
        return self.pieces(texts) * self.price[None, :] / n[:, None]


@functools.lru_cache(maxsize=8)
def _joined(texts: tuple[bytes, ...]) -> tuple[np.ndarray, int, np.ndarray, list[int]]:
    """(code of each byte, number of codes, table, root of each text); bytes that no text has are code 0, which ends any piece."""
    used = sorted(set(b"".join(texts)) | {32})
    codes = np.zeros(256, "int32")
    codes[used] = np.arange(1, len(used) + 1)
    tables, roots, base, width = [], [], 0, len(used) + 1
    for t in texts:
        table = _suffix_automaton(codes[np.frombuffer(t, "uint8")].tolist(), width)
        first = np.where(table[0] >= 0, table[0] + base, base)
        tables.append(np.where(table >= 0, table + base, ~first[None, :]).astype("int32"))
        roots.append(base)
        base += len(table)
    return codes, width, np.concatenate(tables).ravel() if tables else np.zeros(0, "int32"), roots


def _suffix_automaton(codes: list[int], width: int) -> np.ndarray:
    """Transitions (state, letter) -> state or -1, state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    table = np.full((len(nxt), width), -1, "int32")
    for s, d in enumerate(nxt):
        for c, t in d.items():
            table[s, c] = t
    return table


def fit_documents(labelled: dict[str, list[str]]) -> Automata:
    """Automata from labelled documents of each language, without the stretches that the other half of the sample disowns.

    A stretch stays where it is cheapest in the language of its label and no other language reads it nearly as well
    as text of its own; so copies of one wrongly labelled text do not speak for each other.
    """
    docs = {c: [[x for x in map(letters, sentences(t)) if len(x) > 2] for t in ts] for c, ts in sorted(labelled.items())}
    docs = {c: [d for d in ds if d] for c, ds in docs.items()}
    docs = {c: ds for c, ds in docs.items() if len(ds) > 1}
    halves = [Automata({c: b"".join(x for d in ds[h::2] for x in d) for c, ds in docs.items()}) for h in (0, 1)]
    read: list[tuple[str, list[bytes], int, np.ndarray]] = []  # label, sentences, cheapest language, bytes a piece in each
    for c, ds in docs.items():
        for h in (0, 1):
            judge = halves[1 - h]
            n = judge.pieces([x for d in ds[h::2] for x in d])
            at = 0
            for d in ds[h::2]:
                own, at = n[at : at + len(d)], at + len(d)
                path = cheapest_path(own * judge.price[None, :], CHANGE * float(judge.price.mean()))
                cuts = [0, *(np.flatnonzero(np.diff(path)) + 1), len(d)]
                for i, j in zip(cuts, cuts[1:]):
                    read.append((c, d[i:j], int(path[i]), sum(map(len, d[i:j])) / own[i:j].sum(0)))
    names = list(docs)
    typical = {c: float(np.median([r[k] for x, _, p, r in read if x == c and p == k] or [np.inf])) for k, c in enumerate(names)}
    usual = np.array(list(typical.values()))
    kept: dict[str, list[bytes]] = {c: [] for c in names}
    for c, d, p, r in read:
        if names[p] == c and (len(names) == 1 or np.delete(r / usual, p).max() < READ_AS_WELL):
            kept[c] += [x for x in d if len(x) > 12]
    machine = Automata({c: b"".join(s) or b" " for c, s in kept.items()}, typical)
    machine.clean = kept
    return machine


def cheapest_path(cost: np.ndarray, change: float) -> np.ndarray:
    """Language of each sentence on the cheapest way through a document, where a change of language costs so much; ties keep the language."""
    n, k = cost.shape
    back = np.zeros((n, k), int)
    total = cost[0].copy()
    for i in range(1, n):
        best = int(total.argmin())
        moved = total[best] + change < total
        back[i] = np.where(moved, best, np.arange(k))
        total = np.where(moved, total[best] + change, total) + cost[i]
    path = np.zeros(n, int)
    path[-1] = int(total.argmin())
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def stretches(machine: Automata, pieces: np.ndarray, sizes: list[int]) -> list[tuple[str, float, int, int]]:
    """(language, confidence, first and last sentence) of each maximal stretch of a document, from the pieces of its sentences.

    Confidence is the share of its price that the language saves over the next one. Sentences without letters join
    no side. Sentences and stretches whose pieces are much shorter than those of labelled text, such as names, have
    no language and join no side either.
    """
    if not machine.names or not len(pieces):
        return []
    best = (pieces * machine.price[None, :]).argmin(1)
    least = [min(SHORTEST_BYTES, SHORTEST * machine.typical[c]) for c in machine.names]
    at = [i for i, n in enumerate(sizes) if n > 2 and n >= least[best[i]] * pieces[i, best[i]]]
    if not at:
        return []
    cost = pieces[at] * machine.price[None, :]
    path = cheapest_path(cost, CHANGE * float(machine.price.mean()))
    groups: list[tuple[int, list[int]]] = []
    for k, p in enumerate(path):
        if groups and groups[-1][0] == p:
            groups[-1][1].append(k)
        else:
            groups.append((int(p), [k]))
    out: list[tuple[int, list[int]]] = []
    for p, rows in groups:
        if sum(sizes[at[k]] for k in rows) < least[p] * pieces[[at[k] for k in rows], p].sum():
            continue
        if out and out[-1][0] == p:
            out[-1][1].extend(rows)
        else:
            out.append((p, list(rows)))
    res = []
    for p, rows in out:
        c = cost[rows].sum(0)
        rest = np.delete(c, p).min() if len(c) > 1 else np.inf
        res.append((machine.names[p], float(max(0.0, 1 - c[p] / rest)) if np.isfinite(rest) else 1.0, at[rows[0]], at[rows[-1]]))
    return res


def _lot(column: str, share: Column) -> Column:
    """Whether a row is among the given share of all, by a hash."""
    return (F.xxhash64(column) / F.lit(2.0**63) + F.lit(1.0)) / F.lit(2.0) < share


def document_sample(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", size: int = SAMPLE_DOCS) -> dict[str, list[str]]:
    """At most `size` labelled documents of each language, chosen by a hash of their key.

    One pass over the labels counts the documents of each code, one over the texts takes a share of them.
    """
    rows = docs.where(F.col(label).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"), _code_column(label).alias("c")).where("c is not null")
    n = {r["c"]: r["n"] for r in rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect() if r["n"] >= LEAST_DOCS}  # one row per code of two or three letters
    if not n:
        return {}
    size = max(LEAST_DOCS, min(size, SAMPLE_ALL // len(n)))
    # four times as many as needed, since some have no fitting length
    share = F.create_map(*[F.lit(x) for c, k in n.items() for x in (c, min(1.0, 4.0 * size / k))])
    few = rows.where(_lot("k", share[F.col("c")]) & F.length("t").between(*SAMPLE_LENGTH)).select("c", F.xxhash64("k").alias("h"), "t").distinct()
    out: dict[str, list[tuple[int, str]]] = defaultdict(list)
    for c, h, t in few.collect():
        out[c].append((h, t))
    return {c: [t for _, t in sorted(v)[:size]] for c, v in sorted(out.items())}


def document_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", machine: Automata | None = None) -> DataFrame:
    """key, segment_no, language, confidence, first and last sentence, and the given label's code: one row per stretch.

    Documents without text in any language give no row. Without any labelled document there is no language.
    """
    machine = machine or fit_documents(document_sample(docs, key, text, label))
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    schema = f"`{key}` {dict(docs.dtypes)[key]}, given string, segment_no int, language string, confidence double, first_sentence int, last_sentence int, segments int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for pdf in batches:
            owner, texts = [0], []
            for t in pdf.iloc[:, 1]:
                texts += map(letters, sentences(t))
                owner.append(len(texts))
            pieces, rows = m.pieces(texts), []
            for k, given, a, b in zip(pdf.iloc[:, 0], pdf.iloc[:, 2], owner, owner[1:]):
                got = stretches(m, pieces[a:b], [len(t) for t in texts[a:b]])
                rows += [(k, code_of(given), j, c, round(f, 4), x, y, len(got)) for j, (c, f, x, y) in enumerate(got)]
            yield pd.DataFrame(rows, columns=[key, "given", "segment_no", "language", "confidence", "first_sentence", "last_sentence", "segments"])

    return docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, text, label).mapInPandas(run, schema)


# ---- chat turns in English, Hindi or both ---------------------------------------------------------------------

_WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def turn_words(text: str, names: pii.Names) -> list[str]:
    """Words of a turn that have a language: no identifiers, names, fillers, numbers; lengthened letters are cut."""
    for a, b, _ in reversed(pii.detect(text, names)):
        text = text[:a] + " 0 " + text[b:]
    low = re.sub(r"^\s*\[?forwarded\]?:?\s+", "", readable(text).lower())
    low = pii.MEDIA.sub(" ", low)
    words = [re.sub(r"([^\W\d_])\1{2,}", r"\1", w.replace("’", "'")) for w in _WORDS.findall(low)]
    return [w for w in words if w not in FILLERS and w not in names.given and w not in names.family and len(w) > 0 and not re.fullmatch(r"(?:ha)+h?|(?:he)+h?|h+m+|l+o+l+|o+k+", w)]


class TurnModel:
    """Automata of clean English and Hindi text, how often each language has a word, and words of mixed turns only.

    A turn is parsed by words: a word costs its pieces in a language, a little less where the language also has
    it after the word before, and a change of language has a price. The cheapest parse gives the class.
    """

    def __init__(self, machine: Automata, counts: dict[str, dict[str, float]], lent: dict[str, str]):
        self.machine, self.counts, self.lent = machine, counts, lent

    def parts(self) -> tuple:
        return self.machine, self.counts, self.lent

    def word_costs(self, words: set[str]) -> tuple[dict[str, tuple[int, int]], dict[str, tuple[float, float]]]:
        """(pieces, cost) of each word in English and Hindi. A word held whole by both costs more where the other has it
        clearly more often, one held by neither nothing more in the language that mixed turns show it to be."""
        order, e, h = sorted(words), self.counts["en"], self.counts["hi"]
        raw = dict(zip(order, map(tuple, self.machine.pieces([letters(w) for w in order]).tolist())))
        cost = {}
        for w, (x, y) in raw.items():
            if x == y == 1:
                a, b = e.get(w, 0.0), h.get(w, 0.0)
                cost[w] = (1, 2) if a > 3 * b else (2, 1) if b > 3 * a else (1, 1)
            elif min(x, y) > 1 and w in self.lent:
                cost[w] = (1, max(2, y)) if self.lent[w] == "en" else (max(2, x), 1)
            else:
                cost[w] = (x + BROKEN * (x > 1), y + BROKEN * (y > 1))
        return raw, cost

    def classify(self, turns: list[list[str]]) -> list[tuple[str, float]]:
        """(class, confidence) of turns: confidence is the share of its price that the cheapest class saves over the next one."""
        raw, cost = self.word_costs({w for ws in turns for w in ws})
        pairs = sorted({p for ws in turns for p in zip(ws, ws[1:])})
        both = self.machine.pieces([letters(f"{a} {b}") for a, b in pairs]).tolist()
        after = {p: (n[0] - raw[p[0]][0] < raw[p[1]][0], n[1] - raw[p[0]][1] < raw[p[1]][1]) for p, n in zip(pairs, both)}
        return [self._cheapest(ws, cost, after) for ws in turns]

    @staticmethod
    def _cheapest(words: list[str], cost: dict, after: dict) -> tuple[str, float]:
        if not words:
            return "neutral", 1.0
        pure, mixed = [float(c) for c in cost[words[0]]], [np.inf, np.inf]
        for before, w in zip(words, words[1:]):
            c, follows = cost[w], after[before, w]
            stay = [c[k] - FOLLOWS * follows[k] for k in (0, 1)]
            moved = [min(pure[1 - k], mixed[1 - k]) + (WORD_CHANGE if c[k] == 1 else PART_CHANGE) + c[k] for k in (0, 1)]
            mixed = [min(mixed[k] + stay[k], moved[k]) for k in (0, 1)]
            pure = [pure[k] + stay[k] for k in (0, 1)]
        order = sorted([(pure[0], 0, "pure_english"), (pure[1], 1, "pure_hindi"), (min(mixed), 2, "code_switched")])
        return order[0][2], round(1 - order[0][0] / order[1][0], 4)


def _covering(turns: list[str]) -> list[str]:
    """Turns that bring a new word, then such that bring a new pair of words."""
    words: set[str] = set()
    pairs: set[tuple[str, str]] = set()
    first, second = [], []
    for t in turns:
        w = t.split()
        if not words.issuperset(w):
            words.update(w)
            pairs.update(zip(w, w[1:]))
            first.append(t)
    for t in turns:
        w = t.split()
        if not pairs.issuperset(zip(w, w[1:])):
            pairs.update(zip(w, w[1:]))
            second.append(t)
    return first + second


def fit_turns(turns: list[tuple[list[str], str]], documents: Automata) -> TurnModel:
    """Model from labelled turns (words and label) and the clean sentences of English and Hindi documents.

    A pure turn is clean unless one of its words is clearly commoner in turns of the other language.
    """
    n = {c: Counter(w for ws, k in turns if k == c for w in set(ws)) for c in CLASSES}
    e, h = n["pure_english"], n["pure_hindi"]
    el, hl = max(1, sum(e.values())), max(1, sum(h.values()))
    clean: dict[str, list[list[str]]] = {"en": [], "hi": []}
    for ws, k in turns:
        for c, own, size, other, rest in (("en", e, el, h, hl), ("hi", h, hl, e, el)):
            if k == ("pure_english" if c == "en" else "pure_hindi") and not any((other[w] + 0.5) / rest > 3 * (own[w] + 0.5) / size for w in ws):
                clean[c].append(ws)
    text, counts = {}, {}
    for c in ("en", "hi"):
        # a word of a turn or two may be a slip or the mark of a wrong label, one of mixed turns may be of either language
        own, mixed = n["pure_english" if c == "en" else "pure_hindi"], n["code_switched"]
        seen = Counter(w for ws in clean[c] for w in set(ws) if MIXED_RATIO * own[w] >= mixed[w])
        mine = _covering(sorted({" ".join(w for w in ws if seen[w] > 2) for ws in clean[c]} - {""}))
        docs = documents.clean.get(c, [])
        text[c] = (b"".join(map(letters, mine)) + b"".join(docs)) or b" "
        turn_total, doc_seen = max(1, sum(seen.values())), Counter(w for s in docs for w in s.decode().split())
        doc_total = max(1, sum(doc_seen.values()))
        counts[c] = {w: seen[w] / turn_total + doc_seen[w] / doc_total for w in seen.keys() | doc_seen.keys()}
    model = TurnModel(Automata(text), counts, {})
    raw, cost = model.word_costs({w for ws, _ in turns for w in ws})
    # words held by neither stand, in mixed turns, for the language that is missing otherwise
    held = {w: {c for c, x in zip(("en", "hi"), cost[w]) if x == 1} for w in raw}
    lack: dict[str, Counter] = {}
    for ws, k in turns:
        has = {c for w in ws if len(held[w]) == 1 for c in held[w]}
        missing = "en" if has == {"hi"} else "hi" if has == {"en"} else "none"
        for w in ws:
            if not held[w]:
                lack.setdefault(w, Counter())[missing if k == "code_switched" else "pure"] += 1
    lent = {w: lang for w, c in lack.items() for lang in ("en", "hi") if c[lang] >= 3 and c[lang] >= 0.6 * sum(c.values())}
    return TurnModel(model.machine, counts, lent)


def turn_sample(turns: DataFrame, key: str, text: str, label: str, size: int = SAMPLE_TURNS) -> list[tuple[str, str]]:
    """At most `size` labelled turns (text, label), chosen by a hash of their key."""
    d = turns.where(F.col(label).isin(*CLASSES) & F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("k"), text, label)
    share = F.lit(min(1.0, 1.5 * size / max(1, d.count())))
    few = d.where(_lot("k", share)).select(F.xxhash64("k").alias("h"), text, label).collect()  # half as many again as needed
    return [(r[1], r[2]) for r in sorted(few)[:size]]


def turn_classes(turns: DataFrame, names: pii.Names, documents: Automata, key: str = "message_uid", text: str = "text", label: str = "classification") -> DataFrame:
    """key, given, class, confidence: one row per turn with text. Null texts are left out, blank ones are neutral."""
    model = fit_turns([(turn_words(t, names), k) for t, k in turn_sample(turns, key, text, label)], documents)
    sent = turns.sparkSession.sparkContext.broadcast((model.parts(), (names.given, names.family, names.speakers)))
    schema = f"`{key}` {dict(turns.dtypes)[key]}, given string, class string, confidence double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, n = sent.value
        m, who = TurnModel(*parts), pii.Names(*n)
        for pdf in batches:
            got = m.classify([turn_words(t, who) for t in pdf.iloc[:, 1]])
            yield pd.DataFrame({key: pdf.iloc[:, 0], "given": pdf.iloc[:, 2], "class": [g[0] for g in got], "confidence": [g[1] for g in got]})

    return turns.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, text, label).mapInPandas(run, schema)
