"""Runs of one message sent again and again by the same sender, collapsed to one event.

Rows that differ from their predecessor are kept as boundaries; lead over the boundaries gives each run its end,
position differences its count. Time is cut into buckets so that no key, however large, is ordered in one task;
a bucket sees the rows of the last gap before it, and run pieces that touch a bucket's edge are joined at the end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.operators.sessions import GAP_US, one_row_per_id
from chatloom.runtime import persisted

# Remarks that mark a message as sent again, and the mark of a forwarded one.
AGAIN = r"\s*\((?:again|retry|resending|resend|resent|repost|sent again|bump)\)"
FORWARDED = r"^\s*\[?forwarded\]?:?\s+"
#: A word counts as known if so many messages have it, whatever the size of the table.
KNOWN_LEAST = 3
#: A known word may be a slip for another only if that one is so many times as frequent.
SLIP_RATIO = 20
#: Lanes over which the runs of one key are spread.
LANES = 256


def said(text: Column) -> dict[str, Column]:
    """What a message says: words with lengthened letters cut to one and to two, and, without any word, its signs."""
    low = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(text), "[\uFE0E\uFE0F]", ""), FORWARDED, ""), AGAIN, " ")
    words = F.trim(F.regexp_replace(F.regexp_replace(low, r"(?<=\p{L})['’](?=\p{L})", ""), r"[^\p{L}\p{M}\p{N}]+", " "))
    bare = F.regexp_replace(low, r"\s+", "")
    return {
        "one": F.regexp_replace(words, r"(\p{L})\1{2,}", "$1"),
        # kept only where it differs from the first
        "two": F.when(words.rlike(r"(\p{L})\1{2,}"), F.regexp_replace(words, r"(\p{L})\1{2,}", "$1$1")),
        "signs": F.when(words == "", F.regexp_replace(bare, r"(.)\1+", "$1")),
    }


def osa(a: str, b: str, most: int) -> int:
    """Edits (insert, drop, change, swap neighbours) between a and b, or most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            now.append(v)
        before, row = row, now
    return min(row[-1], most + 1)


def slip(a: str, b: str, known: dict[str, int]) -> bool:
    """Whether one of two different words is the other one mistyped. Words with digits never are."""
    if re.search(r"\d", a + b) or min(len(a), len(b)) < 1:
        return False
    low, high = sorted((known.get(a, 0), known.get(b, 0)))
    if high and high >= SLIP_RATIO * low and max(len(a), len(b)) >= 2 and osa(a, b, 1) == 1:
        return True
    # both mistyped for a third word; in a large table slips themselves reach the least number
    return min(len(a), len(b)) >= 4 and osa(a, b, 2) <= 2 and any(known[w] >= SLIP_RATIO * high and osa(a, w, 1) <= 1 and osa(b, w, 1) <= 1 for w in _near(a, known))


def _near(a: str, known: dict[str, int]) -> Iterator[str]:
    letters = sorted(set("abcdefghijklmnopqrstuvwxyz") | set(a))
    for i in range(len(a) + 1):
        head, tail = a[:i], a[i:]
        cand = [head + tail[1:]] if tail else []
        cand += [head + tail[1] + tail[0] + tail[2:]] if len(tail) > 1 else []
        cand += [head + c + tail[1:] for c in letters if tail] + [head + c + tail for c in letters]
        yield from (w for w in cand if w in known)


def same_words(a: str, b: str, known: dict[str, int]) -> bool:
    """Whether two texts of words say the same but for slips of typing, at most in every other word."""
    if a.replace(" ", "") == b.replace(" ", ""):
        return True
    x, y = a.split(), b.split()
    if len(x) != len(y):
        # a lost or moved blank makes one word of two: compare without blanks, within one edit
        return abs(len(x) - len(y)) == 1 and not re.search(r"\d", a + b) and min(len(x), len(y)) >= 2 and osa(a, b, 1) == 1 and not ((set(x) ^ set(y)) <= known.keys())
    diff = [(p, q) for p, q in zip(x, y) if p != q]
    return len(diff) <= max(1, len(x) // 2) and all(slip(p, q, known) for p, q in diff)


def known_words(rows: DataFrame, words: str = "one", least: int = KNOWN_LEAST) -> dict[str, int]:
    """Messages with each known word; their number is that of the vocabulary, not of the rows."""
    counted = rows.select(F.explode(F.array_distinct(F.split(words, " "))).alias("w")).where("w != ''").groupBy("w").count()
    t = counted.where(F.col("count") >= least).toArrow()
    return dict(zip(t["w"].to_pylist(), t["count"].to_pylist()))


def comparable(a: Column, b: Column) -> Column:
    """Whether same_words() could hold for two texts of words; it leaves nothing out that would.

    Equal but for blanks, one blank and one edit apart, or word by word, at most every other one, within two edits
    (a swap costs levenshtein two of its own).
    """
    x, y = F.split(a, " "), F.split(b, " ")
    pairs = F.filter(F.arrays_zip(x.alias("x"), y.alias("y")), lambda p: p["x"] != p["y"])
    near = F.forall(pairs, lambda p: F.levenshtein(p["x"], p["y"], 4) >= 0)
    by_word = (F.size(x) == F.size(y)) & (F.size(pairs) <= F.greatest(F.lit(1), F.floor(F.size(x) / 2))) & near
    by_blank = (F.abs(F.size(x) - F.size(y)) == 1) & (F.levenshtein(a, b, 2) >= 0)
    return (F.replace(a, F.lit(" "), F.lit("")) == F.replace(b, F.lit(" "), F.lit(""))) | by_word | by_blank


def collapse_runs(messages: DataFrame, gap_us: int = GAP_US, least: int = 2, bucket_gaps: int = 12, key: str = "source_file", event_id: str = "message_id", ts: str = "timestamp", actor: str = "sender", text: str = "text", arrival: str = "received_at") -> DataFrame:
    """One row per run of at least `least` neighbouring messages of one sender that say the same.

    Columns: key, sender, first and last id, start, end, message_count, duration_seconds. Messages are ordered by
    time and id inside a key, an id counts once, rows without id or timestamp are left out. Null senders and null or
    empty texts make no run. Steps of gap or more end a run. A null key is one key. least=1 gives every message.
    """
    rows = one_row_per_id(messages, key, event_id, ts, [actor, text], arrival)
    rows = rows.select("key", "id", "us", F.col(actor).alias("actor"), *[c.alias(k) for k, c in said(F.col(text)).items()])
    rows = persisted(rows, "said")
    known = messages.sparkSession.sparkContext.broadcast(known_words(rows))

    span = gap_us * bucket_gaps
    own = F.floor(F.col("us") / F.lit(span))
    late = (F.col("us") - own * F.lit(span)) > F.lit(span - gap_us)
    both = F.when(late, F.array(F.struct(own.alias("b"), F.lit(False).alias("seen")), F.struct((own + 1).alias("b"), F.lit(True).alias("seen")))).otherwise(F.array(F.struct(own.alias("b"), F.lit(False).alias("seen"))))
    placed = rows.select("*", F.explode(both).alias("p")).select("key", "id", "us", "actor", "one", "two", "signs", "p.b", "p.seen")

    part = Window.partitionBy("key", "b")
    w = part.orderBy("us", "id")
    prev = F.lag(F.struct("id", "us", "actor", "one", "two", "signs")).over(w)
    d = placed.withColumn("prev", prev).withColumn("pos", F.row_number().over(w)).withColumn("last", F.max(F.struct("pos", "us", "id")).over(part))
    near = (F.col("actor") == F.col("prev.actor")) & (F.col("us") - F.col("prev.us") < gap_us)
    worded = (F.col("one") != "") & (F.col("prev.one") != "")
    signs, psigns = F.col("signs"), F.col("prev.signs")
    same = (worded & ((F.col("one") == F.col("prev.one")) | (F.coalesce("two", "one") == F.coalesce("prev.two", "prev.one")))) | ((signs != "") & (psigns != "") & (signs.startswith(psigns) | psigns.startswith(signs)))
    same = F.coalesce(same, F.lit(False))
    # the comparison is worked out for neighbours only
    alike = F.when(near & worded & ~same, comparable(F.col("one"), F.col("prev.one")))

    def compare(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        k = known.value
        for a, b in batches:
            yield pd.Series([x is not None and y is not None and same_words(x, y, k) for x, y in zip(a, b)], dtype=bool)

    slips = F.pandas_udf(compare, "boolean").asNondeterministic()
    d = d.withColumn("cand", F.coalesce(alike, F.lit(False)))
    d = d.withColumn("slip", slips(F.when(F.col("cand"), F.col("one")), F.when(F.col("cand"), F.col("prev.one"))))
    d = d.withColumn("joins", F.coalesce(near & same, F.lit(False)) | F.col("slip"))
    fields = ["key", "b", "id", "us", "actor", "pos", "joins", "last", F.col("prev.us").alias("prev_us"), F.col("prev.id").alias("prev_id"), F.lag("seen", 1, True).over(w).alias("prev_seen"), "seen"]
    starts = d.select(*fields).where(~F.col("seen") & (~F.col("joins") | F.col("prev_seen")))

    nxt = F.lead(F.struct("pos", "prev_us", "prev_id")).over(w)
    e = starts.withColumn("nxt", nxt)
    pieces = e.select(
        "key", "actor", F.col("us").alias("start_us"), F.col("id").alias("first_id"), "joins", F.col("nxt").isNull().alias("edge"),
        (F.coalesce(F.col("nxt.pos"), F.col("last.pos") + 1) - F.col("pos")).alias("n"),
        F.when(F.col("nxt").isNull(), F.col("last.us")).otherwise(F.col("nxt.prev_us")).alias("end_us"),
        F.when(F.col("nxt").isNull(), F.col("last.id")).otherwise(F.col("nxt.prev_id")).alias("last_id"),
    ).where((F.col("n") >= least) | F.col("joins") | F.col("edge"))
    # only pieces at the edge of a bucket, at most two of each, have to meet; all others are runs of their own and are spread
    pieces = pieces.withColumn("lane", F.when(F.col("joins") | F.col("edge"), F.lit(-1)).otherwise(F.pmod(F.xxhash64("first_id"), F.lit(LANES))))
    kw = Window.partitionBy("key", "lane").orderBy("start_us", "first_id")
    runs = pieces.withColumn("r", F.sum((~F.col("joins")).cast("int")).over(kw.rowsBetween(Window.unboundedPreceding, 0)))
    g = runs.groupBy("key", "lane", "r").agg(F.min(F.struct("start_us", "first_id", "actor")).alias("lo"), F.max(F.struct("end_us", "last_id")).alias("hi"), F.sum("n").alias("n")).where(F.col("n") >= least)
    return g.select(
        F.col("key").alias(key), F.col("lo.actor").alias(actor), F.col("lo.first_id").alias(f"first_{event_id}"), F.col("hi.last_id").alias(f"last_{event_id}"),
        F.timestamp_micros("lo.start_us").alias("run_start"), F.timestamp_micros("hi.end_us").alias("run_end"), F.col("n").alias("message_count"),
        ((F.col("hi.end_us") - F.col("lo.start_us")) / 1e6).alias("duration_seconds"),
    )
