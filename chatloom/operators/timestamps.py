"""Timestamps of mixed notation, precision and zone, brought to one instant in UTC.

Each string is reduced to a shape mask: 0 for a digit, a for a letter, other characters as they are. Every distinct
mask is mapped to a field layout once; all strings of one mask have the same length, so their fields are cut out and
converted as columns of a character matrix, and words (months, zones, halves of the day) by their distinct values.
Wall times go through per-zone transition tables: a wall time is taken when exactly one offset of the zone leads back
to it. Results carry the version of the zone tables.
"""

from __future__ import annotations

import functools
import importlib.metadata
import re
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from pathlib import Path
from typing import NamedTuple
from zoneinfo import TZPATH, ZoneInfo

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

US = 1_000_000
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
UTC_NAMES = {"z", "utc", "gmt"}

# Marks that carry no time: direction marks, zero-width marks and the byte order mark.
INVISIBLE = "​‌‍‎‏‪‫‬⁠﻿"
BLANKS = "     \t"

_MONTH = r"(?P<mon>a{3,9})\.?"
_TIME = r"(?P<h>0{1,2}):(?P<mi>00)(?::(?P<s>00)(?:[.,](?P<f>0{1,9}))?)?(?:\s?(?P<ap>a)\.?(?P<m>a)\.?(?!a))?"
_ZONE = r"(?:\s?(?P<z>a|a{3,5}|[+-]00(?::?00)?)(?:\[(?P<iana>[a0_/+-]+)\])?)?"
_WEEKDAY = r"(?:(?P<wd>a{3,9}),?\s+)?"

# One layout per notation family, over masks; a mask is mapped to the first that fits.
LAYOUTS = [
    ("epoch", re.compile(r"(?P<epoch>0{10}|0{13}|0{16}|0{19})")),
    ("ymd", re.compile(_WEEKDAY + r"(?P<y>0000)(?P<sep>[-/.])(?P<mo>0{1,2})(?P=sep)(?P<d>0{1,2})(?:(?P<t>a)|,?\s+)" + _TIME + _ZONE)),
    ("ymd", re.compile(r"(?P<y>0000)(?P<mo>00)(?P<d>00)(?P<t>a)?(?P<h>00)(?P<mi>00)(?:(?P<s>00)(?:[.,](?P<f>0{1,9}))?)?" + _ZONE)),
    ("dmony", re.compile(_WEEKDAY + r"(?P<d>0{1,2})[\s-]" + _MONTH + r"[\s-](?P<y>0000|00),?\s+" + _TIME + _ZONE)),
    ("dmony", re.compile(_WEEKDAY + _MONTH + r"\s(?P<d>0{1,2}),?\s+(?P<y>0000),?\s+" + _TIME + _ZONE)),
    ("numeric", re.compile(r"(?P<p>0{1,2})(?P<sep>[-/.])(?P<q>0{1,2})(?P=sep)(?P<y>0000|00),?\s+" + _TIME + _ZONE)),
]
WEEKDAYS = "mon tue wed thu fri sat sun".split()
#: Years whose changes of offset are always looked up; others only where a time needs them.
NEAR_YEARS, ALL_YEARS = (1970, 2060), (1840, 2460)
#: The calendar, and with it the rule of a zone for the future, repeats after 400 years.
CYCLE_US = 146_097 * 86_400 * US


def tz_version() -> str:
    """Version of the zone tables in use, to be stored beside results."""
    for d in TZPATH:
        for f, rx in (("tzdata.zi", r"# version (\S+)"), ("+VERSION", r"(\S+)")):
            p = Path(d, f)
            if p.exists() and (m := re.match(rx, p.read_text(errors="replace")[:60])):
                return m[1]
    try:
        return importlib.metadata.version("tzdata")
    except importlib.metadata.PackageNotFoundError:
        return "system"


class Zone(NamedTuple):
    """Offsets of a zone: when each starts, its length, its abbreviation, and the offsets each abbreviation has stood for, latest first."""

    at: np.ndarray
    offset: np.ndarray
    name: np.ndarray
    by_name: dict[str, list[int]]


@functools.lru_cache(maxsize=2048)
def transitions(zone: str, years: tuple[int, int] = NEAR_YEARS) -> Zone | None:
    """Table of a zone over some years (UTC microseconds), None for no zone. The first offset holds for all time before."""
    try:
        z = ZoneInfo(zone)
    except Exception:  # noqa: BLE001 - zoneinfo raises many kinds for bad names
        return None

    def look(t: datetime) -> tuple[int, str]:
        w = t.astimezone(z)
        return int(w.utcoffset().total_seconds()), w.tzname().lower()

    t, end = datetime(years[0], 1, 1, tzinfo=timezone.utc), datetime(years[1], 1, 1, tzinfo=timezone.utc)
    before, at, states = look(t), [-(2**62)], []
    states.append(before)
    while t < end:
        nxt = t + timedelta(days=7)
        now = look(nxt)
        if now != before:
            lo, hi = t, nxt
            while hi - lo > timedelta(seconds=1):
                mid = (lo + (hi - lo) / 2).replace(microsecond=0)
                if mid in (lo, hi):
                    break
                lo, hi = (mid, hi) if look(mid) == before else (lo, mid)
            at.append(int(hi.timestamp()) * US)
            states.append(now)
            before = now
        t = nxt
    by_name: dict[str, list[int]] = {}
    for o, name in reversed(states):
        known = by_name.setdefault(name, [])
        if o * US not in known:
            known.append(o * US)
    return Zone(np.array(at, "int64"), np.array([o for o, _ in states], "int64") * US, np.array([n for _, n in states]), by_name)


def _table(zone: str, wall: np.ndarray) -> tuple[Zone | None, np.ndarray]:
    """(table that covers wall times, what to take off them first): the small one where it does; later cycles of the calendar are read in the last one known."""
    day = 2 * 86_400 * US
    lo, hi = (int((datetime(y, 1, 1) - datetime(1970, 1, 1)).total_seconds()) * US for y in NEAR_YEARS)
    if not len(wall) or (wall.min() >= lo + day and wall.max() < hi - day):
        return transitions(zone), np.zeros_like(wall)
    last = int((datetime(ALL_YEARS[1] - 10, 1, 1) - datetime(1970, 1, 1)).total_seconds()) * US
    return transitions(zone, ALL_YEARS), np.maximum(0, -(-(wall - last) // CYCLE_US)) * CYCLE_US


def wall_to_utc(wall: np.ndarray, zone: str) -> tuple[np.ndarray, np.ndarray]:
    """(UTC microseconds, number of instants that show this wall time)."""
    table, cycle = _table(zone, wall)
    out, n, near = np.zeros_like(wall), np.zeros(len(wall), int), wall - cycle
    for o in np.unique(table.offset):
        u = near - o
        ok = table.offset[np.searchsorted(table.at, u, "right") - 1] == o
        out = np.where(ok, u, out)
        n += ok
    return out + cycle, n


def named_to_utc(wall: np.ndarray, zone: str, name: str) -> np.ndarray | None:
    """UTC microseconds of wall times under an abbreviation of the zone, None for one it never had.

    Where the abbreviation has stood for several offsets, the one in force then; at times when none was, the latest.
    """
    table, cycle = _table(zone, wall)
    known = table.by_name.get(name) or (transitions(zone, ALL_YEARS).by_name.get(name) if name not in table.by_name else None)
    if not known:
        return None
    out, done = wall - known[0], np.zeros(len(wall), bool)
    if len(known) > 1:
        for o in known:
            u = wall - cycle - o
            k = np.searchsorted(table.at, u, "right") - 1
            ok = (table.offset[k] == o) & (table.name[k] == name) & ~done
            out, done = np.where(ok, u + cycle, out), done | ok
    return out


def _mask(s: str) -> str:
    """Digits to 0, letters to a."""
    return s.translate(_TO_MASK)


_TO_MASK = str.maketrans("123456789bcdefghijklmnopqrstuvwxyz", "0" * 9 + "a" * 25)
_TIDY = str.maketrans({**{c: None for c in INVISIBLE}, **{c: " " for c in BLANKS}})


def days_from_civil(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(days since 1970-01-01, whether the date exists)."""
    ok = (m >= 1) & (m <= 12) & (d >= 1) & (y >= 1)
    mm = np.where(ok, m, 1)
    month = ((y - 1970) * 12 + mm - 1).astype("datetime64[M]")
    start = month.astype("datetime64[D]").astype("int64")
    length = (month + 1).astype("datetime64[D]").astype("int64") - start
    return start + np.where(ok, d, 1) - 1, ok & (d <= length)


@functools.lru_cache(maxsize=65536)
def _layout(mask: str) -> tuple[str, dict[str, tuple[int, int]]] | None:
    """Kind and field spans of a mask."""
    for kind, rx in LAYOUTS:
        if m := rx.fullmatch(mask):
            return kind, {k: m.span(k) for k, v in m.groupdict().items() if v is not None}
    return None


def parse(texts: np.ndarray, zones: np.ndarray, orders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(UTC microseconds, status) for strings, their file's zone or None, and 'dmy', 'mdy' or None.

    status: ok, empty, junk, no_date, ambiguous_order, no_zone, bad_zone, twice, never.
    """
    n = len(texts)
    out, status = np.zeros(n, "int64"), np.full(n, "junk", object)
    tidy = [None if t is None else " ".join(t.translate(_TIDY).lower().split()) for t in texts]
    groups: dict[tuple, list[int]] = {}
    for i, t in enumerate(tidy):
        if not t:
            status[i] = "empty"
        else:
            groups.setdefault((_mask(t), zones[i], orders[i]), []).append(i)
    for (mask, zone, order), rows in groups.items():
        found = _layout(mask)
        if found is None:
            continue
        kind, span = found
        at = np.array(rows)
        chars = np.array([tidy[i] for i in rows], f"U{len(mask)}").view("U1").reshape(len(rows), len(mask))

        def num(k: str) -> np.ndarray:
            a, b = span[k]
            v = np.zeros(len(rows), "int64")
            for j in range(a, b):
                v = v * 10 + (chars[:, j].view("uint32").astype("int64") - 48)
            return v

        def words(k: str) -> tuple[list[str], np.ndarray]:
            """(distinct words of a field, which one each row has)."""
            a, b = span[k]
            u, inv = np.unique(np.ascontiguousarray(chars[:, a:b]).view(f"U{b - a}")[:, 0], return_inverse=True)
            return u.tolist(), inv

        def number(k: str, of: list[str]) -> np.ndarray:
            """Place of each row's word, by its first three letters, or -1."""
            u, inv = words(k)
            return np.array([of.index(w[:3]) if w[:3] in of else -1 for w in u])[inv]

        if kind == "epoch":
            e, width = num("epoch"), span["epoch"][1] - span["epoch"][0]
            out[at], status[at] = {10: e * US, 13: e * 1000, 16: e, 19: e // 1000}[width], "ok"
            continue
        said = np.ones(len(rows), bool)  # whether the words are words of a time
        if "t" in span:
            said &= chars[:, span["t"][0]] == "t"
        year = num("y")
        if span["y"][1] - span["y"][0] == 2:
            year = year + 2000
        if kind == "numeric":
            p, q = num("p"), num("q")
            same = p == q
            day, month = (q, p) if order == "mdy" else (p, q)
            unclear = ~same & (order is None) & (p <= 12) & (q <= 12)
            if order is None:
                day, month = np.where(p > 12, p, q), np.where(p > 12, q, p)
        else:
            day = num("d")
            month = number("mon", MONTHS) + 1 if "mon" in span else num("mo")
            said &= month > 0 if "mon" in span else True
            unclear = np.zeros(len(rows), bool)
        days, ok = days_from_civil(year, month, day)
        hour, minute = num("h"), num("mi")
        second = num("s") if "s" in span else np.zeros(len(rows), "int64")
        micro = np.zeros(len(rows), "int64")
        if "f" in span:
            width = span["f"][1] - span["f"][0]
            micro = num("f") * 10 ** (6 - width) if width <= 6 else num("f") // 10 ** (width - 6)
        if "ap" in span:
            half = chars[:, span["ap"][0]]
            said &= np.isin(half, ("a", "p")) & (chars[:, span["m"][0]] == "m")
            ok &= (hour >= 1) & (hour <= 12)
            hour = hour % 12 + np.where(half == "p", 12, 0)
        ok &= (hour <= 23) & (minute <= 59) & (second <= 59)
        if "wd" in span:
            weekday = number("wd", WEEKDAYS)
            said &= weekday >= 0
            ok &= (days + 3) % 7 == weekday
        # an impossible date must not call for far years
        wall = np.where(ok, ((days * 24 + hour) * 60 + minute) * 60 * US + second * US + micro, 10_957 * 86_400 * US)
        why = np.full(len(rows), "ok", object)
        if "z" in span and mask[span["z"][0]] in "+-":
            a, b = span["z"]
            sign = np.where(chars[:, a] == "-", -1, 1)
            digits = [j for j in range(a + 1, b) if mask[j] == "0"]
            v = [chars[:, j].view("uint32").astype("int64") - 48 for j in digits]
            hh = v[0] * 10 + v[1]
            mi = v[2] * 10 + v[3] if len(v) == 4 else 0 * hh
            ok &= (hh <= 15) & (mi <= 59)
            utc = wall - sign * (hh * 60 + mi) * 60 * US
        elif "z" in span:
            utc = wall.copy()
            for k, name in enumerate((found := words("z"))[0]):
                here = found[1] == k
                if name in UTC_NAMES:
                    continue
                if len(name) == 1:
                    said &= ~here
                    continue
                got = named_to_utc(wall[here], zone, name) if zone and transitions(zone) is not None else None
                if got is None:
                    why[here] = "bad_zone" if zone else "no_zone"
                else:
                    utc[here] = got
        elif not zone:
            utc, why[:] = wall, "no_zone"
        elif transitions(zone) is None:
            utc, why[:] = wall, "bad_zone"
        else:
            utc, k = wall_to_utc(wall, zone)
            why = np.where(k == 1, "ok", np.where(k == 0, "never", "twice")).astype(object)
        if "iana" in span and mask[span["z"][0]] in "+-":
            for k, name in enumerate((found := words("iana"))[0]):  # the bracketed name must agree with the offset
                here = found[1] == k
                name = _zone_name(name)
                if transitions(name) is not None:
                    table, cycle = _table(name, utc[here])
                    ok[here] &= table.offset[np.searchsorted(table.at, utc[here] - cycle, "right") - 1] == (wall - utc)[here]
        st = why
        st = np.where(unclear, "ambiguous_order", st)
        st = np.where(said, np.where(ok, st, "no_date"), "junk")
        out[at], status[at] = utc, st
    return out, status


@functools.lru_cache(maxsize=4096)
def _zone_name(lower: str) -> str:
    """Zone names are matched in lower case and written with capitals."""
    return "utc".upper() if lower == "utc" else "/".join("_".join(w.capitalize() for w in p.split("_")) for p in lower.split("/"))


def file_orders(messages: DataFrame, ts: str, key: str) -> DataFrame:
    """key, day_order: 'dmy' or 'mdy' from all numeric dates of a file that can be read one way only, null without such."""
    rx = r"^\W*(\d{1,2})[-/.](\d{1,2})[-/.](?:\d{4}|\d{2}),?\s"
    p, q = (F.regexp_extract(F.col(ts), rx, i) for i in (1, 2))
    d = messages.where(F.col(ts).rlike(rx)).select(F.col(key), p.cast("int").alias("__p"), q.cast("int").alias("__q"))
    dmy, mdy = F.col("__p").between(13, 31) & F.col("__q").between(1, 12), F.col("__q").between(13, 31) & F.col("__p").between(1, 12)
    c = d.groupBy(key).agg(F.count_if(dmy).alias("__dmy"), F.count_if(mdy).alias("__mdy"))
    return c.select(key, F.when(F.col("__dmy") > F.col("__mdy"), "dmy").when(F.col("__mdy") > F.col("__dmy"), "mdy").alias("day_order"))


def normalise_timestamps(messages: DataFrame, files: DataFrame, ts: str = "timestamp", key: str = "source_file", zone: str = "time_zone") -> DataFrame:
    """messages with utc_micros (null unless the string denotes exactly one instant), ts_status and tz_version.

    files gives one zone per key; the order of day and month is decided per key over all its rows. Nulls and blanks
    get status 'empty', an unknown key counts as a key without a zone. Columns of messages keep their names; those
    added are utc_micros, ts_status and tz_version, the version of the zone tables, replacing any of that name. An
    empty table gives an empty table.
    """
    base = messages.drop("utc_micros", "ts_status", "tz_version")
    fields = base.columns
    z = files.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__zk")).agg(F.min(zone).alias("__zone"))
    o = file_orders(base.where(F.col(key).isNotNull()), ts, key).select(F.col(key).alias("__ok"), F.col("day_order").alias("__order"))
    per_file = z.join(o, F.col("__zk") == F.col("__ok"), "full").select(F.coalesce("__zk", "__ok").alias("__k"), "__zone", "__order")
    joined = base.join(per_file, F.col(key) == F.col("__k"), "left").drop("__k")

    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for t, z_, o_ in batches:
            as_object = lambda s: s.astype(object).where(s.notna(), None).to_numpy()
            utc, st = parse(as_object(t), as_object(z_), as_object(o_))
            yield pd.DataFrame({"utc_micros": pd.Series(utc, dtype="int64").astype("Int64").where(pd.Series(st == "ok"), pd.NA), "ts_status": st})

    parsed = F.pandas_udf(run, "utc_micros long, ts_status string").asNondeterministic()  # else a filter on the result runs it twice
    out = joined.withColumn("__p", parsed(F.col(ts), F.col("__zone"), F.col("__order")))
    return out.select(*[F.col(f"`{c}`") for c in fields], F.col("__p.utc_micros").alias("utc_micros"), F.col("__p.ts_status").alias("ts_status"), F.lit(tz_version()).alias("tz_version"))
