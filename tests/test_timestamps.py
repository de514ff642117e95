from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from chatloom.operators.timestamps import _mask, normalise_timestamps, parse, tz_version

US = 1_000_000


def one(text, zone="UTC", order=None):
    utc, status = parse(np.array([text], object), np.array([zone], object), np.array([order], object))
    return int(utc[0]) if status[0] == "ok" else status[0]


def micros(*a, zone="UTC", micro=0):
    return round(datetime(*a, tzinfo=ZoneInfo(zone)).timestamp()) * US + micro


def test_notations():
    want = micros(2024, 2, 22, 17, 41, 20)
    for t in ("2024-02-22 17:41:20", "2024-02-22T17:41:20Z", "20240222T174120", "22 Feb 2024 17:41:20", "Thu, 22 Feb 2024 17:41:20 GMT", "2024/02/22, 17:41:20", "1708623680", "1708623680000", " ‎2024-02-22T19:41:20+02:00 ", "2024-02-22 11:41:20 -0600", "2024-02-22T18:41:20+01", "2/22/24, 5:41:20 pm", "22/2/24, 5:41:20PM"):
        assert one(t) == want, t
    assert one("2024-02-22 17:41:20,796") == want + 796_000
    assert one("2024-02-22T17:41:20.000001") == want + 1
    assert one("Feb 22, 2024 5:41 PM") == want - 20 * US


def test_zones_and_clock_changes():
    assert one("2025-10-26 02:30", "Europe/Berlin") == "twice"
    assert one("2025-03-30 02:30", "Europe/Berlin") == "never"
    assert one("2025-10-26 02:30:00 CEST", "Europe/Berlin") == micros(2025, 10, 26, 0, 30)
    assert one("2025-10-26 02:30:00 CET", "Europe/Berlin") == micros(2025, 10, 26, 1, 30)
    assert one("2025-07-01 12:00:00 BST", "Europe/London") == micros(2025, 7, 1, 11)
    assert one("2025-07-01 12:00", None) == "no_zone"
    assert one("2025-07-01 12:00", "Nowhere/City") == "bad_zone"
    assert one("2025-07-01T12:00:00+05:30[Europe/Berlin]") == "no_date"  # name and offset disagree


def test_junk_and_impossible():
    assert [one(t) for t in ("2025-02-30 10:15:00", "2025-13-05 09:12:44", "2025-04-17 25:61:00", "0000-00-00 00:00:00", "13:30 PM")] == ["no_date"] * 4 + ["junk"]
    assert [one(t) for t in ("", None, "  ", "yesterday", "T09:30", "x" * 20000)] == ["empty", "empty", "empty", "junk", "junk", "junk"]


def test_order_of_day_and_month():
    assert one("03/04/2025, 05:22") == "ambiguous_order"
    assert one("03/04/2025, 05:22", "UTC", "dmy") == micros(2025, 4, 3, 5, 22)
    assert one("03/04/2025, 05:22", "UTC", "mdy") == micros(2025, 3, 4, 5, 22)
    assert one("04/04/2025, 05:22") == micros(2025, 4, 4, 5, 22)


@settings(max_examples=60, deadline=None)
@given(st.datetimes(datetime(1850, 1, 1), datetime(3500, 1, 1)), st.sampled_from(["Europe/Berlin", "America/New_York", "Asia/Kathmandu", "Australia/Sydney", "America/Sao_Paulo"]))
def test_against_zoneinfo(t, zone):
    z = ZoneInfo(zone)
    real = {u for f in (0, 1) if (u := t.replace(tzinfo=z, fold=f).astimezone(timezone.utc)).astimezone(z).replace(tzinfo=None) == t}
    got = one(t.strftime("%Y-%m-%d %H:%M:%S.%f"), zone)
    if len(real) == 1:
        assert got == (real.pop() - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    else:
        assert got == ("twice" if real else "never")


def test_years_far_from_now():
    assert one("1985-07-15 12:00", "Europe/London") == micros(1985, 7, 15, 11)
    assert one("1970-01-01 00:00", "Europe/London") == micros(1969, 12, 31, 23)
    assert one("15/07/1985, 12:00", "America/New_York") == micros(1985, 7, 15, 16)
    assert one("2150-07-15 12:00", "Europe/London") == micros(2150, 7, 15, 11)
    assert one("9999-07-15 12:00", "Europe/London") == micros(9999, 7, 15, 11)
    assert one("1971-02-01 12:00:00 BST", "Europe/London") == micros(1971, 2, 1, 11)
    # one abbreviation, two offsets
    assert one("2012-06-01 12:00:00 MSK", "Europe/Moscow") == micros(2012, 6, 1, 8)
    assert one("2020-06-01 12:00:00 MSK", "Europe/Moscow") == micros(2020, 6, 1, 9)


def test_masks_are_shapes():
    assert _mask("thu, 22 feb 2024 17:41:20 gmt") == _mask("fri, 03 mar 2025 09:00:00 ist") == "aaa, 00 aaa 0000 00:00:00 aaa"
    assert one("Xyz, 22 Feb 2024 17:41:20 GMT") == "junk" and one("22 Foo 2024 17:41:20") == "junk" and one("2024-02-22X17:41:20") == "junk"
    assert one("2024-02-22 05:41 xm") == "junk" and one("2024-02-22 05:41 pm UTC") == micros(2024, 2, 22, 17, 41) and one("2024-02-22 05:41:00Q") == "junk"
    assert one("Fri, 22 Feb 2024 17:41:20 GMT") == "no_date"
    got = parse(np.array(["1 Jan 2024 1:00 pm", "2 Feb 2025 2:30 am", "3 Foo 2025 2:30 am"], object), np.array(["UTC"] * 3, object), np.array([None] * 3, object))
    assert list(got[1]) == ["ok", "ok", "junk"] and list(got[0][:2]) == [micros(2024, 1, 1, 13), micros(2025, 2, 2, 2, 30)]


def test_operator(spark):
    m = spark.createDataFrame([(1, "13/02/2025, 10:00", "a", "x"), (2, "03/02/2025, 10:00", "a", "x"), (3, None, "a", None), (4, "2025-01-01 00:00", None, "x"), (1, "13/02/2025, 10:00", "a", "x")], "uid long, timestamp string, source_file string, utc_micros string")
    f = spark.createDataFrame([("a", "UTC"), ("b", None)], "source_file string, time_zone string")
    got = normalise_timestamps(m, f)
    assert got.select("tz_version").distinct().collect()[0][0] == tz_version()
    out = {(r["uid"], r["utc_micros"], r["ts_status"]) for r in got.collect()}
    assert out == {(1, micros(2025, 2, 13, 10), "ok"), (2, micros(2025, 2, 3, 10), "ok"), (3, None, "empty"), (4, None, "no_zone")}
    assert normalise_timestamps(m.limit(0), f.limit(0)).count() == 0
