import random
from datetime import datetime, timedelta

import pytest

from chatloom.operators.sessions import GAP_US, ConcurrentMerge, SessionTable, sessionise
from chatloom.runtime import scratch
from chatloom.streaming.sessions import merge_into, session_windows
from tests.conftest import rows

T0 = datetime(2024, 1, 1)
SCHEMA = "source_file string, message_id string, timestamp timestamp, sender string, received_at timestamp, duration_seconds string"


def brute(data):
    seen, by = {}, {}
    for f, i, t, s, r, _ in data:
        if t is not None and i is not None and i not in seen:
            seen[i] = 1
            by.setdefault(f, []).append((t, i, s))
    out = []
    for f, ms in by.items():
        ms.sort(key=lambda x: (x[0], x[1]))
        cur = [ms[0]]
        for a in ms[1:]:
            if a[0] - cur[-1][0] >= timedelta(hours=4):
                out.append((f, cur[0][1], cur[-1][1], len(cur)))
                cur = []
            cur.append(a)
        out.append((f, cur[0][1], cur[-1][1], len(cur)))
    return sorted(out, key=str)


def data(n, seed=1):
    r = random.Random(seed)
    out = []
    for k in range(n):
        f = r.choice(["a", "a", "a", "b", None])
        t = T0 + timedelta(minutes=r.choice([0, 60, 239, 240, 241]) * r.randint(0, 60))
        out.append((f, f"{f}:{k:05d}", r.choice([t, t, t, None]), r.choice(["x", "y", None]), r.choice([T0 + timedelta(hours=k), None]), None))
    return out + out[: n // 5]


def test_against_brute_force(spark):
    for n, batches in ((0, 2), (1, 1), (60, 1), (300, 2), (300, 4)):
        d = data(n)
        got = rows(sessionise(spark.createDataFrame(d, SCHEMA), batches=batches), "source_file", "first_message_id", "last_message_id", "message_count")
        assert got == brute(d)


def test_gap_is_exact(spark):
    ms = [("a", "1", T0), ("a", "2", T0 + timedelta(hours=4)), ("a", "3", T0 + timedelta(hours=8, microseconds=-1))]
    d = spark.createDataFrame([(f, i, t, "x", None, None) for f, i, t in ms], SCHEMA)
    assert rows(sessionise(d), "first_message_id", "last_message_id") == [("1", "1"), ("2", "3")]
    assert sorted(r["message_count"] for r in session_windows(d).collect()) == [1, 2]


def test_late_batch_bridges_and_repeats_do_nothing(spark):
    t = SessionTable(spark, scratch(spark, "t"), GAP_US, 4)
    ev = lambda *h: spark.createDataFrame([("k", f"m{x}", int(x * 3_600_000_000), "s") for x in h], "key string, id string, us long, actor string")
    t.merge(ev(0, 6))
    assert t.read().count() == 2
    t.merge(ev(3))
    assert rows(t.read(), "first_id", "last_id", "events") == [("m0", "m6", 3)]
    t.merge(ev(3))
    assert rows(t.read(), "events") == [(3,)]
    assert t.merge(ev(3).limit(0)) == []


def test_small_batch_replaces_few_files(spark):
    day = 24 * 3_600_000_000
    t = SessionTable(spark, scratch(spark, "few"), GAP_US, parts=4, slice_us=30 * day)
    ev = lambda *x: spark.createDataFrame([(f"k{k}", f"{k}:{d}", d * day, "s") for k, d in x], "key string, id string, us long, actor string")
    assert len(t.merge(ev(*[(k, d) for k in range(40) for d in range(0, 300, 10)]))) == 40  # 4 parts, 10 slices
    before = {f["path"] for f in t.manifest()["sessions"]}
    assert len(t.merge(ev((7, 155)))) == 1
    after = {f["path"] for f in t.manifest()["sessions"]}
    assert len(before - after) == 1 and len(after - before) == 1
    # a day outside all stored spans replaces nothing
    assert len(t.merge(ev((7, 1000)))) == 1 and len(t.manifest()["sessions"]) == 41
    assert t.read().count() == 40 * 30 + 2


def test_two_writers_from_one_manifest(spark):
    path = scratch(spark, "two")
    a, b = SessionTable(spark, path, GAP_US, 2), SessionTable(spark, path, GAP_US, 2)
    ev = lambda x: spark.createDataFrame([("k", x, 0, "s")], "key string, id string, us long, actor string")
    stale = b.manifest()
    a.merge(ev("m1"))
    b.manifest = lambda: stale
    with pytest.raises(ConcurrentMerge):
        b.merge(ev("m2"))
    assert rows(a.read(), "first_id", "events") == [("m1", 1)]


def test_ids_are_compared_by_value_and_lateness(spark):
    day = 24 * 3_600_000_000
    ev = lambda *x: spark.createDataFrame([("k", i, d * day, "s") for i, d in x], "key string, id string, us long, actor string")
    for late, want in ((None, 3), (5 * day, 4)):
        t = SessionTable(spark, scratch(spark, "late"), GAP_US, 2, lateness_us=late)
        t.merge(ev(("a", 0), ("b", 1)))
        t.merge(ev(("a", 30), ("c", 30)))  # a comes again with another time, 29 days after the newest id
        assert sum(r["events"] for r in t.read().collect()) == want


def test_stream_merges_like_batch(spark, tmp_path):
    d = data(200, 3)
    df = spark.createDataFrame(d, SCHEMA)
    df.where("message_id is not null").repartition(3).write.parquet(str(tmp_path / "in"))
    t = SessionTable(spark, scratch(spark, "s"), GAP_US, 4)
    s = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = s.writeStream.foreachBatch(merge_into(t)).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(t.read(), "key", "first_id", "last_id", "events") == brute(d)
