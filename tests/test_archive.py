import random
from datetime import datetime, timedelta

import pytest

from chatloom.functions import masking
from chatloom.functions import text as T
from chatloom.operators import archive as A
from chatloom.operators import conversations as C
from chatloom.operators import dataset as D
from chatloom.sources import exports as X
from pyspark.sql import functions as F
from tests.conftest import rows

T0 = datetime(2024, 1, 1, 10)


def test_parse_export(spark, tmp_path):
    (tmp_path / "b.txt").write_text("preamble\n\n[9/5/26, 7:31:22 PM] You: hello: there\nsecond line\n\nthird\n[05/09/2026, 19:31] Mira: <image omitted>\n[13/09/2026, 19:31] Messages and calls are end-to-end encrypted.\n[9/5/26, 7:31 PM] You: [Forwarded] look\n[99/99/26, 7:31 PM] Jo:x\n", encoding="utf-8")
    (tmp_path / "a.log").write_text("[9/5/26, 7:31 PM] You: not read\n")
    lines = X.lines(X.read_exports(spark, str(tmp_path)))
    m = sorted(X.parse(lines).collect(), key=lambda r: r["message_id"])
    assert [(r["sender"], r["text"], r["message_type"], r["raw_line_start"], r["raw_line_end"]) for r in m] == [
        ("You", "hello: there\nsecond line\n\nthird", "text", 3, 6), ("Mira", "<image omitted>", "image", 7, 7), (None, "Messages and calls are end-to-end encrypted.", "system", 8, 8), ("You", "[Forwarded] look", "text", 9, 9), ("Jo", "x", "text", 10, 10),
    ]
    assert [r["timestamp"] for r in m[:3]] == [datetime(2026, 9, 5, 19, 31, 22), datetime(2026, 5, 9, 19, 31), datetime(2026, 9, 13, 19, 31)] and m[4]["timestamp"] is None
    assert m[3]["is_forwarded"] and len(m[4]["parse_warnings"]) == 1 and m[2]["parse_warnings"] == []
    assert rows(X.issues(lines), "line_no", "line") == [(1, "preamble")]
    assert [r["message_id"] for r in sorted(X.canonical(X.parse(lines)).collect(), key=lambda r: r["message_id"])][0] == "b.txt:00000001"
    n = X.nested_results(X.parse(lines), X.issues(lines))
    X.write_table(n, str(tmp_path / "out"), "json")
    assert X.load_nested(spark, str(tmp_path / "out")).count() == 5
    with pytest.raises(Exception, match="(?i)path"):
        X.read_exports(spark, str(tmp_path / "none")).collect()


def test_tolerant_json(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": "a"}\n\nnot json\n{"id": "b"}\n')
    r = X.tolerant_json_lines(spark, str(tmp_path), "id string").orderBy("line_no").collect()
    assert [(x["line_no"], x["malformed"]) for x in r] == [(1, None), (3, "not json"), (4, None)]


def test_cached_stage(spark, tmp_path):
    made = []

    def build():
        made.append(1)
        return spark.range(3)

    for c in ({"k": 1}, {"k": 1}, {"k": 2}):
        assert X.cached_stage(spark, str(tmp_path), c, build).count() == 3
    assert len(made) == 2


def test_large_files_are_split(spark, tmp_path):
    text = "".join(f"[9/5/26, 7:{k % 60:02d}:{k // 60 % 60:02d} PM] {'You' if k % 3 else 'Mira'}: line {k}\nmore {k}\x0bstill {k}\n" for k in range(3000))
    (tmp_path / "big.txt").write_text("before\n" + text, encoding="utf-8")
    (tmp_path / "two words.txt").write_text("[9/5/26, 7:31 PM] You: hi", encoding="utf-8")
    (tmp_path / "no.log").write_text("x")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        n = X.read_lines(spark, str(tmp_path))
        whole = X.lines(X.read_exports(spark, str(tmp_path)))
        assert rows(n.where("source_file = 'big.txt'")) == rows(whole.where("source_file = 'big.txt'")) and n.where("source_file = 'two words.txt'").count() == 1
        m, bad = X.read_messages(spark, str(tmp_path))
        assert m.count() == 3001 and bad.count() == 1 and m.where("source_file = 'big.txt'").agg({"raw_line_end": "max"}).first()[0] == 9001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_vectors_with_their_record(spark, tmp_path):
    v = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0])], "pair_id string, v array<double>")
    assert X.write_vectors(v, str(tmp_path / "v"), "hashed") == {"model": "hashed", "vectors": 2, "dimension": 2}
    back, meta = X.read_vectors(spark, str(tmp_path / "v"))
    assert rows(back) == [("a", [1.0, 2.0]), ("b", [3.0, 4.0])] and meta["model"] == "hashed"
    with pytest.raises(ValueError):
        X.write_vectors(v.unionByName(spark.createDataFrame([("c", [1.0])], v.schema)), str(tmp_path / "w"), "hashed")


def test_conversations_in_small_blocks(spark, monkeypatch):
    r = random.Random(3)
    t0 = datetime(2024, 1, 1)
    ms = [("f", f"m{k:03d}", t0 + timedelta(minutes=3 * k), r.choice(["You", "You", "Mira", "Mira", "Oren", None]), f"t{k}") for k in range(200)] + [("f", "z", t0 + timedelta(days=2), None, "last")]
    d = spark.createDataFrame(ms, "source_file string, message_id string, timestamp timestamp, sender string, text string")
    sess = C.conversations(d)
    assert [x["seq"] for x in sess.where("session_index = 1").orderBy("seq").collect()] == list(range(1, 201)) and sess.where("session_index = 1").select("bucket").distinct().count() == 3
    turns, cur = [], None
    for k, (_, i, _, s, t) in enumerate(ms[:200]):
        if s is None:
            cur = None
            if k < 199:
                continue
        if cur and cur[0] == s:
            cur[1].append(i)
        else:
            cur = [s, [i]]
            turns.append(cur)
    monkeypatch.setattr(C, "BLOCK", 7)
    for x in (sess, sess.drop("bucket")):  # buckets of time, and blocks of seven messages
        got = C.turns(x).where("conversation_id = 'f:c00001'").orderBy("turn_id").collect()
        assert [(g["speaker"], g["message_ids"]) for g in got] == [(a, b) for a, b in turns] and [g["turn_id"] for g in got] == list(range(1, len(turns) + 1))
    assert C.turns(sess).where("conversation_id = 'f:c00002'").count() == 1
    t = C.turns(sess)
    assert rows(C.context_pairs(t, block=5)) == rows(C.context_pairs(t, block=10_000))


def test_masking(spark):
    t = ["see https://x.example/a?b=1.", "mail a.b@example.org now", "password is hunter2, ok", "pay me: some.one@okaxis", "card 1234 5678 9012 3456", "otp is 123456", "call +91 90000 12345", "id 12", None, "[EMAIL] already"]
    out = masking.sanitized(spark.createDataFrame([(x,) for x in t], "text string")).collect()
    assert [r["text"] for r in out] == ["see [URL].", "mail [EMAIL] now", "password is [CREDENTIAL], ok", "pay me: [UPI_ID]", "card [FINANCIAL_ID]", "otp is [OTP]", "call [PHONE_NUMBER]", "id 12", None, "[EMAIL] already"]
    assert [r["pii_detected"] for r in out][:2] == [["url"], ["email"]] and out[9]["pii_detected"] == [] and not out[8]["original_text_masked"]


def test_cleaning(spark):
    d = spark.createDataFrame([("a​ b\r\n\r\n\r\n\r\nc\t\td  ", ), ("[Forwarded] soooo good!!!😂 NASA",), ("",)], "t string")
    r = d.select(T.views(F.col("t")).alias("v")).collect()
    assert r[0]["v"]["normalized_text"] == "a b\n\nc d"
    v = r[1]["v"]
    assert v["analysis_text"] == "soo good !!! 😂 NASA"
    m = v["tokenized_text"]["style_markers"]
    assert m["all_caps_words"] == ["NASA"] and m["punctuation_clusters"] == ["!!!"] and m["emojis"] == ["😂"]
    assert tuple(m["elongated_words"][0]) == ("soooo", "so", "o", 4)


def msgs(spark, items):
    s = "message_id string, source_file string, timestamp timestamp, sender string, text string"
    return spark.createDataFrame([(f"{f}:{k}", f, T0 + timedelta(seconds=s_), who, t) for k, (f, s_, who, t) in enumerate(items)], s)


def test_sessions_turns_pairs(spark):
    m = msgs(spark, [("a", 0, "Mira", "hi"), ("a", 5, "Mira", "there"), ("a", 10, None, "x"), ("a", 20, "You", "yes"), ("a", 45, "Mira", "ok"), ("a", 70, "You", "bye"), ("a", 70 + 4 * 3600, "You", "new"), ("a", 80 + 4 * 3600, None, "left"), ("b", 75, "You", "other file")])
    t = C.turns(C.conversations(m))
    assert rows(t, "conversation_id", "turn_id", "speaker", "text") == [("a:c00001", 1, "Mira", "hi\nthere"), ("a:c00001", 2, "You", "yes"), ("a:c00001", 3, "Mira", "ok"), ("a:c00001", 4, "You", "bye"), ("a:c00002", 1, "You", "new"), ("a:c00002", 2, None, "left"), ("b:c00001", 1, "You", "other file")]
    p = {r["pair_id"]: r for r in C.context_pairs(t).collect()}
    assert p["a:c00001:p0002"]["response_latency_seconds"] == 25.0 and p["a:c00001:p0002"]["context_depth"] == 3
    assert p["a:c00001:p0001"]["context_text"] == "Mira: hi\nthere" and p["b:c00001:p0001"]["is_initiation"]
    h = {r["conversation_id"]: r for r in C.headers(C.conversations(m)).collect()}
    assert h["a:c00001"]["duration_seconds"] == 70 and h["a:c00001"]["participants"] == "Mira|You" and h["a:c00001"]["initiator"] == "Mira"
    assert C.turns(C.conversations(m.limit(0))).count() == 0


def test_duplicates_and_order(spark):
    s = "message_id string, source_file string, timestamp timestamp, sender string, text string, message_type string, is_system boolean, is_media boolean, is_forwarded boolean, raw_line_start int, raw_line_end int, parse_warnings array<string>, received_at timestamp"
    d = [("m1", "a", T0, "x", "t", "text", False, False, False, 1, 2, [], T0), ("m1", "a", T0, "x", "t", "text", False, False, False, 1, 2, [], None), ("m2", "a", None, None, "", "odd", None, False, False, 2, 1, ["w"], None), ("m3", "a", T0 - timedelta(1), "x", "t", "text", False, False, False, 5, 5, [], None)]
    m = spark.createDataFrame(d, s)
    once = A.deliver_once(m)
    assert once.count() == 3 and once.where("message_id = 'm1'").first()["received_at"] == T0
    assert rows(A.row_issues(once).where("message_id = 'm2'"), "issue") == [(x,) for x in ("bad_line_end", "empty_text", "missing_flag", "missing_sender", "missing_timestamp", "parse_error", "unexpected_type")]
    assert rows(A.order_issues(once), "message_id", "issue") == [("m2", "line_overlap"), ("m3", "timestamp_backward")]
    assert A.status(A.row_issues(once)).first()["status"] == "FAIL" and A.status(A.row_issues(once).limit(0)).first()["status"] == "PASS"
    assert rows(A.duplicates(m), "copies") == [(2,)]
    assert A.missing_fields(spark.createDataFrame([('{"text": 1}',), ("no",)], "value string"), required=("text", "id")).collect()[0]["missing"] == ["id"]


def test_filter_sample_split(spark):
    why = {"": "empty_response", "<image omitted>": "pure_media_response", "[URL]": "pure_url_response", "...": "punctuation_ping", "ha": None, "😂": None, None: "empty_response", "- You added x": "system_event_response", "[Forwarded]": "empty_analysis_text"}
    d = spark.createDataFrame([(k,) for k in why], "t string").select("t", D.drop_reason(F.col("t")).alias("r"))
    assert {r["t"]: r["r"] for r in d.collect()} == why
    p = spark.createDataFrame([(f"p{k}", f"c{k % 10}", "s" if k < 60 else "t", k % 12 == 0, "w " * (k % 30)) for k in range(66)], "pair_id string, conversation_id string, source_file string, is_initiation boolean, target_text string")
    s = D.stratified_sample(p, 20)
    n = {r["source_file"]: r["count"] for r in s.groupBy("source_file").count().collect()}
    assert n == {"s": 20, "t": 6} and s.where("source_file = 's' and is_initiation").count() == 5
    m = D.conversation_split(p.select("pair_id", "conversation_id", F.lit("one").alias("source_file")))
    assert {r["split"]: r["count"] for r in m.groupBy("split").count().collect()} == {"train": 6, "dev": 2, "test": 2}
    assert D.leakage(D.split_pairs(p, m)).count() == 0 and D.split_pairs(p.withColumn("conversation_id", F.lit(None).cast("string")), m).where("split = 'train'").count() == 66
    with pytest.raises(ValueError, match="add up"):
        D.conversation_split(p, 0.8, 0.8)
