from datetime import datetime, timedelta

from chatloom.llm.runs import collapse_runs, known_words, osa, same_words
from tests.conftest import rows

T0 = datetime(2024, 1, 1)
SCHEMA = "source_file string, message_id string, timestamp timestamp, sender string, text string, received_at timestamp, message_count int"


def table(spark, items):
    return spark.createDataFrame([(f, f"{f}:{k:04d}", T0 + timedelta(minutes=m), s, t, None, 9) for k, (f, m, s, t) in enumerate(items)], SCHEMA)


def found(df, **kw):
    return rows(collapse_runs(df, **kw), "first_message_id", "last_message_id", "message_count", "duration_seconds")


def test_runs(spark):
    base = [("z", k, "w", f"we missed the {x} again") for k, x in enumerate(["bus", "cake"] * 40)]
    items = [("a", 0, "x", "See you soon"), ("a", 1, "x", "see you SOON!! 😂"), ("a", 2, "x", "see you soon (again)"), ("a", 3, "y", "see you soon"), ("a", 4, None, "hm"), ("a", 5, None, "hm"), ("a", 6, "x", "room 12"), ("a", 7, "x", "room 13"),
             ("a", 8, "x", None), ("a", 9, "x", None), ("a", 10, "x", "😂"), ("a", 11, "x", "😂 🎉"), ("a", 12, "x", "<image omitted>"), ("a", 13, "x", "<image omitted>"), ("a", 20, "x", "soooo"), ("a", 21, "x", "so")]
    got = found(table(spark, items + base))
    assert got == [("a:0000", "a:0002", 3, 120.0), ("a:0010", "a:0011", 2, 60.0), ("a:0012", "a:0013", 2, 60.0), ("a:0014", "a:0015", 2, 60.0)]


def test_slips_need_a_known_word(spark):
    items = [("k", k, str(k % 7), f"we missed the {x} again") for k, x in enumerate(["bus", "charger"] * 60)]
    items += [("a", 0, "x", "we missed the charger again"), ("a", 1, "x", "we missed teh charger again"), ("a", 2, "x", "we missed the chagrer again"), ("a", 3, "x", "we missed the bus again")]
    assert [r[:3] for r in found(table(spark, items)) if r[0].startswith("a")] == [("a:0120", "a:0122", 3)]


def test_gap_and_buckets(spark):
    # one run over many buckets, an equal text a gap later, and the rows delivered twice
    items = [("a", 230 * k, "x", "still here") for k in range(30)] + [("a", 230 * 29 + 240, "x", "still here")]
    t = table(spark, items)
    want = [("a:0000", "a:0029", 30, 29 * 230 * 60.0)]
    assert found(t.union(t)) == want
    assert found(t, bucket_gaps=2) == want
    assert found(t.limit(0)) == []
    assert len(found(t, least=1)) == 2


def test_words():
    known = {w: 1000 for w in "we missed the charger again bus".split()}
    assert osa("ab", "ba", 1) == 1 and osa("abc", "xyz", 1) == 2
    assert same_words("we missed the charger again", "we missed thecharger again", known)
    assert not same_words("room 12", "room 13", known)
    assert not same_words("we missed the bus again", "we missed the charger again", known)


def test_slips_of_a_long_message(spark):
    # four words with swapped letters are eight edits of the whole message
    good, bad = "please bring the charger from the kitchen before dinner tomorrow", "plaese bring the chagrer from the kicthen before dinenr tomorrow"
    base = [("k", k, str(k % 7), good) for k in range(5)]
    items = [("a", 0, "x", good), ("a", 1, "x", bad), ("a", 9, "y", good), ("a", 10, "y", "please bring the chargerfrom thekitchen before dinner to morrow")]
    assert [r[:3] for r in found(table(spark, base + items)) if r[0].startswith("a")] == [("a:0005", "a:0006", 2), ("a:0007", "a:0008", 2)]


def test_known_words_do_not_depend_on_size(spark):
    words = spark.range(100_000).selectExpr("'the bus' as one").unionByName(spark.createDataFrame([("charger",)] * 3 + [("twice",)] * 2, "one string"))
    assert known_words(words) == {"the": 100_000, "bus": 100_000, "charger": 3}
    # slips seen often enough to be known are still slips of the frequent word
    known = {"charger": 1000, "chagrer": 4, "chargr": 5, "lamp": 1000, "lamb": 900}
    assert same_words("bring the chagrer", "bring the chargr", known) and not same_words("bring the lamp", "bring the lamb", known)
