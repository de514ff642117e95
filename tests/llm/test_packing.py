import random

from hypothesis import given, settings
from hypothesis import strategies as st

from chatloom.llm.packing import best_fit, pack, token_counts


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_best_fit(sizes):
    bins = best_fit([(n, str(k)) for k, n in enumerate(sizes)], 100)
    assert sorted(x for _, b in bins for x in b) == sorted(map(str, range(len(sizes))))
    assert all(u == sum(sizes[int(x)] for x in b) <= 100 for u, b in bins)
    assert sum(2 * u <= 100 for u, _ in bins) <= 1


def test_pack(spark):
    r = random.Random(1)
    d = [(k, r.choice([10, 200, 900, 1500, 2048, 2049, 5000, 0])) for k in range(600)] + [(None, 5), (1000, None), (5000, 300), (5000, 300)]
    sizes = spark.createDataFrame(d, "doc_id long, tokens long")
    out = pack(sizes, "doc_id", "tokens", items_per_group=40).collect()
    used = {}
    for x in out:
        used[x["container"]] = used.get(x["container"], 0) + x["tokens"]
        assert x["tokens"] == 2048 or not any(o["doc_id"] == x["doc_id"] and o["piece"] > x["piece"] for o in out)
    total = sum(n for k, n in d if k is not None and n)
    assert sum(used.values()) == total and max(used.values()) <= 2048
    assert len(used) <= 1.06 * -(-total // 2048)
    assert pack(sizes.limit(0), "doc_id", "tokens").count() == 0


def test_tokens(spark):
    t = spark.createDataFrame([(1, "hello hello"), (2, None), (3, ""), (4, "<|endoftext|>")], "doc_id long, text string")
    n = {r["doc_id"]: r["tokens"] for r in token_counts(t).collect()}
    assert n[1] == 2 and n[2] == n[3] == 0 and n[4] > 1
