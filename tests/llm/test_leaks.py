import random

from chatloom.llm.leaks import find_leaks
from tests.conftest import rows

R = random.Random(4)
VOCAB = ["".join(R.choice("bcdfghklmnprstvz") + R.choice("aeiou") for _ in range(R.randint(2, 4))) for _ in range(800)]
ITEMS = [(k, " ".join(R.choice(VOCAB) for _ in range(60)) + ". Answer as the writer would.") for k in range(20)] + [(98, None), (99, "")]


def other(n):
    return " ".join(R.choice(VOCAB) for _ in range(n))


def test_leaks(spark):
    w = {k: t.split(". ")[0].split() for k, t in ITEMS if t}
    altered = list(w[2][5:50])
    altered[7] = altered[7][1] + altered[7][0] + altered[7][2:]
    altered.insert(20, altered[20])
    del altered[30]
    docs = [
        (1, other(50) + " " + " ".join(w[0]) + " " + other(50)), (2, other(10) + " " + " ".join(w[1][10:46]) + " " + other(10)), (3, other(9) + " " + " ".join(altered) + " " + other(9)),
        (4, other(10) + " " + " ".join(w[3][10:43]) + " " + other(10)), (5, other(100) + " Answer as the writer would."), (6, None), (7, " "), (8, " ".join(w[4]).upper().replace("A", "А")), (9, " ".join(w[0]) + " " + " ".join(w[5])), (9, " ".join(w[0]) + " " + " ".join(w[5])),
    ]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(find_leaks(d, i).distinct(), "doc_id", "item_id") == [(1, 0), (2, 1), (3, 2), (8, 4), (9, 0), (9, 5)]
    r = find_leaks(d.where("doc_id = 1"), i).first()
    assert docs[0][1][r["start"] : r["end"]] == " ".join(w[0]) and r["words"] == 60
    assert find_leaks(d, i.limit(0)).count() == 0 and find_leaks(d.limit(0), i).count() == 0


def test_shared_and_repeating_passages(spark):
    shared, verse = other(40), "ab cd ef gh " * 15
    items = [(k, f"{shared}. {other(8)}?") for k in range(6)] + [(6, verse)]
    docs = [(1, f"{other(9)} {shared} {other(9)}"), (2, f"{other(9)} {verse} {other(9)}"), (3, f"{other(9)} {' '.join(shared.split()[:20])} {other(30)}")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows(find_leaks(d, i), "doc_id", "item_id") == [(1, k) for k in range(6)] + [(2, 6)]
