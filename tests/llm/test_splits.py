import random

from chatloom.llm.splits import deal, grouped_split, linked_values, spanning_forest
from tests.conftest import rows

KEYS = ["source_file", "conversation_id", "pair_id"]
SCHEMA = "source_file string, conversation_id string, pair_id string, split int"


def brute(data):
    par = {}

    def f(x):
        while par.setdefault(x, x) != x:
            x = par[x]
        return x

    files = {}
    for r in data:
        n = [(i, v.strip().lower()) for i, v in enumerate(r[:3]) if v and v.strip()]
        for a in n[1:]:
            par[f(a)] = f(n[0])
        if r[0] and r[0].strip():
            files[r[0]] = n[0]
    return sorted((a, b) for a in files for b in files if a < b and f(files[a]) == f(files[b]))


def data(n, m, seed=0):
    r = random.Random(seed)
    spell = lambda s: r.choice([s, s.upper(), f" {s} "])
    return [(r.choice([None, *[f"f{r.randint(0, m)}"] * 5]), r.choice([None, spell(f"c{r.randint(0, m * 3)}")]), r.choice([None, spell(f"p{r.randint(0, m * 8)}")]), 7) for _ in range(n)]


def test_links_against_union_find(spark):
    for n, m in ((0, 1), (1, 1), (40, 12), (120, 60), (300, 300)):
        d = data(n, m, n)
        assert rows(linked_values(spark.createDataFrame(d, SCHEMA), "source_file", KEYS)) == brute(d)


def test_forest_has_no_circles(spark):
    r = random.Random(1)
    e = {tuple(sorted((f"n{r.randint(0, 60):02d}", f"n{r.randint(0, 60):02d}"))) for _ in range(90)}
    e = [x for x in e if x[0] != x[1]]
    forest, comp = spanning_forest(spark.createDataFrame(e, "a string, b string"))
    nodes, roots = len({x for p in e for x in p}), len({r["root"] for r in comp.collect()})
    assert forest.count() == nodes - roots


def test_split_keeps_together_and_near_shares(spark):
    d = [(f"f{k}", f"c{k}", f"p{k}", 1) for k in range(3000)] + [("big", "b", f"q{k}", 1) for k in range(1500)] + [(None, None, None, 1)] * 3 + [("f1", "c2", "p3", 1)]
    out = grouped_split(spark.createDataFrame(d, SCHEMA), KEYS)
    assert out.count() == len(d)
    assert out.groupBy("component").agg({"split": "min"}).count() == out.select("component", "split").distinct().count()
    n = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert abs(n["train"] / len(d) - 0.7) < 0.01 and abs(n["dev"] / len(d) - 0.15) < 0.01
    assert len(out.where("source_file in ('f1', 'f2', 'f3')").select("component").distinct().collect()) == 1
    assert [d.count() for d in deal(spark.createDataFrame([], "component string, n long"))] == [0, 0]
