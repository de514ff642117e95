import inspect

import numpy as np
import pytest

from chatloom.functions.lexicons import DEFAULT
from chatloom.operators import evaluate as E
from chatloom.operators import profiles as P
from chatloom.operators import style as S
from chatloom.operators import topics as K
from chatloom.operators import vectors as V
from chatloom.plans import dataset
from chatloom.plans import profiles as plans
from pyspark.sql import functions as F
from tests.conftest import rows


def vecs(spark, n=75, d=16, seed=42):
    r = np.random.default_rng(seed)
    out = [(f"p{k:03d}", (np.eye(d)[k % 3] + 0.1 * r.normal(size=d)).tolist(), k % 3) for k in range(n)]
    return spark.createDataFrame(out, "pair_id string, v array<double>, cluster_id int")


def test_search_and_diversity(spark):
    v = vecs(spark)
    top = V.top_k(v, np.eye(16)[0].tolist(), 5).collect()
    assert all(int(r["pair_id"][1:]) % 3 == 0 for r in top)
    each = V.top_k_each(v, v.where("pair_id <= 'p002'"), 3)
    assert each.count() == 9 and each.where("query_id = pair_id").count() == 0
    x = np.array([r["v"] for r in v.collect()])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = (x @ x.T)[np.triu_indices(75, 1)]
    m = V.mean_similarity(v, dim=16).first()
    assert m["mean_similarity"] == pytest.approx(s.mean(), abs=1e-5)
    st = V.pair_similarity_stats(v).first()
    assert st["pairs"] == 2775 and st["std"] == pytest.approx(s.std(), abs=1e-5)
    assert V.usable(spark.createDataFrame([("a", None), ("b", [0.0]), ("c", [float("nan")]), ("d", [2.0])], "pair_id string, vectors array<double>"), dim=1).count() == 1
    e = V.encoded(spark.createDataFrame([(1, "hi there", "x"), (2, " ", "hi there"), (3, None, None)], "id int, text string, alt string"), V.hashed_words(8), "text", "alt")
    g = {r["id"]: r["v"] for r in e.collect()}
    assert g[1] == g[2] and set(g[3]) == {0.0}


def test_clustering(spark):
    v = vecs(spark)
    labels, centres, _ = K.kmeans(v, 3)
    j = v.join(labels.withColumnRenamed("cluster_id", "k"), "pair_id")
    assert j.groupBy("cluster_id").agg(F.count_distinct("k").alias("n")).where("n = 1").count() == 3 and len(centres) == 3
    a = K.agglomerative(v, 3).withColumnRenamed("cluster_id", "a").join(v, "pair_id")
    assert a.groupBy("cluster_id").agg(F.count_distinct("a").alias("n")).where("n = 1").count() == 3
    with pytest.raises(ValueError, match="at most"):
        K.agglomerative(v, 3, most=10)
    assert K.medoids(v, 2, dim=16).count() == 6 and K.calinski_harabasz(v, dim=16).first()["calinski_harabasz"] > 100


def test_terms_and_matrix(spark):
    d = spark.createDataFrame([(1, "exam homework exam", "a"), (1, "exam the", "b"), (2, "movie cake", "a"), (2, None, "a")], "t int, text string, s string")
    top = {r["t"]: r["term"] for r in K.class_terms(d, "t", "text").where("rank = 1").collect()}
    assert top == {1: "exam", 2: "cake"}
    m = K.style_by_topic(d, "t", "s")
    assert m.count() == 4 and rows(m.where("t = 2"), "s", "n", "dominant") == [("a", 2, True), ("b", 0, False)]


def test_mmr_skips_near_copies():
    v = np.array([[1, 0, 0, 0], [0.999, 0.04, 0, 0], [0.6, 0.8, 0, 0], [0, 0, 1, 0]], "float64")
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    assert S.mmr(v, v @ v[0], 2) == [0, 2] and S.mmr(v, v @ v[0], 9)[0] == 0 and len(S.mmr(v, v @ v[0], 9)) == 4 and S.mmr(v[:0], v[:0, 0], 3) == []


def test_exemplars_and_search(spark):
    v = vecs(spark).withColumn("word_count", F.pmod(F.crc32("pair_id"), F.lit(20)).cast("int") + 1).withColumn("target_text", F.col("pair_id"))
    e = S.exemplars(v, 8, dim=16)
    assert e.groupBy("cluster_id").count().where("count <= 8").count() == 3
    i = S.style_index(e.join(v.select("pair_id", "target_text"), "pair_id"), v, 16)
    r = S.search(i, np.eye(16)[1].tolist(), 3, category=1).collect()
    assert len(r) == 3 and all(int(x["pair_id"][1:]) % 3 == 1 for x in r)
    assert len(S.search(i, np.eye(16)[1].tolist(), 3, category=99).collect()) == 3
    both = i.withColumn("context_v", F.reverse("v"))
    by = {m: S.search(both, np.eye(16)[1].tolist(), 3, mode=m).orderBy("rank").first() for m in S.MODES}
    assert by["response"]["similarity"] > 0.9 and by["context"]["similarity"] < 0.5 and by["hybrid"]["similarity"] < by["response"]["similarity"]
    assert S.search(both, [0.0] * 16).count() == 0 and S.search(both.limit(0), np.eye(16)[1].tolist()).count() == 0
    with pytest.raises(ValueError):
        S.search(i, np.eye(16)[1].tolist(), mode="context")
    g = spark.createDataFrame([("",), ("ok!",), ("😂",), ("word",), ("two words",)], "t string").select(S.retrieval_gate(F.col("t")).alias("g"))
    assert [x["g"] for x in g.collect()] == ["empty", "trivial_ping", "no_words", "too_short", None]


def features(spark, *texts):
    d = spark.createDataFrame([(f"p{k}", t, c, 1) for k, (t, c) in enumerate(texts)], "pair_id string, target_text string, context_text string, message_count int")
    return P.turn_features(d).orderBy("pair_id").collect()


def test_features(spark):
    f = features(spark, ("NEVER!!", "Mira: why?"), ("kya hua party tonight", None), ("", ""), (None, None), ("because I think you should not worry about the exam tomorrow", "You: x"), ("😂😂", ""))
    assert f[0]["all_upper"] and f[0]["many_exclamations"] and f[0]["primary_act"] == "disagree" and f[0]["context_act"] == "question"
    assert f[1]["language"] == "code_switched" and f[1]["switches"] >= 1 and f[1]["primary_act"] == "question"
    assert f[2]["primary_act"] == f[3]["primary_act"] == "informative" and f[3]["clause"] == "fragment" and f[3]["situation"] == "casual_banter"
    assert f[4]["clause"] == "subordinate" and f[4]["first_person"] and f[4]["second_person"] and f[4]["has_modal"] and f[4]["primary_act"] == "explain"
    assert f[5]["emoji_only"] and f[5]["emoji_burst"] and f[5]["humor"] == 1.0
    assert all(0 <= r[d] <= 1 for r in f for d in P.DIMENSIONS)


def test_homograph_window(spark):
    w = F.array(*[F.lit(x) for x in ("tum", "main", "about", "the", "party", "so")])
    assert spark.range(1).select(P.raw_tags(w).alias("r")).select(P.tags(F.col("r")).alias("t")).first()["t"] == ["HIN", "HIN", "ENG", "ENG", "ENG", "ENG"]
    assert "main" in DEFAULT.homograph


EVAL = "strategy string, pair_id string, candidate string, target string, context string"


def test_pair_metrics_by_rule(spark):
    cases = [
        ("done.", "done", dict(punctuation=0.0, casing=1.0, length=1.0, jaccard=1.0, vocabulary=1.0)),
        ("done.", "done.", dict(punctuation=0.9)), ("done", "done.", dict(punctuation=0.7)),
        ("COME NOW PLEASE", "come now please", dict(casing=0.2, jaccard=1.0)), ("come", "Come", dict(casing=0.85)), ("Come", "come", dict(casing=0.5)), ("Come", "Go", dict(casing=1.0)),
        ("a b c", "a b", dict(length=0.75, jaccard=2 / 3)), ("a", "a b", dict(length=0.6, jaccard=0.5)), ("a b c d e f", "a", dict(length=0.0)),
        ("", "", dict(jaccard=1.0, length=1.0)), ("!!", "word", dict(jaccard=0.0)), (None, None, dict(jaccard=1.0, punctuation=1.0)),
        ("nothing here to say", "bhai sahi", dict(vocabulary=0.0)), ("bhai", "bhai sahi", dict(vocabulary=0.5)), ("nothing of that kind", "so what", dict(vocabulary=0.8)),
    ]
    d = spark.createDataFrame([("s", f"p{k:02d}", c, t, "") for k, (c, t, _) in enumerate(cases)], EVAL)
    for r, (c, t, want) in zip(E.pair_metrics(d).orderBy("pair_id").collect(), cases):
        for k, v in want.items():
            assert abs(r[k] - v) < 1e-9, (c, t, k, r[k])
        assert abs(r["composite"] - sum(r[k] * w for k, w in E.WEIGHTS.items())) < 1e-5
    e = E.pair_metrics(d.limit(1).withColumn("embedding", F.lit(-0.5))).first()
    assert e["embedding"] == 0.25


def test_failures_and_judge_by_rule(spark):
    long = " ".join(["bhai"] * 36)
    cases = [
        ("ok bhai", "ok", "", []), ("ok.", "ok", "", ["ERR_TRAILING_PERIOD"]), ("ok.", "ok.", "", []), ("Certainly bhai", "ok", "", ["ERR_ROBOTIC_AI"]), (long, "", "", ["ERR_TOO_VERBOSE"]),
        (" ".join(["ka"] * 16), "one two three", "", ["ERR_TOO_VERBOSE"]), (" ".join(["ka"] * 15), "one two three", "", []), ("perhaps kal", "x", "", ["ERR_HIGH_HEDGING"]), ("nice 🎉", "x", "", ["ERR_EXCESSIVE_EMOJI"]), ("😂😂😂😂", "x", "", ["ERR_EXCESSIVE_EMOJI"]),
        ("my phone is 9000043210", "x", "", ["ERR_HALLUCINATED_PII"]), ("COME NOW FAST", "x", "", ["ERR_CASING_MISMATCH"]), ("going now to buy fruit", "x", "", ["ERR_WRONG_LANGUAGE_MIX"]), ("going now to buy fruit", "x", "fix the api", []), (None, None, None, []),
    ]
    d = spark.createDataFrame([("s", f"p{k:02d}", *c[:3]) for k, c in enumerate(cases)], EVAL)
    got = E.judge(E.failures(d)).orderBy("pair_id").collect()
    assert [r["failure_codes"] for r in got] == [c[3] for c in cases]
    by = {(r["candidate"], r["context"]): r for r in got}
    assert by["ok bhai", ""]["judged"] == 4.9 and by["ok.", ""]["stylistic_adherence"] in (3.5, 5.0) and by["Certainly bhai", ""]["voice_authenticity"] == 1.0 and by["Certainly bhai", ""]["behavioral_consistency"] == 1.5
    assert by["perhaps kal", ""]["behavioral_consistency"] == 1.5 and by["my phone is 9000043210", ""]["epistemic_grounding"] == 1.0 and by["going now to buy fruit", "fix the api"]["situational_appropriateness"] == 3.5
    s = E.summary(E.pair_metrics(E.judge(E.failures(d)))).first()
    assert (s["turns"], s["failed"], s["clean"]) == (15, 10, 5) and s["top_failures"].startswith("ERR_EXCESSIVE_EMOJI=2,ERR_TOO_VERBOSE=2,")
    assert E.matrix(E.summary(E.pair_metrics(E.judge(E.failures(d))))).count("\n") == 2
    x = E.failure_examples(E.failures(d)).where("code = 'ERR_TOO_VERBOSE'").orderBy("rank").collect()
    assert [(r["pair_id"], r["rank"]) for r in x] == [("p04", 1), ("p05", 2)]


def test_three_of_one_clean_two_failed(spark):
    d = spark.createDataFrame([("s", "p1", "ha bhai", "ha", ""), ("s", "p2", "Certainly.", "ha", ""), ("s", "p3", "Perhaps we should.", "ha", "")], EVAL)
    s = E.summary(E.pair_metrics(E.judge(E.failures(d)))).first()
    assert (s["clean"], s["failed"]) == (1, 2) and s["top_failures"] == "ERR_TRAILING_PERIOD=2,ERR_HIGH_HEDGING=1,ERR_ROBOTIC_AI=1"


def test_behaviour_and_retrieval(spark):
    d = spark.createDataFrame([("s", "p1", "kya bhai", "kya bhai", ""), ("s", "p2", "Perhaps, dear friend, we might kindly see to that matter tomorrow", "haan", ""), ("s", "p3", None, "haan", "")], EVAL)
    t = E.behaviour(E.behaviour(d, "candidate", "c_"), "target", "t_")
    r = {x["pair_id"]: x for x in E.behaviour_gap(t, {k: 0.0 for k in E.BEHAVIOUR}).collect()}
    assert r["p1"]["c_directness"] == 1.0 and r["p1"]["c_question"] == 1.0 and r["p1"]["mae"] == round(sum(r["p1"]["c_" + k] / 2 for k in E.BEHAVIOUR) / 10, 6) and r["p1"]["behaviour_cosine"] == 1.0
    assert r["p2"]["c_hedging"] == r["p2"]["c_formality"] == 1.0 and r["p2"]["behaviour"] < r["p1"]["behaviour"]
    assert all(r["p3"]["c_" + k] == 0.0 for k in E.BEHAVIOUR) and r["p3"]["behaviour_cosine"] == round(1 - r["p3"]["mae"], 6)
    v = spark.createDataFrame([("a", [1.0, 0.0], "Come HERE!.."), ("b", [0.9, 0.1], "No"), ("c", [0.0, 1.0], "Why")], "pair_id string, v array<double>, response string")
    f = E.retrieved(v, v.where("pair_id <> 'b'"))
    assert rows(f, "pair_id", "example") == [("a", "c"), ("b", "a"), ("c", "a")]
    p = spark.createDataFrame([("b", "x", "Mira: hi\nMira: what now"), ("z", "y", None)], "pair_id string, target_text string, context_text string")
    c = {(x["pair_id"], x["strategy"]): x["candidate"] for x in E.candidate_texts(p, f).collect()}
    assert c["b", "retrieved"] == "come here" and c["z", "retrieved"] == "ok" and c["b", "echo"] == "what now" and c["z", "echo"] == ""
    assert E.retrieved(v.limit(0), v).count() == 0 and E.retrieved(v, v.limit(0)).count() == 0


def test_judge_prompt_and_replies(spark):
    q = spark.range(1).select(E.judge_prompt(F.lit(" yes "), F.lit("no"), F.lit(" ")).alias("q")).first()["q"]
    assert "(No prior context)" in q and q.endswith("Second response:\nyes\n") and all(a in q for a in E.AXES)
    r = spark.createDataFrame([('{"overall_score": 99, "voice_authenticity": -3}',), ("no json",), ("[1]",)], "r string")
    got = E.parse_judgement(r, "r").collect()
    assert got[0]["overall_score"] == 5.0 and got[0]["voice_authenticity"] == 1.0 and [x["offline"] for x in got] == [False, True, True]


def test_examples_are_chosen_from_all_candidates(spark):
    # 500 near copies of the typical row crowd out the four others wherever only the nearest are looked at
    d = 16
    v = [("p%03d" % k, (np.eye(d)[0] + 0.001 * np.eye(d)[1 + k % 8]).tolist()) for k in range(500)]
    v += [("q%d" % k, (0.6 * np.eye(d)[0] + 0.8 * np.eye(d)[9 + k]).tolist()) for k in range(4)]
    t = spark.createDataFrame([(i, x, 7, 10) for i, x in v], "pair_id string, v array<double>, cluster_id int, word_count int")
    got = [r["pair_id"] for r in S.exemplars(t, 8, dim=d).orderBy("rank").collect()]
    x = np.array([y for _, y in v])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    m = np.mean([y for _, y in v], axis=0)
    assert got == [v[k][0] for k in S.mmr(x, x @ (m / np.linalg.norm(m)), 4)] and sum(i[0] == "q" for i in got) == 3
    found = [r["pair_id"] for r in S.search(t, np.eye(d)[0].tolist(), 4).orderBy("rank").collect()]
    assert sum(i[0] == "q" for i in found) == 3


def test_cues_of_all_situations(spark, monkeypatch):
    d = spark.createDataFrame([("p0", "Ok", None, 1), ("p1", "nobody said ok \U0001f602\U0001f602", None, 1), ("p2", None, None, 1)], "pair_id string, target_text string, context_text string, message_count int")
    monkeypatch.setattr(plans, "_features", lambda spark, d_: P.turn_features(d))
    got = rows(plans.situation_cues_all(spark, ""), "family", "term", "uses")
    assert [g for g in got if g[0] in ("acknowledgement", "conflict_friction", "casual_banter")] == [("acknowledgement", "ok", 1), ("casual_banter", "\U0001f602", 2), ("conflict_friction", "nobody", 1)]


def test_sweeps_see_every_k(spark, monkeypatch):
    assert len(set(inspect.signature(K.kmeans).parameters["seeds"].default)) == 10 and inspect.signature(K.kmeans).parameters["iterations"].default == 300
    asked = []
    monkeypatch.setattr(K, "kmeans", lambda rows, k, seeds, key: asked.append((k, len(seeds))) or (vecs(spark).select("pair_id", "cluster_id"), [], 1.0))
    monkeypatch.setattr(dataset, "_vectors", lambda spark, d: vecs(spark, n=12, d=64).select("pair_id", "v"))
    assert {r["k"] for r in dataset.kmeans_sweep(spark, "").collect()} == set(range(6, 12)) and set(asked) == {(k, 10) for k in range(6, 12)}
    seen = []
    monkeypatch.setattr(K, "sweep", lambda rows, ks: seen.append(list(ks)))
    dataset.kmeans_sweep(spark, "")
    dataset.topic_sweep(spark, "")
    assert seen == [list(range(6, 19)), list(range(5, 13))]
