import numpy as np
import pytest

from chatloom.operators import topics as K
from chatloom.operators.lloyd import Blocks
from chatloom.plans import dataset
from pyspark.sql import functions as F


def frame(spark, x):
    return spark.createDataFrame([("p%04d" % i, v.tolist()) for i, v in enumerate(x)], "pair_id string, v array<double>")


def blobs(n=240, groups=8, d=64, seed=3):
    """Groups of equal size along axes of their own."""
    r = np.random.default_rng(seed)
    return np.eye(d)[np.arange(n) % groups] + 0.03 * r.normal(size=(n, d))


def jobs(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    got = work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return got, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def swept_together(spark, monkeypatch, query):
    """A pass over the vectors serves every run: far fewer jobs than fits times rounds."""
    monkeypatch.setattr(dataset, "_vectors", lambda spark, d: frame(spark, blobs()))
    got, n = jobs(spark, query, lambda: [tuple(r) for r in getattr(dataset, query)(spark, "").collect()])
    assert n < 130, n
    return got


def test_best_cluster_k(spark, monkeypatch):
    got = swept_together(spark, monkeypatch, "best_cluster_k")
    assert [g[0] for g in got] == [8] and got[0][2] > 0.9


def test_best_topic_k(spark, monkeypatch):
    got = swept_together(spark, monkeypatch, "best_topic_k")
    assert [g[0] for g in got] == [8] and got[0][2] > 0.9


def test_kmeans_sweep(spark, monkeypatch):
    got = swept_together(spark, monkeypatch, "kmeans_sweep")
    assert [g[0] for g in got] == list(range(6, 19)) and max(got, key=lambda g: g[2])[0] == 8


def test_topic_sweep(spark, monkeypatch):
    got = swept_together(spark, monkeypatch, "topic_sweep")
    assert [g[0] for g in got] == list(range(5, 13)) and max(got, key=lambda g: g[2])[0] == 8


def test_fits_are_the_rows_own_optimum(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    r = np.random.default_rng(5)
    x = r.normal(size=(700, 64)) * r.choice([1, 9], size=(700, 1), p=[0.97, 0.03])
    d = frame(spark, x).repartition(5).cache()
    swept = {s["k"]: s for s in K.sweep(d, (2, 5)).collect()}
    for k in (2, 5):
        labels, unit, cost = K.kmeans(d, k)
        b = Blocks(d, "pair_id")
        c = b.fit([k], K.SEEDS, K.ITERATIONS)[k]["centres"] + b.origin
        far = ((x[:, None] - c[None]) ** 2).sum(2)
        own = far.argmin(1)
        assert cost == pytest.approx(far.min(1).sum(), rel=1e-9) and swept[k]["inertia"] == pytest.approx(cost, rel=1e-9)
        assert max(np.linalg.norm(x[own == i].mean(0) - c[i]) for i in range(k)) < 1e-3  # means of their rows: at rest
        assert {a["pair_id"]: a["cluster_id"] for a in labels.collect()} == {"p%04d" % i: int(o) for i, o in enumerate(own)}
        j = d.join(labels, "pair_id").withColumn("features", array_to_vector("v"))
        assert swept[k]["silhouette"] == pytest.approx(ClusteringEvaluator(predictionCol="cluster_id", distanceMeasure="cosine").evaluate(j), abs=1e-4)
        assert swept[k]["calinski_harabasz"] == pytest.approx(K.calinski_harabasz(j).first()["calinski_harabasz"], abs=1e-3)
        assert np.allclose(np.linalg.norm(unit, axis=1), 1)
    other = [KMeans(k=5, seed=s, maxIter=300).fit(j).summary.trainingCost for s in K.SEEDS[:3]]
    assert swept[5]["inertia"] < min(other) * 1.02


def test_runs_depend_on_no_partition_and_no_other_k(spark):
    d = frame(spark, np.random.default_rng(6).normal(size=(500, 16)))
    one = Blocks(d.repartition(1), "pair_id").fit([4], (1, 2, 3), 300)[4]
    two = Blocks(d.repartition(7), "pair_id").fit([3, 4, 6], (1, 2, 3), 300)[4]
    assert one["cost"] == pytest.approx(two["cost"], rel=1e-12) and np.allclose(one["centres"], two["centres"])


@pytest.mark.parametrize("scale, shift", [(1.0, 1e5), (1e-30, 0.0), (1e60, 0.0)])
def test_runs_end_in_double_precision(spark, scale, shift):
    x = (blobs(n=80, groups=4, d=8)[1:] + shift) * scale
    f = Blocks(frame(spark, x), "pair_id").fit([4], K.SEEDS, K.ITERATIONS)[4]
    own = np.arange(1, 80) % 4
    assert f["cost"] == pytest.approx(sum(((x[own == g] - x[own == g].mean(0)) ** 2).sum() for g in range(4)), rel=1e-4)


def test_few_rows(spark):
    assert K.kmeans(frame(spark, np.ones((1, 3))).limit(0), 3)[0].count() == 0 and K.sweep(frame(spark, np.ones((1, 3))).limit(0), (2, 3)).count() == 0
    same = frame(spark, np.repeat([[1.0, 0.0], [0.0, 1.0]], [30, 10], axis=0))
    labels, centres, cost = K.kmeans(same, 5)  # two different rows make two clusters
    assert len(centres) == 2 and cost == 0 and sorted(r["count"] for r in labels.groupBy("cluster_id").count().collect()) == [10, 30]
    assert [tuple(r) for r in K.sweep(frame(spark, np.ones((9, 2))), (3,)).select("k", "silhouette", "calinski_harabasz").collect()] == [(3, 0.0, 0.0)]
    alone = frame(spark, np.array([[1.0, 0.0], [0.9, 0.0], [0.0, 1.0]]))  # a cluster of one row counts 0
    assert K.sweep(alone, (2,)).first()["silhouette"] == pytest.approx(2 / 3, abs=1e-4)
