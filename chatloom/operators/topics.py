"""Clusters and topics: k-means, quality of a clustering, medoids, profiles, typical terms, style by topic."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.functions.lexicons import DEFAULT
from chatloom.operators import vectors as V
from chatloom.operators.lloyd import Blocks, labelled


SEEDS = tuple(range(42, 52))
ITERATIONS = 300


def kmeans(rows: DataFrame | Blocks, k: int, seeds: tuple[int, ...] = SEEDS, iterations: int = ITERATIONS, key: str = "pair_id") -> tuple[DataFrame, list[list[float]], float]:
    """(key, cluster_id), unit centres and cost of the cheapest of several runs; of blocks those that were fitted before."""
    b = rows if isinstance(rows, Blocks) else Blocks(rows, key)
    f = b.fit([k], seeds, iterations).get(k, {"centres": [], "cost": 0.0})
    centres = []
    for c in (m + b.origin for m in f["centres"]):
        n = float((c * c).sum()) ** 0.5 or 1.0
        centres.append([float(x) / n for x in c])
    return labelled(b.rows, f["centres"], b.origin, key), centres, f["cost"]


def sweep(rows: DataFrame, ks: Iterable[int], seeds: tuple[int, ...] = SEEDS, key: str = "pair_id") -> DataFrame:
    """k, inertia, silhouette, calinski_harabasz for each k from 2 up to less than the number of rows.

    All runs of all k go over the rows together.
    """
    b, out = Blocks(rows, key), []
    ks = [k for k in ks if 2 <= k < b.n]
    quality = b.quality(b.fit(ks, seeds, ITERATIONS))
    for k in ks:
        cost = kmeans(b, k, seeds, key=key)[2]
        s, ch = quality[k]
        out.append((k, float(cost), round(s, 4), round(float(ch), 4)))
    return rows.sparkSession.createDataFrame(out, "k int, inertia double, silhouette double, calinski_harabasz double")


def best_k(swept: DataFrame) -> DataFrame:
    """The k of the highest silhouette, the smallest of equals."""
    return swept.orderBy(F.desc("silhouette"), "k").limit(1)


def calinski_harabasz(labelled: DataFrame, label: str = "cluster_id", dim: int = 64) -> DataFrame:
    """One row: variance between clusters over variance within, each by its degrees of freedom."""
    m = V.mean_vector(labelled, [label], dim=dim)
    sq = labelled.agg(F.sum(V.dot(F.col("v"), F.col("v"))).alias("sq"), F.count(F.lit(1)).alias("n"))
    own = m.agg(F.sum(F.col("n") * V.dot(F.col("m"), F.col("m"))).alias("own"), F.count(F.lit(1)).alias("k"), *[F.sum(F.col("n") * F.col("m")[i]).alias(f"__{i}") for i in range(dim)])
    j = own.crossJoin(sq)  # one row each
    grand = sum((F.col(f"__{i}") * F.col(f"__{i}") for i in range(dim)), F.lit(0.0)) / F.col("n")
    within, between = F.col("sq") - F.col("own"), F.col("own") - grand
    return j.select("n", "k", F.when(F.col("k") > 1, (between / (F.col("k") - 1)) / (within / (F.col("n") - F.col("k")))).otherwise(0.0).alias("calinski_harabasz"))


def agglomerative(rows: DataFrame, groups: int, key: str = "pair_id", most: int = 2000) -> DataFrame:
    """key, cluster_id by average linkage on cosine distance, for a set of at most `most` rows; more are refused."""
    import numpy as np
    import pandas as pd

    if rows.limit(most + 1).count() > most:
        raise ValueError(f"average linkage takes at most {most} rows; cluster a larger set by k-means or density peaks first")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key).reset_index(drop=True)
        x = np.array(pdf["v"].tolist())
        n = np.linalg.norm(x, axis=1, keepdims=True)
        x = x / np.where(n > 0, n, 1)
        d = 1 - x @ x.T
        np.fill_diagonal(d, np.inf)
        size, label, alive = np.ones(len(x)), np.arange(len(x)), len(x)
        while alive > groups:
            i, j = np.unravel_index(np.argmin(d), d.shape)
            i, j = min(i, j), max(i, j)
            merged = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
            d[i], d[:, i] = merged, merged
            d[i, i] = np.inf
            d[j], d[:, j] = np.inf, np.inf
            size[i] += size[j]
            label[label == j] = i
            alive -= 1
        ids = {v: k for k, v in enumerate(dict.fromkeys(label))}
        return pd.DataFrame({key: pdf[key], "cluster_id": [ids[v] for v in label]})

    return rows.select(key, "v").groupBy(F.lit(0).alias("__all")).applyInPandas(lambda p: run(p), f"`{key}` {dict(rows.dtypes)[key]}, cluster_id int")


def medoids(labelled: DataFrame, top: int = 3, key: str = "pair_id", label: str = "cluster_id", dim: int = 64) -> DataFrame:
    """label, key, similarity_to_centroid, rank of the `top` members nearest to their centroid."""
    m = V.mean_vector(labelled, [label], dim=dim).select(label, "m")
    s = labelled.join(m, label).select(label, key, F.round(V.cosine(F.col("v"), F.col("m")), 6).alias("similarity_to_centroid"))
    w = Window.partitionBy(label).orderBy(F.desc("similarity_to_centroid"), key)
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def cluster_profile(labelled: DataFrame, label: str = "cluster_id") -> DataFrame:
    """Size, share and word statistics of each cluster of pairs (with target_text and is_initiation)."""
    p = labelled.withColumn("w", T.word_count(F.col("target_text")))
    g = p.groupBy(label).agg(F.count(F.lit(1)).alias("size"), F.round(F.avg("w"), 2).alias("mean_words"), F.median("w").alias("median_words"), F.min("w").alias("min_words"), F.max("w").alias("max_words"), F.round(F.avg(F.col("is_initiation").cast("int")), 4).alias("initiation_ratio"))
    return g.withColumn("percentage", F.round(100 * F.col("size") / F.sum("size").over(Window.partitionBy(F.lit(0))), 2))  # one row per cluster


def ranked_values(rows: DataFrame, by: str, value: str, top: int) -> DataFrame:
    """by, value, uses, rank of the commonest values in each group."""
    g = rows.groupBy(by, value).agg(F.count(F.lit(1)).alias("uses"))
    return g.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("uses"), value))).where(F.col("rank") <= top)


def class_terms(rows: DataFrame, by: str, text: str, top: int = 10, stop: tuple[str, ...] = DEFAULT.stopwords, shortest: int = 2, rare_above: int = 20) -> DataFrame:
    """Typical terms of each class by c-TF-IDF: tf is the share in the class, idf = ln(1 + (K + 1) / (df + 1)) + 1.

    Terms used once are dropped in classes of more than `rare_above` rows. Null texts have no terms.
    """
    t = rows.select(by, F.explode(T.words(F.col(text))).alias("term")).where((F.length("term") >= shortest) & ~F.col("term").isin(*stop) & F.col("term").rlike(r"\p{L}"))
    c = t.groupBy(by, "term").agg(F.count(F.lit(1)).alias("n"))
    size = rows.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))
    c = c.join(size, by).where((F.col("n") >= 2) | (F.col("rows") <= rare_above))
    df = c.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = c.groupBy(by).agg(F.sum("n").alias("total"))
    k = size.agg(F.count(F.lit(1)).alias("k"))
    s = c.join(df, "term").join(total, by).crossJoin(F.broadcast(k))  # k is one number
    score = F.round(F.col("n") / F.col("total") * (F.log(1 + (F.col("k") + 1) / (F.col("df") + 1)) + 1), 6)
    s = s.withColumn("score", score)
    w = Window.partitionBy(by).orderBy(F.desc("score"), "term")
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select(by, "term", "n", "score", "rank")


def topic_labels(terms: DataFrame, by: str) -> DataFrame:
    """`Topic_07_first_second_third` of each class."""
    t = terms.where("rank <= 3").groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), "_").alias("k"))
    return t.select(by, F.concat(F.format_string("Topic_%02d_", F.col(by).cast("int")), "k").alias("label"))


def style_by_topic(rows: DataFrame, topic: str, style: str) -> DataFrame:
    """topic, style, n, probability, dominant for every topic and style, zeros included."""
    n = rows.groupBy(topic, style).agg(F.count(F.lit(1)).alias("n"))
    grid = rows.select(topic).distinct().crossJoin(F.broadcast(rows.select(style).distinct()))  # styles are a small fixed set
    j = grid.join(n, [topic, style], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    w = Window.partitionBy(topic)
    j = j.withColumn("probability", F.round(F.col("n") / F.sum("n").over(w), 4))
    return j.withColumn("dominant", F.row_number().over(w.orderBy(F.desc("n"), style)) == 1)


def name_stopwords(senders: DataFrame, sender: str = "sender") -> DataFrame:
    """Words of sender names, to be left out of terms."""
    return senders.select(F.explode(T.words(F.col(sender))).alias("term")).where(F.length("term") > 1).distinct()
