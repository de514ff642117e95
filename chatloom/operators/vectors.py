"""Vector arithmetic, similarity search and diversity as column expressions and bounded joins."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector has no length."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))


def unit(a: Column) -> Column:
    """Of length 1; a zero vector stays as it is."""
    n = norm(a)
    return F.transform(a, lambda x: F.when(n > 0, x / n).otherwise(x.cast("double")))


def hybrid(context: Column, response: Column, alpha: float = 0.5) -> Column:
    return unit(F.zip_with(context, response, lambda x, y: F.lit(alpha) * x + F.lit(1 - alpha) * y))


def usable(vectors: DataFrame, key: str = "pair_id", vec: str = "vectors", dim: int = 64) -> DataFrame:
    """key, v (double array): one row per key with a full, finite vector that is not zero; of several the smallest."""
    v = F.col(vec)
    ok = F.col(key).isNotNull() & (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return vectors.where(v.isNotNull() & ok).groupBy(key).agg(F.min(v.cast("array<double>")).alias("v"))


def mean_vector(rows: DataFrame, by: list[str], v: str = "v", dim: int = 64) -> DataFrame:
    """by, n, m: mean vectors, combined before the shuffle."""
    g = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(v)[i]).alias(f"__{i}") for i in range(dim)])
    return g.select(*by, "n", F.array(*[F.col(f"__{i}") for i in range(dim)]).alias("m"))


def top_k(rows: DataFrame, query: list[float], k: int = 10, least: float = 0.0, key: str = "pair_id") -> DataFrame:
    """key, similarity of the k rows nearest to one query vector."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return rows.select(key, cosine(F.col("v"), q).alias("similarity")).where(F.col("similarity") >= least).orderBy(F.desc("similarity"), key).limit(k)


def top_k_each(rows: DataFrame, queries: DataFrame, k: int = 5, key: str = "pair_id", lanes: int = 16) -> DataFrame:
    """query_id, key, similarity, rank: for each of a stated set of queries the k nearest rows.

    Rows meet the queries in blocks; each block keeps its k best before they are brought together.
    """
    import numpy as np

    kind = dict(rows.dtypes)[key]
    schema = f"query_id {kind}, `{key}` {kind}, similarity double"

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], key: [], "similarity": []})
        a, b = np.array(left["v"].tolist()), np.array(right["v"].tolist())
        a, b = a / np.linalg.norm(a, axis=1, keepdims=True), b / np.linalg.norm(b, axis=1, keepdims=True)
        ids, out = right["id"].to_numpy(), []
        order = np.argsort(ids.astype(str), kind="stable")
        b, ids = b[order], ids[order]
        for i in range(0, len(a), 256):
            s = np.round(a[i : i + 256] @ b.T, 9)
            top = np.argsort(-s, 1, kind="stable")[:, : k + 1]
            for r, t in enumerate(top):
                q = left["id"].iloc[i + r]
                out += [(q, ids[j], s[r, j]) for j in t if ids[j] != q][:k]
        return pd.DataFrame(out, columns=["query_id", key, "similarity"])

    block = 4096
    nq, nr = max(1, -(-queries.count() // block)), max(lanes, -(-rows.count() // block))
    q = queries.select(F.col(key).alias("id"), "v").withColumn("i", F.pmod(F.xxhash64("id"), F.lit(nq)).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(nr - 1))))
    r = rows.select(F.col(key).alias("id"), "v").withColumn("j", F.pmod(F.xxhash64("id"), F.lit(nr)).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    near = q.groupBy("i", "j").cogroup(r.select(F.col("id").alias("id"), F.col("v").alias("v"), F.col("i").alias("i"), F.col("j").alias("j")).groupBy("i", "j")).applyInPandas(run, schema)
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), key)
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mean_similarity(rows: DataFrame, v: str = "v", dim: int = 64) -> DataFrame:
    """n, mean_similarity, diversity over all pairs of unit vectors, from their sum alone."""
    u = rows.select(unit(F.col(v)).alias("u"))
    s = u.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("u")[i]).alias(f"__{i}") for i in range(dim)])
    total = sum((F.col(f"__{i}") * F.col(f"__{i}") for i in range(dim)), F.lit(0.0))
    m = F.when(F.col("n") > 1, (total - F.col("n")) / (F.col("n") * (F.col("n") - 1))).otherwise(F.lit(1.0))
    return s.select("n", F.round(m, 6).alias("mean_similarity"), F.round(1 - m, 6).alias("diversity"))


def pair_similarity_stats(sample: DataFrame, v: str = "v", key: str = "pair_id") -> DataFrame:
    """Statistics over all pairs of a sample of bounded size (the caller's limit, 1,000 as a rule)."""
    a = sample.select(F.col(key).alias("a"), F.col(v).alias("x"))
    b = sample.select(F.col(key).alias("b"), F.col(v).alias("y"))
    s = a.join(F.broadcast(b), F.col("a") < F.col("b")).select(cosine(F.col("x"), F.col("y")).alias("s"))
    r = lambda c: F.round(c, 6)
    return s.agg(F.count(F.lit(1)).alias("pairs"), r(F.avg("s")).alias("mean"), r(F.median("s")).alias("median"), r(F.stddev_pop("s")).alias("std"), r(F.min("s")).alias("min"), r(F.max("s")).alias("max"))


def gram(sample: DataFrame, v: str = "v", key: str = "pair_id") -> DataFrame:
    """All similarities within a sample of bounded size, as rows."""
    a, b = sample.select(F.col(key).alias("a"), F.col(v).alias("x")), sample.select(F.col(key).alias("b"), F.col(v).alias("y"))
    return a.join(F.broadcast(b)).select("a", "b", F.round(cosine(F.col("x"), F.col("y")), 6).alias("similarity"))


def alignment(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Statistics of row-wise similarity and its classes: mirroring from 0.5, balanced from 0.2, reactive below."""
    s = pairs.select(cosine(F.col(a), F.col(b)).alias("s"))
    p = F.percentile("s", F.array(*[F.lit(x) for x in (0.1, 0.25, 0.5, 0.75, 0.9)]))
    g = s.agg(F.count(F.lit(1)).alias("n"), F.avg("s").alias("mean"), F.stddev_pop("s").alias("std"), p.alias("p"), F.count_if(F.col("s") >= 0.5).alias("mirroring"), F.count_if((F.col("s") >= 0.2) & (F.col("s") < 0.5)).alias("balanced"), F.count_if(F.col("s") < 0.2).alias("reactive"))
    r = lambda c: F.round(c, 6)
    return g.select("n", r("mean").alias("mean"), r("std").alias("std"), *[r(F.col("p")[i]).alias(k) for i, k in enumerate(("p10", "p25", "median", "p75", "p90"))], "mirroring", "balanced", "reactive")


def discrimination(triplets: DataFrame, anchor: str, positive: str, negative: str) -> DataFrame:
    """Mean of similarity to the positive minus similarity to the negative."""
    gap = cosine(F.col(anchor), F.col(positive)) - cosine(F.col(anchor), F.col(negative))
    return triplets.select(gap.alias("g")).agg(F.count(F.lit(1)).alias("triplets"), F.round(F.avg("g"), 6).alias("gap"), F.count_if(F.col("g") > 0).alias("won"))


def hashed_words(dim: int = 64):
    """The offline provider: signed hashed counts of words, of length 1; blank texts give a zero vector."""
    import re
    import zlib

    import numpy as np

    word = re.compile(r"[^\W_]+(?:'[^\W_]+)*")

    def provider(batches):
        memo: dict[str, tuple[int, float]] = {}
        for s in batches:
            out = []
            for t in s:
                v = np.zeros(dim)
                for w in word.findall((t or "").lower()):
                    if w not in memo:
                        h = zlib.crc32(w.encode())
                        memo[w] = (h % dim, 1.0 if (h >> 16) & 1 else -1.0)
                    i, sign = memo[w]
                    v[i] += sign
                n = np.linalg.norm(v)
                out.append((v / n if n else v).tolist())
            yield pd.Series(out)

    return provider


def encoded(texts: DataFrame, provider, text: str = "text", fallback: str | None = None) -> DataFrame:
    """texts with v from a provider, an iterator function over batches of strings; a blank text takes the fallback column."""
    c = F.coalesce(F.when(F.trim(F.col(text)) != "", F.col(text)), F.col(fallback) if fallback else F.lit(""), F.lit(""))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from provider(batches)

    return texts.withColumn("v", F.pandas_udf(run, "array<double>")(c))
