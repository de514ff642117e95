"""Style of a speaker: tags, typical and diverse examples, a search index over them, and its gate."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.operators import vectors as V
from chatloom.runtime import persisted

BINS = ("short", "medium", "long")


def exemplar_bin(words: Column) -> Column:
    return F.when(words <= 4, "short").when(words <= 14, "medium").otherwise("long")


def style_tags(f: DataFrame) -> Column:
    """Sorted tags of a turn with features."""
    c = lambda cond, tag: F.when(cond, F.lit(tag))
    tags = [
        c(F.col("all_lower"), "lowercase"), c(F.col("all_upper"), "uppercase"), c(~F.col("all_lower") & ~F.col("all_upper"), "mixed_case"), c(~F.col("terminal_mark"), "no_terminal_mark"), c(F.col("many_questions"), "many_questions"),
        c(F.col("many_exclamations"), "many_exclamations"), c(F.col("has_ellipsis"), "ellipsis"), c(F.col("has_emoji"), "emoji"), c(F.col("has_elongation"), "elongation"), c(F.col("has_abbreviation"), "abbreviation"),
        F.col("language"), F.col("clause"), c(F.col("message_count") > 1, "burst"),
    ]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*tags))))


def candidates(f: DataFrame, most_words: int = 120, blocked: tuple[str, ...] = ()) -> DataFrame:
    """Turns fit for examples: 1 to most_words words, a context and a response, no contact card, nothing blocked."""
    ok = F.col("word_count").between(1, most_words) & (T.strip(F.coalesce("context_text", F.lit(""))) != "") & ~F.coalesce("target_text", F.lit("")).rlike(r"(?i)begin:vcard")
    for b in blocked:
        ok = ok & ~F.concat_ws("\n", "context_text", "target_text").rlike(b)
    return f.where(ok)


def anonymized_context(context: Column, owner: str = "You") -> Column:
    """Speaker labels rewritten to You and Friend, mentions masked."""
    line = lambda x: F.when(x.startswith(f"{owner}: "), x).otherwise(F.regexp_replace(x, r"^[^:\n]{1,60}: ", "Friend: "))
    return F.regexp_replace(F.array_join(F.transform(F.split(context, "\n"), line), "\n"), r"(^|\s)@[\p{L}\p{N}_]+", "$1@[NAME]")


def anonymized_ids(rows: DataFrame, column: str = "source_file") -> DataFrame:
    """column, anonymous: `chat_01` and so on in the order of the names; distinct files only are ranked."""
    d = rows.select(column).where(F.col(column).isNotNull()).distinct()
    return d.withColumn("anonymous", F.format_string("chat_%02d", F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy(column))))


def mmr(vectors: np.ndarray, relevance: np.ndarray, k: int, lam: float = 0.7, most: float = 0.9) -> list[int]:
    """Indices of up to k rows: the most relevant first, then lam * relevance - (1 - lam) * nearness to those chosen;
    rows nearer than `most` to a chosen one are passed over while others are left."""
    if not len(vectors) or k <= 0:
        return []
    chosen = [int(np.argmax(relevance))]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < min(k, len(vectors)):
        score = lam * relevance - (1 - lam) * near
        score[chosen] = -np.inf
        open_ = np.where(near <= most, score, -np.inf)
        open_[chosen] = -np.inf
        i = int(np.argmax(open_ if np.isfinite(open_).any() else score))
        chosen.append(i)
        near = np.maximum(near, vectors @ vectors[i])
    return chosen


def greedy_mmr(rows: DataFrame, by: list[str], key: str, relevance: str, lam: float = 0.7, most: float = 0.9) -> list[tuple]:
    """(by, key, rank, relevance) of the choice mmr() makes in each group over all its rows (by, key, k, relevance, v).

    k is the number to choose, alike in a group; keys do not repeat in a group. Each round is an aggregate: a partition offers its best open and
    its best other row, so only the chosen vectors, a few for each group, travel.
    """
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in by) + f", taken int, minus double, `{key}` {kinds[key]}, relevance double, k int, v array<double>"
    rows = rows.select(*by, key, F.col(relevance).cast("double").alias("relevance"), F.col("k").cast("int").alias("k"), "v")
    chosen: dict[tuple, tuple[set, list[np.ndarray]]] = {}
    out: list[tuple] = []
    more = True
    while more:

        def run(batches, chosen=chosen):
            best: dict[tuple, tuple] = {}
            for pdf in batches:
                for g, p in pdf.groupby(by, sort=False):
                    keys, vectors = chosen.get(g, ((), []))
                    p = p[(p["k"] > len(vectors)) & ~p[key].isin(keys)]
                    if not len(p):
                        continue
                    rel, x = p["relevance"].to_numpy("float64"), np.array(p["v"].tolist(), "float64")
                    n = np.linalg.norm(x, axis=1, keepdims=True)
                    x = x / np.where(n > 0, n, 1)
                    near = np.max([(x * c).sum(1) for c in vectors], axis=0) if vectors else np.zeros(len(x))
                    score, taken = lam * rel - (1 - lam) * near, (near > most).astype(int)
                    for t in (0, 1):
                        at = np.flatnonzero(taken == t)
                        if len(at):
                            top = at[score[at] == score[at].max()]
                            i = min(top, key=lambda j: p[key].iloc[j])
                            new = (-score[i], p[key].iloc[i], rel[i], p["k"].iloc[i], x[i])
                            best[g, t] = min(best.get((g, t), new), new, key=lambda r: r[:2])
            yield pd.DataFrame([(*g, t, *r) for (g, t), r in best.items()], columns=[*by, "taken", "minus", key, "relevance", "k", "v"])

        won = rows.mapInPandas(run, schema).groupBy(*by).agg(F.min(F.struct("taken", "minus", key, "relevance", "k", "v")).alias("w")).collect()
        more = False
        for r in won:
            g, w = tuple(r[c] for c in by), r["w"]
            keys, vectors = chosen.setdefault(g, (set(), []))
            keys.add(w[key])
            vectors.append(np.array(w["v"]))
            out.append((*g, w[key], len(vectors), w["relevance"]))
            more |= len(vectors) < w["k"]
    return out


def exemplars(rows: DataFrame, per_category: int = 8, least: float = 0.15, category: str = "cluster_id", key: str = "pair_id", dim: int = 64) -> DataFrame:
    """category, length_bin, key, rank, centroid_similarity of diverse typical examples.

    Each category and length bin offers all its rows of at least `least` similarity to the category's centroid, or all
    where none is. A quarter of the examples is short, half medium, the rest long.
    """
    m = V.mean_vector(rows, [category], dim=dim).select(category, "m")
    s = rows.join(m, category).withColumn("centroid_similarity", V.cosine(F.col("v"), F.col("m"))).withColumn("length_bin", exemplar_bin(F.col("word_count")))
    s = persisted(s.select(category, "length_bin", key, "v", "centroid_similarity"), "candidates")
    typical = s.groupBy(category, "length_bin").agg(F.max("centroid_similarity").alias("__most"))  # one row per category and bin
    s = s.join(F.broadcast(typical), [category, "length_bin"]).where((F.col("__most") < least) | (F.col("centroid_similarity") >= least))
    short, medium = per_category // 4, per_category // 2
    s = s.withColumn("k", F.when(F.col("length_bin") == "short", short).when(F.col("length_bin") == "medium", medium).otherwise(per_category - short - medium))
    kind = dict(rows.dtypes)
    schema = f"`{category}` {kind[category]}, length_bin string, `{key}` {kind[key]}, rank int, centroid_similarity double"
    found = greedy_mmr(s, [category, "length_bin"], key, "centroid_similarity")
    return rows.sparkSession.createDataFrame([(*r[:-1], round(r[-1], 6)) for r in found], schema)


def style_index(examples: DataFrame, pairs: DataFrame, dim: int = 64) -> DataFrame:
    """Examples with the vector of the pair of the same trimmed response, the last of equals; unmatched ones a uniform one."""
    text = T.strip(F.coalesce("target_text", F.lit("")))
    last = pairs.withColumn("__t", text).groupBy("__t").agg(F.max_by("v", "pair_id").alias("v"))
    e = examples.withColumn("__t", text).join(last, "__t", "left").drop("__t")
    return e.withColumn("v", F.coalesce("v", F.array_repeat(F.lit(dim**-0.5), dim)))


MODES = ("context", "response", "hybrid")


def search(
    index: DataFrame, query: list[float], k: int = 5, least: float = 0.2, lam: float = 0.7, category: int | None = None, length_bin: str | None = None, key: str = "pair_id",
    mode: str = "response", alpha: float = 0.6, most: float = 0.9, context: str = "context_v", response: str = "v",
) -> DataFrame:
    """key, similarity, rank: examples near to one query, chosen for nearness and diversity from all that reach the threshold.

    mode says which vectors are compared: those of contexts, of responses, or alpha parts of the former and the rest of
    the latter. Near copies, of more than `most` similarity to a chosen one, come last; a `most` above 1 turns that off.
    A filter that leaves nothing is dropped, and so is the threshold where nothing reaches it. An empty
    index or a query without length finds nothing.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    schema = f"`{key}` {dict(index.dtypes)[key]}, similarity double, rank int"
    if not any(query):
        return index.sparkSession.createDataFrame([], schema)
    v = {"context": F.col(context) if context in index.columns else None, "response": F.col(response), "hybrid": V.hybrid(F.col(context), F.col(response), alpha) if context in index.columns else None}[mode]
    if v is None:
        raise ValueError(f"the index has no {context}")
    rows = index.withColumn("v", v)
    kept = [F.col(c) == x for c, x in (("cluster_id", category), ("length_bin", length_bin)) if x is not None]
    if kept:
        some = rows.where(reduce(Column.__and__, kept))
        rows = some if some.limit(1).count() else rows
    q = F.array(*[F.lit(float(x)) for x in query])
    near = rows.select(key, "v", V.cosine(F.col("v"), q).alias("similarity"), F.lit(k).alias("k"), F.lit(0).alias("__all"))
    good = near.where(F.col("similarity") >= least)
    near = good if good.limit(1).count() else near.orderBy(F.desc("similarity"), key).limit(k)
    found = greedy_mmr(near, ["__all"], key, "similarity", lam, most)
    return index.sparkSession.createDataFrame([(i, round(s, 6), r) for _, i, r, s in found], schema)


def retrieval_gate(message: Column, trivial: tuple[str, ...] = ("hi", "hello", "hey", "ok", "okk", "hmm", "haha", "lol", "gm", "gn")) -> Column:
    """Why no example is looked up: empty, trivial_ping, no_words, too_short; null where one is."""
    t = T.strip(F.coalesce(message, F.lit("")))
    bare = F.lower(F.regexp_replace(t, r"[^\p{L}\p{N} ]", ""))
    return F.when(t == "", "empty").when(T.strip(bare).isin(*trivial), "trivial_ping").when(~t.rlike(r"[\p{L}\p{N}]"), "no_words").when(T.word_count(t) < 2, "too_short")


def few_shot_prompt(found: DataFrame, message: str) -> str:
    """Prompt text of at most a search's k examples, in rank order."""
    rows = found.orderBy("rank").collect()
    return "\n\n".join([*(f"Context:\n{r['context_text']}\nResponse: {r['target_text']}" for r in rows), f"Message: {message}\nResponse:"])
