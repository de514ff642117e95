"""Candidate responses held against real ones: surface, behaviour, judgement, failures and summaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.functions.lexicons import DEFAULT, Lexicon
from chatloom.operators import profiles as P

# ---- fixed values: weights, marks, codes and phrases of the rules ---------------------------------------------------
WEIGHTS = {"punctuation": 0.20, "casing": 0.15, "length": 0.15, "jaccard": 0.15, "vocabulary": 0.10, "embedding": 0.25}
#: Words that show the voice of casual mixed chat.
SIGNATURE = "bhai bro bc bkl tbh imo ngl waise bas are ha haa haan sahi shi thik theek cool done accha acha nahi nhi naa galat chodd scene fati legit fr bruh lol lmao ded api curl endpoint wsl json repo branch".split()
FAILURES = ("ERR_TRAILING_PERIOD", "ERR_ROBOTIC_AI", "ERR_TOO_VERBOSE", "ERR_HIGH_HEDGING", "ERR_EXCESSIVE_EMOJI", "ERR_WRONG_LANGUAGE_MIX", "ERR_HALLUCINATED_PII", "ERR_CASING_MISMATCH")
ASSISTANT = ["i'd be happy to", "certainly", "i hope this helps", "feel free to", "let me know if you need", "as an artificial intelligence", "as an ai", "how can i assist", "is there anything else"]
HEDGES = ["i might be wrong", "in my humble opinion", "it seems to me", "perhaps", "tentatively", "i could be mistaken"]
FORMAL = ["dear", "sincerely", "regards", "furthermore", "moreover", "consequently", "nevertheless", "pleasure", "cordially", "hereby", "kindly", "please be advised"]
FORBIDDEN_EMOJI = "🎉✨🤖😊👍👋"
MIX_PARTS = ["bhai", "nahi", "ha", "toh", "ka", "ki", "ke", "me", "he", "ho", "kya", "kar"]
MIX_WORDS = ["bhai", "ha", "nahi", "kar", "he", "ho", "tu", "me", "bc", "sahi", "kya", "toh", "ka", "ki", "ko"]
TECHNICAL = ["api", "curl", "json", "endpoint", "wsl", "docker", "server"]
ASKED_TECHNICAL, SAID_TECHNICAL = ["api", "curl", "endpoint", "bug", "code"], ["api", "curl", "endpoint", "wsl", "code", "run", "check", "host"]
DEFERRALS = ["pata nahi", "idk", "nahi", "kya"]
AXES = ("voice_authenticity", "stylistic_adherence", "behavioral_consistency", "situational_appropriateness", "epistemic_grounding")
MOST_WORDS = 35
BEHAVIOUR = ("directness", "verbosity", "hedging", "confidence", "disagreement", "humor", "question", "formality", "code_switching", "technical_depth")
# -------------------------------------------------------------------------------------------------------------------

#: Examples a retriever may hold; more have to be searched with the index operators.
MOST_EXAMPLES = 10_000


def phrases(words: list[str]) -> str:
    """Pattern of any of the phrases as whole words."""
    return r"(?i)\b(?:" + "|".join(words) + r")\b"


#: Data that a response may not make up: mail addresses, mobile numbers, declared passwords and phones.
PRIVATE = r"(?i)[6-9]\d{9}|\bpassword\s*(?:is|[=:])|\bphone\s*(?:number\s*)?(?:is|[=:])|[a-z0-9_.+-]+@[a-z0-9-]+\.[a-z0-9.-]+"


def _said(rows: Column) -> Column:
    return T.strip(F.coalesce(rows, F.lit("")))


def _lower(t: Column) -> Column:
    """Whether a text has letters with case and all are small."""
    return (F.lower(t) == t) & (F.upper(t) != t)


def _upper(t: Column) -> Column:
    return (F.upper(t) == t) & (F.lower(t) != t)


def _full_stop(t: Column) -> Column:
    return t.endswith(".")


def _holds(t: Column, parts: list[str]) -> Column:
    """Whether any of the parts occurs in lower case."""
    low = F.lower(t)
    return F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: low.contains(p))


def plain_tokens(t: Column) -> Column:
    """Distinct words of plain letters, digits and underscores, in lower case."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(t), F.lit(r"[\p{L}\p{M}\p{N}_]+"), F.lit(0)), lambda w: w.rlike("^[a-z0-9_]+$")))


def pair_metrics(rows: DataFrame, candidate: str = "candidate", target: str = "target", signature: list[str] = SIGNATURE) -> DataFrame:
    """rows with six scores between 0 and 1 and their weighted sum, composite.

    A column `embedding` of rows, the cosine of the two texts' vectors, counts with a negative value mapped to
    (x + 1) / 2; without it, or where it is null, the overlap of words stands in. Null texts count as empty.
    """
    c, t = _said(F.col(candidate)), _said(F.col(target))
    wc, wt = plain_tokens(c), plain_tokens(t)
    nc, nt = F.greatest(F.lit(1), T.word_count(c)), F.greatest(F.lit(1), T.word_count(t))
    shout = lambda x: _upper(x) & (T.word_count(x) > 1)
    r = nc / nt
    sig = F.array(*[F.lit(s) for s in signature])
    hc, ht = F.size(F.array_intersect(wc, sig)), F.size(F.array_intersect(wt, sig))
    both, either = F.size(F.array_intersect(wc, wt)), F.size(F.array_union(wc, wt))
    out = rows.withColumns({
        "punctuation": F.when(_full_stop(c) & ~_full_stop(t), 0.0).when(~_full_stop(c) & ~_full_stop(t), 1.0).when(_full_stop(c), 0.9).otherwise(0.7),
        "casing": F.when(shout(c) & ~shout(t), 0.2).when(_lower(c) == _lower(t), 1.0).when(_lower(c), 0.85).otherwise(0.5),
        "length": F.greatest(F.lit(0.0), F.when(r >= 1, 1 - 0.5 * (r - 1)).otherwise(1 - 0.4 * (nt / nc - 1))),
        "jaccard": F.when(either == 0, 1.0).otherwise(both / either),
        "vocabulary": F.when(ht > 0, F.least(F.lit(1.0), hc / ht)).when((hc > 0) | (nc <= 3), 1.0).otherwise(0.8),
    })
    e = F.coalesce(F.col("embedding").cast("double"), F.col("jaccard")) if "embedding" in rows.columns else F.col("jaccard")
    out = out.withColumn("embedding", F.when(e < 0, F.greatest(F.lit(0.0), (e + 1) / 2)).otherwise(e))
    total = sum((F.col(m) * w for m, w in WEIGHTS.items()), F.lit(0.0)) / sum(WEIGHTS.values())
    return out.withColumn("composite", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)), 6))


METRICS = (*WEIGHTS, "composite")


def batch_means(scored: DataFrame, by: str = "strategy") -> DataFrame:
    return scored.groupBy(by).agg(F.count(F.lit(1)).alias("pairs"), *[F.round(F.avg(m), 4).alias(m) for m in METRICS])


def behaviour(rows: DataFrame, text: str, prefix: str, context: str = "context", lex: Lexicon = DEFAULT) -> DataFrame:
    """rows with the ten behaviour scores of a text, each between 0 and 1; a text without words scores 0 everywhere."""
    f = P.turn_features(rows.withColumn("message_count", F.lit(1)), lex, text, context)
    t = F.coalesce(F.col(text), F.lit(""))
    hedge = (F.col("hedging") > 0) | t.rlike(phrases(HEDGES))
    flag = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    score = {
        "directness": F.col("directness"), "verbosity": F.col("verbosity"), "hedging": flag(hedge), "confidence": flag(F.col("primary_act").isin("informative", "explain", "advice") & ~hedge), "disagreement": F.col("disagreement"),
        "humor": F.col("humor"), "question": flag((F.col("question_initiative") > 0) | t.contains("?")), "formality": flag(t.rlike(phrases(FORMAL))), "code_switching": flag(F.col("language") == "code_switched"),
        "technical_depth": flag(F.arrays_overlap(F.col("words"), F.array(*[F.lit(x) for x in (*TECHNICAL, *lex.technical)]))),
    }
    some = F.col("word_count") > 0
    return f.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.when(some, score[k]).otherwise(0.0).alias(prefix + k) for k in BEHAVIOUR])


def behaviour_gap(rows: DataFrame, usual: dict[str, float], candidate: str = "c_", target: str = "t_") -> DataFrame:
    """rows with mae, behaviour_cosine and behaviour: the candidate's scores against the half-and-half blend of the real
    turn's and the usual ones, less penalties for hedging and formality. Without length, the cosine is 1 - mae."""
    pairs = [(F.col(candidate + k), (F.col(target + k) + F.lit(float(usual[k]))) / 2) for k in BEHAVIOUR]
    mae = sum((F.abs(a - b) for a, b in pairs), F.lit(0.0)) / len(BEHAVIOUR)
    dot = sum((a * b for a, b in pairs), F.lit(0.0))
    na, nb = (F.sqrt(sum((x[i] * x[i] for x in pairs), F.lit(0.0))) for i in (0, 1))
    cos = F.when((na > 1e-6) & (nb > 1e-6), dot / (na * nb)).otherwise(1 - mae)
    over = lambda k: F.greatest(F.lit(0.0), F.col(candidate + k) - 0.05)
    score = 0.5 * F.greatest(F.lit(0.0), 1 - mae) + 0.5 * F.greatest(F.lit(0.0), cos) - 0.25 * over("hedging") - 0.25 * over("formality")
    return rows.withColumns({"mae": F.round(mae, 6), "behaviour_cosine": F.round(cos, 6), "behaviour": F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 6)})


def usual_behaviour(scored: DataFrame, prefix: str = "t_") -> dict[str, float]:
    """Mean scores of real turns, one row."""
    r = scored.agg(*[F.avg(prefix + k).alias(k) for k in BEHAVIOUR]).first()
    return {k: r[k] or 0.0 for k in BEHAVIOUR}


def judge(rows: DataFrame, candidate: str = "candidate", target: str = "target", context: str = "context") -> DataFrame:
    """rows with marks from 1 to 5 on five axes, each 5 less deductions, and their mean, judged."""
    c, t, x = _said(F.col(candidate)), F.coalesce(F.col(target), F.lit("")), F.lower(F.coalesce(F.col(context), F.lit("")))
    n, off = T.word_count(c), lambda cond, by: F.when(cond, by).otherwise(0.0)
    words = F.array_distinct(T.split_words(F.lower(c)))
    robot = c.rlike(phrases([a for a in ASSISTANT if a not in ("as an artificial intelligence", "is there anything else")]))
    mixed = F.arrays_overlap(words, F.array(*[F.lit(w) for w in MIX_WORDS]))
    hedged = c.rlike(phrases(["i might be wrong", "perhaps", "i think maybe", "in my humble opinion"]))
    b = F.when(robot, 1.5).otherwise(5.0)
    least = lambda v: F.greatest(F.lit(1.0), v)
    axes = {
        "voice_authenticity": F.when(robot, 1.0).otherwise(5.0 - off(~mixed & (F.size(words) > 3), 1.5)),
        "stylistic_adherence": least(5.0 - off(_full_stop(c) & ~_full_stop(T.strip(t)), 1.5) - off(n > MOST_WORDS, 1.5) - off(_upper(c) & (n > 2), 1.0)),
        "behavioral_consistency": least(F.when(hedged, F.least(b, F.lit(3.0)) - 1.5).otherwise(b)),
        "situational_appropriateness": F.when(~_holds(x, ASKED_TECHNICAL), 4.5).when(_holds(c, SAID_TECHNICAL), 5.0).when(n <= 4, 4.5).otherwise(3.5),
        "epistemic_grounding": F.when(c.rlike(r"(?i)\b(?:\d{10}|password\s*is|my\s*phone\s*is)\b"), 1.0).when(x.contains("password") | x.contains("phone"), F.when(_holds(c, DEFERRALS), 5.0).otherwise(3.0)).otherwise(5.0),
    }
    out = rows.withColumns(axes)
    return out.withColumn("judged", F.round(sum((F.col(a) for a in axes), F.lit(0.0)) / len(axes), 2))


def judge_prompt(candidate: Column, target: Column, context: Column) -> Column:
    """What a judge is asked: the axes to mark from 1 to 5, and the three texts."""
    axes = "\n".join(f'- "{a}"' for a in (*AXES, "overall_score"))
    ask = f"Mark the second response against the first, which a person really wrote. Give a JSON object with numbers from 1 to 5 for\n{axes}\nand a text \"reasoning\".\n"
    c = F.when(_said(context) == "", "(No prior context)").otherwise(_said(context))
    return F.concat(F.lit(f"{ask}\nContext:\n"), c, F.lit("\n\nFirst response:\n"), _said(target), F.lit("\n\nSecond response:\n"), _said(candidate), F.lit("\n"))


def parse_judgement(rows: DataFrame, reply: str) -> DataFrame:
    """rows with the marks of a judge's JSON reply, with or without a fence of code, each clamped to 1 to 5.

    A mark that is missing is 3, a missing one for grounding 5, a missing overall score the mean. A reply that is no
    JSON object is judged itself by the rules, as a response without context; offline tells which.
    """
    text = F.regexp_replace(F.regexp_replace(_said(F.col(reply)), r"^```(?:json)?\s*", ""), r"\s*```$", "")
    schema = ", ".join(f"{a} double" for a in (*AXES, "overall_score"))
    d = judge(rows.withColumn("__reply", text).withColumn("__none", F.lit("")), "__reply", "__none", "__none")
    d = d.withColumn("__j", F.when(F.col("__reply").startswith("{") & F.get_json_object("__reply", "$").isNotNull(), F.from_json("__reply", schema)))
    clamp = lambda c: F.least(F.lit(5.0), F.greatest(F.lit(1.0), c))
    ok = F.col("__j").isNotNull()
    given = {a: F.coalesce(F.col(f"__j.{a}"), F.lit(5.0 if a == "epistemic_grounding" else 3.0)) for a in AXES}
    mean = sum(given.values(), F.lit(0.0)) / len(AXES)
    out = {a: F.when(ok, clamp(v)).otherwise(F.col(a)) for a, v in given.items()}
    overall = F.when(ok, clamp(F.coalesce(F.col("__j.overall_score"), mean))).otherwise(F.col("judged"))
    d = d.withColumns({f"__{a}": v for a, v in out.items()}).withColumn("__overall", overall)
    return d.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(f"__{a}").alias(a) for a in AXES], F.col("__overall").alias("overall_score"), (~ok).alias("offline"))


def failures(rows: DataFrame, candidate: str = "candidate", target: str = "target", context: str = "context") -> DataFrame:
    """rows with failure_codes, the sorted codes of what went wrong."""
    c, t, x = _said(F.col(candidate)), _said(F.col(target)), F.coalesce(F.col(context), F.lit(""))
    nc, nt = T.word_count(c), T.word_count(t)
    cond = {
        "ERR_TRAILING_PERIOD": _full_stop(c) & ~_full_stop(t),
        "ERR_ROBOTIC_AI": c.rlike(phrases(ASSISTANT)),
        "ERR_TOO_VERBOSE": (nc > MOST_WORDS) | ((nt > 0) & (nc > F.greatest(F.lit(15), F.floor(nt * 2.5)))),
        "ERR_HIGH_HEDGING": c.rlike(phrases(HEDGES)),
        "ERR_EXCESSIVE_EMOJI": (F.size(T.emojis(c)) > 3) | c.rlike(f"[{FORBIDDEN_EMOJI}]"),
        "ERR_HALLUCINATED_PII": c.rlike(PRIVATE),
        "ERR_CASING_MISMATCH": _upper(c) & (nc > 2),
        "ERR_WRONG_LANGUAGE_MIX": (nc > 4) & ~_holds(c, MIX_PARTS) & ~_holds(c, TECHNICAL) & ~_holds(x, TECHNICAL),
    }
    return rows.withColumn("failure_codes", F.array_sort(F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in cond.items()]))))


def failure_report(tagged: DataFrame, by: str = "strategy") -> DataFrame:
    """by, code, turns, rate for each code met."""
    n = tagged.groupBy(by).agg(F.count(F.lit(1)).alias("all"))
    g = tagged.select(by, F.explode("failure_codes").alias("code")).groupBy(by, "code").agg(F.count(F.lit(1)).alias("turns"))
    return g.join(n, by).select(by, "code", "turns", F.round(F.col("turns") / F.col("all"), 4).alias("rate"))


def failure_examples(tagged: DataFrame, by: str = "strategy", key: str = "pair_id", top: int = 3, lanes: int = 32) -> DataFrame:
    """The first `top` turns of each code by key; lanes keep a frequent code from one task."""
    e = tagged.select(by, key, F.explode("failure_codes").alias("code")).withColumn("__l", F.pmod(F.xxhash64(key), F.lit(lanes)))
    w = Window.partitionBy(by, "code", "__l").orderBy(key)
    few = e.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy(by, "code").orderBy(key))).where(F.col("rank") <= top).drop("__l")


def summary(scored: DataFrame, by: str = "strategy", top: int = 5) -> DataFrame:
    """One row per strategy: means of metrics, behaviour and judge, failed and clean turns, and the `top` failure codes as code=turns."""
    r = lambda c: F.round(F.avg(c), 4).alias(c)
    failed = F.size("failure_codes") > 0
    more = [c for c in ("behaviour",) if c in scored.columns]
    s = scored.groupBy(by).agg(F.count(F.lit(1)).alias("turns"), r("composite"), *map(r, more), r("judged"), r("jaccard"), r("length"), F.count_if(failed).alias("failed"), F.count_if(~failed).alias("clean"), F.round(F.avg(failed.cast("int")), 4).alias("failure_rate"))
    f = failure_report(scored, by).withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("turns"), "code"))).where(F.col("r") <= top)  # at most eight rows a strategy
    f = f.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "code", "turns"))), lambda x: F.concat_ws("=", x["code"], x["turns"])), ",").alias("top_failures"))
    return s.join(f, by, "left").withColumn("top_failures", F.coalesce("top_failures", F.lit("")))


def matrix(summaries: DataFrame, by: str = "strategy") -> str:
    """A table of strategies and measures in Markdown, from one row per strategy."""
    rows = summaries.orderBy(by).collect()
    names = [c for c in summaries.columns if c != by]
    return "\n".join(["| " + " | ".join([by, *names]) + " |", "|" + "---|" * (len(names) + 1), *("| " + " | ".join(str(r[c]) for c in (by, *names)) + " |" for r in rows)])


def retrieved(rows: DataFrame, examples: DataFrame, key: str = "pair_id") -> DataFrame:
    """key, example, response: the most similar example (key, v, response) of each row (key, v), never the row itself.

    Examples are a curated set of at most MOST_EXAMPLES. Of equals the first by key.
    """
    kept = examples.select(key, "v", "response").orderBy(key).limit(MOST_EXAMPLES + 1).collect()
    if len(kept) > MOST_EXAMPLES:
        raise ValueError(f"more than {MOST_EXAMPLES} examples")
    sent = rows.sparkSession.sparkContext.broadcast(([r[0] for r in kept], [r["v"] for r in kept], [r["response"] for r in kept]))

    def unit(m: np.ndarray) -> np.ndarray:
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n > 0, n, 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vectors, said = sent.value
        m, place = unit(np.array(vectors, "float64")) if ids else None, {k: i for i, k in enumerate(ids)}
        for pdf in batches:
            if not len(pdf) or m is None:
                continue
            s = unit(np.array(pdf["v"].tolist(), "float64")) @ m.T
            for r, k in enumerate(pdf[key]):
                if k in place:
                    s[r, place[k]] = -np.inf
            best = np.round(s, 9).argmax(1)
            ok = np.isfinite(s[np.arange(len(s)), best])
            yield pd.DataFrame({key: pdf[key], "example": [ids[i] for i in best], "response": [said[i] for i in best]})[ok]

    kind = dict(rows.dtypes)[key]
    return rows.select(key, "v").mapInPandas(run, f"`{key}` {kind}, example {kind}, response string")


def candidate_texts(pairs: DataFrame, found: DataFrame, key: str = "pair_id", fallback: str = "ok") -> DataFrame:
    """pairs of (strategy, candidate): the retrieved response in lower case without a closing mark, a canned reply, and the last line of the context.

    A pair for which nothing was found takes the fallback.
    """
    last = F.element_at(F.split(F.coalesce("context_text", F.lit("")), "\n"), -1)
    got = T.strip(F.regexp_replace(F.lower(T.strip(F.col("__response"))), r"[.!]+$", ""))
    made = {"retrieved": F.coalesce(got, F.lit(fallback)), "canned": F.lit("Certainly! How can I assist you with that today?"), "echo": F.regexp_replace(last, r"^[^:\n]{1,60}: ", "")}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("strategy"), v.alias("candidate")) for k, v in made.items()]))
    j = pairs.join(found.select(key, F.col("response").alias("__response")), key, "left")
    return j.withColumn("__c", each).select("*", "__c.strategy", "__c.candidate").drop("__c", "__response").withColumnRenamed("target_text", "target").withColumnRenamed("context_text", "context")
