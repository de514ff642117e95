"""Reports from profiles: global style, evidence, inferred traits, package artifacts. Values are computed, never defaults."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.operators.profiles import SITUATIONS


def global_style(features: DataFrame) -> DataFrame:
    """One row of rates over all turns, with formality and humour derived from them."""
    r = lambda c: F.avg(F.col(c).cast("int"))
    g = features.agg(
        F.count(F.lit(1)).alias("turns"), F.round(F.avg("word_count"), 2).alias("mean_words"), r("all_lower").alias("lower"), (1 - r("terminal_mark")).alias("open_ended"), r("has_emoji").alias("emoji"), r("has_elongation").alias("elongation"),
        F.avg("humor").alias("humor"), F.avg((F.col("language") == "code_switched").cast("int")).alias("mixed"), F.avg("hedging").alias("hedging"), F.avg("question_initiative").alias("asking"),
    )
    g = g.withColumn("formality", F.greatest(F.lit(0.0), 1 - (0.6 * F.col("open_ended") + 0.4 * F.col("lower")))).withColumn("sarcasm", 0.8 * F.col("humor"))
    return g.select("turns", "mean_words", *[F.round(c, 4).alias(c) for c in ("lower", "open_ended", "emoji", "elongation", "humor", "mixed", "hedging", "asking", "formality", "sarcasm")])


def situational_style(features: DataFrame) -> DataFrame:
    """Each situation that occurs with its share, leading act and main rates."""
    acts = features.groupBy("situation", "primary_act").agg(F.count(F.lit(1)).alias("n")).groupBy("situation").agg(F.max_by("primary_act", F.struct("n", "primary_act")).alias("top_act"))
    g = features.groupBy("situation").agg(F.count(F.lit(1)).alias("turns"), F.round(F.avg("word_count"), 2).alias("mean_words"), F.round(F.avg(F.col("has_emoji").cast("int")), 4).alias("emoji"), F.round(F.avg(F.col("all_lower").cast("int")), 4).alias("lower"))
    total = features.agg(F.count(F.lit(1)).alias("all"))
    return g.join(acts, "situation").crossJoin(F.broadcast(total)).withColumn("prevalence", F.round(F.col("turns") / F.col("all"), 4)).drop("all")  # total is one row


def evidence(style: DataFrame, situations: DataFrame) -> DataFrame:
    """trait, score, observations, status: observed traits with their counts, inferred ones from them, unknown ones left open."""
    obs = style.select(F.expr("stack(5, 'lowercase', lower, 'open_ended', open_ended, 'emoji', emoji, 'mixed_language', mixed, 'humor', humor) as (trait, score)"), "turns")
    observed = obs.select("trait", "score", F.floor(F.col("score") * F.col("turns")).cast("long").alias("observations"), F.lit("observed").alias("status"))
    sit = situations.where(F.col("prevalence") >= 0.05).select(F.concat(F.lit("situation_"), "situation").alias("trait"), F.col("prevalence").alias("score"), F.col("turns").alias("observations"), F.lit("observed").alias("status"))
    inf = style.select(F.expr("stack(3, 'formality', formality, 'sarcasm', sarcasm, 'directness', 1 - hedging) as (trait, score)"), "turns").select("trait", F.round("score", 4).alias("score"), F.col("turns").alias("observations"), F.lit("inferred").alias("status"))
    unknown = style.sparkSession.createDataFrame([("age",), ("occupation",), ("values",)], "trait string").select("trait", F.lit(None).cast("double").alias("score"), F.lit(0).cast("long").alias("observations"), F.lit("unknown").alias("status"))
    return observed.unionByName(sit).unionByName(inf).unionByName(unknown)


def artifacts(style: DataFrame, situations: DataFrame, traits: DataFrame) -> DataFrame:
    """name, content, sha256 of the package: JSON profiles, the prompt and the report. All inputs are small summaries."""
    s = style.first().asDict()
    sit = {r["situation"]: {k: v for k, v in r.asDict().items() if k != "situation"} for r in situations.orderBy("situation").collect()}
    tr = [r.asDict() for r in traits.orderBy("status", "trait").collect()]
    prompt = [f"Write like the person with these habits, seen over {s['turns']} turns:", f"- {s['mean_words']} words a turn on average", f"- {s['lower']:.0%} of turns in lower case, {s['open_ended']:.0%} without a closing mark", f"- emoji in {s['emoji']:.0%}, two languages in {s['mixed']:.0%} of turns"]
    report = ["# Style report", "", "| trait | score | observations | status |", "|---|---|---|---|", *(f"| {t['trait']} | {'' if t['score'] is None else t['score']} | {t['observations']} | {t['status']} |" for t in tr)]
    files = {"style_profile.json": json.dumps(s, sort_keys=True), "situations.json": json.dumps(sit, sort_keys=True), "traits.json": json.dumps(tr, sort_keys=True), "system_prompt.txt": "\n".join(prompt), "report.md": "\n".join(report)}
    d = style.sparkSession.createDataFrame(sorted(files.items()), "name string, content string")
    return d.withColumn("sha256", F.sha2("content", 256))


__all__ = ["SITUATIONS", "artifacts", "evidence", "global_style", "situational_style"]
