"""Queries of the profilers on context/response pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.functions.lexicons import ACTS, DEFAULT, SITUATIONS
from chatloom.operators import profiles as P
from chatloom.plans.archive import _EMOJI, _q, sql_word_count
from chatloom.sources.tables import table

def _features(spark: SparkSession, d: str) -> DataFrame:
    """Features of all turns, labelled by the style cluster of their pair."""
    style = table(spark, d, "cluster_assignments").where("pair_id is not null").groupBy("pair_id").agg(F.min("cluster_id").alias("style"))
    p = table(spark, d, "context_pairs").distinct().join(style, "pair_id", "left")
    return P.turn_features(p.withColumn("label", F.coalesce(F.concat(F.lit("style_"), "style"), F.lit("none"))).drop("style"))


def turn_features(spark: SparkSession, d: str) -> DataFrame:
    f = _features(spark, d)
    return f.select(
        "pair_id", "source_file", "conversation_id", "characters", "word_count", *P.SURFACE, "emoji_count", *P.SYNTAX, "negations", "enclitics", "clause", "eng_words", "hin_words", "eng_ratio", "switches", "language",
        F.array_join("acts", ",").alias("acts"), "primary_act", "context_act", "situation", *[F.round(x, 6).alias(x) for x in P.DIMENSIONS],
    )


def surface_profile(spark: SparkSession, d: str) -> DataFrame:
    return P.ratios(_features(spark, d), "label", P.SURFACE)


def syntax_profile(spark: SparkSession, d: str) -> DataFrame:
    return P.ratios(_features(spark, d), "label", P.SYNTAX)


def densities(spark: SparkSession, d: str) -> DataFrame:
    return P.densities(_features(spark, d), "label")


def enclitics_by_style(spark: SparkSession, d: str) -> DataFrame:
    return P.words_by_label(_features(spark, d), "label", DEFAULT.enclitic, 5)


def situations_by_style(spark: SparkSession, d: str) -> DataFrame:
    return P.shares(_features(spark, d), "label", "situation")


def acts_by_style(spark: SparkSession, d: str) -> DataFrame:
    return P.shares(_features(spark, d), "label", "primary_act")


def word_distribution(spark: SparkSession, d: str) -> DataFrame:
    return P.distribution(_features(spark, d), "label", "word_count")


def burst_distribution(spark: SparkSession, d: str) -> DataFrame:
    return P.distribution(_features(spark, d), "label", "message_count")


def burst_ratios(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "context_pairs").distinct()
    n = F.col("message_count")
    r = lambda c: F.round(F.avg(c.cast("int")), 4)
    return p.agg(F.count(F.lit(1)).alias("turns"), r(n == 1).alias("single"), r(n == 2).alias("double"), r(n >= 3).alias("burst"), F.max("message_count").alias("most"))


def lexical_diversity(spark: SparkSession, d: str) -> DataFrame:
    return P.lexical_diversity(_features(spark, d), "label")


def clause_types(spark: SparkSession, d: str) -> DataFrame:
    return P.shares(_features(spark, d), "label", "clause")


def language_shares(spark: SparkSession, d: str) -> DataFrame:
    return P.shares(_features(spark, d), "label", "language")


def switch_points(spark: SparkSession, d: str) -> DataFrame:
    f = _features(spark, d)
    return f.groupBy("language").agg(F.count(F.lit(1)).alias("turns"), F.round(F.avg("switches"), 4).alias("mean_switches"), F.max("switches").alias("max_switches"), F.sum("eng_words").alias("eng_words"), F.sum("hin_words").alias("hin_words"))


def borrowed_words(spark: SparkSession, d: str) -> DataFrame:
    return P.borrowed(_features(spark, d))


def enclitic_topk(spark: SparkSession, d: str) -> DataFrame:
    return P.ranked_words(_features(spark, d), DEFAULT.enclitic, 8)


def abbreviation_topk(spark: SparkSession, d: str) -> DataFrame:
    return P.ranked_words(_features(spark, d), DEFAULT.abbreviation, 12)


def discourse_acts(spark: SparkSession, d: str) -> DataFrame:
    return P.act_counts(_features(spark, d))


def act_cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    return P.act_pairs(_features(spark, d))


def act_transitions(spark: SparkSession, d: str) -> DataFrame:
    return P.act_transitions(_features(spark, d))


def act_markers(spark: SparkSession, d: str) -> DataFrame:
    """The ten commonest markers of each act."""
    return P.ranked_markers(_features(spark, d), DEFAULT.discourse)


def situation_cues(spark: SparkSession, d: str) -> DataFrame:
    """The ten commonest cues of the three situations read from contexts and responses together; situation_cues_all has all six."""
    f = _features(spark, d).withColumn("both", T.words(F.concat_ws(" ", "context_text", "target_text")))
    return P.ranked_markers(f, {"technical_collab": DEFAULT.technical, "career_academic": DEFAULT.career, "advice_probing": DEFAULT.probing}, "both")


def situation_cues_all(spark: SparkSession, d: str) -> DataFrame:
    """The ten commonest cues of all six situations, from the texts that weigh for each in situation_weights()."""
    text = T.strip(F.coalesce("target_text", F.lit("")))
    f = _features(spark, d).withColumn("alone", F.when((F.size("words") == 1) & (F.col("word_count") <= 3), F.col("words"))).withColumn("emoji", F.regexp_extract_all(text, F.lit(f"[{DEFAULT.humor_emoji}]"), F.lit(0)))
    own = (("alone", "acknowledgement", DEFAULT.acknowledgement), ("words", "conflict_friction", DEFAULT.conflict), ("emoji", "casual_banter", tuple(DEFAULT.humor_emoji)))
    return reduce(DataFrame.unionByName, (P.ranked_markers(f, {name: terms}, c) for c, name, terms in own), situation_cues(spark, d))


def situations(spark: SparkSession, d: str) -> DataFrame:
    return P.filled(_features(spark, d).groupBy("situation").agg(F.count(F.lit(1)).alias("turns")), "situation", SITUATIONS)


def behavior_dimensions(spark: SparkSession, d: str) -> DataFrame:
    return P.dimensions(_features(spark, d))


def behavior_exemplars(spark: SparkSession, d: str) -> DataFrame:
    return P.dimension_exemplars(_features(spark, d))


QUERIES = {
    f.__name__: f
    for f in (
        turn_features, surface_profile, syntax_profile, densities, enclitics_by_style, situations_by_style, acts_by_style, word_distribution, burst_distribution, burst_ratios, lexical_diversity, clause_types, language_shares, switch_points, borrowed_words, enclitic_topk,
        abbreviation_topk, discourse_acts, act_cooccurrence, act_transitions, act_markers, situation_cues, situation_cues_all, situations, behavior_dimensions, behavior_exemplars,
    )
}

L = DEFAULT


def _l(terms) -> str:
    return "[" + ", ".join(_q(t) for t in sorted(terms)) + "]"


def _any(terms, w: str = "w") -> str:
    return f"list_has_any({w}, {_l(terms)})"


def _n(terms, w: str = "w") -> str:
    return f"len(list_filter({w}, lambda x: list_contains({_l(terms)}, x)))"


_ONLY_E, _ONLY_H = _l(set(L.english) - set(L.hindi)), _l(set(L.hindi) - set(L.english))
_LISTED = lambda x: f"when list_contains({_ONLY_H}, {x}) then 'HIN' when list_contains({_ONLY_E}, {x}) then 'ENG'"
_ENDS = P.endings(L)
_TAG = f"""list_transform(w, lambda x: case when list_contains({_l(L.universal)}, x) or regexp_full_match(x, '\\p{{N}}+') or length(x) <= 1 then 'UNIV' when list_contains({_l(L.homograph)}, x) then 'AMBIG'
 {_LISTED('x')} {' '.join(_LISTED(f"case when length(x) >= {k + 3} then left(x, length(x) - {k}) end") for k in (1, 2, 3))}
 {' '.join(f"when length(x) > {k} and list_contains({_l([e for e, v in _ENDS.items() if v == t and len(e) == k] + ['-'])}, right(x, {k})) then '{t}'" for k in (3, 2) for t in ('ENG', 'HIN'))} else 'HIN' end)"""
_SETTLED = """list_transform(raw, lambda x, i: case when x <> 'AMBIG' then x when len(list_filter(list_concat(raw[greatest(i - 2, 1):i - 1], raw[i + 1:i + 2]), lambda y: y = 'ENG')) > len(list_filter(list_concat(raw[greatest(i - 2, 1):i - 1], raw[i + 1:i + 2]), lambda y: y = 'HIN')) then 'ENG' else 'HIN' end)"""


def _acts(w: str, t: str) -> str:
    parts = []
    for a in ACTS[:-1]:
        c = _any(L.discourse[a], w)
        c += f" or regexp_matches({t}, '[{L.humor_emoji}]')" if a == "humor" else f" or contains({t}, '?')" if a == "question" else ""
        parts.append(f"case when {c} then '{a}' end")
    return "(case when len([x for x in [" + ", ".join(parts) + "] if x is not null]) > 0 then [x for x in [" + ", ".join(parts) + "] if x is not null] else ['informative'] end)"


def _primary(a: str, t: str) -> str:
    n, h = sql_word_count(t), lambda x: f"list_contains({a}, '{x}')"
    return f"""case when contains({t}, '?') or ({h('question')} and {n} <= 7) then 'question' when {h('disagree')} and ({n} <= 6 or regexp_matches(lower({t}), '^(?:nahi|nhi|no)')) then 'disagree'
 when {h('agree')} and ({n} <= 4 or regexp_matches(lower({t}), '^(?:ha|done|ok|cool)')) then 'agree' when {h('explain')} then 'explain' when {h('advice')} then 'advice' when {h('clarify')} then 'clarify' when {h('disagree')} then 'disagree'
 when {h('agree')} then 'agree' when {h('question')} then 'question' when {h('hedge')} then 'hedge' when {h('humor')} then 'humor' when {h('emphasis')} then 'emphasis' else 'informative' end"""


_LET = "length(regexp_replace(t, '[^\\p{L}]', '', 'g'))"
_ELONG = "(" + "|".join(f"{x}{{3,}}|{x.upper()}{{3,}}" for x in "abcdefghijklmnopqrstuvwxyz") + ")"
_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_SIT = f"""[case when len(w) = 1 and list_contains({_l(L.acknowledgement)}, w[1]) and {sql_word_count('t')} <= 3 then 3.0::double else 0.0::double end, {_n(L.technical, 'b')} * 1.2::double, {_n(L.career, 'b')} * 1.2::double, {_n(L.conflict)} * 1.0::double, {_n(L.probing, 'b')} * 0.8::double, len(regexp_extract_all(t, '[{L.humor_emoji}]')) * 0.8::double + 0.2::double]"""

F0 = f"""with f0 as (select *, coalesce('style_' || (select min(cluster_id) from cluster_assignments ca where ca.pair_id = src.pair_id), 'none') as label, {_STRIP.format("coalesce(target_text, '')")} as t, regexp_extract_all(lower(coalesce(target_text, '')), {_q(T.WORD)}) as w,
  regexp_extract_all(lower(concat_ws(' ', context_text, target_text)), {_q(T.WORD)}) as b, regexp_replace(coalesce(context_text, ''), '^[^:\\n]{{1,30}}:\\s*', '') as c from (select distinct * from context_pairs) src),
f1 as (select *, {_TAG} as raw, regexp_extract_all(t, {_q(_EMOJI)}) as e, {_acts('w', "coalesce(target_text, '')")} as acts, {_SIT} as sr, regexp_extract_all(lower(c), {_q(T.WORD)}) as cw from f0),
f2 as (select *, {_SETTLED} as tags, list_transform(sr, lambda x: round(x / list_sum(sr), 4)) as ss from f1),
f3 as (select *, list_filter(tags, lambda x: x <> 'UNIV') as content from f2),
f4 as (select pair_id, source_file, conversation_id, label, target_text, message_count, w as words, tags, acts, length(t) as characters, {sql_word_count('t')} as word_count, {_LET} > 0 and t = lower(t) as all_lower, {_LET} > 1 and t = upper(t) and t <> lower(t) as all_upper, {_LET} > 0 and t <> lower(t) and not ({_LET} > 1 and t = upper(t) and t <> lower(t)) as mixed_case, length(regexp_replace(t, '[^.,!?;:]', '', 'g')) as marks, regexp_matches(t, '^\\p{{Lu}}') as initial_cap,
  regexp_matches(t, '[.?!]$') as terminal_mark, contains(t, '?') as has_question, contains(t, '??') as many_questions, contains(t, '!') as has_exclamation, contains(t, '!!') as many_exclamations, contains(t, '..') as has_ellipsis,
  len(e) as emoji_count, len(e) > 0 as has_emoji, len(e) > 0 and not regexp_matches(t, '[\\p{{L}}\\p{{N}}]') as emoji_only, len(e) > len(list_distinct(e)) as emoji_burst, regexp_matches(t, '{_ELONG}') as has_elongation, {_any(L.abbreviation)} as has_abbreviation,
  contains(coalesce(target_text, ''), '?') or {_any(L.interrogative)} as is_question, {_any(L.negation)} as has_negation, {_n(L.negation)} as negations, {_any(L.conditional)} or ({_any(L.when)} and {_any(L.then)}) as has_conditional,
  coalesce(list_contains({_l(L.imperative)}, w[1]) or (list_contains({_l(L.prohibitive)}, w[1]) and list_contains({_l(L.imperative)}, w[2])) or list_contains({_l(L.closing_imperative)}, w[2]), false) as is_imperative,
  {_any(L.first_person)} as first_person, {_any(L.second_person)} as second_person, {_any(L.third_person)} as third_person, {_any(L.modal)} as has_modal, {_n(L.enclitic)} as enclitics,
  case when len(w) <= 2 then 'fragment' when {_any(L.subordinating)} then 'subordinate' when {_any(L.coordinating)} then 'coordinate' else 'simple' end as clause,
  len(list_filter(tags, lambda x: x = 'ENG')) as eng_words, len(list_filter(tags, lambda x: x = 'HIN')) as hin_words, round(len(list_filter(tags, lambda x: x = 'ENG')) / greatest(len(content), 1), 4) as eng_ratio,
  coalesce(len(list_filter(list_transform(content, lambda x, i: i > 1 and content[i - 1] <> x), lambda y: y)), 0) as switches,
  case when len(content) = 0 then 'neutral' when not list_contains(content, 'HIN') then 'pure_english' when not list_contains(content, 'ENG') then 'pure_hindi' else 'code_switched' end as language,
  {_primary('acts', 't')} as primary_act, case when {_STRIP.format('c')} <> '' then {_primary(_acts('cw', 'c'), _STRIP.format('c'))} end as context_act,
  [{', '.join(_q(s) for s in SITUATIONS)}][list_position(ss, list_max(ss))] as situation, {_n(L.technical)} as tech from f3),
f as (select *, not is_question and not is_imperative as is_declarative, enclitics > 0 as has_enclitic, case when word_count <= 3 then 1.0 when word_count <= 7 then 0.5 else 0.0 end::double as directness, least(1.0, word_count / 30.0)::double as verbosity, list_contains(acts, 'hedge')::int::double as hedging, list_contains(acts, 'disagree')::int::double as disagreement,
  list_contains(acts, 'humor')::int::double as humor, list_contains(acts, 'question')::int::double as question_initiative, (primary_act in ('informative', 'explain', 'advice') and not list_contains(acts, 'hedge'))::int::double as confidence,
  (has_emoji::int * 0.5 + list_contains(acts, 'emphasis')::int * 0.3 + (all_upper and word_count > 1)::int * 0.2)::double as expressiveness, case when language = 'code_switched' then least(1.0, switches / 4.0) else 0.0 end::double as switching, least(1.0, tech / 3.0)::double as technical from f4)"""

_STACK = "s as (" + " union all ".join(f"select pair_id, target_text, '{x}' as dimension, {x} as score from f where word_count > 0" for x in P.DIMENSIONS) + ")"
_DIST = "select label, count({0}) as n, round(avg({0}), 2) as mean, round(stddev_pop({0}), 2) as std, min({0}) as min, max({0}) as max, round(quantile_cont({0}, 0.25), 2) as p25, round(quantile_cont({0}, 0.5), 2) as median, round(quantile_cont({0}, 0.75), 2) as p75, round(quantile_cont({0}, 0.9), 2) as p90 from f group by rollup (label)"
_TOP = " select term, count(*) as uses from (select unnest(words) as term from f) where list_contains({0}, term) group by 1 order by uses desc, term limit {1}"



def _families(column: str, families: dict) -> str:
    parts = " union all ".join(f"select '{k}' as family, unnest(list_filter({column}, lambda x: list_contains({_l(v)}, x))) as term from f " for k, v in families.items())
    return f", mk as ({parts}) select family, term, count(*) as uses, row_number() over (partition by family order by count(*) desc, term) as rank from mk group by 1, 2 qualify rank <= 10"


SQL = {
    "turn_features": F0 + f""" select pair_id, source_file, conversation_id, characters, word_count, {', '.join(P.SURFACE)}, emoji_count, {', '.join(P.SYNTAX)}, negations, enclitics, clause, eng_words, hin_words, eng_ratio, switches, language,
        array_to_string(acts, ',') as acts, primary_act, context_act, situation, {', '.join(f'round({x}, 6) as {x}' for x in P.DIMENSIONS)} from f""",
    "surface_profile": F0 + f" select label, count(*) as turns, {', '.join(f'round(avg({x}::int), 4) as {x}' for x in P.SURFACE)} from f group by grouping sets ((), (label))",
    "syntax_profile": F0 + f" select label, count(*) as turns, {', '.join(f'round(avg({x}::int), 4) as {x}' for x in P.SYNTAX)} from f group by grouping sets ((), (label))",
    "densities": F0 + " select label, sum(word_count)::bigint as all_words, " + ", ".join(f"round(100 * sum({c}) / sum(word_count), 4) as {c}_per_100" for c in ("marks", "emoji_count", "enclitics", "switches")) + ", " + ", ".join(f"round(sum({c}) / sum(eng_words + hin_words), 4) as {c}_share" for c in ("eng_words", "hin_words")) + " from f group by grouping sets ((), (label))",
    "enclitics_by_style": F0 + f" select label, term, count(*) as uses, row_number() over (partition by label order by count(*) desc, term) as rank from (select label, unnest(words) as term from f) where list_contains({_l(L.enclitic)}, term) group by 1, 2 qualify rank <= 5",
    "situations_by_style": F0 + " select label, situation, count(*) as turns, round(count(*) / sum(count(*)) over (partition by label), 4) as share from f group by 1, 2",
    "acts_by_style": F0 + " select label, primary_act, count(*) as turns, round(count(*) / sum(count(*)) over (partition by label), 4) as share from f group by 1, 2",
    "word_distribution": F0 + " " + _DIST.format("word_count"),
    "burst_distribution": F0 + " " + _DIST.format("message_count"),
    "burst_ratios": "with p as (select distinct * from context_pairs) select count(*) as turns, round(avg((message_count = 1)::int), 4) as single, round(avg((message_count = 2)::int), 4) as double, round(avg((message_count >= 3)::int), 4) as burst, max(message_count) as most from p",
    "lexical_diversity": F0 + ", t as (select label, x, count(*) as c from (select label, unnest(words) as x from f) group by 1, 2), g as (select label, count(*) as vocabulary, sum(c)::bigint as tokens, count(*) filter (c = 1) as hapax, count(*) filter (c = 2) as dis from t group by label) select *, round(vocabulary / tokens, 4) as ttr, round(vocabulary / sqrt(tokens), 4) as guiraud, round(vocabulary / sqrt(2 * tokens), 4) as cttr, round(ln(vocabulary) / ln(tokens), 4) as bilog_ttr, round(hapax / vocabulary, 4) as hapax_ratio from g",
    "clause_types": F0 + " select label, clause, count(*) as turns, round(count(*) / sum(count(*)) over (partition by label), 4) as share from f group by 1, 2",
    "language_shares": F0 + " select label, language, count(*) as turns, round(count(*) / sum(count(*)) over (partition by label), 4) as share from f group by 1, 2",
    "switch_points": F0 + " select language, count(*) as turns, round(avg(switches), 4) as mean_switches, max(switches) as max_switches, sum(eng_words)::bigint as eng_words, sum(hin_words)::bigint as hin_words from f group by 1",
    "borrowed_words": F0 + " select x as term, count(*) as uses from (select unnest(words) as x, unnest(tags) as y from f where language = 'code_switched') where y = 'ENG' and length(x) >= 3 group by 1 order by uses desc, term limit 20",
    "enclitic_topk": F0 + _TOP.format(_l(L.enclitic), 8),
    "abbreviation_topk": F0 + _TOP.format(_l(L.abbreviation), 12),
    "discourse_acts": F0 + f", d as (select unnest([{', '.join(_q(a) for a in ACTS)}]) as act), a as (select unnest(acts) as act, primary_act from f) select act, count(a.primary_act) as turns, count(*) filter (act = a.primary_act) as primary_turns from d left join a using (act) group by act",
    "act_cooccurrence": F0 + ", x as (select unnest(acts) as a, acts from f), y as (select a, unnest(acts) as b from x) select a, b, count(*) as turns from y group by 1, 2",
    "act_transitions": F0 + f", d as (select unnest([{', '.join(_q(a) for a in ACTS)}]) as act), g as (select a.act as context_act, b.act as primary_act from d a, d b), n as (select context_act, primary_act, count(*) as n from f where context_act is not null group by 1, 2), j as (select context_act, primary_act, coalesce(n, 0) as turns from g left join n using (context_act, primary_act)) select *, case when sum(turns) over (partition by context_act) > 0 then round(turns / sum(turns) over (partition by context_act), 4) else 0.0 end as probability from j",
    "act_markers": F0 + _families("words", L.discourse),
    "situation_cues": F0 + _families("b", {"technical_collab": L.technical, "career_academic": L.career, "advice_probing": L.probing}).replace(" from f ", " from f1 "),
    "situation_cues_all": F0 + f""", mk as (select 'acknowledgement' as family, unnest(list_filter(w, lambda x: list_contains({_l(L.acknowledgement)}, x))) as term from f1 where len(w) = 1 and {sql_word_count('t')} <= 3
        union all select 'conflict_friction', unnest(list_filter(w, lambda x: list_contains({_l(L.conflict)}, x))) from f1 union all select 'casual_banter', unnest(regexp_extract_all(t, '[{L.humor_emoji}]')) from f1
        """ + "".join(f" union all select '{k}', unnest(list_filter(b, lambda x: list_contains({_l(v)}, x))) from f1" for k, v in (("technical_collab", L.technical), ("career_academic", L.career), ("advice_probing", L.probing))) + ") select family, term, count(*) as uses, row_number() over (partition by family order by count(*) desc, term) as rank from mk group by 1, 2 qualify rank <= 10",
    "situations": F0 + f", d as (select unnest([{', '.join(_q(a) for a in SITUATIONS)}]) as situation) select situation, count(f.pair_id) as turns from d left join f using (situation) group by 1",
    "behavior_dimensions": F0 + ", " + _STACK + " select dimension, round(avg(score), 4) as score, count(*) as turns, round(least(1.0, count(*) / 500.0), 4)::double as confidence from s group by 1",
    "behavior_exemplars": F0 + ", " + _STACK + ", o as (select dimension, target_text, max(score) as score, min(pair_id) as pair_id from s where score > 0 group by 1, 2) select dimension, pair_id, target_text, round(score, 2) as score, row_number() over (partition by dimension order by score desc, pair_id, target_text) as rank from o qualify rank <= 5",
}
