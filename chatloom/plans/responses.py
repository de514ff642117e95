"""Queries on style, examples, retrieval, evaluation, reports and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import masking
from chatloom.functions import text as T
from chatloom.functions.lexicons import DEFAULT
from chatloom.operators import archive as A
from chatloom.operators import evaluate as E
from chatloom.operators import report as R
from chatloom.operators import style as S
from chatloom.operators import topics as K
from chatloom.operators import vectors as V
from chatloom.plans import dataset as D
from chatloom.plans.archive import _EMOJI, _M, _q, sql_mask
from chatloom.plans.dataset import _COS
from chatloom.plans.dataset import L as LABELS
from chatloom.plans.dataset import LP as LABELLED_PAIRS
from chatloom.plans.profiles import F0, _features, _l
from chatloom.runtime import persisted
from chatloom.sources.tables import table
from chatloom.streaming.sessions import session_windows


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "context_pairs").distinct()


def _examples(spark: SparkSession, d: str) -> DataFrame:
    f = S.candidates(_features(spark, d)).groupBy("pair_id").agg(F.min(F.struct("target_text", "context_text", "word_count")).alias("r")).select("pair_id", "r.*")
    c = table(spark, d, "cluster_assignments").groupBy("pair_id").agg(F.min("cluster_id").alias("cluster_id"))
    return f.join(c, "pair_id").join(V.usable(table(spark, d, "train_target_vectors")), "pair_id")


def style_tags(spark: SparkSession, d: str) -> DataFrame:
    f = _features(spark, d)
    return f.withColumn("tag", F.explode(S.style_tags(f))).groupBy("tag").agg(F.count(F.lit(1)).alias("turns"))


def exemplar_candidates(spark: SparkSession, d: str) -> DataFrame:
    c = S.candidates(_features(spark, d), blocked=(r"(?i)password",))
    return c.groupBy(S.exemplar_bin(F.col("word_count")).alias("length_bin")).agg(F.count(F.lit(1)).alias("pairs"))


def anonymized_contexts(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("pair_id", "source_file", "conversation_id", S.anonymized_context(F.col("context_text")).alias("context"))


def anonymized_ids(spark: SparkSession, d: str) -> DataFrame:
    return S.anonymized_ids(_pairs(spark, d))


def mmr_exemplars(spark: SparkSession, d: str) -> DataFrame:
    return S.exemplars(_examples(spark, d))


def exemplar_diversity(spark: SparkSession, d: str) -> DataFrame:
    e = _examples(spark, d)
    return V.mean_similarity(S.exemplars(e).join(e.select("pair_id", "v"), "pair_id"))


def _index(spark: SparkSession, d: str) -> DataFrame:
    e = _examples(spark, d)
    return S.style_index(S.exemplars(e).join(e.select("pair_id", "target_text"), "pair_id"), e)


def hybrid_search(spark: SparkSession, d: str) -> DataFrame:
    i = _index(spark, d)
    return S.search(i, i.orderBy("pair_id").first()["v"], 5)


def search_modes(spark: SparkSession, d: str) -> DataFrame:
    """One query looked up by context, by response and by both, whole and within a category and a length."""
    i = _index(spark, d)
    said = _pairs(spark, d).groupBy("pair_id").agg(F.min("context_text").alias("context_text"))
    e = V.encoded(said, V.hashed_words(), "context_text").select("pair_id", F.col("v").alias("context_v"))
    i = persisted(i.join(e, "pair_id"), "index")
    q = i.orderBy("pair_id").first()
    asked = [(m, c, b) for m in S.MODES for c, b in ((None, None), (q["cluster_id"], None), (None, q["length_bin"]), (-1, "short"))]
    found = [S.search(i, q["v" if m == "response" else "context_v"], 3, category=c, length_bin=b, mode=m).select(F.lit(m).alias("mode"), F.lit(c).cast("int").alias("category"), F.lit(b).cast("string").alias("length"), "pair_id", "similarity", "rank") for m, c, b in asked]
    return reduce(DataFrame.unionByName, found)


def prompts(spark: SparkSession, d: str) -> DataFrame:
    """The prompt for the first few messages that pass the gate, each with its examples."""
    i = _index(spark, d)
    said = _pairs(spark, d).groupBy("pair_id").agg(F.min("context_text").alias("context_text"))
    i = persisted(i.join(said, "pair_id"), "index")
    asked = i.orderBy("pair_id").limit(3).collect()
    rows = [(q["pair_id"], S.few_shot_prompt(S.search(i, q["v"], 3).join(i.select("pair_id", "target_text", "context_text"), "pair_id"), q["context_text"])) for q in asked]
    return spark.createDataFrame(rows, "pair_id string, prompt string").select("pair_id", F.length("prompt").alias("characters"), F.sha2("prompt", 256).alias("sha256"))


def retrieval_gate(spark: SparkSession, d: str) -> DataFrame:
    g = F.coalesce(S.retrieval_gate(F.col("text")), F.lit("search"))
    return A.deliver_once(table(spark, d, "messages"), "text").groupBy(g.alias("gate")).agg(F.count(F.lit(1)).alias("messages"))


def _retrieved(spark: SparkSession, d: str) -> DataFrame:
    """For each pair with a vector, the response of the most similar medoid: its curated example."""
    said = D._labelled_pairs(spark, d).select("pair_id", F.col("target_text").alias("response"))
    examples = K.medoids(D._labelled(spark, d)).select("pair_id").join(said, "pair_id").join(D._vectors(spark, d), "pair_id")
    return E.retrieved(D._vectors(spark, d), examples)


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d).select("pair_id", "source_file", "conversation_id", "target_text", "context_text")
    return E.candidate_texts(p, persisted(_retrieved(spark, d), "retrieved"))


def _evaluated(spark: SparkSession, d: str) -> DataFrame:
    return E.failures(E.judge(E.pair_metrics(_candidates(spark, d))))


def retrieved_examples(spark: SparkSession, d: str) -> DataFrame:
    """Each pair with the example found for it."""
    return _retrieved(spark, d)


def pair_metrics(spark: SparkSession, d: str) -> DataFrame:
    return E.batch_means(_evaluated(spark, d))


def judge_scores(spark: SparkSession, d: str) -> DataFrame:
    e = _evaluated(spark, d)
    return e.groupBy("strategy").agg(*[F.round(F.avg(c), 4).alias(c) for c in (*E.AXES, "judged")])


def judge_prompts(spark: SparkSession, d: str) -> DataFrame:
    """Length of what a judge would be asked, by strategy."""
    n = F.length(E.judge_prompt(F.col("candidate"), F.col("target"), F.col("context")))
    return _candidates(spark, d).groupBy("strategy").agg(F.count(F.lit(1)).alias("prompts"), F.sum(n).alias("characters"), F.max(n).alias("longest"))


#: Replies of a judge, with the marks that must come out of them.
REPLIES = [
    ('{"voice_authenticity": 4, "stylistic_adherence": 9, "behavioral_consistency": 0, "situational_appropriateness": 4, "epistemic_grounding": 5, "overall_score": 4.5}', (4.0, 5.0, 1.0, 4.0, 5.0, 4.5, False)),
    ('```json\n{"voice_authenticity": 2}\n```', (2.0, 3.0, 3.0, 3.0, 5.0, 3.2, False)),
    ("Certainly, as an AI I think so.", (1.0, 3.5, 1.5, 4.5, 5.0, 3.1, True)),
    (None, (5.0, 5.0, 5.0, 4.5, 5.0, 4.9, True)),
]


def judge_replies(spark: SparkSession, d: str) -> DataFrame:
    """Literal replies of a judge read."""
    r = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(REPLIES)], "case_no int, reply string")
    return E.parse_judgement(r, "reply").drop("reply")


def failure_tags(spark: SparkSession, d: str) -> DataFrame:
    return E.failure_report(_evaluated(spark, d))


def failure_examples(spark: SparkSession, d: str) -> DataFrame:
    """The first turns of each code; of several rows of one pair the one with the smallest codes counts."""
    one = _evaluated(spark, d).groupBy("strategy", "pair_id").agg(F.min("failure_codes").alias("failure_codes"))
    return E.failure_examples(one)


def strategy_summary(spark: SparkSession, d: str) -> DataFrame:
    return E.summary(E.failures(E.judge(E.pair_metrics(_behaviour(spark, d)))))


def _behaviour(spark: SparkSession, d: str) -> DataFrame:
    c = E.behaviour(_candidates(spark, d), "candidate", "c_")
    t = persisted(E.behaviour(c, "target", "t_"), "behaviour")
    return E.behaviour_gap(t, E.usual_behaviour(t))


def behaviour_gap(spark: SparkSession, d: str) -> DataFrame:
    """Candidates against the real turns, half and half with what is usual."""
    return _behaviour(spark, d).groupBy("strategy").agg(F.count(F.lit(1)).alias("turns"), F.round(F.avg("mae"), 4).alias("mae"), F.round(F.avg("behaviour_cosine"), 4).alias("cosine"), F.round(F.avg("behaviour"), 4).alias("behaviour"))


def global_style(spark: SparkSession, d: str) -> DataFrame:
    return R.global_style(_features(spark, d))


def situational_style(spark: SparkSession, d: str) -> DataFrame:
    return R.situational_style(_features(spark, d))


def evidence(spark: SparkSession, d: str) -> DataFrame:
    f = _features(spark, d)
    return R.evidence(R.global_style(f), R.situational_style(f))


def package_artifacts(spark: SparkSession, d: str) -> DataFrame:
    f = _features(spark, d)
    g, s = R.global_style(f), R.situational_style(f)
    return R.artifacts(g, s, R.evidence(g, s)).select("name", F.length("content").alias("characters"), "sha256")


def privacy_audit(spark: SparkSession, d: str) -> DataFrame:
    """Hits of each blocked expression in contexts and responses before and after masking."""
    p = _pairs(spark, d)
    t = p.select(F.lit("context").alias("part"), F.col("context_text").alias("a")).unionByName(p.select(F.lit("target"), F.col("target_text").alias("a")).toDF("part", "a"))
    before, after = (masking.audit(t.withColumn("x", c), "part", "x").withColumn("stage", F.lit(k)) for k, c in (("before", F.col("a")), ("after", masking.mask(F.col("a")))))
    return before.unionByName(after).groupBy("part", "stage", "expression").agg(F.sum("hits").alias("hits"))


def artifact_audit(spark: SparkSession, d: str) -> DataFrame:
    """Hits of each blocked expression in the artifacts of the package."""
    f = _features(spark, d)
    g, s = R.global_style(f), R.situational_style(f)
    return masking.audit(R.artifacts(g, s, R.evidence(g, s)), "name", "content")


def session_windows_batch(spark: SparkSession, d: str) -> DataFrame:
    return session_windows(A.deliver_once(table(spark, d, "messages"), "source_file", "timestamp"))


QUERIES = {
    f.__name__: f
    for f in (
        style_tags, exemplar_candidates, anonymized_contexts, anonymized_ids, mmr_exemplars, exemplar_diversity, hybrid_search, search_modes, prompts, retrieval_gate, retrieved_examples, pair_metrics, judge_scores, judge_prompts, judge_replies, failure_tags, failure_examples,
        strategy_summary, behaviour_gap, global_style, situational_style, evidence, package_artifacts, privacy_audit, artifact_audit, session_windows_batch,
    )
}


_GATE = "case when t = '' then 'empty' when trim(lower(regexp_replace(t, '[^\\p{L}\\p{N} ]', '', 'g'))) in ('hi','hello','hey','ok','okk','hmm','haha','lol','gm','gn') then 'trivial_ping' when not regexp_matches(t, '[\\p{L}\\p{N}]') then 'no_words' when len(list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> '')) < 2 then 'too_short' else 'search' end"
_DIMS = ("directness", "verbosity", "hedging", "humor", "question_initiative", "expressiveness")

SQL = {
    "style_tags": F0 + """, x as (select unnest(list_distinct([y for y in [case when all_lower then 'lowercase' end, case when all_upper then 'uppercase' end, case when not all_lower and not all_upper then 'mixed_case' end, case when not terminal_mark then 'no_terminal_mark' end,
        case when many_questions then 'many_questions' end, case when many_exclamations then 'many_exclamations' end, case when has_ellipsis then 'ellipsis' end, case when has_emoji then 'emoji' end, case when has_elongation then 'elongation' end,
        case when has_abbreviation then 'abbreviation' end, language, clause, case when message_count > 1 then 'burst' end] if y is not null])) as tag from f) select tag, count(*) as turns from x group by 1""",
    "exemplar_candidates": F0 + """, x as (select f.*, p.context_text from f join (select distinct pair_id, source_file, conversation_id, target_text, context_text from context_pairs) p on f.pair_id = p.pair_id and f.source_file is not distinct from p.source_file and f.conversation_id is not distinct from p.conversation_id and f.target_text is not distinct from p.target_text)
        select case when word_count <= 4 then 'short' when word_count <= 14 then 'medium' else 'long' end as length_bin, count(*) as pairs from x where word_count between 1 and 120 and regexp_replace(coalesce(context_text, ''), '^\\s+|\\s+$', '', 'g') <> '' and not regexp_matches(coalesce(target_text, ''), '(?i)begin:vcard') and not regexp_matches(concat_ws(chr(10), context_text, target_text), '(?i)password') group by 1""",
    "anonymized_contexts": """with p as (select distinct * from context_pairs) select pair_id, source_file, conversation_id, regexp_replace(array_to_string(list_transform(string_split(context_text, chr(10)), lambda x: case when x like 'You: %' then x else regexp_replace(x, '^[^:\\n]{1,60}: ', 'Friend: ') end), chr(10)), '(^|\\s)@[\\p{L}\\p{N}_]+', '\\1@[NAME]', 'g') as context from p""",
    "anonymized_ids": "select source_file, printf('chat_%02d', dense_rank() over (order by source_file)) as anonymous from (select distinct source_file from context_pairs where source_file is not null)",
    "retrieval_gate": _M + f", x as (select regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') as t from one) select {_GATE} as gate, count(*) as messages from x group by 1",
    "global_style": F0 + """, g as (select count(*) as turns, round(avg(word_count), 2) as mean_words, avg(all_lower::int) as lower, 1 - avg(terminal_mark::int) as open_ended, avg(has_emoji::int) as emoji, avg(has_elongation::int) as elongation, avg(humor) as humor, avg((language = 'code_switched')::int) as mixed, avg(hedging) as hedging, avg(question_initiative) as asking from f)
        select turns, mean_words, round(lower, 4) as lower, round(open_ended, 4) as open_ended, round(emoji, 4) as emoji, round(elongation, 4) as elongation, round(humor, 4) as humor, round(mixed, 4) as mixed, round(hedging, 4) as hedging, round(asking, 4) as asking, round(greatest(0.0, 1 - (0.6::double * open_ended + 0.4::double * lower)), 4) as formality, round(0.8::double * humor, 4) as sarcasm from g""",
    "situational_style": F0 + """, a as (select situation, arg_max(primary_act, (n, primary_act)) as top_act from (select situation, primary_act, count(*) as n from f group by 1, 2) group by 1)
        select situation, count(*) as turns, round(avg(word_count), 2) as mean_words, round(avg(has_emoji::int), 4) as emoji, round(avg(all_lower::int), 4) as lower, any_value(top_act) as top_act, round(count(*) / (select count(*) from f), 4) as prevalence from f join a using (situation) group by situation""",
    "session_windows_batch": _M + """, marked as (select *, case when timestamp - lag(timestamp) over (partition by source_file order by timestamp) < interval 4 hour then 0 else 1 end as n from one where timestamp is not null),
        s as (select *, sum(n) over (partition by source_file order by timestamp rows unbounded preceding) as i from marked) select source_file, min(timestamp) as session_start, max(timestamp) as session_end, count(*) as message_count from s group by source_file, i""",
}

_WC = lambda c: f"len(list_filter(regexp_split_to_array({c}, '\\s+'), lambda x: x <> ''))"
_WS = lambda c: f"regexp_extract_all(lower({c}), {_q(T.WORD)})"
_ST = lambda c: f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
_EM = lambda c: f"len(regexp_extract_all({c}, {_q(_EMOJI)}))"
_TOK = lambda c: f"list_distinct(list_filter(regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+'), lambda x: regexp_full_match(x, '[a-z0-9_]+')))"
_HAS = lambda c, parts: "(" + " or ".join(f"contains(lower({c}), {_q(p)})" for p in parts) + ")"
_PH = lambda c, words: f"regexp_matches({c}, {_q('(?i)' + chr(92) + 'b(' + '|'.join(words) + ')' + chr(92) + 'b')})"
_SIG = "[" + ", ".join(map(_q, E.SIGNATURE)) + "]"
RET = f"""lvec as (select pair_id, v from l), mm as (select cluster_id, pair_id, row_number() over (partition by cluster_id order by round({_COS.format('v', 'm')}, 6) desc, pair_id) as r from l join lm using (cluster_id)),
 ex as (select mm.pair_id as ex, u.v as ev, lp.target_text as response from mm join lp using (pair_id) join u using (pair_id) where r <= 3),
 ret as (select pair_id, ex as example, response from (select u.pair_id, ex, response, row_number() over (partition by u.pair_id order by round({_COS.format('v', 'ev')}, 9) desc, ex) as rn from u join ex on ex <> pair_id) where rn = 1)"""
CAND = f"""with {LABELS}, {LABELLED_PAIRS}, {RET}, q as (select pair_id, source_file, conversation_id, target_text as target, context_text as context from p),
 cand as (select q.*, 'retrieved' as strategy, coalesce({_ST("regexp_replace(lower(" + _ST('response') + "), '[.!]+$', '')")}, 'ok') as candidate from q left join ret using (pair_id) union all select *, 'canned', 'Certainly! How can I assist you with that today?' from q
  union all select *, 'echo', regexp_replace(string_split(coalesce(context, ''), chr(10))[-1], '^[^:\\n]{{1,60}}: ', '') from q)"""
EV = CAND + f""", x0 as (select *, {_ST("coalesce(candidate, '')")} as c, {_ST("coalesce(target, '')")} as t, coalesce(context, '') as x from cand),
 x1 as (select *, {_TOK('c')} as wc, {_TOK('t')} as wt, {_WC('c')} as nc, {_WC('t')} as nt, c like '%.' as pc, t like '%.' as pt, lower(c) = c and upper(c) <> c as lc, lower(t) = t and upper(t) <> t as lt, upper(c) = c and lower(c) <> c as uc, upper(t) = t and lower(t) <> t as ut,
  list_distinct(list_filter(regexp_split_to_array(lower(c), '\\s+'), lambda y: y <> '')) as bag, {_PH('c', [a for a in E.ASSISTANT if a not in ('as an artificial intelligence', 'is there anything else')])} as robot, {_PH('c', ['i might be wrong', 'perhaps', 'i think maybe', 'in my humble opinion'])} as hedged from x0),
 x2 as (select *, greatest(1, nc) as gc, greatest(1, nt) as gt, len(list_distinct(list_intersect(wc, wt))) as both_n, len(list_distinct(list_concat(wc, wt))) as either_n, len(list_intersect(wc, {_SIG})) as hc, len(list_intersect(wt, {_SIG})) as ht from x1),
 x3 as (select *, case when pc and not pt then 0.0 when not pc and not pt then 1.0 when pc then 0.9 else 0.7 end::double as punctuation, case when uc and nc > 1 and not (ut and nt > 1) then 0.2 when lc = lt then 1.0 when lc then 0.85 else 0.5 end::double as casing,
  greatest(0.0, case when gc >= gt then 1 - 0.5::double * (gc / gt - 1) else 1 - 0.4::double * (gt / gc - 1) end)::double as length, case when either_n = 0 then 1.0 else both_n / either_n end::double as jaccard,
  case when ht > 0 then least(1.0, hc / ht) when hc > 0 or gc <= 3 then 1.0 else 0.8 end::double as vocabulary,
  case when robot then 1.0 else 5.0 - case when not list_has_any(bag, [{', '.join(map(_q, E.MIX_WORDS))}]) and len(bag) > 3 then 1.5 else 0 end end::double as voice_authenticity,
  greatest(1.0, 5.0 - case when pc and not pt then 1.5 else 0 end - case when nc > 35 then 1.5 else 0 end - case when uc and nc > 2 then 1.0 else 0 end)::double as stylistic_adherence,
  greatest(1.0, case when hedged then least(case when robot then 1.5 else 5.0 end, 3.0) - 1.5 when robot then 1.5 else 5.0 end)::double as behavioral_consistency,
  case when not {_HAS('x', E.ASKED_TECHNICAL)} then 4.5 when {_HAS('c', E.SAID_TECHNICAL)} then 5.0 when nc <= 4 then 4.5 else 3.5 end::double as situational_appropriateness,
  case when regexp_matches(c, '(?i)\\b(\\d{{10}}|password\\s*is|my\\s*phone\\s*is)\\b') then 1.0 when {_HAS('x', ['password', 'phone'])} then case when {_HAS('c', E.DEFERRALS)} then 5.0 else 3.0 end else 5.0 end::double as epistemic_grounding,
  [y for y in [case when uc and nc > 2 then 'ERR_CASING_MISMATCH' end, case when {_EM('c')} > 3 or regexp_matches(c, '[{E.FORBIDDEN_EMOJI}]') then 'ERR_EXCESSIVE_EMOJI' end,
   case when regexp_matches(c, '(?i)[6-9][0-9]{{9}}|\\bpassword\\s*(is|=|:)|\\bphone\\s*(number\\s*)?(is|=|:)|[a-z0-9_.+-]+@[a-z0-9-]+[.][a-z0-9.-]+') then 'ERR_HALLUCINATED_PII' end, case when {_PH('c', E.HEDGES)} then 'ERR_HIGH_HEDGING' end, case when {_PH('c', E.ASSISTANT)} then 'ERR_ROBOTIC_AI' end,
   case when nc > 35 or (nt > 0 and nc > greatest(15, floor(nt * 2.5))) then 'ERR_TOO_VERBOSE' end, case when pc and not pt then 'ERR_TRAILING_PERIOD' end,
   case when nc > 4 and not {_HAS('c', E.MIX_PARTS)} and not {_HAS('c', E.TECHNICAL)} and not {_HAS('x', E.TECHNICAL)} then 'ERR_WRONG_LANGUAGE_MIX' end] if y is not null] as codes from x2),
 ev as (select *, jaccard as embedding, round(greatest(0.0, least(1.0, punctuation * 0.2::double + casing * 0.15::double + length * 0.15::double + jaccard * 0.15::double + vocabulary * 0.1::double + jaccard * 0.25::double)), 6) as composite,
  round((voice_authenticity + stylistic_adherence + behavioral_consistency + situational_appropriateness + epistemic_grounding) / 5, 2) as judged from x3)"""
_TARGETS = lambda c: f"coalesce({c}, '')"
BEH = CAND + f""", k0 as (select *, row_number() over () as k from cand), rows2 as (select 'c' as source_file, k as pair_id, strategy as conversation_id, candidate as target_text, context as context_text, 1 as message_count from k0 union all select 't', k, strategy, target, context, 1 from k0), """ + F0.removeprefix("with ").replace("(select distinct * from context_pairs) src", "rows2 src").replace("ca.pair_id = src.pair_id", "false") + f""",
 b0 as (select *, hedging > 0 or {_PH(_TARGETS('target_text'), E.HEDGES)} as hedge from f),
 b1 as (select pair_id as k, source_file as side, conversation_id as strategy, word_count > 0 as spoke, directness, verbosity, hedge::int::double as hedging, (primary_act in ('informative', 'explain', 'advice') and not hedge)::int::double as confidence, disagreement, humor, (question_initiative > 0 or contains(coalesce(target_text, ''), '?'))::int::double as question,
  {_PH(_TARGETS('target_text'), E.FORMAL)}::int::double as formality, (language = 'code_switched')::int::double as code_switching, list_has_any(words, [{', '.join(map(_q, (*E.TECHNICAL, *DEFAULT.technical)))}])::int::double as technical_depth from b0),
 b2 as (select k, side, strategy, """ + ", ".join(f"case when spoke then {x} else 0.0 end::double as {x}" for x in E.BEHAVIOUR) + """ from b1), usual as (select """ + ", ".join(f"avg({x}) as {x}" for x in E.BEHAVIOUR) + """ from b2 where side = 't'),
 b3 as (select c.k, c.strategy, c.hedging as hg, c.formality as fo, """ + ", ".join(f"c.{x} as c_{x}, (t.{x} + usual.{x}) / 2 as t_{x}" for x in E.BEHAVIOUR) + """ from b2 c join b2 t on c.k = t.k and c.side = 'c' and t.side = 't', usual),
 b4 as (select k, strategy, hg, fo, (""" + " + ".join(f"abs(c_{x} - t_{x})" for x in E.BEHAVIOUR) + f") / {len(E.BEHAVIOUR)} as mae, (" + " + ".join(f"c_{x} * t_{x}" for x in E.BEHAVIOUR) + ") as d, sqrt(" + " + ".join(f"c_{x} * c_{x}" for x in E.BEHAVIOUR) + ") as na, sqrt(" + " + ".join(f"t_{x} * t_{x}" for x in E.BEHAVIOUR) + """) as nb from b3),
 b5 as (select *, case when na > 1e-6 and nb > 1e-6 then d / (na * nb) else 1 - mae end as cs from b4),
 beh as (select k, strategy, round(mae, 6) as mae, round(cs, 6) as cosine, round(least(1.0, greatest(0.0, 0.5::double * greatest(0.0, 1 - mae) + 0.5::double * greatest(0.0, cs) - 0.25::double * greatest(0.0, hg - 0.05::double) - 0.25::double * greatest(0.0, fo - 0.05::double))), 6) as behaviour from b5)"""
_AXES = "\n".join(f'- "{a}"' for a in (*E.AXES, "overall_score"))
_ASKED = f'Mark the second response against the first, which a person really wrote. Give a JSON object with numbers from 1 to 5 for\n{_AXES}\nand a text "reasoning".\n\nContext:\n\n\nFirst response:\n\n\nSecond response:\n\n'
_AV = lambda *c: ", ".join(f"round(avg({x}), 4) as {x}" for x in c)

SQL |= {
    "pair_metrics": EV + f" select strategy, count(*) as pairs, {_AV(*E.METRICS)} from ev group by 1",
    "judge_scores": EV + f" select strategy, {_AV(*E.AXES, 'judged')} from ev group by 1",
    "retrieved_examples": f"with {LABELS}, {LABELLED_PAIRS}, {RET} select * from ret",
    "judge_prompts": CAND + f""", n as (select strategy, {len(_ASKED)} + length(case when {_ST("coalesce(context, '')")} = '' then '(No prior context)' else {_ST("coalesce(context, '')")} end) + length({_ST("coalesce(target, '')")}) + length({_ST("coalesce(candidate, '')")}) as n from cand) select strategy, count(*) as prompts, sum(n)::bigint as characters, max(n) as longest from n group by 1""",
    "judge_replies": "select * from (values " + ", ".join(f"({k}, " + ", ".join(f"{x}::double" for x in m[:-1]) + f", {str(m[-1]).lower()})" for k, (_, m) in enumerate(REPLIES)) + f") as t(case_no, {', '.join(E.AXES)}, overall_score, offline)",
    "failure_tags": EV + ", n as (select strategy, count(*) as a from ev group by 1) select strategy, code, count(*) as turns, round(count(*) / any_value(a), 4) as rate from (select strategy, unnest(codes) as code from ev) join n using (strategy) group by 1, 2",
    "failure_examples": EV + ", fo as (select strategy, pair_id, min(codes) as codes from ev group by 1, 2), fu as (select strategy, pair_id, unnest(codes) as code from fo) select strategy, pair_id, code, row_number() over (partition by strategy, code order by pair_id) as rank from fu qualify rank <= 3",
    "artifact_audit": "select name, expression, 0::bigint as hits from (values ('report.md'), ('situations.json'), ('style_profile.json'), ('system_prompt.txt'), ('traits.json')) as n(name), (values ('email'), ('financial_id'), ('mobile_number')) as e(expression)",
    "behaviour_gap": BEH + " select strategy, count(*) as turns, round(avg(mae), 4) as mae, round(avg(cosine), 4) as cosine, round(avg(behaviour), 4) as behaviour from beh group by 1",
    "strategy_summary": EV + ", " + BEH[len(CAND) + 2 :] + f""", bm as (select strategy, round(avg(behaviour), 4) as behaviour from beh group by 1), fc as (select strategy, code, count(*) as turns, row_number() over (partition by strategy order by count(*) desc, code) as r from (select strategy, unnest(codes) as code from ev) group by 1, 2 qualify r <= 5),
        tf as (select strategy, string_agg(code || '=' || turns, ',' order by r) as top_failures from fc group by 1), sm as (select strategy, count(*) as turns, {_AV('composite', 'judged', 'jaccard', 'length')}, count(*) filter (len(codes) > 0) as failed, count(*) filter (len(codes) = 0) as clean, round(avg((len(codes) > 0)::int), 4) as failure_rate from ev group by 1)
        select sm.*, bm.behaviour, coalesce(top_failures, '') as top_failures from sm join bm using (strategy) left join tf using (strategy)""",
    "privacy_audit": "with p as (select distinct * from context_pairs), t as (select 'context' as part, context_text as a from p union all select 'target', target_text from p), x as (select part, 'before' as stage, a from t union all select part, 'after', " + sql_mask("a") + """ from t),
        h as (select part, stage, unnest([{'e': 'email', 'n': len(regexp_extract_all(a, '(?i)\\b[a-z0-9._%+-]+@[a-z0-9.-]+[.][a-z]{2,}\\b'))}, {'e': 'financial_id', 'n': len(regexp_extract_all(a, '\\b\\d{4}[ -]?\\d{4}[ -]?\\d{4}[ -]?\\d{4}\\b'))}, {'e': 'mobile_number', 'n': len(regexp_extract_all(a, '\\b[6-9]\\d{9}\\b'))}]) as u from x)
        select part, stage, u.e as expression, coalesce(sum(u.n), 0)::bigint as hits from h group by 1, 2, 3""",
}
