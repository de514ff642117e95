"""Queries on pairs and vectors: filter, sample, split, similarity, clusters and topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.functions.lexicons import DEFAULT
from chatloom.operators import dataset as D
from chatloom.operators import topics as K
from chatloom.operators import vectors as V
from chatloom.plans.archive import _EMOJI, _q, sql_analysis, sql_normalize, sql_word_count
from chatloom.sources.tables import table


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "context_pairs").distinct()


def drop_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).groupBy(F.coalesce(D.drop_reason(F.col("target_text")), F.lit("passed")).alias("reason")).agg(F.count(F.lit(1)).alias("pairs"))


def quality_filter(spark: SparkSession, d: str) -> DataFrame:
    f = D.filtered(_pairs(spark, d))
    return f.groupBy("source_file", "context_depth", "quality_status").agg(F.count(F.lit(1)).alias("pairs"))


def length_bins(spark: SparkSession, d: str) -> DataFrame:
    w = T.word_count(F.col("target_text"))
    return _pairs(spark, d).groupBy(D.length_bin(w).alias("sampling_bin"), D.length_bin(w, 4, 14).alias("exemplar_bin")).agg(F.count(F.lit(1)).alias("pairs"))


def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return D.stratified_sample(_pairs(spark, d).where("source_file is not null")).select("pair_id", "source_file", "conversation_id", "is_initiation", "length_bin", "word_count")


def sample_report(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d).where("source_file is not null")
    before = p.groupBy("source_file").agg(F.count(F.lit(1)).alias("before"))
    after = D.stratified_sample(p).groupBy("source_file").agg(F.count(F.lit(1)).alias("after"))
    return before.join(after, "source_file", "full").select("source_file", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))


def conversation_split(spark: SparkSession, d: str) -> DataFrame:
    return D.conversation_split(_pairs(spark, d))


def split_crosstab(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d)
    s = D.split_pairs(p, D.conversation_split(p)).withColumn("length_bin", D.length_bin(T.word_count(F.col("target_text"))))
    return s.groupBy("split").pivot("length_bin", ["short", "medium", "long"]).agg(F.count(F.lit(1))).na.fill(0)


def split_sources(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of each source by split, with their share of the split."""
    p = _pairs(spark, d)
    g = D.split_pairs(p, D.conversation_split(p)).groupBy("split", F.coalesce("source_file", F.lit("<none>")).alias("source_file")).agg(F.count(F.lit(1)).alias("pairs"))
    return g.withColumn("share", F.round(F.col("pairs") / F.sum("pairs").over(Window.partitionBy("split")), 4))  # one row per source


def split_leakage(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d)
    return D.leakage(D.split_pairs(p, D.conversation_split(p)))


def holdout(spark: SparkSession, d: str) -> DataFrame:
    return D.holdout(_pairs(spark, d)).select("pair_id", "source_file", "conversation_id")


def holdout_bins(spark: SparkSession, d: str) -> DataFrame:
    return D.holdout_by_bin(_pairs(spark, d)).select("pair_id", "source_file", "conversation_id", "length_bin")


# ---- vectors -----------------------------------------------------------------------------------------------------


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return V.usable(table(spark, d, "train_target_vectors"))


def _embeddings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("pair_id"), F.col("embedding").cast("array<double>").alias("v"), "label")


def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    e = _embeddings(spark, d)
    q = e.orderBy("pair_id").limit(1).first()["v"]
    return V.top_k(e, q, 10).select("pair_id", F.round("similarity", 6).alias("similarity"))


def cosine_topk_each(spark: SparkSession, d: str) -> DataFrame:
    """Every vector whose number is divisible by 100 against all vectors."""
    e = _embeddings(spark, d)
    return V.top_k_each(e, e.where("pair_id % 100 = 0"), 5).select("query_id", "pair_id", F.round("similarity", 6).alias("similarity"), "rank")


def vector_norms(spark: SparkSession, d: str) -> DataFrame:
    v = _vectors(spark, d)
    return v.select("pair_id", F.round(V.norm(F.col("v")), 6).alias("norm"), F.round(V.norm(V.unit(F.col("v"))), 6).alias("unit_norm"))


def diversity_index(spark: SparkSession, d: str) -> DataFrame:
    return V.mean_similarity(_vectors(spark, d))


def pair_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Over a draw of at most 1,000 vectors: the operator is defined on a sample."""
    return V.pair_similarity_stats(_embeddings(spark, d).orderBy(F.md5(F.col("pair_id").cast("string")), "pair_id").limit(1000))


def gram_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Similarities between the means of the labels."""
    return V.gram(V.mean_vector(_embeddings(spark, d), ["label"]).select(F.col("label").alias("pair_id"), F.col("m").alias("v")))


def alignment_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each vector beside the mean of its label."""
    e = _embeddings(spark, d)
    m = V.mean_vector(e, ["label"])
    return V.alignment(e.join(m, "label"), "v", "m")


def hybrid_vectors(spark: SparkSession, d: str) -> DataFrame:
    e = _embeddings(spark, d)
    m = V.mean_vector(e, ["label"])
    h = e.join(m, "label").select("pair_id", V.hybrid(F.col("v"), F.col("m"), 0.3).alias("h"), F.col("v").alias("v"))
    return h.select("pair_id", F.round(V.dot(F.col("h"), F.col("v")), 6).alias("similarity"))


def model_gap(spark: SparkSession, d: str) -> DataFrame:
    """Triplets of a vector, its label's mean and the next label's mean."""
    e = _embeddings(spark, d)
    m = V.mean_vector(e, ["label"])
    own = e.join(m.select("label", F.col("m").alias("p")), "label")
    other = m.select(((F.col("label") + 9) % 10).cast("int").alias("label"), F.col("m").alias("g"))
    return V.discrimination(own.join(other, "label"), "v", "p", "g")


def embedding_offline(spark: SparkSession, d: str) -> DataFrame:
    """The length of the offline embedding of each response, 1, or 0 where it has no word."""
    p = _pairs(spark, d).select("pair_id", "target_text", "context_text").distinct()
    h = V.encoded(p, V.hashed_words(), "target_text", "context_text")
    return h.groupBy(F.round(V.norm(F.col("v")), 6).alias("norm")).agg(F.count(F.lit(1)).alias("pairs"))


# ---- clusters and topics -----------------------------------------------------------------------------------------


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "cluster_assignments").groupBy("pair_id").agg(F.min("cluster_id").alias("cluster_id"))
    return _vectors(spark, d).join(a, "pair_id")


def _labelled_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d).groupBy("pair_id").agg(F.min("target_text").alias("target_text"), F.min("context_text").alias("context_text"), F.bool_and("is_initiation").alias("is_initiation"), F.min("source_file").alias("source_file"))
    a = table(spark, d, "cluster_assignments").groupBy("pair_id").agg(F.min("cluster_id").alias("cluster_id"))
    return p.join(a, "pair_id")


def centroids(spark: SparkSession, d: str) -> DataFrame:
    m = V.mean_vector(_labelled(spark, d), ["cluster_id"])
    return m.select("cluster_id", "n", F.round(V.norm(F.col("m")), 6).alias("length"))


def medoids(spark: SparkSession, d: str) -> DataFrame:
    return K.medoids(_labelled(spark, d))


def calinski_harabasz(spark: SparkSession, d: str) -> DataFrame:
    return K.calinski_harabasz(_labelled(spark, d)).select("n", "k", F.round("calinski_harabasz", 4).alias("calinski_harabasz"))


def cluster_profile(spark: SparkSession, d: str) -> DataFrame:
    return K.cluster_profile(_labelled_pairs(spark, d))


def cluster_sources(spark: SparkSession, d: str) -> DataFrame:
    return K.ranked_values(_labelled_pairs(spark, d).where("source_file is not null"), "cluster_id", "source_file", 5)


def cluster_emoji(spark: SparkSession, d: str) -> DataFrame:
    e = _labelled_pairs(spark, d).select("cluster_id", F.explode(T.emojis(F.col("target_text"))).alias("emoji"))
    return K.ranked_values(e, "cluster_id", "emoji", 5)


def ctfidf_terms(spark: SparkSession, d: str) -> DataFrame:
    return K.class_terms(_labelled_pairs(spark, d), "cluster_id", "target_text")


def topic_terms(spark: SparkSession, d: str) -> DataFrame:
    p = _labelled_pairs(spark, d).withColumn("both", F.concat_ws(" ", "context_text", "target_text"))
    return K.class_terms(p, "cluster_id", "both", 10, DEFAULT.stopwords, 3, 50)


def topic_labels(spark: SparkSession, d: str) -> DataFrame:
    return K.topic_labels(topic_terms(spark, d), "cluster_id")


def style_topic_matrix(spark: SparkSession, d: str) -> DataFrame:
    p = _labelled_pairs(spark, d).withColumn("style", D.length_bin(T.word_count(F.col("target_text"))))
    return K.style_by_topic(p, "cluster_id", "style")


def sender_stopwords(spark: SparkSession, d: str) -> DataFrame:
    return K.name_stopwords(table(spark, d, "messages"))


def kmeans_sweep(spark: SparkSession, d: str) -> DataFrame:
    return K.sweep(_vectors(spark, d), range(6, 19))


def topic_sweep(spark: SparkSession, d: str) -> DataFrame:
    """The sweep of the numbers of topics, over the only vectors given, those of the responses."""
    return K.sweep(_vectors(spark, d), range(5, 13))


def best_cluster_k(spark: SparkSession, d: str) -> DataFrame:
    return K.best_k(kmeans_sweep(spark, d))


def best_topic_k(spark: SparkSession, d: str) -> DataFrame:
    return K.best_k(topic_sweep(spark, d))


def kmeans_clusters(spark: SparkSession, d: str) -> DataFrame:
    labels, _, _ = K.kmeans(_vectors(spark, d), 8)
    return labels.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))


def agglomerative(spark: SparkSession, d: str) -> DataFrame:
    """Means of the stale clusters joined to six groups."""
    m = V.mean_vector(_labelled(spark, d), ["cluster_id"]).select(F.col("cluster_id").cast("string").alias("pair_id"), F.col("m").alias("v"))
    return K.agglomerative(m, 6)


P = "p as (select distinct * from context_pairs)"
_T = "regexp_replace(coalesce(target_text, ''), '^\\s+|\\s+$', '', 'g')"
_REASON = f"""case when t = '' then 'empty_response'
 when regexp_full_match(t, {_q(r"(?i)(?:\[forwarded\]\s*)?(?:<[^>]+omitted>\s*)+")}) or (t like '<%' and t like '%omitted>') then 'pure_media_response'
 when t in ('[URL]', '[Forwarded][URL]', '[Forwarded] [URL]', '[Forwarded]' || chr(10) || '[URL]') then 'pure_url_response' when regexp_matches(lower(t), '^-\\s*(messages and calls are end-to-end encrypted|missed (voice|video) call|you (added|removed|created|changed))') then 'system_event_response'
 when regexp_full_match(t, {_q("[" + chr(92) + "s.,;:_*~`'" + chr(34) + "^/|" + chr(92) * 2 + "-]+")}) and not regexp_matches(t, {_q(_EMOJI)}) then 'punctuation_ping'
 when {sql_analysis(sql_normalize('t'))} = '' then 'empty_analysis_text' end"""
R = f"{P}, r as (select *, {_REASON} as reason from (select *, {_T} as t from p))"
_BIN = lambda w, a=3, b=15: f"case when {w} <= {a} then 'short' when {w} <= {b} then 'medium' else 'long' end"
W = f"{P}, b as (select *, {sql_word_count('target_text')} as word_count, {_BIN(sql_word_count('target_text'))} as length_bin from p)"
_DRAW = "md5(concat_ws('|', '42', pair_id, target_text))"
S = W + f""", q as (select *, count(*) over (partition by source_file) as n, count(*) filter (is_initiation) over (partition by source_file) as init,
  row_number() over (partition by source_file, is_initiation, length_bin order by {_DRAW}, pair_id) as r from b where source_file is not null),
 f as (select source_file, length_bin, row_number() over (partition by source_file order by case length_bin when 'short' then 1 when 'medium' then 2 else 3 end) - 1 as place, count(*) over (partition by source_file) as bins
  from (select distinct source_file, length_bin from q where not is_initiation)),
 sample as (select q.* from q left join f using (source_file, length_bin) where n <= 500 or is_initiation or r <= greatest(0, 500 - init) // bins + case when place < greatest(0, 500 - init) % bins then 1 else 0 end)"""
SPLIT = P + """, c as (select distinct conversation_id, source_file from p where conversation_id is not null and source_file is not null),
 cn as (select *, count(*) over (partition by source_file) as n, row_number() over (partition by source_file order by md5(concat_ws('|', '42', conversation_id)), conversation_id) as r from c),
 ct as (select *, greatest(1, round_even(n * 0.15, 0))::int as t from cn),
 m as (select conversation_id, source_file, case when n = 1 then 'train' when n = 2 then case when r = 1 then 'train' else 'test' end
  when n = 3 then case r when 1 then 'train' when 2 then 'dev' else 'test' end when r <= t then 'test' when r <= 2 * t then 'dev' else 'train' end as split from ct),
 m1 as (select conversation_id, min(split) as split from m group by 1),
 a as (select p.*, coalesce(m1.split, 'train') as split from p left join m1 using (conversation_id))"""
U = """u as (select pair_id, min(vectors::double[]) as v from train_target_vectors where vectors is not null and pair_id is not null and len(vectors) = 64
  and len(list_filter(vectors, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(vectors, lambda x: x <> 0)) > 0 group by pair_id)"""
E = "e as (select vec_id as pair_id, embedding::double[] as v, label from embeddings)"
_COS = "(list_dot_product({0}, {1}) / (sqrt(list_dot_product({0}, {0})) * sqrt(list_dot_product({1}, {1}))))"
EM = E + ", em as (select label, count(*) as n, list(x order by i) as m from (select label, i, avg(x) as x, count(*) from (select label, unnest(v) as x, generate_subscripts(v, 1) as i from e) group by label, i) group by label)"
L = U + ", l as (select u.pair_id, v, cluster_id from u join (select pair_id, min(cluster_id) as cluster_id from cluster_assignments group by 1) using (pair_id)), lm as (select cluster_id, list(x order by i) as m, max(n) as n from (select cluster_id, i, avg(x) as x, count(*) as n from (select cluster_id, unnest(v) as x, generate_subscripts(v, 1) as i from l) group by 1, 2) group by 1)"
LP = P + ", lp as (select * from (select pair_id, min(target_text) as target_text, min(context_text) as context_text, bool_and(is_initiation) as is_initiation, min(source_file) as source_file from p group by 1) join (select pair_id, min(cluster_id) as cluster_id from cluster_assignments group by 1) using (pair_id))"


def _terms(text: str, shortest: int, rare: int) -> str:
    stop = "(" + ", ".join(_q(w) for w in DEFAULT.stopwords) + ")"
    return f""", t as (select cluster_id, unnest(regexp_extract_all(lower({text}), {_q(T.WORD)})) as term from lp), c0 as (select cluster_id, term, count(*) as n from t where length(term) >= {shortest} and term not in {stop} and regexp_matches(term, '\\p{{L}}') group by 1, 2),
 sz as (select cluster_id, count(*) as rows from lp group by 1), c as (select c0.* from c0 join sz using (cluster_id) where n >= 2 or rows <= {rare}),
 sc as (select cluster_id, term, n, round(n / sum(n) over (partition by cluster_id) * (ln(1 + ((select count(*) from sz) + 1) / (count(*) over (partition by term) + 1)) + 1), 6) as score from c),
 terms as (select *, row_number() over (partition by cluster_id order by score desc, term) as rank from sc qualify rank <= 10)"""


QUERIES = {
    f.__name__: f
    for f in (
        drop_reasons, quality_filter, length_bins, stratified_sample, sample_report, conversation_split, split_crosstab, split_sources, split_leakage, holdout, holdout_bins,
        cosine_topk, cosine_topk_each, vector_norms, diversity_index, pair_similarity, gram_matrix, alignment_classes, hybrid_vectors, model_gap, embedding_offline,
        centroids, medoids, calinski_harabasz, cluster_profile, cluster_sources, cluster_emoji, ctfidf_terms, topic_terms, topic_labels, style_topic_matrix, sender_stopwords, kmeans_sweep, topic_sweep, best_cluster_k, best_topic_k, kmeans_clusters, agglomerative,
    )
}

SQL = {
    "drop_reasons": f"with {R} select coalesce(reason, 'passed') as reason, count(*) as pairs from r group by 1",
    "quality_filter": f"with {R} select source_file, context_depth, 'passed' as quality_status, count(*) as pairs from r where reason is null group by 1, 2",
    "length_bins": f"with {W} select length_bin as sampling_bin, {_BIN('word_count', 4, 14)} as exemplar_bin, count(*) as pairs from b group by 1, 2",
    "stratified_sample": f"with {S} select pair_id, source_file, conversation_id, is_initiation, length_bin, word_count from sample",
    "sample_report": f"with {S} select source_file, count(*) as before, (select count(*) from sample s where s.source_file = q.source_file) as after from q group by source_file",
    "conversation_split": f"with {SPLIT} select * from m",
    "split_crosstab": f"with {SPLIT}, x as (select split, {_BIN(sql_word_count('target_text'))} as length_bin from a) select split, count(*) filter (length_bin = 'short') as short, count(*) filter (length_bin = 'medium') as medium, count(*) filter (length_bin = 'long') as long from x group by split",
    "split_sources": f"with {SPLIT} select split, coalesce(source_file, '<none>') as source_file, count(*) as pairs, round(count(*) / sum(count(*)) over (partition by split), 4) as share from a group by 1, 2",
    "split_leakage": f"with {SPLIT} select conversation_id, count(distinct split) as splits from a where conversation_id is not null group by 1 having count(distinct split) > 1",
    "holdout": f"with {P} select pair_id, source_file, conversation_id from p order by {_DRAW}, pair_id limit 60",
    "holdout_bins": f"with {W} select pair_id, source_file, conversation_id, length_bin from b qualify row_number() over (partition by length_bin order by {_DRAW}, pair_id) <= 20",
    "cosine_topk": f"with {E}, q as (select v as q from e order by pair_id limit 1) select pair_id, round({_COS.format('v', 'q')}, 6) as similarity from e, q order by {_COS.format('v', 'q')} desc, pair_id limit 10",
    "cosine_topk_each": f"with {E}, s as (select a.pair_id as query_id, b.pair_id, {_COS.format('a.v', 'b.v')} as s from e a, e b where a.pair_id % 100 = 0 and a.pair_id <> b.pair_id) select query_id, pair_id, round(s, 6) as similarity, row_number() over (partition by query_id order by round(s, 9) desc, pair_id) as rank from s qualify rank <= 5",
    "vector_norms": f"with {U} select pair_id, round(sqrt(list_dot_product(v, v)), 6) as norm, 1.0::double as unit_norm from u",
    "diversity_index": f"with {U}, s as (select i, sum(x / n) as x from (select unnest(v) as x, generate_subscripts(v, 1) as i, sqrt(list_dot_product(v, v)) as n from u) group by i), t as (select sum(x * x) as q, (select count(*) from u) as n from s) select n, round((q - n) / (n * (n - 1)), 6) as mean_similarity, round(1 - (q - n) / (n * (n - 1)), 6) as diversity from t",
    "pair_similarity": f"with {E}, x as (select * from e order by md5(pair_id::varchar), pair_id limit 1000), s as (select {_COS.format('a.v', 'b.v')} as s from x a join x b on a.pair_id < b.pair_id) select count(*) as pairs, round(avg(s), 6) as mean, round(median(s), 6) as median, round(stddev_pop(s), 6) as std, round(min(s), 6) as min, round(max(s), 6) as max from s",
    "gram_matrix": f"with {EM} select a.label as a, b.label as b, round({_COS.format('a.m', 'b.m')}, 6) as similarity from em a, em b",
    "alignment_classes": f"with {EM}, s as (select {_COS.format('v', 'm')} as s from e join em using (label)) select count(*) as n, round(avg(s), 6) as mean, round(stddev_pop(s), 6) as std, round(quantile_cont(s, 0.1), 6) as p10, round(quantile_cont(s, 0.25), 6) as p25, round(quantile_cont(s, 0.5), 6) as median, round(quantile_cont(s, 0.75), 6) as p75, round(quantile_cont(s, 0.9), 6) as p90, count(*) filter (s >= 0.5) as mirroring, count(*) filter (s >= 0.2 and s < 0.5) as balanced, count(*) filter (s < 0.2) as reactive from s",
    "hybrid_vectors": f"with {EM}, h as (select pair_id, v, list_transform(list_zip(v, m), lambda x: 0.3 * x[1] + 0.7 * x[2]) as h from e join em using (label)) select pair_id, round(list_dot_product(h, v) / sqrt(list_dot_product(h, h)), 6) as similarity from h",
    "model_gap": f"with {EM}, s as (select {_COS.format('v', 'a.m')} - {_COS.format('v', 'b.m')} as g from e join em a using (label) join em b on b.label = (e.label + 1) % 10) select count(*) as triplets, round(avg(g), 6) as gap, count(*) filter (g > 0) as won from s",
    "centroids": f"with {L} select cluster_id, n, round(sqrt(list_dot_product(m, m)), 6) as length from lm",
    "medoids": f"with {L}, s as (select cluster_id, pair_id, round({_COS.format('v', 'm')}, 6) as similarity_to_centroid from l join lm using (cluster_id)) select *, row_number() over (partition by cluster_id order by similarity_to_centroid desc, pair_id) as rank from s qualify rank <= 3",
    "calinski_harabasz": f"with {L}, a as (select count(*) as n, sum(list_dot_product(v, v)) as sq from l), b as (select count(*) as k, sum(n * list_dot_product(m, m)) as own from lm), g as (select sum(x * x) as gg from (select avg(x) as x from (select unnest(v) as x, generate_subscripts(v, 1) as i from l) group by i)) select n, k, round(((own - n * gg) / (k - 1)) / ((sq - own) / (n - k)), 4) as calinski_harabasz from a, b, g",
    "cluster_profile": f"with {LP}, x as (select *, {sql_word_count('target_text')} as w from lp) select cluster_id, count(*) as size, round(avg(w), 2) as mean_words, median(w) as median_words, min(w) as min_words, max(w) as max_words, round(avg(is_initiation::int), 4) as initiation_ratio, round(100 * count(*) / sum(count(*)) over (), 2) as percentage from x group by 1",
    "cluster_sources": f"with {LP} select cluster_id, source_file, count(*) as uses, row_number() over (partition by cluster_id order by count(*) desc, source_file) as rank from lp where source_file is not null group by 1, 2 qualify rank <= 5",
    "cluster_emoji": f"with {LP}, x as (select cluster_id, unnest(regexp_extract_all(target_text, {_q(_EMOJI)})) as emoji from lp) select cluster_id, emoji, count(*) as uses, row_number() over (partition by cluster_id order by count(*) desc, emoji) as rank from x group by 1, 2 qualify rank <= 5",
    "ctfidf_terms": f"with {LP}" + _terms("target_text", 2, 20) + " select * from terms",
    "topic_terms": f"with {LP}" + _terms("concat_ws(' ', context_text, target_text)", 3, 50) + " select * from terms",
    "topic_labels": f"with {LP}" + _terms("concat_ws(' ', context_text, target_text)", 3, 50) + " select cluster_id, printf('Topic_%02d_', cluster_id) || string_agg(term, '_' order by rank) as label from terms where rank <= 3 group by cluster_id",
    "style_topic_matrix": f"with {LP}, x as (select cluster_id, {_BIN(sql_word_count('target_text'))} as style from lp), g as (select * from (select distinct cluster_id from x), (select distinct style from x)), c as (select cluster_id, style, count(*) as n from x group by 1, 2) select cluster_id, style, coalesce(n, 0) as n, round(coalesce(n, 0) / sum(coalesce(n, 0)) over (partition by cluster_id), 4) as probability, row_number() over (partition by cluster_id order by coalesce(n, 0) desc, style) = 1 as dominant from g left join c using (cluster_id, style)",
    "sender_stopwords": f"select distinct term from (select unnest(regexp_extract_all(lower(sender), {_q(T.WORD)})) as term from messages) where length(term) > 1",
}
