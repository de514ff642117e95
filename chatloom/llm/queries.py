"""Queries of the operators for training data, and their SQL where SQL can express them on whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import clusters, langs, leaks, packing, pii, runs, splits, textform
from chatloom.runtime import persisted
from chatloom.sources.tables import table


def _documents_model(spark: SparkSession, d: str) -> langs.Automata:
    return langs.fit_documents(langs.document_sample(table(spark, d, "documents")))


def _turns(spark: SparkSession, d: str, model: langs.Automata) -> DataFrame:
    turns = table(spark, d, "parsed_messages").where("message_type = 'text'").select("message_uid", "text")
    given = table(spark, d, "turn_languages").select("message_uid", "classification")
    return langs.turn_classes(turns.join(given, "message_uid", "left"), _names(spark, d), model)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    model = _documents_model(spark, d)
    t = _turns(spark, d, model)
    missing = F.coalesce(F.col("given"), F.lit("")).isin("", "unknown") | (F.trim("given") == "")
    turns = t.where(missing | (F.col("class") != F.col("given"))).select(F.col("message_uid").cast("string").alias("record_id"), F.lit(0).alias("segment_no"), F.col("class").alias("label"))
    s = langs.document_languages(table(spark, d, "documents"), machine=model)
    docs = s.where(F.col("given").isNull() | (F.col("segments") > 1) | (F.col("given") != F.col("language")))
    return turns.distinct().unionByName(docs.select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("record_id"), "segment_no", F.col("language").alias("label")))


def p1_segments(spark: SparkSession, d: str) -> DataFrame:
    """Each document's stretches with language and confidence."""
    return langs.document_languages(table(spark, d, "documents"), machine=_documents_model(spark, d))


def p1_turns(spark: SparkSession, d: str) -> DataFrame:
    """Each turn's class with its confidence beside the given label."""
    return _turns(spark, d, _documents_model(spark, d)).distinct()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return runs.collapse_runs(table(spark, d, "messages")).select("source_file", "first_message_id", "last_message_id")


def p2_runs(spark: SparkSession, d: str) -> DataFrame:
    """Each run of repeats as one event with its count and duration."""
    return runs.collapse_runs(table(spark, d, "messages"))


SPLIT_KEYS = ["source_file", "conversation_id", "pair_id"]


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    r = splits.linked_values(table(spark, d, "context_pairs"), "source_file", SPLIT_KEYS)
    return r.select(F.col("a").alias("file_a"), F.col("b").alias("file_b"))


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each source_file with the smallest of those that must land with it, and how many these are."""
    v = persisted(splits.value_classes(table(spark, d, "context_pairs"), "source_file", SPLIT_KEYS), "file-classes")
    g = v.groupBy("c").agg(F.min("v").alias("class_id"), F.count(F.lit(1)).alias("files"))
    return v.join(g, "c").select(F.col("v").alias("source_file"), "class_id", "files")


def p3_forest(spark: SparkSession, d: str) -> DataFrame:
    """Edges of the spanning forest over key values, with the root of their tree."""
    return splits.forest(table(spark, d, "context_pairs"), SPLIT_KEYS)


def p3_splits(spark: SparkSession, d: str) -> DataFrame:
    """Each row's component and split."""
    return splits.grouped_split(table(spark, d, "context_pairs"), SPLIT_KEYS).select(*SPLIT_KEYS, "component", "split")


def p3_shares(spark: SparkSession, d: str) -> DataFrame:
    """Rows by split."""
    return splits.grouped_split(table(spark, d, "context_pairs").select(*SPLIT_KEYS), SPLIT_KEYS).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def _peaks(spark: SparkSession, d: str) -> DataFrame:
    return persisted(clusters.density_peaks(table(spark, d, "train_target_vectors")), "peaks")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return clusters.exact_groups(_peaks(spark, d)).select(F.col("first_id").alias("first_pair_id"), F.col("id").alias("pair_id"))


def p4_assignments(spark: SparkSession, d: str) -> DataFrame:
    """Each record's cluster and similarity to its centroid."""
    m = clusters.cluster_members(_peaks(spark, d))
    return m.select(F.col("cluster_id"), F.col("id").alias("pair_id"), F.round("similarity_to_centroid", 4).alias("similarity_to_centroid"))


def p4_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Each cluster's size and most typical members."""
    c = clusters.described(clusters.cluster_members(_peaks(spark, d)))
    return c.select("cluster_id", "size", F.to_json("typical").alias("typical"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Each document, or piece of a long one, with its container."""
    return packing.pack(packing.token_counts(table(spark, d, "documents")), "doc_id", "tokens")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers used and space left in them, beside the least number possible."""
    p = p8_containers(spark, d).groupBy("container").agg(F.sum("tokens").alias("used"), F.count(F.lit(1)).alias("items"))
    a = p.agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), F.sum(F.lit(packing.CAPACITY) - F.col("used")).alias("unused"), F.max("used").alias("fullest"))
    return a.withColumn("least_containers", F.ceil(F.col("tokens") / F.lit(packing.CAPACITY)))


def _names(spark: SparkSession, d: str) -> pii.Names:
    return pii.names_of([(table(spark, d, t), "sender") for t in ("messages", "parsed_messages")])


PII_TEXTS = {
    "parsed_messages": ("message_uid", {"text": ("parsed_messages.text", False)}),
    "messages": ("message_id", {"text": ("messages.text", False)}),
    "context_pairs": ("pair_id", {"target_text": ("context_pairs.target_text", False), "context_text": ("context_pairs.context_text", True)}),
}


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    names = _names(spark, d)
    return reduce(DataFrame.unionByName, (pii.occurrences(table(spark, d, t), key, texts, names) for t, (key, texts) in PII_TEXTS.items())).distinct()


def _masked_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    key, texts = PII_TEXTS[name]
    out = pii.masked(table(spark, d, name).select(key, *texts), texts, _names(spark, d))
    return out.select(key, *[c for t in texts for c in (f"{t}_masked", f"{t}_pii_count")]).distinct()


def p6_masked(spark: SparkSession, d: str) -> DataFrame:
    """context_pairs with both texts masked."""
    return _masked_table(spark, d, "context_pairs")


def p6_masked_messages(spark: SparkSession, d: str) -> DataFrame:
    """messages with the text masked."""
    return _masked_table(spark, d, "messages")


def p6_masked_parsed(spark: SparkSession, d: str) -> DataFrame:
    """parsed_messages with the text masked."""
    return _masked_table(spark, d, "parsed_messages")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p9_passages(spark: SparkSession, d: str) -> DataFrame:
    """Each leak with the place and length of its passage."""
    return leaks.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).distinct()


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return textform.same_look_pairs(table(spark, d, "documents"))


def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each document with the class of its look."""
    return textform.look_classes(table(spark, d, "documents"))


QUERIES = {
    "p1_found": p1_found, "p1_segments": p1_segments, "p1_turns": p1_turns,
    "p2_found": p2_found, "p2_runs": p2_runs, 
    "p3_found": p3_found, "p3_splits": p3_splits, "p3_classes": p3_classes, "p3_forest": p3_forest, "p3_shares": p3_shares, "p4_found": p4_found, "p4_assignments": p4_assignments,
    "p4_clusters": p4_clusters, "p8_containers": p8_containers, "p8_fill": p8_fill, "p6_found": p6_found, "p6_masked": p6_masked, "p6_masked_messages": p6_masked_messages, "p6_masked_parsed": p6_masked_parsed,
    "p9_found": p9_found, "p9_passages": p9_passages, "p10_found": p10_found, "p10_classes": p10_classes,
}

_SAME = "nullif(regexp_replace(lower({0}), '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g'), '')"
_USABLE = """u as (select pair_id, min(vectors) as r, min(vectors)::double[] as v from train_target_vectors where vectors is not null and pair_id is not null and len(vectors) = 64
  and len(list_filter(vectors, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(vectors, lambda x: x <> 0)) > 0 group by pair_id)"""

_FILES = f"""with recursive k as (select source_file, '0:' || {_SAME.format('source_file')} as f, '1:' || {_SAME.format('conversation_id')} as c, '2:' || {_SAME.format('pair_id')} as p from context_pairs),
        r as (select *, coalesce(f, c, p) as x from k), h as (select distinct x, unnest([c, p]) as v from r), m as (select v, min(x) as a from h where v is not null group by v having count(*) > 1),
        e as (select distinct m.a, h.x as b from h join m using (v) where h.x <> m.a), b as (select a, b from e union select b, a from e),
        reach(a, b) as (select a, b from b union select reach.a, b.b from reach join b on reach.b = b.a), files as (select distinct source_file, x from r where source_file is not null)"""

SQL: dict[str, str] = {
    "p3_found": _FILES + """ select distinct l.source_file as file_a, o.source_file as file_b from files l join files o on l.source_file < o.source_file and (l.x = o.x or exists (select 1 from reach where reach.a = l.x and reach.b = o.x))""",
    "p3_classes": _FILES + """, linked as (select l.source_file as f, o.source_file as g from files l join files o on l.x = o.x or exists (select 1 from reach where reach.a = l.x and reach.b = o.x))
        select f as source_file, min(g) as class_id, count(distinct g) as files from linked group by f""",
    "p4_found": f"""with {_USABLE}, w as (select pair_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as v from u),
        nb as (select a.pair_id, list(b.pair_id order by b.pair_id) as n from w a, w b where list_dot_product(a.v, b.v) >= 0.75 or a.pair_id = b.pair_id group by 1), g as (select n from nb group by n having count(*) >= 5 and count(*) = len(n))
        select n[1] as first_pair_id, pair_id from nb join g using (n)""",
}
