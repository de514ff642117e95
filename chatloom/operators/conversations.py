"""Conversations, turns and context/response pairs of ordered messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions import text as T

GAP_SECONDS = 4 * 3600
BLOCK = 10_000  # messages or turns of a conversation that are looked at together


def conversations(messages: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Messages with a timestamp, with session_index, conversation_id `file:c00001` and seq, their place in the conversation.

    A step of the gap or more starts a new one. All messages of a file within one span as long as the gap are in one
    session, so only one row per file and span is ordered by file; messages are ordered within the span, `bucket`.
    """
    gap = gap_seconds * 1_000_000
    us = F.unix_micros("timestamp")
    m = messages.where(F.col("timestamp").isNotNull()).withColumn("bucket", F.floor(us / F.lit(gap))).withColumn("__key", F.coalesce("source_file", F.lit("\0")))
    spans = m.groupBy("__key", "bucket").agg(F.min(us).alias("lo"), F.max(us).alias("hi"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("__key").orderBy("bucket")
    spans = spans.withColumn("new", F.coalesce((F.col("lo") - F.lag("hi").over(w) >= gap).cast("int"), F.lit(1))).withColumn("session_index", F.sum("new").over(w))
    before = F.sum("n").over(Window.partitionBy("__key", "session_index").orderBy("bucket")) - F.col("n")
    d = m.join(spans.select("__key", "bucket", "session_index", before.alias("__before")), ["__key", "bucket"]).drop("__key")
    d = d.withColumn("conversation_id", F.format_string("%s:c%05d", "source_file", "session_index"))
    own = F.row_number().over(Window.partitionBy("conversation_id", "bucket").orderBy("timestamp", "message_id"))
    return d.withColumn("seq", (F.col("__before") + own).cast("int")).drop("__before")


def headers(sessions: DataFrame) -> DataFrame:
    """One row per conversation: span, size, participants and who began."""
    g = sessions.groupBy("conversation_id", "source_file").agg(
        F.min("timestamp").alias("start_timestamp"), F.max("timestamp").alias("end_timestamp"), F.count(F.lit(1)).alias("message_count"),
        F.array_join(F.array_sort(F.collect_set("sender")), "|").alias("participants"), F.min_by("sender", F.when(F.col("sender").isNotNull(), F.col("seq"))).alias("initiator"),
    )
    s = F.greatest(F.lit(0), F.floor((F.unix_micros("end_timestamp") - F.unix_micros("start_timestamp")) / 1e6)).cast("long")
    return g.withColumn("duration_seconds", s).withColumn("duration_minutes", F.round(F.col("duration_seconds") / 60, 2))


def participants(sessions: DataFrame) -> DataFrame:
    """conversation_id, sender, messages: how much each participant of a conversation said; null senders are left out."""
    return sessions.where(F.col("sender").isNotNull()).groupBy("conversation_id", "sender").agg(F.count(F.lit(1)).alias("messages"))


def bucket(c: Column, edges: list[tuple[int, str]], last: str) -> Column:
    out = None
    for top, name in edges:
        out = F.when(c <= top, name) if out is None else out.when(c <= top, name)
    return out.otherwise(last)


SIZES = [(1, "1"), (5, "2-5"), (20, "6-20"), (50, "21-50")]
DURATIONS = [(0, "0"), (300, "0-5min"), (1800, "5-30min"), (7200, "30min-2h")]
LATENCIES = [(60, "0-1min"), (300, "1-5min"), (1800, "5-30min"), (7200, "30min-2h")]


def turns(sessions: DataFrame) -> DataFrame:
    """One row per island of one speaker: turn_id from 1, speaker, span, ids in order and texts joined by line breaks.

    A null speaker breaks an island and makes no turn, except that the last message of a conversation is kept. A
    conversation is looked at in the buckets of its messages, or in blocks where it has none; what a bucket has to know
    of the ones before it is one row per bucket.
    """
    d = sessions if "bucket" in sessions.columns else sessions.withColumn("bucket", F.floor((F.col("seq") - 1) / F.lit(BLOCK)))
    per = ["conversation_id", "bucket"]
    w, bw = Window.partitionBy(*per).orderBy("seq"), Window.partitionBy("conversation_id").orderBy("bucket")
    ends = d.groupBy(*per).agg(F.max(F.struct("seq", "sender")).alias("e"))
    ends = ends.select(*per, F.lag("e.sender").over(bw).alias("__prev"), F.max("e.seq").over(Window.partitionBy("conversation_id")).alias("__last"))
    d = d.join(ends, per)
    before = F.when(F.row_number().over(w) == 1, F.col("__prev")).otherwise(F.lag("sender").over(w))
    begins = (F.col("seq") == 1) | ~F.col("sender").eqNullSafe(before)
    d = d.withColumn("__start", ((F.col("sender").isNotNull() & begins) | (F.col("sender").isNull() & (F.col("seq") == F.col("__last")))).cast("int"))
    d = d.withColumn("__own", F.sum("__start").over(w))
    done = d.groupBy(*per).agg(F.sum("__start").alias("n"))
    done = done.select(*per, (F.sum("n").over(bw) - F.col("n")).alias("__before"))
    d = d.where(F.col("sender").isNotNull() | (F.col("seq") == F.col("__last"))).join(done, per).withColumn("turn_id", (F.col("__before") + F.col("__own")).cast("int"))
    parts = F.array_sort(F.collect_list(F.struct("seq", F.coalesce("text", F.lit("")).alias("text"), "message_id")))
    g = d.groupBy("conversation_id", "source_file", "turn_id").agg(
        F.first("sender").alias("speaker"), F.min("timestamp").alias("start_timestamp"), F.max("timestamp").alias("end_timestamp"), F.count(F.lit(1)).alias("message_count"), parts.alias("p"),
    )
    return g.select(
        "conversation_id", "source_file", "turn_id", "speaker", "start_timestamp", "end_timestamp", "message_count",
        F.transform("p", lambda x: x["message_id"]).alias("message_ids"), F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"),
    )


def context_pairs(turn_rows: DataFrame, speaker: str = "You", k: int = 3, block: int = BLOCK) -> DataFrame:
    """One row per turn of the speaker with up to k turns before it.

    Turns are taken in blocks of a conversation, each with the last k of the block before it.
    """
    b = F.floor((F.col("turn_id") - 1) / F.lit(block))
    near = F.when((F.col("turn_id") - 1) % F.lit(block) >= block - k, F.array(F.struct(b.alias("b"), F.lit(False).alias("seen")), F.struct((b + 1).alias("b"), F.lit(True).alias("seen"))))
    d = turn_rows.withColumn("__p", F.explode(F.coalesce(near, F.array(F.struct(b.alias("b"), F.lit(False).alias("seen")))))).withColumn("__b", F.col("__p.b")).withColumn("__seen", F.col("__p.seen"))
    per = ["conversation_id", "__b"]
    w = Window.partitionBy(*per).orderBy("turn_id")
    ctx = F.collect_list(F.struct("turn_id", "speaker", "text")).over(w.rowsBetween(-k, -1))
    late = (F.unix_micros("start_timestamp") - F.unix_micros(F.lag("end_timestamp").over(w))) / 1e6
    d = d.withColumn("context", ctx).withColumn("response_latency_seconds", F.greatest(F.lit(0.0), late)).where((F.col("speaker") == speaker) & ~F.col("__seen"))
    counts = turn_rows.where(F.col("speaker") == speaker).groupBy("conversation_id", b.alias("__b")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(*per, (F.sum("n").over(Window.partitionBy("conversation_id").orderBy("__b")) - F.col("n")).alias("__before"))
    d = d.join(counts, per)
    n = F.col("__before") + F.row_number().over(w)
    label = F.transform("context", lambda c: F.concat(F.coalesce(c["speaker"], F.lit("<UNKNOWN>")), F.lit(": "), c["text"]))
    return d.select(
        F.format_string("%s:p%04d", "conversation_id", n).alias("pair_id"), "conversation_id", "source_file", (F.col("turn_id") == 1).alias("is_initiation"), F.size("context").alias("context_depth"),
        "response_latency_seconds", F.array_join(label, "\n").alias("context_text"), F.col("text").alias("target_text"), "message_count", F.col("start_timestamp").alias("target_start"), F.col("end_timestamp").alias("target_end"),
    )


def enriched(turn_rows: DataFrame) -> DataFrame:
    """turns with analysis_text, the analysis views of the joined text."""
    return turn_rows.withColumn("analysis_text", T.analysis(T.normalize(F.col("text"))))
