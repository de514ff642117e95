"""Canonical archive: delivery once, sender statistics, speaker choice and data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.text import strip, word_count

UNKNOWN = "<UNKNOWN>"
REQUIRED = ("message_id", "timestamp", "sender", "text", "message_type", "is_system", "is_media", "is_forwarded", "source_file", "raw_line_start", "raw_line_end", "parse_warnings")
TYPES = ("text", "image", "video", "gif", "audio", "sticker", "document", "album", "deleted", "call", "system")
MEDIA = ("image", "video", "gif", "audio", "sticker", "document", "album")
#: Expected system notices.
NOTICE = r"(?i)^(?:-\s*)?(?:messages and calls are end-to-end encrypted|changed the subject|changed this group's icon|changed the group description|added a new member|you (?:added|removed|created|changed)|.* (?:left|joined|was added|was removed)$|missed (?:voice|video) call)"


def deliver_once(messages: DataFrame, *columns: str) -> DataFrame:
    """One row per message id, the earliest received; ties fall to the smallest line. With columns, only these travel."""
    wanted = list(columns) or messages.columns
    rest = [c for c in wanted if c not in ("message_id", "received_at", "raw_line_start")]
    row = F.struct(F.col("received_at").isNull().alias("n"), "received_at", "raw_line_start", *rest)
    g = messages.groupBy("message_id").agg(F.min(row).alias("r"))
    return g.select(*[F.col("message_id") if c == "message_id" else F.col(f"r.{c}").alias(c) for c in wanted])


def sender_stats(messages: DataFrame) -> DataFrame:
    """One row per sender with counts, sums, averages and two histograms as sorted 'key=count' lists."""
    m = messages.withColumn("sender", F.coalesce("sender", F.lit(UNKNOWN))).withColumn("t", F.coalesce(F.lower("message_type"), F.lit("text"))).withColumn("w", word_count(F.col("text"))).withColumn("c", F.length(F.coalesce("text", F.lit(""))))
    base = m.groupBy("sender", "t", "source_file").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c").alias("c"), F.sum("w").alias("w"), F.count_if("is_media").alias("media"), F.count_if("is_system").alias("system"), F.count_if("is_forwarded").alias("forwarded"),
    )
    per = base.groupBy("sender").agg(
        F.sum("n").alias("message_count"), F.sum(F.when(F.col("t") == "text", F.col("n")).otherwise(0)).alias("text_count"), F.sum("media").alias("media_count"), F.sum("system").alias("system_count"),
        F.sum("forwarded").alias("forwarded_count"), F.sum(F.when(F.col("t") == "deleted", F.col("n")).otherwise(0)).alias("deleted_count"), F.sum("c").alias("total_characters"), F.sum("w").alias("total_words"),
        F.count_distinct("source_file").alias("files"),
    )
    kinds = base.groupBy("sender", "t").agg(F.sum("n").alias("n")).groupBy("sender").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "t", "n"))), ",").alias("message_types"))
    j = per.join(kinds, "sender")
    return j.withColumn("avg_characters", F.round(F.col("total_characters") / F.col("message_count"), 2)).withColumn("avg_words", F.round(F.col("total_words") / F.col("message_count"), 2))


def speaker_ranking(messages: DataFrame, system_phrases: tuple[str, ...] = ("added", "removed", "left", "changed", "created")) -> DataFrame:
    """Senders by files, messages and name, all descending, without names that hold a system phrase."""
    bad = F.lit(False)
    for p in system_phrases:
        bad = bad | F.lower("sender").contains(p)
    s = messages.where(F.col("sender").isNotNull() & ~bad).groupBy("sender").agg(F.count_distinct("source_file").alias("files"), F.count(F.lit(1)).alias("messages"))
    return s


def resolve_speaker(messages: DataFrame, explicit: str | None = None, owner: str = "You") -> DataFrame:
    """One row: the explicit speaker, else the owner if present, else the first of the ranking."""
    r = speaker_ranking(messages)
    if explicit:
        return r.limit(0).select("sender").unionByName(messages.sparkSession.createDataFrame([(explicit,)], "sender string"))
    return r.orderBy((F.col("sender") == owner).desc(), F.desc("files"), F.desc("messages"), F.desc("sender")).limit(1).select("sender")


def system_event(text: Column) -> Column:
    return strip(text).rlike(NOTICE)


def row_issues(messages: DataFrame, large: int = 20_000) -> DataFrame:
    """message_id, source_file, issue: checks of single rows, one row per issue found."""
    ev = F.coalesce(system_event(F.col("text")) | F.col("is_system"), F.lit(False))
    known = F.lower("message_type").isin(*TYPES)
    checks = [
        ("missing_timestamp", F.col("timestamp").isNull()),
        ("missing_sender", F.col("sender").isNull() & ~ev),
        ("empty_text", strip(F.coalesce("text", F.lit(""))) == ""),
        ("unexpected_type", ~F.coalesce(known, F.lit(False))),
        ("large_text", F.length("text") > large),
        ("parse_error", (F.size("parse_warnings") > 0) & ~(F.col("sender").isNull() & ev)),
        ("expected_warning", (F.size("parse_warnings") > 0) & F.col("sender").isNull() & ev),
        ("bad_line_start", F.coalesce(F.col("raw_line_start") <= 0, F.lit(True))),
        ("bad_line_end", F.coalesce(F.col("raw_line_end") < F.col("raw_line_start"), F.lit(True))),
        ("missing_flag", F.col("is_system").isNull() | F.col("is_media").isNull() | F.col("is_forwarded").isNull()),
        ("missing_id", F.coalesce(strip(F.col("message_id")), F.lit("")) == ""),
    ]
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in checks]))
    return messages.select("message_id", "source_file", F.explode(found).alias("issue"))


def order_issues(messages: DataFrame, block: int = 10_000) -> DataFrame:
    """message_id, source_file, issue: a timestamp before the last one of its file, and lines that overlap the previous ones.

    Files are looked at in blocks of lines; what a block has to know of the ones before it is one row per block.
    """
    d = messages.withColumn("__b", F.floor(F.coalesce("raw_line_start", F.lit(0)) / F.lit(block))).withColumn("__key", F.coalesce("source_file", F.lit("\0")))
    at = F.struct("raw_line_start", "message_id")
    ends = d.groupBy("__key", "__b").agg(F.max_by("timestamp", F.when(F.col("timestamp").isNotNull(), at)).alias("ts"), F.max_by("raw_line_end", at).alias("end"))
    bw = Window.partitionBy("__key").orderBy("__b")
    ends = ends.select("__key", "__b", F.last("ts", ignorenulls=True).over(bw.rowsBetween(Window.unboundedPreceding, -1)).alias("carried_ts"), F.lag("end").over(bw).alias("carried_end"))
    w = Window.partitionBy("__key", "__b").orderBy("raw_line_start", "message_id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    d = d.join(ends, ["__key", "__b"])
    d = d.withColumn("last_ts", F.coalesce(F.last("timestamp", ignorenulls=True).over(before), "carried_ts")).withColumn("last_end", F.when(F.row_number().over(w) == 1, F.col("carried_end")).otherwise(F.lag("raw_line_end").over(w)))
    found = F.array_compact(F.array(F.when(F.col("timestamp") < F.col("last_ts"), "timestamp_backward"), F.when(F.col("raw_line_start") <= F.col("last_end"), "line_overlap")))
    return d.select("message_id", "source_file", F.explode(found).alias("issue"))


EXACT_KEY = ("timestamp", "sender", "text", "message_type", "is_system", "is_media", "is_forwarded", "source_file")
POTENTIAL_KEY = ("timestamp", "sender", "text", "message_type", "source_file")


def duplicates(messages: DataFrame, key: tuple[str, ...] = EXACT_KEY) -> DataFrame:
    """The key with the number of rows, and the smallest and largest id, of every key that occurs more than once."""
    return messages.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.min("message_id").alias("first_id"), F.max("message_id").alias("last_id")).where("copies > 1")


def missing_fields(rows: DataFrame, json: str = "value", required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """value, missing: required fields a JSON object lacks; a line that is no object lacks all."""
    keys = F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))
    return rows.select(json, F.array_except(F.array(*[F.lit(r) for r in required]), keys).alias("missing"))


def status(issues: DataFrame) -> DataFrame:
    """One row: FAIL for backward times, overlaps and broken rows, WARN for parse errors, senders and types, else PASS."""
    bad = F.count_if(F.col("issue").isin("timestamp_backward", "line_overlap", "bad_line_start", "bad_line_end", "missing_flag", "missing_id", "missing_timestamp"))
    warn = F.count_if(F.col("issue").isin("parse_error", "missing_sender", "unexpected_type"))
    a = issues.agg(bad.alias("failures"), warn.alias("warnings"), F.count(F.lit(1)).alias("issues"))
    return a.withColumn("status", F.when(F.col("failures") > 0, "FAIL").when(F.col("warnings") > 0, "WARN").otherwise("PASS"))
