"""Queries of the general training-data operators: time stamps (p5) and sessions (p7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.sessions import sessionise
from chatloom.operators.timestamps import normalise_timestamps
from chatloom.sources.tables import table


def p5_normalised(spark: SparkSession, d: str) -> DataFrame:
    """Every message with its instant, or the reason why it has none."""
    r = normalise_timestamps(table(spark, d, "parsed_messages"), table(spark, d, "export_files"))
    return r.select("message_uid", "timestamp", "utc_micros", "ts_status", "tz_version").distinct()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    r = normalise_timestamps(table(spark, d, "parsed_messages").select("message_uid", "timestamp", "source_file"), table(spark, d, "export_files"))
    return r.where(F.col("utc_micros").isNotNull()).select("message_uid", "utc_micros").distinct()


def p5_status(spark: SparkSession, d: str) -> DataFrame:
    """Messages by outcome."""
    r = normalise_timestamps(table(spark, d, "parsed_messages").select("message_uid", "timestamp", "source_file"), table(spark, d, "export_files"))
    return r.groupBy("ts_status").agg(F.count(F.lit(1)).alias("messages"))


def p7_sessions(spark: SparkSession, d: str) -> DataFrame:
    return sessionise(table(spark, d, "messages")).withColumn("senders", F.array_join("senders", "|"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return sessionise(table(spark, d, "messages")).select("source_file", "first_message_id", "last_message_id")


_SESSIONS = """
with one as (select source_file, message_id, timestamp as ts, sender,
                    row_number() over (partition by message_id order by received_at nulls last, source_file, timestamp) as copy
             from messages where timestamp is not null and message_id is not null),
marked as (select *, case when ts - lag(ts) over w < interval 4 hour then 0 else 1 end as is_new from one where copy = 1
           window w as (partition by source_file order by ts, message_id)),
numbered as (select *, sum(is_new) over (partition by source_file order by ts, message_id rows unbounded preceding) as s from marked)
"""

QUERIES = {"p5_found": p5_found, "p5_normalised": p5_normalised, "p5_status": p5_status, "p7_found": p7_found, "p7_sessions": p7_sessions}

SQL = {
    "p7_found": _SESSIONS + """select source_file, arg_min(message_id, (ts, message_id)) as first_message_id,
        arg_max(message_id, (ts, message_id)) as last_message_id from numbered group by source_file, s""",
    "p7_sessions": _SESSIONS + """select source_file, min(ts) as session_start, max(ts) as session_end,
        epoch(max(ts) - min(ts))::double as duration_seconds, count(*) as message_count,
        arg_min(message_id, (ts, message_id)) as first_message_id, arg_max(message_id, (ts, message_id)) as last_message_id,
        coalesce(string_agg(distinct sender, '|' order by sender), '') as senders from numbered group by source_file, s""",
}
