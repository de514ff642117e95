"""Sessions over a stream of messages, with the split at exactly the gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.sessions import GAP_US, SessionTable


def session_windows(stream: DataFrame, ts: str = "timestamp", key: str = "source_file", gap_us: int = GAP_US, late: str = "2 days") -> DataFrame:
    """Sessions by the engine's session windows. Its gap merges at equality, ours splits, so it is shorter by a microsecond."""
    w = F.session_window(F.col(ts), f"{(gap_us - 1) / 1_000_000:.6f} seconds")
    s = stream.where(F.col(ts).isNotNull())
    s = s.withWatermark(ts, late) if s.isStreaming else s
    g = s.groupBy(F.col(key), w.alias("w")).agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("message_count"))
    return g.select(key, "session_start", "session_end", "message_count")


def merge_into(table: SessionTable, key: str = "source_file", event_id: str = "message_id", ts: str = "timestamp", actor: str = "sender"):
    """A function for foreachBatch that merges each micro-batch into a session table; a batch may come again."""

    def run(batch: DataFrame, _: int) -> None:
        e = batch.where(F.col(ts).isNotNull() & F.col(event_id).isNotNull()).groupBy(F.col(event_id).alias("id")).agg(F.min(F.struct(F.col(key).alias("key"), F.unix_micros(F.col(ts)).alias("us"), F.col(actor).alias("actor"))).alias("r"))
        table.merge(e.select("r.key", "id", "r.us", "r.actor"))

    return run


def read_messages(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Parquet files that appear in a folder, as a stream."""
    return spark.readStream.schema(schema).parquet(folder)
