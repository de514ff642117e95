"""Sessions separated by silences, kept in a table that batches are merged into.

No raw event is ever sorted: all events of one key inside one span of the length of the gap belong to one
session, so a batch is first combined to one row for each key and span (map-side, whatever the skew), and only
these rows are ordered. Stored sessions are kept in files by key and slice of time; a batch reads and replaces only
the files that hold sessions within the gap of its own, and publishes them with one rename of a manifest.
"""

from __future__ import annotations

import json
import uuid
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.runtime import persisted, scratch

HOUR_US = 3_600_000_000
GAP_US = 4 * HOUR_US

SLICE_US = 365 * 24 * HOUR_US  # stored sessions are cut into files by the slice they start in
PART_SESSIONS = 10_000  # sessions of the first batch for each part of the keys

SPANS = "key string, part int, start_us long, end_us long, first_id string, last_id string, events long, actors array<string>"


def one_row_per_id(events: DataFrame, key: str, event_id: str, ts: str, keep: list[str], order: str | None = None) -> DataFrame:
    """key, id, us and keep, one row per event id, without null ids and timestamps; the earliest by order, key and time stays."""
    us = F.unix_micros(F.col(ts)) if dict(events.dtypes)[ts] == "timestamp" else F.unix_micros(F.col(ts).cast("timestamp"))
    first = F.col(order) if order else F.lit(None).cast("timestamp")
    row = F.struct(first.isNull().alias("n"), first.alias("o"), F.col(key).alias("key"), us.alias("us"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)])
    g = events.where(F.col(ts).isNotNull() & F.col(event_id).isNotNull()).groupBy(F.col(event_id).alias("id")).agg(F.min(row).alias("r"))
    return g.select("r.key", "id", "r.us", *[F.col(f"r.k{i}").alias(k) for i, k in enumerate(keep)])


def local_sessions(events: DataFrame, gap_us: int = GAP_US, parts: int = 64) -> DataFrame:
    """Sessions within one batch of events(key, id, us, actor): one row each, of the columns of SPANS."""
    at = F.struct("us", "id")
    span = F.floor(F.col("us") / F.lit(gap_us))
    spans = events.groupBy("key", span.alias("span"), "actor").agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.count(F.lit(1)).alias("n"))
    spans = spans.groupBy("key", "span").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("events"), F.collect_set("actor").alias("actors"))
    part = F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")
    return bridge(spans.select("key", part.alias("part"), F.col("lo.us").alias("start_us"), F.col("hi.us").alias("end_us"), F.col("lo.id").alias("first_id"), F.col("hi.id").alias("last_id"), "events", "actors"), gap_us)


def bridge(pieces: DataFrame, gap_us: int = GAP_US) -> DataFrame:
    """Merge pieces of sessions (columns of SPANS, possibly overlapping) that lie within the gap of each other."""
    w = Window.partitionBy("key").orderBy("start_us", "end_us")
    reach = F.max("end_us").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = pieces.withColumn("__new", (reach.isNull() | (F.col("start_us") - reach >= gap_us)).cast("int"))
    numbered = marked.withColumn("__s", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    lo, hi = F.min(F.struct("start_us", "first_id")), F.max(F.struct("end_us", "last_id"))
    g = numbered.groupBy("key", "part", "__s").agg(lo.alias("lo"), hi.alias("hi"), F.sum("events").alias("events"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("actors")))).alias("actors"))
    return g.select("key", "part", F.col("lo.start_us").alias("start_us"), F.col("hi.end_us").alias("end_us"), F.col("lo.first_id").alias("first_id"), F.col("hi.last_id").alias("last_id"), "events", "actors")


def gaps_sessions(df: DataFrame, key: str, ts: str, gap_us: int, order: list[str]) -> DataFrame:
    """Row-level variant: session_index from 1 per key, for operators that need each row's session."""
    w = Window.partitionBy(key).orderBy(*order)
    new = F.coalesce((F.col(ts) - F.lag(ts).over(w) >= gap_us).cast("int"), F.lit(1))
    return df.withColumn("__new", new).withColumn("session_index", F.sum("__new").over(w)).drop("__new")


class ConcurrentMerge(RuntimeError):
    """Another writer has published since the manifest was read; nothing of this merge is visible."""


class SessionTable:
    """Sessions by key in a folder, with numbered manifests; the one of the highest number counts.

    A manifest names files of sessions, each of one part of the keys and one slice of time, with the span they cover,
    and files of seen ids with the span of their events. merge(batch) compares the batch's local sessions with the
    stored ones of the files within the gap, merges what the gap bridges and replaces these files at once: readers
    see the old manifest or the new one, and of two writers that start from one manifest the later one fails. Ids
    seen before are dropped by value, so a batch may be delivered again; with lateness_us, a batch is not compared
    with ids whose newest event lies more than that before its oldest one. Null keys are one key of their own; a
    batch without rows leaves the table as it is. The number of parts follows the size of the first batch.
    """

    def __init__(self, spark: SparkSession, path: str, gap_us: int = GAP_US, parts: int | None = None, slice_us: int = SLICE_US, lateness_us: int | None = None):
        self.spark, self.path, self.gap_us, self.parts, self.slice_us, self.lateness_us = spark, path.rstrip("/"), gap_us, parts, slice_us, lateness_us
        self._fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def manifest(self) -> dict:
        """number, parts, sessions (path, part, lo, hi) and ids (path, lo, hi)."""
        found = self._fs.globStatus(self._fs_path(f"{self.path}/manifests/*"))
        names = [x.getPath().getName() for x in found] if found else []
        names = [n for n in names if n.isdigit()]
        if not names:
            return {"number": 0, "parts": self.parts, "sessions": [], "ids": []}
        return json.loads(self.spark.read.text(f"{self.path}/manifests/{max(names)}", wholetext=True).first()[0])

    def _publish(self, manifest: dict) -> None:
        jvm = self.spark.sparkContext._jvm
        tmp, final = self._fs_path(f"{self.path}/manifests/.{uuid.uuid4().hex}"), self._fs_path(f"{self.path}/manifests/{manifest['number']:012d}")
        out = self._fs.create(tmp, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            fc.rename(tmp, final, none)
        except Exception as e:
            self._fs.delete(tmp, False)
            raise ConcurrentMerge(str(final)) from e

    def read(self) -> DataFrame:
        return self._rows(self.manifest()["sessions"])

    def _rows(self, files: list[dict]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], SPANS)
        return self.spark.read.option("basePath", f"{self.path}/sessions").schema(SPANS + ", version string, slice long").parquet(*[f["path"] for f in files]).drop("version", "slice")

    def merge(self, batch: DataFrame) -> list[str]:
        """Merge events(key, id, us, actor), unique by id; returns the files of sessions that were replaced or added."""
        m, version = self.manifest(), uuid.uuid4().hex
        if m["ids"]:
            lo = batch.agg(F.min("us")).first()[0] if self.lateness_us is not None else None
            seen = [f["path"] for f in m["ids"] if lo is None or f["hi"] >= lo - self.lateness_us]
            if seen:
                batch = batch.join(self.spark.read.schema("seen string").parquet(*seen), F.col("id") == F.col("seen"), "left_anti")
        local = persisted(local_sessions(batch, self.gap_us, 1).drop("part"), "local-sessions")
        parts = m["parts"] or max(1, local.count() // PART_SESSIONS)
        part, at = F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"), F.floor(F.col("start_us") / F.lit(self.slice_us))
        local = local.withColumn("part", part)
        reach = local.groupBy("part", at.alias("slice")).agg(F.min("start_us").alias("lo"), F.max("end_us").alias("hi")).collect()  # one row per part and slice
        if not reach:
            return []
        spans: dict[int, list[tuple[int, int]]] = {}
        for r in reach:
            spans.setdefault(r["part"], []).append((r["lo"] - self.gap_us, r["hi"] + self.gap_us))
        near = [f for f in m["sessions"] if any(a < f["hi"] and f["lo"] < b for a, b in spans.get(f["part"], []))]
        rows, ids = f"{self.path}/sessions/version={version}", f"{self.path}/ids/{version}"
        merged = bridge(local.unionByName(self._rows(near)), self.gap_us).withColumn("slice", at)
        merged.repartition("part", "slice").write.partitionBy("part", "slice").parquet(rows)
        batch.select(F.col("id").alias("seen"), "us").write.parquet(ids)
        new = self.spark.read.parquet(rows).groupBy("part", "slice").agg(F.min("start_us").alias("lo"), F.max("end_us").alias("hi")).collect()  # one row per file
        files = [{"path": f"{rows}/part={r['part']}/slice={r['slice']}", "part": r["part"], "lo": r["lo"], "hi": r["hi"]} for r in new]
        gone = {f["path"] for f in near}
        m["sessions"] = [f for f in m["sessions"] if f["path"] not in gone] + sorted(files, key=lambda f: f["path"])
        m["ids"].append({"path": ids, "lo": min(r["lo"] for r in reach), "hi": max(r["hi"] for r in reach)})
        self._publish({**m, "number": m["number"] + 1, "parts": parts})
        return sorted(f["path"] for f in files)


def sessionise(messages: DataFrame, gap_us: int = GAP_US, batches: int = 2, key: str = "source_file", event_id: str = "message_id", ts: str = "timestamp", actor: str = "sender", arrival: str = "received_at", path: str | None = None) -> DataFrame:
    """Sessions of messages, fed to a SessionTable in batches by time of arrival.

    One row per session: key (as named), session start and end, duration, event count, first and last id and the
    sorted distinct actors; null actors are left out. Rows without timestamp or id are no events; an id counts once;
    rows without time of arrival come with the first batch. A null key is one key.
    """
    spark = messages.sparkSession
    events = one_row_per_id(messages, key, event_id, ts, [actor, arrival], arrival)
    events = persisted(events.select("key", "id", "us", F.col(actor).alias("actor"), F.col(arrival).alias("arrival")), "events") if batches > 1 else events.withColumnRenamed(actor, "actor").withColumnRenamed(arrival, "arrival")
    table = SessionTable(spark, path or scratch(spark, "sessions"), gap_us)
    cuts = events.select(F.percentile_approx("arrival", [i / batches for i in range(1, batches)], 100)).first()[0] or [] if batches > 1 else []
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds, bounds[1:]):
        cond: Column = F.lit(True) if lo is None else F.col("arrival") > F.lit(lo)
        if hi is not None:
            cond = cond & (F.col("arrival") <= F.lit(hi))
        if lo is None:
            cond = cond | F.col("arrival").isNull()
        table.merge(events.where(cond).select("key", "id", "us", "actor"))
    s = table.read()
    return s.select(
        F.col("key").alias(key), F.timestamp_micros("start_us").alias("session_start"), F.timestamp_micros("end_us").alias("session_end"),
        ((F.col("end_us") - F.col("start_us")) / 1e6).alias("duration_seconds"), F.col("events").alias("message_count"),
        F.col("first_id").alias("first_message_id"), F.col("last_id").alias("last_message_id"), F.col("actors").alias("senders"),
    )
