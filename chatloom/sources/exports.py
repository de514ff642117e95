"""Chat exports: text files to framed lines and messages; issue lines kept aside; sinks for nested results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.functions.text import nfc, strip
from chatloom.runtime import persisted

# The header of a message, media marks, notices, formats of dates and times in the order they are tried.
HEADER = r"^\[(\d{1,4}[/-]\d{1,2}[/-]\d{1,4}),\s+(\d{1,2}:\d{2}(?::\d{2})?(?:\s*[APap][Mm])?)\]\s*(.*)$"
LINE_END = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x85  ]"
MEDIA = [("image", "image"), ("video", "video"), ("gif", "gif"), ("audio", "audio|voice message"), ("sticker", "sticker")]
NOTICES = ["Messages and calls are end-to-end encrypted", "You created this group", "You added", "added you", "changed the subject", "changed this group's icon", "changed the group description", "left", "removed"]
DATES = ["M/d/yy", "M/d/yyyy", "d/M/yy", "d/M/yyyy", "yyyy/M/d", "yyyy-M-d", "M-d-yy", "M-d-yyyy", "d-M-yy", "d-M-yyyy"]
TIMES = ["h:mm:ss a", "h:mm a", "H:mm:ss", "H:mm"]
TYPES = {"text": "text", "image": "image", "video": "video", "gif": "gif", "audio": "audio", "voice": "audio", "sticker": "sticker", "document": "document", "album": "album", "deleted": "deleted", "call": "call", "system": "system"}


def read_exports(spark: SparkSession, path: str, pattern: str = "*.txt", recursive: bool = False) -> DataFrame:
    """source_file (base name), content: one row per file. A missing path fails; files must be UTF-8."""
    r = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    f = r.text(path, wholetext=True)
    return f.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("source_file"), F.col("value").alias("content"))


def lines(files: DataFrame) -> DataFrame:
    """source_file, line_no from 1, line."""
    parts = F.split(F.col("content"), LINE_END)
    parts = F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return files.select("source_file", F.posexplode(parts).alias("p", "line")).select("source_file", (F.col("p") + 1).alias("line_no"), "line")


def read_lines(spark: SparkSession, path: str, pattern: str = "*.txt", recursive: bool = False) -> DataFrame:
    """source_file, line_no from 1, line of all files of a folder, or of one file, however large: files are split.

    Lines are numbered within each split of a file, and one row per split carries the number on. A missing path fails.
    """
    r = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).text(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    d = r.select(F.url_decode(name).alias("source_file"), F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__b"), F.monotonically_increasing_id().alias("__i"), F.split("value", LINE_END).alias("parts"))
    d = persisted(d, "export-lines")  # numbers depend on how the files were read, so they are read once
    w = Window.partitionBy("__f").orderBy("__b")
    before = d.groupBy("__f", "__b").agg(F.sum(F.size("parts")).alias("n")).select("__f", "__b", (F.sum("n").over(w) - F.col("n")).alias("__before"))
    own = F.sum(F.size("parts")).over(Window.partitionBy("__f", "__b").orderBy("__i")) - F.size("parts")
    d = d.withColumn("__own", own).join(before, ["__f", "__b"])
    return d.select("source_file", (F.col("__before") + F.col("__own")).alias("__n"), F.posexplode("parts").alias("p", "line")).select("source_file", (F.col("__n") + F.col("p") + 1).cast("int").alias("line_no"), "line")


def read_messages(spark: SparkSession, path: str, pattern: str = "*.txt", recursive: bool = False) -> tuple[DataFrame, DataFrame]:
    """(messages, issues) of the exports at a path: the scan, the framing and the lines that belong to no message."""
    n = read_lines(spark, path, pattern, recursive)
    return parse(n), issues(n)


def timestamps(date: F.Column, time: F.Column) -> F.Column:
    """The first format that fits, month first."""
    both = F.concat_ws(" ", date, F.upper(F.regexp_replace(time, r"\s+", " ")))
    return F.coalesce(*[F.try_to_timestamp(both, F.lit(f"{d} {t}")) for d in DATES for t in TIMES])


def message_type(text: F.Column) -> F.Column:
    """call, deleted, a kind of media, system or text, in this order; a forwarding mark does not count."""
    t = F.regexp_replace(strip(text), r"(?i)^\[forwarded\]\s*", "")
    out = F.when(t.rlike(r"(?i)^-\s*\[call\]\s*$"), "call").when(t.rlike(r"(?i)^this message was deleted$"), "deleted")
    for kind, names in MEDIA:
        out = out.when(t.rlike(rf"(?i)^<(?:{names}) omitted>$"), kind)
    out = out.when(t.rlike(r"(?i)^<album message>$"), "album").when(t.rlike(r"(?is)^<document omitted>(?:\s+.*)?$"), "document")
    for n in NOTICES:
        out = out.when(t.startswith(n), "system")
    return out.otherwise("text")


def parse(numbered: DataFrame, block: int = 100_000) -> DataFrame:
    """Messages of numbered lines: a line with a header starts one, others continue it; columns of a parsed message.

    Headers are counted within blocks of lines, and one row per block carries the count on.
    """
    d = numbered.withColumn("head", F.col("line").rlike(HEADER)).withColumn("__b", F.floor(F.col("line_no") / F.lit(block)))
    one = F.col("head").cast("int")
    bw = Window.partitionBy("source_file").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = d.groupBy("source_file", "__b").agg(F.sum(one).alias("n")).select("source_file", "__b", F.coalesce(F.sum("n").over(bw), F.lit(0)).alias("__before"))
    w = Window.partitionBy("source_file", "__b").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    framed = d.join(before, ["source_file", "__b"]).withColumn("message_id", F.col("__before") + F.sum(one).over(w))
    own = framed.where("message_id > 0").withColumn("part", F.when(F.col("head"), F.regexp_extract("line", HEADER, 3)).otherwise(F.col("line")))
    g = own.groupBy("source_file", "message_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("line_no", "part"))), lambda x: x["part"]).alias("parts"), F.min("line_no").alias("raw_line_start"), F.max("line_no").alias("raw_line_end"),
        F.min_by("line", "line_no").alias("first"),
    )
    head = F.col("parts")[0]
    spaced, colon = F.instr(head, ": "), F.instr(head, ":")
    bare = (spaced == 0) & (colon > 1) & (colon < F.length(head))
    sender = F.when(spaced > 0, F.substring_index(head, ": ", 1)).when(bare, F.substring_index(head, ":", 1))
    body = F.when(spaced > 0, F.substring(head, spaced + 2, F.length(head))).when(bare, F.ltrim(F.substring(head, colon + 1, F.length(head)))).otherwise(head)
    text = F.array_join(F.concat(F.array(body), F.slice("parts", F.lit(2), F.greatest(F.size("parts") - 1, F.lit(0)))), "\n")
    m = g.withColumn("timestamp", timestamps(F.regexp_extract("first", HEADER, 1), F.regexp_extract("first", HEADER, 2))).withColumn("sender", sender).withColumn("text", text)
    m = m.withColumn("message_type", message_type(F.col("text")))
    kind = F.col("message_type")
    warn = F.array_compact(F.array(F.when(F.col("timestamp").isNull(), "timestamp could not be parsed"), F.when(F.col("sender").isNull() & ~kind.isin("system", "call"), "sender is missing")))
    return m.select(
        "message_id", "timestamp", "sender", "text", "message_type", kind.isin("system", "call").alias("is_system"), kind.isin(*[k for k, _ in MEDIA], "album", "document").alias("is_media"),
        F.col("text").startswith("[Forwarded]").alias("is_forwarded"), "raw_line_start", "raw_line_end", "source_file", warn.alias("parse_warnings"),
    )


def issues(numbered: DataFrame) -> DataFrame:
    """Lines with text before the first header of their file."""
    first = numbered.where(F.col("line").rlike(HEADER)).groupBy("source_file").agg(F.min("line_no").alias("first"))
    orphan = (F.col("first").isNull() | (F.col("line_no") < F.col("first"))) & (strip(F.col("line")) != "")
    return numbered.join(first, "source_file", "left").where(orphan).select("source_file", "line_no", "line", F.lit("text before the first message").alias("reason"))


def canonical(parsed: DataFrame, block: int = 100_000) -> DataFrame:
    """Parsed messages with a stable id `file:number`, a known type and text in composed form.

    Messages are numbered within blocks of lines, and one row per block carries the number on.
    """
    types = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
    k = F.lower(F.coalesce("message_type", F.lit("text")))
    b = parsed.withColumn("__b", F.floor(F.coalesce("raw_line_start", F.lit(0)) / F.lit(block)))
    bw = Window.partitionBy("source_file").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = b.groupBy("source_file", "__b").agg(F.count(F.lit(1)).alias("n")).select(F.col("source_file").alias("__f"), F.col("__b").alias("__fb"), F.coalesce(F.sum("n").over(bw), F.lit(0)).alias("__before"))
    w = Window.partitionBy("source_file", "__b").orderBy("raw_line_start", "message_id")
    d = b.join(before, F.col("source_file").eqNullSafe(F.col("__f")) & (F.col("__b") == F.col("__fb"))).withColumn("__n", F.row_number().over(w) + F.col("__before"))
    d = d.withColumn("message_id", F.format_string("%s:%08d", "source_file", "__n")).drop("__n", "__b", "__f", "__fb", "__before")
    return d.withColumn("message_type", F.coalesce(F.try_element_at(types, k), k)).withColumn("text", nfc(F.coalesce("text", F.lit(""))))


def tolerant_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines file with their number; a line that is no object of the schema keeps its text in `malformed`."""
    text = read_lines(spark, path, "*")
    d = text.where(strip(F.col("line")) != "").withColumn("row", F.from_json("line", schema + ", __bad string", {"columnNameOfCorruptRecord": "__bad"}))
    return d.select("source_file", "line_no", F.when(F.col("row").isNull() | F.col("row.__bad").isNotNull(), F.col("line")).alias("malformed"), F.col("row").dropFields("__bad").alias("row"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", by: str | None = None) -> str:
    """Any result as Parquet or JSON lines, optionally one folder per value of a column."""
    w = df.write.mode("overwrite").format(fmt)
    (w.partitionBy(by) if by else w).save(path)
    return path


def nested_results(messages: DataFrame, problem_lines: DataFrame) -> DataFrame:
    """One row per file with its messages and issues, for a nested JSON sink. Files are bounded by what one export holds."""
    m = messages.groupBy("source_file").agg(F.array_sort(F.collect_list(F.struct("message_id", "timestamp", "sender", "text", "message_type", "raw_line_start", "raw_line_end"))).alias("messages"))
    i = problem_lines.groupBy("source_file").agg(F.array_sort(F.collect_list(F.struct("line_no", "line", "reason"))).alias("issues"))
    return m.join(i, "source_file", "full")


def write_vectors(vectors: DataFrame, path: str, model: str, key: str = "pair_id", v: str = "v") -> dict:
    """Vectors as Parquet with a record of their model, number and length beside them; all must have one length."""
    vectors.select(F.col(key).alias("id"), F.col(v).cast("array<float>").alias("vector")).write.mode("overwrite").parquet(f"{path}/vectors")
    r = vectors.sparkSession.read.parquet(f"{path}/vectors").agg(F.count(F.lit(1)).alias("n"), F.min(F.size("vector")).alias("lo"), F.max(F.size("vector")).alias("hi")).first()
    if r["lo"] != r["hi"]:
        raise ValueError(f"vectors of {r['lo']} to {r['hi']} numbers")
    meta = {"model": model, "vectors": r["n"], "dimension": r["hi"] or 0}
    vectors.sparkSession.createDataFrame([tuple(meta.values())], "model string, vectors long, dimension int").coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    return meta


def read_vectors(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """(id, vector) and the record beside them; a table that does not have what the record says fails."""
    meta = spark.read.schema("model string, vectors long, dimension int").json(f"{path}/metadata").first().asDict()
    v = spark.read.parquet(f"{path}/vectors")
    if v.count() != meta["vectors"]:
        raise ValueError("vectors and their record disagree")
    return v, meta


def load_nested(spark: SparkSession, path: str) -> DataFrame:
    """Messages of a nested JSON sink, one row each; a record of another shape fails."""
    schema = "source_file string, messages array<struct<message_id:bigint,timestamp:timestamp,sender:string,text:string,message_type:string,raw_line_start:int,raw_line_end:int>>, issues array<struct<line_no:int,line:string,reason:string>>"
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path).select("source_file", F.explode("messages").alias("m")).select("source_file", "m.*").orderBy("source_file", "message_id")


def cached_stage(spark: SparkSession, folder: str, config: dict, build) -> DataFrame:
    """The table of a stage, built once per configuration: the folder is named by a hash of the configuration."""
    import hashlib
    import json

    key = hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:16]
    path = f"{folder.rstrip('/')}/{key}"
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
