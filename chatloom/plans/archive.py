"""Queries on the message archive: masking, cleaning, statistics, checks, conversations, turns and pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import masking
from chatloom.functions import text as T
from chatloom.operators import archive as A
from chatloom.operators import conversations as C
from chatloom.sources import exports
from chatloom.sources.tables import table


def _messages(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return A.deliver_once(table(spark, d, "messages"), *columns)


ONE = """one as (select * exclude (copy) from (select *, row_number() over (partition by message_id order by received_at nulls last, raw_line_start) as copy from messages) where copy = 1)"""


# ---- reading raw exports -----------------------------------------------------------------------------------------


def export_lines(messages: DataFrame) -> DataFrame:
    """source_file, line_no, line: canonical messages written as the lines of exports, numbered by message and line."""
    head = F.concat(F.lit("["), F.date_format("timestamp", "M/d/yy, h:mm:ss a"), F.lit("] "), F.coalesce(F.concat(F.col("sender"), F.lit(": ")), F.lit("")), F.col("text"))
    n = F.element_at(F.split("message_id", ":"), -1).cast("long")
    d = messages.where("timestamp is not null and text is not null").select("source_file", n.alias("n"), F.posexplode(F.split(head, "\n")).alias("p", "line"))
    return d.select("source_file", (F.col("n") * 1000 + F.col("p")).alias("line_no"), "line")


def parse_exports(spark: SparkSession, d: str) -> DataFrame:
    """The canonical archive written as export lines and framed into messages again, by file."""
    p = exports.parse(export_lines(_messages(spark, d)))
    return p.groupBy("source_file").agg(F.count(F.lit(1)).alias("parsed"), F.sum(F.col("raw_line_end") - F.col("raw_line_start") + 1).cast("long").alias("line_total"), F.count_if("is_media").alias("media"), F.count_if("is_forwarded").alias("forwarded"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))


def type_classifier(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "messages").where("text is not null").select(exports.message_type(F.col("text")).alias("kind"))
    return m.groupBy("kind").agg(F.count(F.lit(1)).alias("messages"))


def canonical_ids(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "parsed_messages").distinct().withColumn("source_line", F.col("raw_line_start"))
    return exports.canonical(p).select("message_uid", "message_id", "source_file", "message_type", F.md5("text").alias("digest"))


# ---- statistics and checks ---------------------------------------------------------------------------------------


def sender_stats(spark: SparkSession, d: str) -> DataFrame:
    return A.sender_stats(_messages(spark, d, "sender", "message_type", "text", "source_file", "is_media", "is_system", "is_forwarded"))


def speaker_ranking(spark: SparkSession, d: str) -> DataFrame:
    return A.speaker_ranking(_messages(spark, d, "sender", "source_file"))


def resolved_speaker(spark: SparkSession, d: str) -> DataFrame:
    return A.resolve_speaker(_messages(spark, d, "sender", "source_file"))


def row_issues(spark: SparkSession, d: str) -> DataFrame:
    return A.row_issues(_messages(spark, d))


def order_issues(spark: SparkSession, d: str) -> DataFrame:
    return A.order_issues(_messages(spark, d, "message_id", "source_file", "timestamp", "raw_line_start", "raw_line_end"))


def issue_counts(spark: SparkSession, d: str) -> DataFrame:
    m = _messages(spark, d)
    return A.row_issues(m).unionByName(A.order_issues(m)).groupBy("issue").agg(F.count(F.lit(1)).alias("rows"))


def validation_status(spark: SparkSession, d: str) -> DataFrame:
    m = _messages(spark, d)
    return A.status(A.row_issues(m).unionByName(A.order_issues(m)))


def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return A.duplicates(table(spark, d, "messages"), A.EXACT_KEY)


def potential_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return A.duplicates(_messages(spark, d, "message_id", *A.POTENTIAL_KEY), A.POTENTIAL_KEY)


def type_histogram(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d, "message_type").groupBy(F.coalesce("message_type", F.lit("<none>")).alias("message_type")).agg(F.count(F.lit(1)).alias("messages"), F.count_if(~F.coalesce(F.lower("message_type").isin(*A.TYPES), F.lit(False))).alias("unexpected"))


# ---- masking and cleaning ----------------------------------------------------------------------------------------


def pii_mask(spark: SparkSession, d: str) -> DataFrame:
    return masking.sanitized(_messages(spark, d, "message_id", "text")).select("message_id", "text", "original_text_masked")


#: Texts with what must come out of them, and the categories found.
MASK_CASES = [
    ("write to desk.one@example.com or b.c@mail.example.org today", "write to [EMAIL] or [EMAIL] today", "email"),
    ("see https://www.example.com/a/?x=1 and https://meet.example.org/k-l-m.", "see [URL] and [URL].", "url"),
    ("(docs at example.io/guide)", "(docs at [URL])", "url"),
    ("ring +91 90000 43210 later", "ring [PHONE_NUMBER] later", "phone_number"),
    ("number 9000043210, thanks", "number [PHONE_NUMBER], thanks", "phone_number"),
    ("here: 90000 56789", "here: [PHONE_NUMBER]", "phone_number"),
    ("office +44 20 7946 0958", "office [PHONE_NUMBER]", "phone_number"),
    ("short +44 20 7946", "short +44 20 7946", ""),
    ("pay 500 to someone@okaxis or shop@paytm.", "pay 500 to [UPI_ID] or [UPI_ID].", "upi_id"),
    ("password is Hidden987", "password is [CREDENTIAL]", "credential"),
    ("key: AIzaSyA0example1234567890abcdefghijkl", "key: [CREDENTIAL]", "credential"),
    ("some.account@example.com\nHidden987", "[EMAIL]\n[CREDENTIAL]", "credential,email"),
    ("Your OTP is 491023 for logging in.", "Your OTP is [OTP] for logging in.", "otp"),
    ("Enter code: 8829", "Enter code: [OTP]", "otp"),
    ("card 4111 2222 3333 4444 exp 12/28", "card [FINANCIAL_ID] exp 12/28", "financial_id"),
    ("broooo this is WILD 😭😭", "broooo this is WILD 😭😭", ""),
    ("Password toh main bhi bhool gaya 💀", "Password toh main bhi bhool gaya 💀", ""),
    ("WHAT?! Are you serious?? ...", "WHAT?! Are you serious?? ...", ""),
    ("Meeting at 10:30, wait for 5 mins, 2026 release", "Meeting at 10:30, wait for 5 mins, 2026 release", ""),
]


def pii_mask_cases(spark: SparkSession, d: str) -> DataFrame:
    """Each literal case masked."""
    s = masking.sanitized(spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(MASK_CASES)], "case_no int, text string"))
    return s.select("case_no", "text", F.array_join("pii_detected", ",").alias("categories"))


def pii_categories(spark: SparkSession, d: str) -> DataFrame:
    s = masking.sanitized(_messages(spark, d, "message_id", "source_file", "text"))
    return s.select(F.explode("pii_detected").alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("messages"))


def pii_by_source(spark: SparkSession, d: str) -> DataFrame:
    s = masking.sanitized(_messages(spark, d, "message_id", "source_file", "text"))
    return s.groupBy("source_file").agg(F.count(F.lit(1)).alias("messages"), F.count_if("original_text_masked").alias("masked"))


def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.md5(T.normalize(F.col("text"))).alias("digest"), F.length(T.normalize(F.col("text"))).alias("characters"))


def nfc_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.md5(T.nfc(F.col("text"))).alias("digest"))


def analysis_text(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d, "message_id", "text").select("message_id", T.analysis(T.normalize(F.col("text"))).alias("analysis_text"))


def token_counts(spark: SparkSession, d: str) -> DataFrame:
    t = T.tokens(T.normalize(F.col("text")))
    return _messages(spark, d, "message_id", "text").select("message_id", F.size(t).alias("tokens"), F.size(T.shouted(t)).alias("shouted"), F.size(T.clusters(t)).alias("clusters"))


def _marks(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d, "message_id", "text").where("text is not null").select("message_id", T.tokens(T.normalize(F.col("text"))).alias("t"))


def elongation_topk(spark: SparkSession, d: str) -> DataFrame:
    e = _marks(spark, d).select(F.explode(T.elongated(F.col("t"))).alias("e")).groupBy(F.lower("e.word").alias("word")).agg(F.count(F.lit(1)).alias("uses"))
    return e.orderBy(F.desc("uses"), "word").limit(15)


def caps_topk(spark: SparkSession, d: str) -> DataFrame:
    e = _marks(spark, d).select(F.explode(T.shouted(F.col("t"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("uses"))
    return e.orderBy(F.desc("uses"), "word").limit(15)


def emoji_topk(spark: SparkSession, d: str) -> DataFrame:
    e = _messages(spark, d, "text").select(F.explode(T.emojis(F.col("text"))).alias("emoji")).groupBy("emoji").agg(F.count(F.lit(1)).alias("uses"))
    return e.orderBy(F.desc("uses"), "emoji").limit(15)


def cleaning_report(spark: SparkSession, d: str) -> DataFrame:
    v = _messages(spark, d, "text").where("text is not null").select(T.views(F.col("text")).alias("v"))
    t = "v.tokenized_text"
    return v.agg(
        F.count(F.lit(1)).alias("messages"), F.round(F.avg(f"{t}.token_count"), 4).alias("avg_tokens"), F.round(F.avg(f"{t}.character_count"), 4).alias("avg_characters"),
        F.count_if(F.size(f"{t}.style_markers.emojis") > 0).alias("with_emoji"), F.count_if(F.size(f"{t}.style_markers.elongated_words") > 0).alias("with_elongation"), F.count_if(F.size(f"{t}.style_markers.all_caps_words") > 0).alias("with_caps"),
    )


# ---- conversations, turns, pairs ---------------------------------------------------------------------------------


def _sessions(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return C.conversations(_messages(spark, d, "message_id", "source_file", "timestamp", "sender", *more))


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return C.turns(_sessions(spark, d, "text"))


def session_headers(spark: SparkSession, d: str) -> DataFrame:
    return C.headers(_sessions(spark, d))


def participants(spark: SparkSession, d: str) -> DataFrame:
    return C.participants(_sessions(spark, d))


def enriched_turns(spark: SparkSession, d: str) -> DataFrame:
    e = C.enriched(_turns(spark, d))
    return e.select("conversation_id", "turn_id", F.md5("analysis_text").alias("digest"), F.length("analysis_text").alias("characters"))


def missing_fields(spark: SparkSession, d: str) -> DataFrame:
    """Required fields that rows of the archive lack when they are written as JSON objects, with how many lack them."""
    j = table(spark, d, "messages").select(F.to_json(F.struct(*A.REQUIRED)).alias("value"))
    m = A.missing_fields(j).select(F.explode("missing").alias("field"))
    return m.groupBy("field").agg(F.count(F.lit(1)).alias("rows"))


def preamble_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines before the first header of a file, where the first message of each file has lost its header."""
    n = export_lines(_messages(spark, d, "message_id", "source_file", "timestamp", "sender", "text"))
    first = n.where(F.col("line").rlike(exports.HEADER)).groupBy("source_file").agg(F.min("line_no").alias("first"))
    bare = n.join(first, "source_file").withColumn("line", F.when(F.col("line_no") == F.col("first"), F.regexp_replace("line", exports.HEADER, "$3")).otherwise(F.col("line")))
    return exports.issues(bare.drop("first")).groupBy("source_file").agg(F.count(F.lit(1)).alias("lines"))


def session_buckets(spark: SparkSession, d: str) -> DataFrame:
    h = C.headers(_sessions(spark, d))
    return h.groupBy(C.bucket(F.col("message_count"), C.SIZES, "51+").alias("size"), C.bucket(F.col("duration_seconds"), C.DURATIONS, "2h+").alias("duration")).agg(F.count(F.lit(1)).alias("conversations"))


def session_report(spark: SparkSession, d: str) -> DataFrame:
    h = C.headers(_sessions(spark, d))
    return h.agg(F.count(F.lit(1)).alias("conversations"), F.sum("message_count").alias("messages"), F.round(F.avg("message_count"), 4).alias("mean_size"), F.median("message_count").alias("median_size"), F.round(F.avg("duration_seconds"), 4).alias("mean_duration"), F.median("duration_seconds").alias("median_duration"))


def session_initiators(spark: SparkSession, d: str) -> DataFrame:
    h = C.headers(_sessions(spark, d)).where("initiator is not null").groupBy("initiator").agg(F.count(F.lit(1)).alias("conversations"))
    return h.orderBy(F.desc("conversations"), "initiator").limit(10)


def turn_islands(spark: SparkSession, d: str) -> DataFrame:
    t = _turns(spark, d)
    return t.select("conversation_id", "turn_id", "speaker", "start_timestamp", "end_timestamp", "message_count", F.array_join("message_ids", ",").alias("message_ids"), "text")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return C.context_pairs(_turns(spark, d))


def context_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d)


def context_depths(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).groupBy("context_depth").agg(F.count(F.lit(1)).alias("pairs"), F.count_if("is_initiation").alias("initiations"))


def latency_buckets(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d).where("response_latency_seconds is not null")
    return p.groupBy(C.bucket(F.col("response_latency_seconds"), C.LATENCIES, "2h+").alias("latency")).agg(F.count(F.lit(1)).alias("pairs"), F.round(F.avg("response_latency_seconds"), 4).alias("mean_seconds"), F.median("response_latency_seconds").alias("median_seconds"))


_M = "with " + ONE
_EMOJI = "[\\x{1F000}-\\x{1FAFF}\\x{2600}-\\x{27BF}\\x{2B00}-\\x{2BFF}]"
_BLANK = "\\s"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_normalize(c: str) -> str:
    zero = "[\\x{200B}\\x{200C}\\x{200D}\\x{FEFF}\\x{200E}\\x{200F}]"
    c = f"regexp_replace({c}, '{zero}', '', 'g')"
    c = f"regexp_replace(replace({c}, chr(160), ' '), '\\r\\n?', chr(10), 'g')"
    c = f"regexp_replace(regexp_replace({c}, '[ \\t\\f\\v]+', ' ', 'g'), ' *\\n *', chr(10), 'g')"
    return f"regexp_replace(regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')"


def sql_analysis(c: str) -> str:
    c = f"regexp_replace(regexp_replace({c}, '(?i)^\\[forwarded\\]\\s*', ''), '(?i)<[^>]+omitted>', '', 'g')"
    c = f"regexp_replace(regexp_replace({c}, '({_EMOJI})', ' \\1 ', 'g'), '([!?.]{{2,}})', ' \\1 ', 'g')"
    for x in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
        c = f"regexp_replace({c}, '{x}{{3,}}', '{x}{x}', 'g')"
    return f"regexp_replace(regexp_replace({c}, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"


#: The masking once more, for the other engine, written out.
_MASKING = [
    (r"(?i)(?:(?:ht|f)tps?://|www[.])[^\s<>\"'{}|\\^`]*[^\s<>\"'{}|\\^`.,!?:;)\]]", "[URL]"),
    (r"(?i)(?:[a-z0-9-]+[.])+(?:com|org|net|edu|gov|io|ai|me|app|co|in|dev|ly|be|gl|is)/[^\s<>\"'{}|\\^`]*[^\s<>\"'{}|\\^`.,!?:;)\]]", "[URL]"),
    (r"(?i)\b[a-z0-9._%+-]+@[a-z0-9.-]+[.][a-z]{2,}\b", "[EMAIL]"),
    (r"(?i)upi://pay[?][^\s<>\"'{}|\\^`]+", "[UPI_ID]"),
    (r"(?i)\b[a-z0-9._-]{2,}@(?:ok(?:axis|hdfcbank|icici|sbi)|paytm|ybl|axl|ibl|apl|upi|postbank|federal|icici|hdfcbank|sbi|kotak)\b", "[UPI_ID]"),
    (r"\bsk-[a-zA-Z0-9]{20,}\b|\bAIza[a-zA-Z0-9_-]{30,45}\b|\bgh[oprsu]_[a-zA-Z0-9]{36}\b|\bxox[abprs]-[a-zA-Z0-9]{10,48}\b", "[CREDENTIAL]"),
    (r"\beyJ[a-zA-Z0-9_-]{10,}[.]eyJ[a-zA-Z0-9_-]{10,}[.][a-zA-Z0-9_-]{10,}\b", "[CREDENTIAL]"),
    (r"(?i)(\b(?:pass(?:word|wd|code)|pwd)\s*(?:is|[:=-])\s*)[^\s,.]+", r"\1[CREDENTIAL]"),
    (r"(\[EMAIL\]\s*\n\s*)[A-Za-z0-9!@#$%^&*()_+=-]{6,}\b", r"\1[CREDENTIAL]"),
    (r"\b\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}\b", "[FINANCIAL_ID]"),
    (r"(?i)(\b(?:otp|one-?\s*time\s*password|(?:verification|auth|security)\s*code|passcode)\s*(?:is|[:=-])?\s*)\d{4,8}\b", r"\1[OTP]"),
    (r"(?i)(\b(?:use|enter|your)\s+(?:code|otp|pin)\s*[:=-]?\s*(?:is\s+)?)\d{4,8}\b", r"\1[OTP]"),
    (r"[+]\d(?:[\s()-]?[\s()-]?\d){9,14}\b", "[PHONE_NUMBER]"),
    (r"(?:[+]91[\s-]?)?(?:\b0)?[6-9]\d{4}[\s-]?\d{5}\b", "[PHONE_NUMBER]"),
    (r"(?:[+]91[\s-]?)?(?:\b0)?[6-9]\d\d[\s-]?\d{3}[\s-]?\d{4}\b", "[PHONE_NUMBER]"),
]


def sql_mask(c: str) -> str:
    for pattern, to in _MASKING:
        c = f"regexp_replace({c}, {_q(pattern)}, {_q(to)}, 'g')"
    return c


def sql_words(c: str) -> str:
    return f"regexp_extract_all(lower({c}), {_q(T.WORD)})"


def sql_word_count(c: str) -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({c}, ''), '\\s+'), lambda x: x <> ''))"


SQL_TOKENS = "regexp_extract_all(" + sql_normalize("text") + ", " + _q(T.TOKEN) + ")"
_LONG = "(" + "|".join(f"{x}{{3,}}|{x.upper()}{{3,}}" for x in "abcdefghijklmnopqrstuvwxyz") + ")"

SEQ = _M + """, ordered as (select *, row_number() over (partition by source_file order by timestamp, message_id) as seq from one where timestamp is not null),
stepped as (select *, case when timestamp - lag(timestamp) over (partition by source_file order by seq) < interval 4 hour then 0 else 1 end as is_new from ordered),
sess as (select *, sum(is_new) over (partition by source_file order by seq rows unbounded preceding)::bigint as session_index from stepped),
conv as (select *, printf('%s:c%05d', source_file, session_index) as conversation_id from sess),
header as (select conversation_id, source_file, min(timestamp) as start_timestamp, max(timestamp) as end_timestamp, count(*) as message_count,
  coalesce(string_agg(distinct sender, '|' order by sender), '') as participants, arg_min(sender, seq) filter (sender is not null) as initiator,
  greatest(0, floor(epoch(max(timestamp) - min(timestamp))))::bigint as duration_seconds, round(greatest(0, floor(epoch(max(timestamp) - min(timestamp)))) / 60, 2) as duration_minutes
  from conv group by conversation_id, source_file)"""

TURNS = SEQ + """, isl as (select *, case when sender is not distinct from lag(sender) over w and seq > min(seq) over (partition by conversation_id) then 0 else 1 end as nw,
  max(seq) over (partition by conversation_id) as last_seq from conv window w as (partition by conversation_id order by seq)),
isl2 as (select *, sum(nw) over (partition by conversation_id order by seq rows unbounded preceding) as i from isl),
tg as (select conversation_id, source_file, i, min(sender) as speaker, min(timestamp) as start_timestamp, max(timestamp) as end_timestamp, count(*) as message_count,
  string_agg(message_id, ',' order by seq) as message_ids, string_agg(coalesce(text, ''), chr(10) order by seq) as text, min(seq) as first_seq
  from isl2 where sender is not null or seq = last_seq group by conversation_id, source_file, i),
turn as (select conversation_id, source_file, row_number() over (partition by conversation_id order by first_seq) as turn_id, speaker, start_timestamp, end_timestamp, message_count, message_ids, text from tg)"""

PAIRS = TURNS + """, ctx as (select *, list(coalesce(speaker, '<UNKNOWN>') || ': ' || text) over (partition by conversation_id order by turn_id rows between 3 preceding and 1 preceding) as c,
  greatest(0.0, epoch(start_timestamp - lag(end_timestamp) over (partition by conversation_id order by turn_id)))::double as late0,
  lag(end_timestamp) over (partition by conversation_id order by turn_id) as prev_end from turn),
pair as (select printf('%s:p%04d', conversation_id, row_number() over (partition by conversation_id order by turn_id)) as pair_id, conversation_id, source_file, turn_id = 1 as is_initiation,
  coalesce(len(c), 0) as context_depth, case when prev_end is not null then late0 else 0.0 end as response_latency_seconds, coalesce(array_to_string(c, chr(10)), '') as context_text,
  text as target_text, message_count, start_timestamp as target_start, end_timestamp as target_end from ctx where speaker = 'You')"""


def _bucket_sql(c: str, edges: list[tuple[int, str]], last: str) -> str:
    return "case " + " ".join(f"when {c} <= {t} then '{n}'" for t, n in edges) + f" else '{last}' end"


_ISSUES = f"""issue as (
  select message_id, source_file, unnest([x for x in [
    case when timestamp is null then 'missing_timestamp' end,
    case when sender is null and not ev then 'missing_sender' end,
    case when regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') = '' then 'empty_text' end,
    case when not coalesce(lower(message_type) in {A.TYPES}, false) then 'unexpected_type' end,
    case when length(text) > LARGE then 'large_text' end,
    case when len(parse_warnings) > 0 and not (sender is null and ev) then 'parse_error' end,
    case when len(parse_warnings) > 0 and sender is null and ev then 'expected_warning' end,
    case when coalesce(raw_line_start <= 0, true) then 'bad_line_start' end,
    case when coalesce(raw_line_end < raw_line_start, true) then 'bad_line_end' end,
    case when is_system is null or is_media is null or is_forwarded is null then 'missing_flag' end,
    case when regexp_replace(coalesce(message_id, ''), '^\\s+|\\s+$', '', 'g') = '' then 'missing_id' end] if x is not null]) as issue
  from (select *, coalesce(regexp_matches(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), {_q(A.NOTICE)}) or is_system, false) as ev from one)),
moved as (select message_id, source_file, unnest([x for x in [case when timestamp < last_ts then 'timestamp_backward' end, case when raw_line_start <= last_end then 'line_overlap' end] if x is not null]) as issue
  from (select *, last_value(timestamp ignore nulls) over (partition by source_file order by raw_line_start, message_id rows between unbounded preceding and 1 preceding) as last_ts,
        lag(raw_line_end) over (partition by source_file order by raw_line_start, message_id) as last_end from one))"""

_STATS_COUNTS = """count(*) as message_count, count(*) filter (t = 'text') as text_count, count(*) filter (is_media) as media_count, count(*) filter (is_system) as system_count, count(*) filter (is_forwarded) as forwarded_count,
 count(*) filter (t = 'deleted') as deleted_count, sum(c) as total_characters, sum(w) as total_words, count(distinct source_file) as files, round(sum(c) / count(*), 2) as avg_characters, round(sum(w) / count(*), 2) as avg_words"""

QUERIES = {
    f.__name__: f
    for f in (
        parse_exports, type_classifier, canonical_ids, sender_stats, speaker_ranking, resolved_speaker, row_issues, order_issues, issue_counts, validation_status, exact_duplicates, potential_duplicates, type_histogram,
        pii_mask, pii_mask_cases, pii_categories, pii_by_source, normalize_text, nfc_text, analysis_text, token_counts, elongation_topk, caps_topk, emoji_topk, cleaning_report,
        participants, enriched_turns, missing_fields, preamble_lines, session_headers, session_buckets, session_report, session_initiators, turn_islands, context_pairs, context_depths, latency_buckets,
    )
}

_MASKED = "masked as (select message_id, source_file, text as raw, " + sql_mask("text") + " as m from one)"
_MARKS = [(m[1:-1].lower(), m) for m in ("[CREDENTIAL]", "[EMAIL]", "[FINANCIAL_ID]", "[OTP]", "[PHONE_NUMBER]", "[UPI_ID]", "[URL]")]
_CAT = "[x for x in [" + ", ".join(f"case when len(string_split(m, '{k}')) > len(string_split(raw, '{k}')) then '{c}' end" for c, k in _MARKS) + "] if x is not null]"

SQL = {
    "parse_exports": _M + """select source_file, count(*) as parsed, sum(1 + length(text) - length(replace(text, chr(10), '')))::bigint as line_total,
        count(*) filter (is_media) as media, count(*) filter (text like '[Forwarded]%' ) as forwarded, min(timestamp) as first_ts, max(timestamp) as last_ts from one where timestamp is not null and text is not null group by source_file""",
    "type_classifier": "with x as (select regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '(?i)^\\[forwarded\\]\\s*', '') as t from messages where text is not null) select case when regexp_full_match(t, '(?i)-\\s*\\[call\\]\\s*') then 'call' when lower(t) = 'this message was deleted' then 'deleted' "
    + " ".join(f"when regexp_full_match(t, '(?i)<(?:{n}) omitted>') then '{k}'" for k, n in exports.MEDIA)
    + " when lower(t) = '<album message>' then 'album' when regexp_full_match(t, '(?is)<document omitted>(?:\\s+.*)?') then 'document' "
    + " ".join(f"when starts_with(t, {_q(n)}) then 'system'" for n in exports.NOTICES)
    + " else 'text' end as kind, count(*) as messages from x group by 1",
    "cleaning_report": _M + f" , x as (select {SQL_TOKENS} as t, {sql_normalize('text')} as n from one where text is not null) select count(*) as messages, round(avg(len(t)), 4) as avg_tokens, round(avg(length(n)), 4) as avg_characters, count(*) filter (regexp_matches(n, {_q(_EMOJI)})) as with_emoji, count(*) filter (len(list_filter(t, lambda y: regexp_matches(y, {_q(_LONG)}))) > 0) as with_elongation, count(*) filter (len(list_filter(t, lambda y: regexp_full_match(y, '[A-Z]{{2,}}'))) > 0) as with_caps from x",
    "canonical_ids": "with p as (select distinct * from parsed_messages) select message_uid, printf('%s:%08d', source_file, row_number() over (partition by source_file order by raw_line_start, message_id)) as message_id, source_file, coalesce(lower(message_type), 'text') as message_type, md5(nfc_normalize(coalesce(text, ''))) as digest from p",
    "sender_stats": _M + ", base as (select coalesce(sender, '<UNKNOWN>') as sender, coalesce(lower(message_type), 'text') as t, source_file, is_media, is_system, is_forwarded, length(coalesce(text, '')) as c, " + sql_word_count("text") + f""" as w from one),
        kinds as (select sender, string_agg(t || '=' || n, ',' order by t || '=' || n) as message_types from (select sender, t, count(*) as n from base group by all) group by sender)
        select s.*, message_types from (select sender, {_STATS_COUNTS} from base group by sender) s join kinds using (sender)""",
    "speaker_ranking": _M + """select sender, count(distinct source_file) as files, count(*) as messages from one where sender is not null and not regexp_matches(lower(sender), 'added|removed|left|changed|created') group by sender""",
    "resolved_speaker": _M + """select sender from (select sender, count(distinct source_file) as files, count(*) as messages from one where sender is not null and not regexp_matches(lower(sender), 'added|removed|left|changed|created') group by sender)
        order by sender = 'You' desc, files desc, messages desc, sender desc limit 1""",
    "row_issues": _M + ", " + _ISSUES.replace("LARGE", "20000") + " select * from issue",
    "order_issues": _M + ", " + _ISSUES.replace("LARGE", "20000") + " select * from moved",
    "issue_counts": _M + ", " + _ISSUES.replace("LARGE", "20000") + " select issue, count(*) as rows from (select * from issue union all select * from moved) group by issue",
    "validation_status": _M + ", " + _ISSUES.replace("LARGE", "20000") + """ , al as (select * from issue union all select * from moved),
        a as (select count(*) filter (issue in ('timestamp_backward','line_overlap','bad_line_start','bad_line_end','missing_flag','missing_id','missing_timestamp')) as failures,
        count(*) filter (issue in ('parse_error','missing_sender','unexpected_type')) as warnings, count(*) as issues from al)
        select *, case when failures > 0 then 'FAIL' when warnings > 0 then 'WARN' else 'PASS' end as status from a""",
    "exact_duplicates": f"select {', '.join(A.EXACT_KEY)}, count(*) as copies, min(message_id) as first_id, max(message_id) as last_id from messages group by {', '.join(A.EXACT_KEY)} having count(*) > 1",
    "potential_duplicates": _M + f" select {', '.join(A.POTENTIAL_KEY)}, count(*) as copies, min(message_id) as first_id, max(message_id) as last_id from one group by {', '.join(A.POTENTIAL_KEY)} having count(*) > 1",
    "type_histogram": _M + f" select coalesce(message_type, '<none>') as message_type, count(*) as messages, count(*) filter (not coalesce(lower(message_type) in {A.TYPES}, false)) as unexpected from one group by 1",
    "pii_mask": _M + ", " + _MASKED + " select message_id, m as text, coalesce(m <> raw, false) as original_text_masked from masked",
    "pii_mask_cases": "select * from (values " + ", ".join(f"({k}, {_q(m)}, {_q(c)})" for k, (_, m, c) in enumerate(MASK_CASES)) + ") as t(case_no, text, categories)",
    "pii_categories": _M + ", " + _MASKED + f" select category, count(*) as messages from (select unnest({_CAT}) as category from masked) group by category",
    "pii_by_source": _M + ", " + _MASKED + " select source_file, count(*) as messages, count(*) filter (coalesce(m <> raw, false)) as masked from masked group by source_file",
    "normalize_text": f"select doc_id, md5({sql_normalize('text')}) as digest, length({sql_normalize('text')}) as characters from documents where text is not null",
    "nfc_text": "select doc_id, md5(nfc_normalize(text)) as digest from documents where text is not null",
    "analysis_text": _M + f" select message_id, {sql_analysis(sql_normalize('text'))} as analysis_text from one",
    "token_counts": _M + f" select message_id, len(t) as tokens, len(list_filter(t, lambda x: regexp_full_match(x, '[A-Z]{{2,}}'))) as shouted, len(list_filter(t, lambda x: regexp_full_match(x, '[!?.]{{2,}}'))) as clusters from (select message_id, {SQL_TOKENS} as t from one)",
    "elongation_topk": _M + f" select lower(x) as word, count(*) as uses from (select unnest({SQL_TOKENS}) as x from one) where regexp_matches(x, {_q(_LONG)}) group by 1 order by uses desc, word limit 15",
    "caps_topk": _M + f" select x as word, count(*) as uses from (select unnest({SQL_TOKENS}) as x from one) where regexp_full_match(x, '[A-Z]{{2,}}') group by 1 order by uses desc, word limit 15",
    "emoji_topk": _M + f" select emoji, count(*) as uses from (select unnest(regexp_extract_all(text, {_q(_EMOJI)})) as emoji from one) group by 1 order by uses desc, emoji limit 15",
    "participants": SEQ + " select conversation_id, sender, count(*) as messages from conv where sender is not null group by 1, 2",
    "enriched_turns": TURNS + f" select conversation_id, turn_id, md5({sql_analysis(sql_normalize('text'))}) as digest, length({sql_analysis(sql_normalize('text'))}) as characters from turn",
    "missing_fields": "select field, rows from (" + " union all ".join(f"select '{c}' as field, count(*) as rows from messages where {c} is null" for c in A.REQUIRED) + ") where rows > 0",
    "preamble_lines": _M + """, x as (select *, row_number() over (partition by source_file order by split_part(message_id, ':', -1)::bigint) as r, coalesce(sender || ': ', '') || text as body from one where timestamp is not null and text is not null and source_file is not null)
        select source_file, len(list_filter(string_split(body, chr(10)), lambda y: regexp_replace(y, '\\s', '', 'g') <> '')) as lines from x where r = 1 and len(list_filter(string_split(body, chr(10)), lambda y: regexp_replace(y, '\\s', '', 'g') <> '')) > 0""",
    "session_headers": SEQ + " select * from header",
    "session_buckets": SEQ + f" select {_bucket_sql('message_count', C.SIZES, '51+')} as size, {_bucket_sql('duration_seconds', C.DURATIONS, '2h+')} as duration, count(*) as conversations from header group by all",
    "session_report": SEQ + " select count(*) as conversations, sum(message_count)::bigint as messages, round(avg(message_count), 4) as mean_size, median(message_count) as median_size, round(avg(duration_seconds), 4) as mean_duration, median(duration_seconds) as median_duration from header",
    "session_initiators": SEQ + " select initiator, count(*) as conversations from header where initiator is not null group by 1 order by conversations desc, initiator limit 10",
    "turn_islands": TURNS + " select conversation_id, turn_id, speaker, start_timestamp, end_timestamp, message_count, message_ids, text from turn",
    "context_pairs": PAIRS + " select * from pair",
    "context_depths": PAIRS + " select context_depth, count(*) as pairs, count(*) filter (is_initiation) as initiations from pair group by 1",
    "latency_buckets": PAIRS + f" select {_bucket_sql('response_latency_seconds', C.LATENCIES, '2h+')} as latency, count(*) as pairs, round(avg(response_latency_seconds), 4) as mean_seconds, median(response_latency_seconds) as median_seconds from pair where response_latency_seconds is not null group by 1",
}
