"""Queries over conversations, chunks, segments, pages and events."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loam.functions import text as T
from loam.operators import chunk, dedup, packing
from loam.plans.registry import query, table
from loam.session import ship


@query("SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS text, count(*) AS n_turns FROM conversations WHERE coalesce(text, '') <> '' GROUP BY conv_id")
def conv_text(spark, d):
    turns = table(spark, d, "conversations").where(T.body(F.col("text")) != "")
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return rows.select("conv_id", F.array_join(F.transform("t", lambda x: F.concat_ws(": ", x["role"], x["text"])), "\n").alias("text"), F.size("t").cast("long").alias("n_turns"))


@query(
    """WITH p AS (SELECT conv_id, turn, role, text, lag(role) OVER w AS q_role, lag(text) OVER w AS q FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
        s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, q, text AS a FROM p WHERE role = 'assistant' AND q_role <> 'assistant')
        SELECT conv_id || ':sft' || i AS unit_id, sha256(q) AS q_sha256, sha256(a) AS a_sha256, len(regexp_extract_all(q || chr(10) || a, '[^ \t\n\r]+')) AS n_tokens FROM s"""
)
def sft_pairs(spark, d):
    """A turn of anyone but the assistant with the assistant's answer right after it."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, d, "conversations").withColumn("q_role", F.lag("role").over(w)).withColumn("q", F.lag("text").over(w))
    rows = rows.where((F.col("role") == "assistant") & (F.col("q_role") != "assistant")).withColumn("i", F.row_number().over(w) - 1)
    unit = F.concat(F.col("conv_id").cast("string"), F.lit(":sft"), F.col("i").cast("string"))
    return rows.select(unit.alias("unit_id"), F.sha2("q", 256).alias("q_sha256"), F.sha2("text", 256).alias("a_sha256"), T.word_count(F.concat_ws("\n", "q", "text")).alias("n_tokens"))


@query(
    """WITH p AS (SELECT conv_id, turn, role, text, lag(role) OVER w AS q_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
        k AS (SELECT conv_id, count(*) FILTER (role = 'assistant' AND q_role <> 'assistant') AS pairs, string_agg(role || ': ' || text, chr(10) ORDER BY turn) FILTER (coalesce(text, '') <> '') AS body FROM p GROUP BY conv_id)
        SELECT conv_id || CASE WHEN pairs > 0 THEN ':sft' || i ELSE ':cpt' END AS unit_id, CASE WHEN pairs > 0 THEN 'sft' ELSE 'cpt' END AS kind, CASE WHEN pairs = 0 THEN sha256(coalesce(body, '')) END AS text_sha256
        FROM (SELECT conv_id, pairs, body, unnest(range(0, greatest(pairs, 1))) AS i FROM k)"""
)
def knowledge_units(spark, d):
    """The units of each conversation: its pairs, or the whole of it where it has none."""
    turns = table(spark, d, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    pairs = turns.withColumn("q", F.lag("role").over(w)).groupBy("conv_id").agg(F.count_if((F.col("role") == "assistant") & (F.col("q") != "assistant")).alias("pairs"))
    alone = turns.join(pairs.where("pairs = 0"), "conv_id", "left_semi").where(T.body(F.col("text")) != "")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.concat_ws(": ", x["role"], x["text"])), "\n")
    rows = pairs.join(alone.groupBy("conv_id").agg(body.alias("body")), "conv_id", "left").withColumn("i", F.explode(F.sequence(F.lit(0), F.greatest(F.col("pairs") - 1, F.lit(0)))))
    some = F.col("pairs") > 0
    unit = F.concat(F.col("conv_id").cast("string"), F.when(some, F.concat(F.lit(":sft"), F.col("i").cast("string"))).otherwise(":cpt"))
    return rows.select(unit.alias("unit_id"), F.when(some, "sft").otherwise("cpt").alias("kind"), F.when(~some, F.sha2(T.body(F.col("body")), 256)).alias("text_sha256"))


@query(
    r"""WITH r AS (SELECT conv_id, role, sum(len(regexp_extract_all(text, '\p{L}'))) AS l FROM conversations WHERE role <> 'system' GROUP BY ALL)
        SELECT conv_id, coalesce(sum(l) FILTER (role = 'user'), 0)::BIGINT AS user_letters, coalesce(sum(l) FILTER (role = 'assistant'), 0)::BIGINT AS answer_letters,
               CASE WHEN coalesce(sum(l) FILTER (role = 'user'), 0) >= 20 THEN 'user' ELSE 'all' END AS basis FROM r GROUP BY conv_id"""
)
def conv_letters(spark, d):
    """Which turns tell a conversation's language: the user's if they have 20 letters, else all."""
    rows = table(spark, d, "conversations").where("role <> 'system'").withColumn("l", T.letters(F.col("text")).cast("long"))
    of = lambda role: F.sum(F.when(F.col("role") == role, F.col("l")).otherwise(0))
    return rows.groupBy("conv_id").agg(of("user").alias("user_letters"), of("assistant").alias("answer_letters"), F.when(of("user") >= 20, "user").otherwise("all").alias("basis"))


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunk.prepare(table(spark, d, "documents"), target=60, most=120, least=20, separator="\n")


@query()
def prepared_chunks(spark, d):
    return _chunks(spark, d)


@query()
def chunk_stats(spark, d):
    docs = _chunks(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"), F.first("lines_removed").alias("removed"))
    return docs.agg(F.count(F.lit(1)).alias("docs"), F.count_if(F.col("n") > 1).alias("split"), F.sum("n").alias("chunks"), F.sum("tokens").alias("tokens"), F.sum("removed").alias("lines_removed"))


LINE_CHUNKS = r"""
    lc AS (SELECT doc_id, unnest(range(0, len(l))) AS idx, unnest(l) AS t FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
    ls AS (SELECT *, len(regexp_extract_all(t, '[^ \t\n\r]+')) AS n FROM lc),
    ks AS (SELECT *, n >= 3 AND sha256(t) NOT IN (SELECT sha256(t) FROM ls GROUP BY t HAVING count(*) > 5) AS keep FROM ls)
"""


def _line_chunks(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(F.split(T.body(F.col("text")), "\n")).alias("idx", "t"))
    rows = rows.withColumn("idx", F.col("idx").cast("long")).withColumn("n", T.word_count(F.col("t")).cast("long"))
    often = rows.groupBy("t").agg(F.count(F.lit(1)).alias("k")).where("k > 5").select("t", F.lit(True).alias("often"))
    rows = rows.join(often, "t", "left")
    return rows.withColumn("keep", (F.col("n") >= 3) & F.col("often").isNull()).drop("often")


SEGMENTS_SQL = (
    LINE_CHUNKS
    + """,
    sl AS (SELECT *, lag(idx) OVER w AS p, coalesce(lag(keep) OVER w, false) AS pk, lead(idx) OVER w AS nx, lead(keep) OVER w AS nk FROM ks WINDOW w AS (PARTITION BY doc_id ORDER BY idx)),
    si AS (SELECT *, sum(CASE WHEN keep AND (NOT pk OR idx <> p + 1) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx) AS island FROM sl),
    sg AS (SELECT doc_id, min(idx) AS first_index, max(idx) AS last_index, count(*) AS n_chunks, sum(n)::BIGINT AS token_count, string_agg(t, chr(10) || chr(10) ORDER BY idx) AS text,
        max_by(CASE WHEN nx IS NULL THEN 'doc_end' WHEN nx <> idx + 1 THEN 'gap' WHEN NOT nk THEN 'rejected' END, idx) AS break_reason FROM si WHERE keep GROUP BY doc_id, island)
"""
)


@query(f"WITH {SEGMENTS_SQL} SELECT doc_id, first_index, last_index, n_chunks, token_count, sha256(text) AS text_sha256, break_reason FROM sg")
def segment_islands(spark, d):
    """Runs of neighbouring kept lines; lines under three words and lines that occur over five times are rejected."""
    rows = packing.segments(_line_chunks(spark, d), "doc_id", "idx", F.col("keep"), "t", "n")
    return rows.withColumn("text_sha256", F.sha2("text", 256)).drop("text")


@query(f"WITH {LINE_CHUNKS} SELECT doc_id, idx, coalesce(sum(length(t) + 2) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin FROM ks WHERE keep")
def running_offsets(spark, d):
    before = Window.partitionBy("doc_id").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    rows = _line_chunks(spark, d).where("keep")
    return rows.select("doc_id", "idx", F.coalesce(F.sum(F.length("t") + 2).over(before), F.lit(0)).cast("long").alias("begin"))


@query()
def packed_sequences(spark, d):
    """Pieces of whole documents packed into sequences of 2048 words; one row for each sequence."""
    docs = table(spark, d, "documents").select("doc_id", T.word_count(F.col("text")).alias("n_tokens"))
    packed = packing.pack(docs, "doc_id", "n_tokens", seq_len=2048, buffer_tokens=200_000)
    return packed.groupBy("buffer", "sequence").agg(F.count(F.lit(1)).alias("n_pieces"), F.sum("n_tokens").alias("used"))


@query(f"WITH {LINE_CHUNKS} SELECT doc_id, idx, row_number() OVER (PARTITION BY sha256(t) ORDER BY doc_id, idx) - 1 AS n_before FROM ks WHERE n >= 5")
def first_chunks(spark, d):
    rows = _line_chunks(spark, d).where("n >= 5")
    return dedup.first_chunks(rows, "t", ["doc_id", "idx"]).select("doc_id", "idx", F.col("n_before").cast("long").alias("n_before"))


class _Text(HTMLParser):
    """Text nodes outside script, style and noscript."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "noscript")

    def handle_endtag(self, tag):
        self.skip = max(0, self.skip - (tag in ("script", "style", "noscript")))

    def handle_data(self, data):
        if not self.skip and data.strip():
            self.parts += [x.strip() for x in data.split("\n") if x.strip()]


def html_lines(source: str) -> str:
    parser = _Text()
    parser.feed(source)
    parser.close()
    return "\n".join(parser.parts)


@F.pandas_udf(StringType())
def html_to_text(source: pd.Series) -> pd.Series:
    return source.fillna("").map(html_lines)


@query()
def page_text(spark, d):
    ship(spark)
    rows = table(spark, d, "pages").withColumn("body", html_to_text("html"))
    return rows.select("page_id", F.sha2("body", 256).alias("text_sha256"), F.length("body").alias("n_chars"), F.size(F.split("body", "\n")).alias("n_lines"))


@query(
    r"""SELECT regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, count(*) AS n, count(*) FILTER (regexp_matches(url, '[?&]ref=')) AS with_ref,
        count(*) FILTER (regexp_matches(html, '<article')) AS with_article FROM pages GROUP BY 1"""
)
def url_hosts(spark, d):
    host = F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1)
    return table(spark, d, "pages").groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("url").rlike("[?&]ref=")).alias("with_ref"), F.count_if(F.col("html").rlike("<article")).alias("with_article"))


@query(
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1"""
)
def latest_write_wins(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return dedup.latest(rows, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query(
    """WITH s AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id), r AS (SELECT e.*, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events e)
        SELECT user_id, count(*) AS n_steady, (count(*) - 1) / nullif(epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6, 0) AS per_second FROM r WHERE k > 20 GROUP BY user_id"""
)
def steady_throughput(spark, d):
    """Events per second of each session without its first 20 events."""
    k = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    rows = table(spark, d, "events").withColumn("k", k).where("k > 20")
    seconds = F.unix_micros(F.max("ts").cast("timestamp")) / 1e6 - F.unix_micros(F.min("ts").cast("timestamp")) / 1e6
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_steady"), ((F.count(F.lit(1)) - 1) / F.nullif(seconds, F.lit(0.0))).alias("per_second"))


@query(
    """SELECT coalesce(event_type, 'total') AS event_type, count(*) AS n, count(*) FILTER (value = 0) AS none, count(*) FILTER (value > 0 AND value < 10) AS tiny, count(*) FILTER (value >= 10) AS more FROM events GROUP BY ROLLUP (event_type)"""
)
def backlog_rollup(spark, d):
    rows = table(spark, d, "events").rollup("event_type")
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") == 0).alias("none"), F.count_if((F.col("value") > 0) & (F.col("value") < 10)).alias("tiny"), F.count_if(F.col("value") >= 10).alias("more")
    ).withColumn("event_type", F.coalesce("event_type", F.lit("total")))


@query(
    """WITH l AS (SELECT event_type, user_id, round(epoch(max(ts)) - epoch(min(ts)))::BIGINT AS span FROM events GROUP BY ALL) SELECT event_type, count(*) AS sessions, sum(span)::BIGINT AS seconds FROM l GROUP BY event_type"""
)
def session_hours(spark, d):
    span = F.round(F.unix_micros(F.max("ts").cast("timestamp")) / 1e6 - F.unix_micros(F.min("ts").cast("timestamp")) / 1e6).cast("long")
    return table(spark, d, "events").groupBy("event_type", "user_id").agg(span.alias("span")).groupBy("event_type").agg(F.count(F.lit(1)).alias("sessions"), F.sum("span").alias("seconds"))


@query("""SELECT event_id, user_id, (props->>'k')::BIGINT AS k FROM events WHERE (props->>'k')::BIGINT >= 5""")
def json_projection(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, d, "events").select("event_id", "user_id", k.alias("k")).where("k >= 5")


@query(
    """WITH t(threshold) AS (VALUES (10.0), (25.0), (50.0), (75.0)), e AS (SELECT event_type, value FROM events) SELECT event_type, threshold::DOUBLE AS threshold, count(*) FILTER (value >= threshold) AS flagged, count(*) AS n FROM e, t GROUP BY ALL"""
)
def threshold_sweep(spark, d):
    """Flagged rows at each of a fixed list of thresholds, in one pass and without a join."""
    steps = [10.0, 25.0, 50.0, 75.0]
    rows = table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("value") >= s).alias(f"s{i}") for i, s in enumerate(steps)])
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("threshold"), F.col(f"s{i}").alias("flagged")) for i, s in enumerate(steps)])).alias("x")
    return rows.select("event_type", "n", each).select("event_type", "x.threshold", "x.flagged", "n")
