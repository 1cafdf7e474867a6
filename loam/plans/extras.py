"""Queries of sources, streams, near-duplicate families, judge samples and script measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.functions import text as T
from loam.operators import minhash, repair, sample
from loam.plans.documents import FUNNEL_SQL, with_status
from loam.plans.registry import query, table
from loam.session import materialize
from loam.sources import readers
from loam.session import ship
from loam.streaming import ingest


@query()
def minhash_families(spark, d):
    return minhash.families(table(spark, d, "documents"), "doc_id", "text")


_STRATUM = r"source || '/' || CASE WHEN words < 100 THEN 'short' WHEN words < 400 THEN 'medium' ELSE 'long' END"


@query(f"WITH {FUNNEL_SQL} SELECT min(doc_id) AS id, arg_min({_STRATUM}, doc_id) AS stratum, arg_min(band <> 'D', doc_id) AS rule_pass FROM st WHERE words > 0 GROUP BY sha256(text)")
def judge_pool(spark, d):
    return sample.pool(with_status(spark, d), "doc_id", "sha", F.col("m.words"), "source", F.col("quality_band") != "D")


@query()
def judge_sample(spark, d):
    """200 documents, 70 % of which pass the rules, spread evenly over sources and lengths."""
    pool, _ = materialize(judge_pool(spark, d), "pool")
    return sample.stratified(pool, 200)


@query("SELECT source || ':' || doc_id AS key, sha256(coalesce(text, '')) AS source_sha256 FROM documents")
def raw_records(spark, d):
    docs = table(spark, d, "documents")
    made = readers.records(docs, "docs", F.col("text"), F.col("source"), F.col("doc_id"))
    return made.select(F.concat_ws(":", "source_path", F.col("row").cast("string")).alias("key"), "source_sha256")


@query("SELECT date_trunc('hour', ts)::VARCHAR AS hour, event_type, count(*) AS n FROM events GROUP BY ALL")
def streamed_counts(spark, d):
    """Hourly counts by a stream over all events that are there."""
    events = ingest.stream_of(spark, f"{d}/events.parquet*", "event_id long, ts timestamp_ntz, event_type string").withColumn("ts", F.col("ts").cast("timestamp"))
    name = "streamed_counts"
    rows = ingest.run_to_table(ingest.windowed_counts(events), name)
    return rows.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type", "n")


@query(
    r"""SELECT doc_id, len(regexp_extract_all(text, '[\x{0000}-\x{0008}\x{000B}\x{000C}\x{000E}-\x{001F}\x{007F}]')) / greatest(length(text), 1) AS control_share,
        len(list_filter(regexp_extract_all(text, '[\p{L}]+'), lambda w: length(w) = 1)) / greatest(len(regexp_extract_all(text, '[\p{L}]+')), 1) AS single_letter_share,
        len(regexp_extract_all(text, '\p{Ll}\p{Lu}')) / greatest(len(regexp_extract_all(text, '[\p{L}]+')), 1) AS case_mix_share,
        len(regexp_extract_all(text, '[\p{Greek}\p{Cyrillic}\p{Arabic}\p{Thai}]')) / greatest(len(regexp_extract_all(text, '\p{L}')), 1) AS foreign_share
        FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)"""
)
def script_measures(spark, d):
    text = T.body(F.col("text"))
    words = F.regexp_extract_all(text, F.lit(r"([\p{L}]+)"), F.lit(1))
    foreign = r"[\p{IsGreek}\p{IsCyrillic}\p{IsArabic}\p{IsThai}]"
    one = T.let(words, lambda w: T.ratio(F.size(F.filter(w, lambda x: F.length(x) == 1)), F.size(w)))
    return table(spark, d, "documents").select(
        "doc_id",
        T.ratio(T.count_of(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"), F.length(text)).alias("control_share"),
        one.alias("single_letter_share"),
        T.ratio(T.count_of(text, r"\p{Ll}\p{Lu}"), F.size(words)).alias("case_mix_share"),
        T.ratio(T.count_of(text, foreign), T.letters(text)).alias("foreign_share"),
    )


@query(
    r"""WITH w AS (SELECT doc_id, lower(t) AS t FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[\p{L}]{3,}')) AS t FROM documents)),
        v AS (SELECT t FROM w GROUP BY t HAVING count(*) >= 20)
        SELECT doc_id, count(*) AS n_words, count(*) FILTER (t NOT IN (SELECT t FROM v)) / count(*) AS unknown_rate, count(*) FILTER (reverse(t) IN (SELECT t FROM v)) / count(*) - count(*) FILTER (t IN (SELECT t FROM v)) / count(*) AS reversed_gain FROM w GROUP BY doc_id"""
)
def vocabulary_measures(spark, d):
    """Share of words outside the corpus vocabulary (20 uses), and how much better the reversed words would do."""
    words = F.regexp_extract_all(T.body(F.col("text")), F.lit(r"([\p{L}]{3,})"), F.lit(1))
    w = table(spark, d, "documents").select("doc_id", F.explode(words).alias("t")).select("doc_id", F.lower("t").alias("t")).groupBy("doc_id", "t").agg(F.count(F.lit(1)).alias("k"))
    v = w.groupBy("t").agg(F.sum("k").alias("n")).where("n >= 20").select("t")
    known = w.join(v.withColumn("known", F.lit(1)), "t", "left").withColumn("r", F.reverse("t"))
    both = known.join(v.select(F.col("t").alias("r"), F.lit(1).alias("back")), "r", "left")
    of = lambda c: F.sum(F.when(F.col(c).isNotNull(), F.col("k")).otherwise(0))
    n = F.sum("k")
    return both.groupBy("doc_id").agg(n.alias("n_words"), ((n - of("known")) / n).alias("unknown_rate"), (of("back") / n - of("known") / n).alias("reversed_gain"))


@query()
def phone_masks(spark, d):
    text = T.body(F.col("text"))
    return table(spark, d, "documents").select("doc_id", repair.phone_count(text).alias("n_phones"), F.sha2(repair.mask_phones(text), 256).alias("masked_sha256"))


@query()
def repeat_guard(spark, d):
    """Repetitions of each document and the reasons they give."""
    ship(spark)
    rows = table(spark, d, "documents").withColumn("r", repair.repeat_stats("text"))
    reasons = F.array_compact(F.array(F.when(F.col("r.char_run") >= 20, "char_run"), F.when(F.col("r.gram4") >= 8, "loop"), F.when(F.col("r.line_run") >= 5, "line_run")))
    return rows.select("doc_id", "r.*", F.array_join(reasons, ",").alias("reasons"))
