"""Audits, gates, samples and plans over documents, their lines (as pages), labels, events and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loam.functions import text as T
from loam.operators.order import order_statistics
from loam.plans.documents import _PHONE, FUNNEL_SQL, LINES_SQL, SCORED_SQL, _lines, scored_documents, with_status
from loam.plans.evaluation import ENGINES_SQL, _engines
from loam.plans.registry import query, table

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _hash(prefix: str, value: str = "doc_id") -> Column:
    return F.sha2(F.concat(F.lit(prefix), F.col(value).cast("string")), 256)


# Sources


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n_rows FROM {t}" for t in TABLES))
def row_counts(spark, d):
    """Rows of each table; for Parquet they come from the footers."""
    out = None
    for name in TABLES:
        one = table(spark, d, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT doc_id FROM documents WHERE ('0x' || substr(sha256(coalesce(text, '')), 1, 8))::BIGINT % 4 = 1")
def shard_documents(spark, d):
    """The second of four shards, by the digest of the content."""
    return table(spark, d, "documents").where(T.hex_bucket(T.body(F.col("text")), "sha256", 4) == 1).select("doc_id")


@query("SELECT source, count(*) AS available, count(*) AS taken, 1.0::DOUBLE AS share FROM documents GROUP BY source")
def take_all(spark, d):
    """The mode without a sample: every row of every source is taken."""
    n = F.count(F.lit(1))
    return table(spark, d, "documents").groupBy("source").agg(n.alias("available"), n.alias("taken"), F.lit(1.0).alias("share"))


@query("SELECT 'documents' AS name, source AS part, count(*) AS n FROM documents GROUP BY source UNION ALL SELECT 'conversations', role, count(*) FROM conversations GROUP BY role UNION ALL SELECT 'benchmark', NULL, count(*) FROM benchmark")
def union_runs(spark, d):
    """Rows of unlike sources under one schema."""
    part = lambda name, by: table(spark, d, name).groupBy(by.alias("part")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "part", "n")
    return part("documents", F.col("source")).unionByName(part("conversations", F.col("role"))).unionByName(part("benchmark", F.lit(None).cast("string")))


# Predicates and projections

#: Sources whose rights don't allow training, as a registry would have them.
_CLOSED = ("src3", "src7", "src11")


@query(
    f"""WITH {FUNNEL_SQL}, md(mode) AS (VALUES ('tag'), ('enforce'))
        SELECT mode, CASE WHEN status = 'rejected:quality' THEN status WHEN mode = 'enforce' AND source IN {_CLOSED} THEN 'rejected:rights' ELSE 'kept' END AS status, source IN {_CLOSED} AS closed, count(*) AS n FROM st, md GROUP BY ALL"""
)
def rights_gate(spark, d):
    """Statuses when rights are only tagged, and when they are enforced; bad quality comes first."""
    rows = with_status(spark, d).select("source", "quality_band", F.explode(F.array(F.lit("tag"), F.lit("enforce"))).alias("mode"))
    closed = F.col("source").isin(*_CLOSED)
    status = F.when(F.col("quality_band") == "D", "rejected:quality").when((F.col("mode") == "enforce") & closed, "rejected:rights").otherwise("kept")
    return rows.groupBy("mode", status.alias("status"), closed.alias("closed")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, b AS bucket FROM (SELECT doc_id, ('0x' || substr(sha1('fam_' || substr(sha1(doc_id::VARCHAR), 1, 12)), 1, 8))::BIGINT % 100 AS b FROM documents) WHERE b BETWEEN 90 AND 99")
def bucket_range(spark, d):
    """The documents of the buckets 90 to 99 of their families' hashes: a holdout that families don't cross."""
    rows = table(spark, d, "documents").select("doc_id", T.hex_bucket(T.family_id(F.col("doc_id"))).alias("bucket"))
    return rows.where(F.col("bucket").between(90, 99))


@query("SELECT doc_id, rank FROM (SELECT doc_id, row_number() OVER (ORDER BY sha256('9:' || doc_id)) AS rank FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)) WHERE rank <= 50")
def sample_without(spark, d):
    """Fifty documents by hash, none of which is labelled."""
    left = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")
    top = left.select("doc_id", _hash("9:").alias("h")).orderBy("h").limit(50)
    return top.withColumn("rank", F.row_number().over(Window.orderBy("h")).cast("long")).drop("h")


#: A metric and the value from which it makes a document suspicious.
SUSPICIOUS = [("symbol", 0.12), ("digit", 0.1), ("upper", 0.3), ("rep_trigram", 0.2), ("dup_line", 0.2), ("replacement", 0.0005)]
_SUSPECT_SQL = ", ".join(f"CASE WHEN {n} >= {v} THEN '{n}' END" for n, v in SUSPICIOUS)
SUSPECT_SQL = SCORED_SQL + f""",
    su AS (SELECT *, list_filter([{_SUSPECT_SQL}, CASE WHEN regexp_matches(text, '{T.EMAIL}') THEN 'email' END, CASE WHEN regexp_matches(text, '{_PHONE}') THEN 'phone' END], lambda x: x IS NOT NULL) AS why FROM q)
"""


def _suspects(spark: SparkSession, d: str) -> DataFrame:
    rules = [F.when(F.col(f"m.{n}") >= v, n) for n, v in SUSPICIOUS]
    text = T.body(F.col("text"))
    # The expression tries each word from each of its letters; most texts have no address.
    rules += [F.when(F.contains(text, F.lit("@")) & text.rlike(T.EMAIL), "email"), F.when(text.rlike(_PHONE), "phone")]
    return scored_documents(spark, d).withColumn("why", F.array_compact(F.array(*rules)))


@query(f"WITH {SUSPECT_SQL} SELECT doc_id, array_to_string(why, ',') AS why FROM su WHERE len(why) > 0")
def suspicious_documents(spark, d):
    """Documents with a metric over its rule, or with personal data, and the names of the rules."""
    return _suspects(spark, d).where(F.size("why") > 0).select("doc_id", F.array_join("why", ",").alias("why"))


@query(
    f"""WITH {SUSPECT_SQL} SELECT doc_id, topical, row_number() OVER (ORDER BY topical DESC, sha256('5:' || doc_id)) AS rank FROM
        (SELECT doc_id, regexp_matches(lower(text), 'data|license') AS topical FROM su WHERE len(why) = 0 AND len(hard) = 0 AND lang = 'en') ORDER BY rank LIMIT 100"""
)
def clean_set(spark, d):
    """A hundred clean documents: no hard code, nothing suspicious; those with a word of the topic come first."""
    hard = F.arrays_overlap("reason_codes", F.array(*[F.lit(x) for x in HARD_CODES]))
    rows = _suspects(spark, d).where((F.size("why") == 0) & ~hard & (F.col("lang") == "en"))
    top = rows.select("doc_id", F.lower("text").rlike("data|license").alias("topical"), _hash("5:").alias("h")).orderBy(F.desc("topical"), "h").limit(100)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("topical"), "h")).cast("long")).drop("h")


HARD_CODES = ("empty", "too_short", "too_long", "lang_not_allowed", "low_alpha", "replacement_chars", "repeated_ngrams", "duplicate_lines", "private_use_chars", "math_font_junk")


@query(f"WITH {FUNNEL_SQL}, sc(scope) AS (VALUES ('all'), ('kept')) SELECT scope, count(*) AS n FROM embeddings JOIN st ON vec_id = doc_id, sc WHERE scope = 'all' OR status = 'kept' GROUP BY scope")
def embed_scopes(spark, d):
    """How many documents would be embedded: all of them, or the kept ones only."""
    rows = with_status(spark, d).select("doc_id", "status").join(table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id")), "doc_id")
    rows = rows.select("status", F.explode(F.array(F.lit("all"), F.lit("kept"))).alias("scope")).where("scope = 'all' OR status = 'kept'")
    return rows.groupBy("scope").agg(F.count(F.lit(1)).alias("n"))


def prefix(fields: list[tuple[str, Column]]) -> Column:
    """"key: value" lines in the given order, without null and empty values, and a blank line after them; '' if none is left."""
    lines = [F.when(F.coalesce(value.cast("string"), F.lit("")) != "", F.concat_ws(": ", F.lit(key), value.cast("string"))) for key, value in fields]
    body = F.concat_ws("\n", *lines)
    return F.when(body == "", "").otherwise(F.concat(body, F.lit("\n\n")))


@query(
    """SELECT doc_id, CASE WHEN b = '' THEN '' ELSE b || chr(10) || chr(10) END AS prefix FROM (SELECT doc_id, concat_ws(chr(10), CASE WHEN coalesce(source, '') <> '' THEN 'source: ' || source END,
            CASE WHEN coalesce(lang, '') <> '' THEN 'language: ' || lang END, CASE WHEN n_chars >= 1000 THEN 'length: ' || n_chars END) AS b FROM documents)"""
)
def metadata_prefix(spark, d):
    fields = [("source", F.col("source")), ("language", F.col("lang")), ("length", F.when(F.col("n_chars") >= 1000, F.col("n_chars")))]
    return table(spark, d, "documents").select("doc_id", prefix(fields).alias("prefix"))


@query(
    """WITH y AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '1970' WHEN event_id % 5 = 0 THEN 'n/a' ELSE (1880 + event_id % 300)::VARCHAR END AS raw FROM events)
        SELECT event_id, CASE WHEN try_cast(raw AS INTEGER) BETWEEN 1900 AND 2100 AND try_cast(raw AS INTEGER) <> 1970 THEN try_cast(raw AS INTEGER) END AS year FROM y"""
)
def plausible_years(spark, d):
    i = F.col("event_id")
    raw = F.when(F.pmod(i, F.lit(7)) == 0, "1970").when(F.pmod(i, F.lit(5)) == 0, "n/a").otherwise((F.pmod(i, F.lit(300)) + 1880).cast("string"))
    return table(spark, d, "events").select("event_id", T.year_of(raw).alias("year"))


@query(
    """SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS INTEGER), -1) AS k, coalesce(json_extract_string(props, '$.label'), 'none') AS label FROM events"""
)
def json_with_defaults(spark, d):
    """Fields of a JSON column, with defaults for what is missing or no number."""
    field = lambda name: F.get_json_object("props", f"$.{name}")
    return table(spark, d, "events").select("event_id", F.coalesce(field("k").try_cast("int"), F.lit(-1)).alias("k"), F.coalesce(field("label"), F.lit("none")).alias("label"))


# Joins


@query(
    f"""WITH {FUNNEL_SQL}, v AS (SELECT doc_id AS key, CASE WHEN doc_id % 13 = 0 THEN 'rights' WHEN doc_id % 5 = 0 THEN 'duplicate' ELSE 'kept' END AS verdict FROM documents WHERE doc_id % 17 <> 0),
        j AS (SELECT st.status, v.verdict FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN doc_id - doc_id % 10 ELSE doc_id END AS parent FROM st) st LEFT JOIN v ON v.key = st.parent)
        SELECT count(*) AS chunks, count(*) FILTER (status = 'kept') AS before, count(*) FILTER (status = 'kept' AND verdict IS NULL) AS missing, count(*) FILTER (status = 'kept' AND verdict IN ('duplicate', 'rights')) AS dropped,
               count(*) FILTER (status = 'kept' AND coalesce(verdict, 'kept') = 'kept') AS after FROM j"""
)
def verdict_counts(spark, d):
    """A later round's verdict applied by the parent document: chunks without one stay and are counted as missing."""
    i = F.col("doc_id")
    chunks = with_status(spark, d).select("status", F.when(F.pmod(i, F.lit(3)) == 0, i - F.pmod(i, F.lit(10))).otherwise(i).alias("parent"))
    verdict = F.when(F.pmod(i, F.lit(13)) == 0, "rights").when(F.pmod(i, F.lit(5)) == 0, "duplicate").otherwise("kept")
    known = table(spark, d, "documents").where("doc_id % 17 <> 0").select(i.alias("parent"), verdict.alias("verdict"))
    rows = chunks.join(known, "parent", "left")
    kept, v = F.col("status") == "kept", F.col("verdict")
    return rows.agg(
        F.count(F.lit(1)).alias("chunks"), F.count_if(kept).alias("before"), F.count_if(kept & v.isNull()).alias("missing"),
        F.count_if(kept & v.isin("duplicate", "rights")).alias("dropped"), F.count_if(kept & (F.coalesce(v, F.lit("kept")) == "kept")).alias("after"),
    )


@query(
    """WITH g AS (SELECT doc_id, source || '/' || coalesce(lang, '') AS grp FROM documents)
        SELECT grp, count(*) AS docs, count(quality) AS labelled, count(*) FILTER (quality = 0) AS bad, count(*) FILTER (toxic = 1) AS toxic, count(*) FILTER (quality = 0) / nullif(count(quality), 0) AS bad_share
        FROM g LEFT JOIN labels USING (doc_id) GROUP BY grp"""
)
def group_labels(spark, d):
    """Labels of each group of documents, which may have none."""
    rows = table(spark, d, "documents").select("doc_id", F.concat_ws("/", "source", F.coalesce("lang", F.lit(""))).alias("grp")).join(table(spark, d, "labels"), "doc_id", "left")
    bad = F.count_if(F.col("quality") == 0)
    return rows.groupBy("grp").agg(
        F.count(F.lit(1)).alias("docs"), F.count("quality").alias("labelled"), bad.alias("bad"), F.count_if(F.col("toxic") == 1).alias("toxic"), (bad / F.nullif(F.count("quality"), F.lit(0))).alias("bad_share")
    )


@query(
    """WITH t AS (SELECT grp, doc_id, r FROM (SELECT source AS grp, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256('font:' || doc_id)) AS r FROM documents) WHERE r <= 2),
        l AS (SELECT doc_id, place, n FROM (SELECT doc_id, unnest(range(0, len(x))) AS place, len(x) AS n FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)))
        SELECT grp, doc_id, place, k AS rank FROM (SELECT grp, t.doc_id, place, row_number() OVER (PARTITION BY grp, t.doc_id ORDER BY abs(place - n // 2), place) AS k FROM t JOIN l USING (doc_id)) WHERE k <= 3"""
)
def middle_lines(spark, d):
    """Two documents of each group by hash, and the three lines nearest to the middle of each."""
    rank = F.row_number().over(Window.partitionBy("source").orderBy(_hash("font:")))
    picked = table(spark, d, "documents").select(F.col("source").alias("grp"), "doc_id", T.body(F.col("text")).alias("text"), rank.alias("r")).where("r <= 2")
    n = F.size(F.split("text", "\n"))
    middle = F.floor(n / 2).cast("int")
    places = F.transform(F.array_sort(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.abs(i - middle).alias("far"), i.alias("place")))), lambda x: x["place"])
    return picked.select("grp", "doc_id", F.posexplode(F.slice(places, 1, 3)).alias("k", "place")).select("grp", "doc_id", F.col("place").cast("long").alias("place"), (F.col("k") + 1).cast("long").alias("rank"))


# Aggregates


@query(
    f"""WITH {FUNNEL_SQL} SELECT source, count(*) AS docs, count(*) FILTER (doc_id <> rep) AS exact, count(DISTINCT CASE WHEN fam > 1 THEN rep END) AS families_multi, max(fam) AS largest_family, count(DISTINCT rep) AS families FROM st GROUP BY source"""
)
def dedup_stats(spark, d):
    """Duplicates and families of each group of documents."""
    rows = with_status(spark, d).groupBy("source", "representative").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("doc_id") != F.col("representative")).alias("dup"), F.max("family_size").alias("size"))
    return rows.groupBy("source").agg(
        F.sum("n").alias("docs"), F.sum("dup").alias("exact"), F.count_if((F.col("size") > 1) & F.col("representative").isNotNull()).alias("families_multi"), F.max("size").alias("largest_family"), F.count("representative").alias("families")
    )


@query(
    f"""WITH {FUNNEL_SQL}, e AS (SELECT a.source AS source, b.source AS kept_in FROM st a JOIN st b ON a.rep = b.doc_id WHERE a.doc_id <> a.rep)
        SELECT source, kept_in, count(*) AS duplicates FROM e GROUP BY ALL"""
)
def duplicates_by_source(spark, d):
    """How many documents of a source are duplicates of one that stays in another (or the same) source."""
    rows = with_status(spark, d)
    heads = rows.select(F.col("doc_id").alias("head"), F.col("source").alias("kept_in"))
    lost = rows.where(F.col("doc_id") != F.col("representative")).groupBy("source", "representative").agg(F.count(F.lit(1)).alias("n"))
    return lost.join(heads, F.col("representative") == F.col("head")).groupBy("source", "kept_in").agg(F.sum("n").alias("duplicates"))


@query(
    r"""WITH c AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS t FROM documents), s AS (SELECT doc_id, len(regexp_extract_all(t, '[^ \t\n\r]+')) AS n, length(t) AS k FROM c WHERE trim(t) <> '')
        SELECT doc_id, count(*) AS n_chunks, sum(n)::BIGINT AS n_tokens, avg(least(k, 100)) AS mean_score FROM s GROUP BY doc_id"""
)
def doc_scores(spark, d):
    """Chunks (lines), tokens and the mean of the chunks' scores of each document."""
    rows = table(spark, d, "documents").select("doc_id", F.explode(F.split(T.body(F.col("text")), "\n")).alias("t")).where(F.trim("t") != "")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum(T.word_count(F.col("t"))).cast("long").alias("n_tokens"), F.avg(F.least(F.length("t"), F.lit(100))).alias("mean_score"))


_HARD_SQL = "(" + ", ".join(f"'{x}'" for x in HARD_CODES) + ")"


@query(
    f"""WITH {FUNNEL_SQL}, ak AS (SELECT *, len(hard) AS n_hard FROM st),
        aa AS (SELECT code, count(*) FILTER (status = 'kept') AS on_kept, count(*) FILTER (n_hard = 1 AND code IN {_HARD_SQL}) AS alone, count(*) AS n FROM (SELECT unnest(codes) AS code, status, n_hard FROM ak) GROUP BY code)
        SELECT *, on_kept / nullif((SELECT count(*) FROM st WHERE status = 'kept'), 0) AS kept_rate FROM aa"""
)
def audit_errors(spark, d):
    """Reason codes among kept documents, and how many documents each hard rule drops on its own."""
    hard = F.array(*[F.lit(x) for x in HARD_CODES])
    rows = with_status(spark, d).select("status", "reason_codes", F.size(F.array_intersect("reason_codes", hard)).alias("n_hard"))
    kept = rows.agg(F.count_if(F.col("status") == "kept").alias("kept"))
    by = rows.select("status", "n_hard", F.explode("reason_codes").alias("code")).groupBy("code").agg(
        F.count_if(F.col("status") == "kept").alias("on_kept"), F.count_if((F.col("n_hard") == 1) & F.col("code").isin(*HARD_CODES)).alias("alone"), F.count(F.lit(1)).alias("n")
    )
    return by.join(F.broadcast(kept)).select("code", "on_kept", "alone", "n", (F.col("on_kept") / F.nullif(F.col("kept"), F.lit(0))).alias("kept_rate"))


@query(
    f"""WITH {FUNNEL_SQL} SELECT CASE WHEN grouping(shard) = 1 THEN 'total' ELSE shard::VARCHAR END AS shard, count(*) AS n, count(*) FILTER (status = 'kept') AS kept, sum(words)::BIGINT AS words FROM (SELECT *, doc_id % 8 AS shard FROM st) GROUP BY ROLLUP (shard)"""
)
def shard_summary(spark, d):
    """Counts of each shard and their total."""
    rows = with_status(spark, d).select(F.pmod("doc_id", F.lit(8)).alias("shard"), "status", F.col("m.words").alias("words"))
    out = rows.rollup("shard").agg(F.grouping("shard").alias("g"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "kept").alias("kept"), F.sum("words").alias("words"))
    return out.select(F.when(F.col("g") == 1, "total").otherwise(F.col("shard").cast("string")).alias("shard"), "n", "kept", "words")


MARKS = "àâäçéèêëîïôöùûüñáíóúß"


@query(
    rf"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}]+')) AS w FROM documents), f AS (SELECT w, count(*) AS n, count(DISTINCT doc_id) AS df FROM w GROUP BY w),
        p AS (SELECT w, n, df >= 10 AS known, i, substr(w, i, 1) AS c, substr(w, 1, i - 1) || '_' || substr(w, i + 1) AS mask FROM (SELECT *, unnest(range(1, length(w) + 1)) AS i FROM f) WHERE contains('{MARKS}', substr(w, i, 1))),
        x AS (SELECT DISTINCT u.w, u.n, u.c AS wrong, v.c AS "right" FROM p u JOIN p v ON u.mask = v.mask AND u.i = v.i AND u.c <> v.c WHERE NOT u.known AND v.known),
        o AS (SELECT w, any_value(n) AS n, any_value(wrong) AS wrong, any_value("right") AS "right" FROM x GROUP BY w HAVING count(*) = 1),
        k AS (SELECT wrong, "right", sum(n)::BIGINT AS n FROM o GROUP BY ALL), t AS (SELECT c AS wrong, sum(n) AS total FROM (SELECT DISTINCT w, n, c FROM p WHERE NOT known) GROUP BY c)
        SELECT wrong, "right", n, n / total AS share FROM (SELECT k.*, total, row_number() OVER (PARTITION BY wrong ORDER BY n DESC, "right") AS r FROM k JOIN t USING (wrong)) WHERE r = 1"""
)
def mark_shifts(spark, d):
    """For each marked letter the other one that most often turns an unknown word into a known one, if just one does.

    Words that agree but for one marked letter meet in a join on the word with that place masked.
    """
    tokens = F.regexp_extract_all(F.lower(T.body(F.col("text"))), F.lit(r"([\p{L}]+)"), F.lit(1))
    by_doc = table(spark, d, "documents").select("doc_id", F.explode(tokens).alias("w")).groupBy("w", "doc_id").agg(F.count(F.lit(1)).alias("k"))
    words = by_doc.groupBy("w").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("df"))
    at = F.col("i")
    p = words.select("w", "n", (F.col("df") >= 10).alias("known"), F.explode(F.sequence(F.lit(1), F.length("w"))).alias("i"))
    p = p.withColumn("c", F.substring("w", at, F.lit(1))).where(F.contains(F.lit(MARKS), F.col("c")))
    p = p.withColumn("mask", F.concat(F.substring(F.col("w"), F.lit(1), at - 1), F.lit("_"), F.substring(F.col("w"), at + 1, F.length("w"))))
    known = p.where("known").select("mask", "i", F.col("c").alias("right"))
    x = p.where("NOT known").join(known, ["mask", "i"]).where(F.col("c") != F.col("right")).select("w", "n", F.col("c").alias("wrong"), "right").distinct()
    one = x.groupBy("w").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("n"), F.max("wrong").alias("wrong"), F.max("right").alias("right")).where("k = 1")
    pairs = one.groupBy("wrong", "right").agg(F.sum("n").alias("n"))
    total = p.where("NOT known").select("w", "n", "c").distinct().groupBy(F.col("c").alias("wrong")).agg(F.sum("n").alias("total"))
    best = pairs.groupBy("wrong").agg(F.min_by(F.struct("right", "n"), F.struct(-F.col("n"), F.col("right"))).alias("b"))
    return best.join(total, "wrong").select("wrong", "b.right", "b.n", (F.col("b.n") / F.col("total")).alias("share"))


@query(
    """WITH m AS (SELECT o_orderpriority AS grp, CASE WHEN year(o_orderdate) BETWEEN 1900 AND 2100 AND year(o_orderdate) <> 1970 THEN year(o_orderdate) END AS y, c_custkey IS NULL OR c_mktsegment IS NULL AS none FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 10 <> 0),
        n AS (SELECT grp, y, count(*) AS n FROM m GROUP BY ALL), t AS (SELECT grp, y, n, row_number() OVER (PARTITION BY grp ORDER BY n DESC, y) AS r FROM n WHERE y IS NOT NULL),
        s AS (SELECT grp, count(*) AS n, count(*) FILTER (y IS NULL) AS no_year, avg(none::INTEGER) AS no_metadata FROM m GROUP BY grp)
        SELECT s.*, string_agg(t.y || '=' || t.n, ',' ORDER BY t.r) AS top_years FROM s LEFT JOIN t ON s.grp = t.grp AND t.r <= 3 GROUP BY ALL"""
)
def year_audit(spark, d):
    """Missing years, the share without metadata, and the three commonest years of each group."""
    known = table(spark, d, "customer").where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment"))
    rows = table(spark, d, "orders").join(known, "o_custkey", "left").select(F.col("o_orderpriority").alias("grp"), T.year_of(F.year("o_orderdate")).alias("y"), F.col("c_mktsegment").isNull().alias("none"))
    n = rows.groupBy("grp", "y").agg(F.count(F.lit(1)).alias("n"), F.count_if("none").alias("none"))
    top = F.slice(F.array_sort(F.collect_list(F.when(F.col("y").isNotNull(), F.struct((-F.col("n")).alias("k"), "y")))), 1, 3)
    shown = F.array_join(F.transform(top, lambda x: F.concat_ws("=", x["y"].cast("string"), (-x["k"]).cast("string"))), ",")
    return n.groupBy("grp").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("y").isNull(), F.col("n")).otherwise(0)).alias("no_year"), (F.sum("none") / F.sum("n")).alias("no_metadata"), F.nullif(shown, F.lit("")).alias("top_years")
    )


# Samples


@query(
    """WITH e AS (SELECT doc_id, source, sha256('exam:' || doc_id) AS h FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
        k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h) AS r FROM e) SELECT doc_id, source FROM (SELECT *, row_number() OVER (ORDER BY h) AS q FROM k WHERE r <= 3) WHERE q <= 40"""
)
def exam_sample(spark, d):
    """Forty documents, three of a source at most, none of the excluded ones."""
    out = table(spark, d, "labels").where("toxic = 1").select("doc_id")
    rows = table(spark, d, "documents").select("doc_id", "source").join(out, "doc_id", "left_anti").withColumn("h", _hash("exam:"))
    few = rows.withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy("h"))).where("r <= 3")
    return few.orderBy("h").limit(40).select("doc_id", "source")


@query(
    f"""WITH {SUSPECT_SQL}, ra AS (SELECT doc_id, 'random' AS kind, row_number() OVER (ORDER BY sha256('r:' || doc_id)) AS r FROM su), rb AS (SELECT doc_id, 'suspicious' AS kind, row_number() OVER (ORDER BY sha256('s:' || doc_id)) AS r FROM su WHERE len(why) > 0 AND doc_id NOT IN (SELECT doc_id FROM ra WHERE r <= 300))
        SELECT doc_id, kind FROM ra WHERE r <= 300 UNION ALL SELECT doc_id, kind FROM rb WHERE r <= 100"""
)
def review_sample(spark, d):
    """300 documents by hash, and 100 suspicious ones among the rest."""
    rows = _suspects(spark, d).select("doc_id", (F.size("why") > 0).alias("odd"))
    some = rows.select("doc_id", _hash("r:").alias("h")).orderBy("h").limit(300).select("doc_id")
    rest = rows.where("odd").join(some, "doc_id", "left_anti").select("doc_id", _hash("s:").alias("h")).orderBy("h").limit(100).select("doc_id")
    return some.withColumn("kind", F.lit("random")).unionByName(rest.withColumn("kind", F.lit("suspicious")))


# Engines, pages and detectors


@query(
    f"""WITH {LINES_SQL}, p AS (SELECT doc_id, place, t, n_words, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i, count(*) OVER (PARTITION BY doc_id) AS n FROM lw WHERE t <> ''),
        f AS (SELECT doc_id, count(*) FILTER (regexp_matches(t, '^[0-9]+$')) AS numbers, count(*) FILTER (regexp_matches(t, '^[0-9]+$') AND i > 1 AND i < n) AS inner_numbers, count(*) FILTER (contains(t, '|')) AS cells FROM p GROUP BY doc_id),
        e AS (SELECT doc_id, t, i FROM p WHERE i = 1 OR i = n),
        v AS (SELECT e.doc_id, e.i, count(o.raw) AS n, count(*) FILTER (o.raw IS NOT NULL AND NOT contains(lower(o.raw), lower(e.t))) AS absent FROM e JOIN (SELECT page_id, engine, raw FROM sc WHERE engine IN ('beta', 'gamma')) o ON o.page_id = e.doc_id GROUP BY ALL)
        SELECT f.doc_id, cells = 0 AND (numbers >= 2 OR inner_numbers >= 1) AS odd_numbers, coalesce(bool_or(v.n >= 2 AND 2 * v.absent > v.n), false) AS edge_missing FROM f LEFT JOIN v USING (doc_id) GROUP BY ALL""".replace(
        "WITH ", f"WITH {ENGINES_SQL}, ", 1
    )
)
def truth_suspects(spark, d):
    """References that look wrong: number-only lines away from the edges (tables aside), or a first or last line that most
    engines with an output don't have."""
    text = T.body(F.col("text"))
    docs = table(spark, d, "documents").select("doc_id", T.lines(text).alias("l"))
    number = lambda x: F.regexp_like(x, F.lit("^[0-9]+$"))
    some = docs.where(F.size("l") > 0)
    inner = F.slice("l", F.lit(2), F.greatest(F.size("l") - 2, F.lit(0)))
    odd = (F.size(F.filter("l", lambda x: F.contains(x, F.lit("|")))) == 0) & ((F.size(F.filter("l", number)) >= 2) | (F.size(F.filter(inner, number)) >= 1))
    edges = F.when(F.size("l") == 1, F.array(F.get("l", F.lit(0)))).otherwise(F.array(F.get("l", F.lit(0)), F.element_at("l", -1)))
    out = _engines(spark, d, reasons=False).where("engine IN ('beta', 'gamma')").select(F.col("page_id").alias("doc_id"), F.lower("raw").alias("raw"))
    votes = some.select("doc_id", F.posexplode(edges).alias("i", "t")).join(out, "doc_id")
    votes = votes.groupBy("doc_id", "i").agg(F.count("raw").alias("n"), F.count_if(F.col("raw").isNotNull() & ~F.contains("raw", F.lower("t"))).alias("absent"))
    votes = votes.groupBy("doc_id").agg(F.max((F.col("n") >= 2) & (2 * F.col("absent") > F.col("n"))).alias("edge_missing"))
    return some.select("doc_id", odd.alias("odd_numbers")).join(votes, "doc_id", "left").select("doc_id", "odd_numbers", F.coalesce("edge_missing", F.lit(False)).alias("edge_missing"))


@query(
    f"""WITH {ENGINES_SQL}, g AS (SELECT engine, reason IS NOT NULL AS bad, raw IS NULL OR trim(raw) = '' OR loops >= 5 AS flagged FROM sc)
        SELECT engine, count(*) FILTER (flagged AND bad) AS tp, count(*) FILTER (flagged AND NOT bad) AS fp, count(*) FILTER (NOT flagged AND bad) AS fn, count(*) FILTER (flagged AND bad) / nullif(count(*) FILTER (flagged), 0) AS "precision",
               count(*) FILTER (flagged AND bad) / nullif(count(*) FILTER (bad), 0) AS recall FROM g GROUP BY engine"""
)
def guard_evaluation(spark, d):
    """A guard that sees outputs only, held against the pages that are bad by their references."""
    bad, flagged = F.col("reason").isNotNull(), F.col("raw").isNull() | (F.trim("raw") == "") | (F.col("loops") >= 5)
    rows = _engines(spark, d).select("engine", bad.alias("bad"), F.coalesce(flagged, F.lit(True)).alias("flagged"))
    hit, zero = F.count_if(F.col("flagged") & F.col("bad")), F.lit(0)
    return rows.groupBy("engine").agg(
        hit.alias("tp"), F.count_if(F.col("flagged") & ~F.col("bad")).alias("fp"), F.count_if(~F.col("flagged") & F.col("bad")).alias("fn"),
        (hit / F.nullif(F.count_if("flagged"), zero)).alias("precision"), (hit / F.nullif(F.count_if("bad"), zero)).alias("recall"),
    )


@query(
    r"""WITH m AS (SELECT doc_id, length(text) AS n, len(regexp_extract_all(text, '\p{L}')) AS l, len(regexp_extract_all(text, chr(65533))) AS bad, len(regexp_extract_all(text, ' ')) AS gaps, len(regexp_extract_all(lower(text), '[àâçéèêëîïôùûü]')) AS marks FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))
        SELECT doc_id, CASE WHEN n < 100 THEN 'few_chars' WHEN bad > 0.001 * n THEN 'bad_chars' WHEN l > 0 AND marks / l > 0.25 THEN 'too_many_marks' WHEN gaps < 0.05 * n THEN 'missing_spaces' END AS reason FROM m"""
)
def truth_validity(spark, d):
    """Why a reference text can't be used: the first rule that it breaks, null if none."""
    text = T.body(F.col("text"))
    m = table(spark, d, "documents").select(
        "doc_id", F.length(text).alias("n"), T.letters(text).alias("l"), T.chars_of(text, "�").alias("bad"), T.chars_of(text, " ").alias("gaps"), T.chars_of(F.lower(text), "àâçéèêëîïôùûü").alias("marks")
    )
    n = F.col("n")
    reason = F.when(n < 100, "few_chars").when(F.col("bad") > 0.001 * n, "bad_chars").when((F.col("l") > 0) & (F.col("marks") / F.greatest("l", F.lit(1)) > 0.25), "too_many_marks").when(F.col("gaps") < 0.05 * n, "missing_spaces")
    return m.select("doc_id", reason.alias("reason"))


@query(
    f"""WITH {LINES_SQL}, f AS (SELECT doc_id, source, n_words < 3 AS short, t <> '' AND NOT regexp_matches(t, '[.!?]$') AS open FROM lw), sw(signals) AS (VALUES ('short'), ('open'), ('both')), sh(share) AS (VALUES (0.15), (0.3), (0.5)),
        p AS (SELECT source, doc_id, signals, share, count(*) AS pages, count(*) FILTER (CASE signals WHEN 'short' THEN short WHEN 'open' THEN open ELSE short AND open END) AS flagged FROM f, sw, sh GROUP BY ALL)
        SELECT signals, share::DOUBLE AS share, count(*) AS docs, count(*) FILTER (redo) AS docs_redone, coalesce(sum(pages) FILTER (redo), 0)::BIGINT AS pages_redone, coalesce(sum(pages) FILTER (redo), 0) / sum(pages) AS page_share,
               coalesce(sum(pages) FILTER (redo), 0) / 1.34 / 3600 AS hours FROM (SELECT *, flagged >= greatest(2, ceil(share * pages)) AS redo FROM p) GROUP BY signals, share"""
)
def reextraction_sweep(spark, d):
    """Cost of doing documents again, for sets of signals and shares of flagged pages (lines): one count for each document,
    signal and page, then the shares in one pass."""
    short, ends = F.col("n_words") < 3, (F.col("t") != "") & ~F.regexp_like("t", F.lit("[.!?]$"))
    by = _lines(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if(short).alias("short"), F.count_if(ends).alias("open"), F.count_if(short & ends).alias("both"))
    sets = F.array(*[F.struct(F.lit(s).alias("signals"), F.col(s).alias("flagged"), F.lit(x).alias("share")) for s in ("short", "open", "both") for x in (0.15, 0.3, 0.5)])
    p = by.select("pages", F.explode(sets).alias("x")).select("pages", "x.*")
    redo = F.col("flagged") >= F.greatest(F.lit(2), F.ceil(F.col("share").cast("decimal(3,2)") * F.col("pages")))
    pages = F.sum(F.when(redo, F.col("pages")).otherwise(0))
    return p.groupBy("signals", "share").agg(F.count(F.lit(1)).alias("docs"), F.count_if(redo).alias("docs_redone"), pages.alias("pages_redone"), (pages / F.sum("pages")).alias("page_share"), (pages / 1.34 / 3600).alias("hours"))


@query(
    f"""WITH {SUSPECT_SQL} SELECT substr(source, 1, 30) AS producer, count(*) AS docs, avg((len(why) > 0)::INTEGER) AS suspicious, avg((len(codes) > 0)::INTEGER) AS covered, count(*) FILTER (len(why) > 0 AND len(codes) = 0) AS uncovered FROM su GROUP BY 1"""
)
def producer_survey(spark, d):
    """Suspicious documents of each producer, and how many of them no rule of the scores covers."""
    rows = _suspects(spark, d).select(F.substring("source", 1, 30).alias("producer"), (F.size("why") > 0).alias("odd"), (F.size("reason_codes") > 0).alias("ruled"))
    share = lambda c: F.avg(F.col(c).cast("int"))
    return rows.groupBy("producer").agg(F.count(F.lit(1)).alias("docs"), share("odd").alias("suspicious"), share("ruled").alias("covered"), F.count_if(F.col("odd") & ~F.col("ruled")).alias("uncovered"))


@query(
    f"""WITH {FUNNEL_SQL}, pj AS (SELECT st.source, st.codes, doc_id % 9 <> 0 AS matched FROM st WHERE status = 'kept'), pb AS (SELECT source, count(*) FILTER (matched) AS kept, count(*) FILTER (matched AND len(codes) > 0) AS bad, count(*) FILTER (NOT matched) AS unmatched FROM pj GROUP BY source),
        pc AS (SELECT source, code, count(*) AS n FROM (SELECT source, unnest(codes) AS code FROM pj WHERE matched) GROUP BY ALL), pr AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, code) AS k FROM pc)
        SELECT pb.source, kept, bad, unmatched, bad / nullif(kept, 0) AS bad_share, string_agg(code || '=' || n, ',' ORDER BY k) AS causes FROM pb LEFT JOIN pr ON pr.source = pb.source AND k <= 3 GROUP BY ALL"""
)
def bad_by_producer(spark, d):
    """Kept documents with reason codes as a share of those whose producer is known, and the three commonest causes."""
    rows = with_status(spark, d).where("status = 'kept'").select("source", "reason_codes", (F.pmod("doc_id", F.lit(9)) != 0).alias("matched"))
    b = rows.groupBy("source").agg(F.count_if("matched").alias("kept"), F.count_if(F.col("matched") & (F.size("reason_codes") > 0)).alias("bad"), F.count_if(~F.col("matched")).alias("unmatched"))
    c = rows.where("matched").select("source", F.explode("reason_codes").alias("code")).groupBy("source", "code").agg(F.count(F.lit(1)).alias("n"))
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "code"))), 1, 3)
    causes = c.groupBy("source").agg(F.array_join(F.transform(top, lambda x: F.concat_ws("=", x["code"], (-x["k"]).cast("string"))), ",").alias("causes"))
    return b.join(causes, "source", "left").select("source", "kept", "bad", "unmatched", (F.col("bad") / F.nullif(F.col("kept"), F.lit(0))).alias("bad_share"), "causes")


@query(
    r"""WITH l AS (SELECT 'gpu' || user_id % 4 || ': ' || round(value, 2) || ' pages/s' AS line, event_id FROM events), x AS (SELECT regexp_extract(line, '(gpu[0-9]+): ([0-9.]+) pages/s', 1) AS gpu, regexp_extract(line, '(gpu[0-9]+): ([0-9.]+) pages/s', 2)::DOUBLE AS v FROM l),
        s AS (SELECT gpu, v, row_number() OVER (PARTITION BY gpu ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY gpu) AS n FROM x)
        SELECT gpu, any_value(n) AS n, max(v) FILTER (i = floor(n * 0.1)::BIGINT) AS p10, max(v) FILTER (i = floor(n * 0.5)::BIGINT) AS p50, max(v) FILTER (i = floor(n * 0.9)::BIGINT) AS p90 FROM s GROUP BY gpu"""
)
def log_rates(spark, d):
    """Quantiles of the rates that the lines of a log report, for each device; counts of distinct values only."""
    line = F.concat(F.lit("gpu"), F.pmod("user_id", F.lit(4)).cast("string"), F.lit(": "), F.round("value", 2).cast("string"), F.lit(" pages/s"))
    part = lambda i: F.regexp_extract("line", r"(gpu[0-9]+): ([0-9.]+) pages/s", i)
    rates = table(spark, d, "events").select(line.alias("line")).select(part(1).alias("gpu"), part(2).cast("double").alias("v"))
    return order_statistics(rates, "gpu", "v", {"p10": 0.1, "p50": 0.5, "p90": 0.9})


@query(
    r"""WITH m AS (SELECT doc_id, source, len(regexp_extract_all(text, '[\x{0000}-\x{0008}\x{000B}\x{000C}\x{000E}-\x{001F}]')) / greatest(length(text), 1) AS r FROM (SELECT doc_id, source, coalesce(text, '') AS text FROM documents))
        SELECT source, CASE WHEN r = 0 THEN '0' WHEN r < 0.001 THEN '<0.001' WHEN r < 0.01 THEN '<0.01' ELSE '>=0.01' END AS bin, count(*) AS n, count(*) FILTER (r >= 0.005) AS over FROM m GROUP BY ALL"""
)
def control_chars(spark, d):
    """Distribution of the share of control characters, and documents over the threshold."""
    text = T.body(F.col("text"))
    share = T.ratio(T.chars_of(text, "\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F"), F.length(text))
    rows = table(spark, d, "documents").select("source", share.alias("r"))
    r = F.col("r")
    return rows.groupBy("source", F.when(r == 0, "0").when(r < 0.001, "<0.001").when(r < 0.01, "<0.01").otherwise(">=0.01").alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.count_if(r >= 0.005).alias("over"))


@query(
    """WITH s AS (SELECT event_type AS stage, user_id % 10 AS source, user_id AS shard, min(ts) AS t0, max(ts) AS t1, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT stage, avg(date_diff('second', t0, t1)) AS mean FROM s GROUP BY stage),
        p AS (SELECT source, shard, count(*) AS done FROM s GROUP BY ALL), k AS (SELECT count(*) AS stages, sum(mean) AS total FROM m),
        e AS (SELECT p.source, p.shard, p.done, k.stages, (SELECT coalesce(sum(m.mean), 0) FROM m WHERE m.stage NOT IN (SELECT s.stage FROM s WHERE s.shard = p.shard)) AS left_s, (SELECT sum(date_diff('second', s.t0, s.t1)) FROM s WHERE s.shard = p.shard) > 1.5 * k.total AS overrun FROM p, k)
        SELECT source, count(*) AS shards, count(*) FILTER (done = stages) AS finished, round(max(left_s), 6) AS eta_s, bool_or(overrun) AS unknown FROM e GROUP BY source"""
)
def stage_eta(spark, d):
    """Remaining seconds of each source: the mean times of the stages that its slowest shard still has to do; unknown if a
    shard has already taken half as long again as all stages take on average."""
    seconds = F.unix_timestamp(F.date_trunc("second", F.max("ts"))) - F.unix_timestamp(F.date_trunc("second", F.min("ts")))
    s = table(spark, d, "events").groupBy(F.col("event_type").alias("stage"), F.col("user_id").alias("shard")).agg(seconds.alias("t"))
    mean = s.groupBy("stage").agg(F.avg("t").alias("mean"))
    total = mean.agg(F.count(F.lit(1)).alias("stages"), F.sum("mean").alias("total"))
    shard = s.join(mean, "stage").groupBy("shard").agg(F.count(F.lit(1)).alias("done"), F.sum("mean").alias("had"), F.sum("t").alias("took")).join(F.broadcast(total))
    left = F.when(F.col("done") == F.col("stages"), F.lit(0.0)).otherwise(F.col("total") - F.col("had"))
    out = shard.groupBy(F.pmod("shard", F.lit(10)).alias("source"))
    return out.agg(
        F.count(F.lit(1)).alias("shards"), F.count_if(F.col("done") == F.col("stages")).alias("finished"), F.round(F.max(left), 6).alias("eta_s"), F.max(F.col("took") > 1.5 * F.col("total")).alias("unknown")
    )


@query(
    f"""WITH {SUSPECT_SQL}, j AS (SELECT doc_id, list_contains(why, 'symbol') AS flag, quality = 0 AS bad, symbol FROM su JOIN labels USING (doc_id))
        SELECT doc_id, CASE WHEN flag THEN 'wrongly flagged' ELSE 'missed' END AS kind, round(symbol, 6) AS value FROM j WHERE flag <> bad"""
)
def flag_listing(spark, d):
    """Documents on which one detector and the labels disagree."""
    rows = _suspects(spark, d).select("doc_id", F.array_contains("why", "symbol").alias("flag"), F.round("m.symbol", 6).alias("value"))
    rows = rows.join(table(spark, d, "labels").select("doc_id", (F.col("quality") == 0).alias("bad")), "doc_id").where(F.col("flag") != F.col("bad"))
    return rows.select("doc_id", F.when(F.col("flag"), "wrongly flagged").otherwise("missed").alias("kind"), "value")


@query(
    """WITH a AS (SELECT page_id, turn, rate, row_number() OVER (PARTITION BY page_id ORDER BY rate DESC, turn) AS r, max(rate) FILTER (turn = 0) OVER (PARTITION BY page_id) AS base FROM (SELECT event_id // 4 AS page_id, (event_id % 4) * 90 AS turn, round(value / 100, 6) AS rate FROM events))
        SELECT page_id, CASE WHEN turn <> 0 AND rate >= 0.6 AND rate >= coalesce(base, 0) + 0.2 THEN turn ELSE 0 END AS turn FROM a WHERE r = 1"""
)
def rotation_choice(spark, d):
    """A page's best rotation, taken only if its rate of valid words is high enough and gains enough on the upright one."""
    rows = table(spark, d, "events").select(F.floor(F.col("event_id") / 4).cast("long").alias("page_id"), (F.pmod("event_id", F.lit(4)) * 90).alias("turn"), F.round(F.col("value") / 100, 6).alias("rate"))
    best = rows.groupBy("page_id").agg(F.min_by(F.struct("turn", "rate"), F.struct(-F.col("rate"), F.col("turn"))).alias("b"), F.max(F.when(F.col("turn") == 0, F.col("rate"))).alias("base"))
    good = (F.col("b.turn") != 0) & (F.col("b.rate") >= 0.6) & (F.col("b.rate") >= F.coalesce("base", F.lit(0.0)) + 0.2)
    return best.select("page_id", F.when(good, F.col("b.turn")).otherwise(0).cast("long").alias("turn"))


@query(
    """WITH a AS (SELECT place, reading, score, row_number() OVER (PARTITION BY place ORDER BY score DESC, reading) AS r, count(*) OVER (PARTITION BY place) AS n FROM (SELECT event_id // 3 AS place, event_id % 3 AS reading, -round(value, 4) AS score FROM events))
        SELECT x.place, CASE WHEN y.score IS NULL OR x.score - y.score >= 2 THEN x.reading END AS reading FROM a x LEFT JOIN a y ON y.place = x.place AND y.r = 2 WHERE x.r = 1"""
)
def reading_choice(spark, d):
    """The likeliest reading of an ambiguous place if it beats the second by the margin, else none."""
    rows = table(spark, d, "events").select(F.floor(F.col("event_id") / 3).cast("long").alias("place"), F.pmod("event_id", F.lit(3)).alias("reading"), (-F.round("value", 4)).alias("score"))
    # A place has few readings: its alternatives are those of one word.
    best = rows.groupBy("place").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("k"), "reading"))), 1, 2).alias("top"))
    first, second = F.get("top", F.lit(0)), F.get("top", F.lit(1))
    sure = second.isNull() | (second["k"] - first["k"] >= 2)
    return best.select("place", F.when(sure, first["reading"]).alias("reading"))


@query(
    f"""WITH {ENGINES_SQL}, sw AS (SELECT page_id, engine, unnest(regexp_extract_all(lower(raw), '[\\p{{L}}]+')) AS t FROM sc WHERE engine IN ('alpha', 'gamma') AND raw IS NOT NULL),
        sv AS (SELECT page_id, t, count(*) FILTER (engine = 'alpha') AS a, count(*) FILTER (engine = 'gamma') AS g FROM sw GROUP BY ALL),
        sd AS (SELECT page_id, 2 * sum(least(a, g)) / sum(a + g) AS dice FROM sv GROUP BY page_id),
        sf AS (SELECT page_id, bool_or(reason IS NOT NULL) AS flagged FROM sc WHERE engine = 'gamma' GROUP BY page_id)
        SELECT source AS grp, count(*) AS pages, round(avg(dice), 9) AS mean_similarity, round(min(dice), 9) AS least_similarity, avg(dice) < 0.85 AS bad, avg(dice) < 0.85 AND NOT bool_or(flagged) AS missed
        FROM sd JOIN documents ON doc_id = page_id JOIN sf USING (page_id) GROUP BY source"""
)
def group_similarity(spark, d):
    """How alike two readings of the pages of each group are, the groups where they differ, and those of them in which the
    detector flags no page."""
    rows = _engines(spark, d).where("engine IN ('alpha', 'gamma') AND raw IS NOT NULL")
    words = rows.select("page_id", "engine", F.explode(F.regexp_extract_all(F.lower("raw"), F.lit(r"([\p{L}]+)"), F.lit(1))).alias("t"))
    bags = words.groupBy("page_id", "t").agg(F.count_if(F.col("engine") == "alpha").alias("a"), F.count_if(F.col("engine") == "gamma").alias("g"))
    dice = bags.groupBy("page_id").agg((2 * F.sum(F.least("a", "g")) / F.sum(F.col("a") + F.col("g"))).alias("dice"))
    flagged = _engines(spark, d).where("engine = 'gamma'").groupBy("page_id").agg(F.max(F.col("reason").isNotNull()).alias("flagged"))
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("page_id"), F.col("source").alias("grp"))
    bad = F.avg("dice") < 0.85
    return dice.join(docs, "page_id").join(flagged, "page_id").groupBy("grp").agg(
        F.count(F.lit(1)).alias("pages"), F.round(F.avg("dice"), 9).alias("mean_similarity"), F.round(F.min("dice"), 9).alias("least_similarity"), bad.alias("bad"), (bad & ~F.max("flagged")).alias("missed")
    )
