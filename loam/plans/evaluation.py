"""Queries that evaluate and compare: labels, engines, runs, joins with logs, vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loam.functions import text as T
from loam.functions.edit import edit_distance, word_distance
from loam.operators import dedup, outputs, quality, vectors
from loam.plans.documents import FUNNEL_SQL, METRICS_SQL, with_status
from loam.plans.registry import query, table
from loam.session import materialize, ship

#: Detectors of bad quality: a metric and the value from which it flags.
DETECTORS = [("symbol", 0.2), ("upper", 0.5), ("rep_trigram", 0.3), ("dup_line", 0.25), ("mean_word_len", 8.0)]


def _flags(spark: SparkSession, d: str) -> DataFrame:
    docs = quality.with_metrics(table(spark, d, "documents")).select("doc_id", "source", "m")
    cases = F.array(*[F.struct(F.lit(n).alias("detector"), (F.col(f"m.{n}") >= v).alias("flag")) for n, v in DETECTORS])
    return docs.select("doc_id", "source", F.explode(cases).alias("x")).select("doc_id", "source", "x.detector", "x.flag")


FLAGS_SQL = METRICS_SQL + ", fl AS (" + " UNION ALL ".join(f"SELECT doc_id, source, '{n}' AS detector, {n} >= {v} AS flag FROM m" for n, v in DETECTORS) + ")"


@query(
    f"""WITH {FLAGS_SQL}, j AS (SELECT detector, flag, quality = 0 AS bad, doc_id % 2 = 0 AS tune FROM fl JOIN labels USING (doc_id)),
        k AS (SELECT detector, tune, count(*) FILTER (flag) AS flagged, count(*) FILTER (flag AND bad) AS hits, count(*) FILTER (bad) AS bad FROM j GROUP BY ALL)
        SELECT *, hits / nullif(flagged, 0) AS "precision", hits / nullif(bad, 0) AS recall, coalesce(hits / nullif(flagged, 0) >= 0.9, false) AND flagged >= 5 AS gate FROM k"""
)
def detector_precision(spark, d):
    """Precision and recall of each detector on both halves of the labels, and whether it passes the gate."""
    j = _flags(spark, d).join(table(spark, d, "labels").select("doc_id", (F.col("quality") == 0).alias("bad")), "doc_id").withColumn("tune", F.pmod("doc_id", F.lit(2)) == 0)
    k = j.groupBy("detector", "tune").agg(F.count_if("flag").alias("flagged"), F.count_if(F.col("flag") & F.col("bad")).alias("hits"), F.count_if("bad").alias("bad"))
    zero = F.lit(0)
    precision = F.col("hits") / F.nullif(F.col("flagged"), zero)
    return k.select("*", precision.alias("precision"), (F.col("hits") / F.nullif(F.col("bad"), zero)).alias("recall"), (F.coalesce(precision >= 0.9, F.lit(False)) & (F.col("flagged") >= 5)).alias("gate"))


_WILSON = "CASE WHEN n = 0 THEN {} ELSE ((p + 3.8416 / (2 * n)) {} 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n) END"


@query(
    f"""WITH k AS (SELECT source, count(*) AS n, count(*) FILTER (quality = 0) AS errors FROM documents JOIN labels USING (doc_id) GROUP BY source), q AS (SELECT *, errors / n AS p FROM k)
        SELECT source, n, errors, round({_WILSON.format("0.0", "-")}, 9) AS low, round({_WILSON.format("1.0", "+")}, 9) AS high, {_WILSON.format("1.0", "+")} <= 0.25 AS proven FROM q"""
)
def error_budget(spark, d):
    """Error rates of the labelled rows by source with Wilson bounds; proven means under a quarter for sure."""
    rows = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id")
    k = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality") == 0).alias("errors"))
    low, high = T.wilson(F.col("errors"), F.col("n"))
    return k.select("source", "n", "errors", F.round(low, 9).alias("low"), F.round(high, 9).alias("high"), (high <= 0.25).alias("proven"))


@query(
    f"""WITH {FLAGS_SQL}, c AS (SELECT source, detector, count(*) FILTER (flag) / count(*) AS rate, count(*) AS n FROM fl GROUP BY ALL),
        md AS (SELECT detector, quantile_cont(rate, 0.5) FILTER (n >= 20) AS med, count(*) FILTER (n >= 20) AS groups FROM c GROUP BY detector)
        SELECT source, detector, rate, coalesce(n >= 20 AND groups >= 3 AND rate > 3 * med AND rate >= 0.15, false) AS odd FROM c JOIN md USING (detector)"""
)
def group_anomalies(spark, d):
    c = _flags(spark, d).groupBy("source", "detector").agg((F.count_if("flag") / F.count(F.lit(1))).alias("rate"), F.count(F.lit(1)).alias("n"))
    large = F.col("n") >= 20
    med = c.groupBy("detector").agg(F.percentile(F.when(large, F.col("rate")), 0.5).alias("med"), F.count_if(large).alias("groups"))
    odd = large & (F.col("groups") >= 3) & (F.col("rate") > 3 * F.col("med")) & (F.col("rate") >= 0.15)
    return c.join(med, "detector").select("source", "detector", "rate", F.coalesce(odd, F.lit(False)).alias("odd"))


@query(
    f"""WITH {FUNNEL_SQL}, r AS (SELECT source, count(*) FILTER (status <> 'kept') / count(*) AS rate, count(*) AS n, count(*) FILTER (status <> 'kept') AS lost FROM st GROUP BY source)
        SELECT sum(lost) / sum(n) AS micro, round(avg(rate), 9) AS macro, (SELECT sum(n) FROM (SELECT n FROM r ORDER BY n DESC, source LIMIT 5)) / sum(n) AS top5_share FROM r"""
)
def drop_rates(spark, d):
    r = with_status(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") != "kept").alias("lost"))
    r = r.withColumn("k", F.row_number().over(Window.orderBy(F.desc("n"), "source")))
    return r.agg((F.sum("lost") / F.sum("n")).alias("micro"), F.round(F.avg(F.col("lost") / F.col("n")), 9).alias("macro"), (F.sum(F.when(F.col("k") <= 5, F.col("n"))) / F.sum("n")).alias("top5_share"))


ENGINES_SQL = r"""
    en(engine, tier) AS (VALUES ('alpha', 0), ('beta', 1), ('gamma', 2)),
    ot AS (SELECT doc_id AS page_id, coalesce(text, '') AS text FROM documents),
    ou AS (SELECT page_id, engine, tier, CASE WHEN engine = 'alpha' THEN text
                WHEN engine = 'beta' THEN left(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), length(text) * 28 // 30)
                WHEN page_id % 13 = 0 THEN repeat(left(text, 60) || ' ', 8) ELSE left(text, length(text) * CASE WHEN page_id % 5 = 0 THEN 15 ELSE 29 END // 30) || ' end' END AS raw
           FROM ot, en WHERE NOT (engine = 'beta' AND page_id % 7 = 0)),
    oj AS (SELECT ot.page_id, en.engine, en.tier, ot.text AS ref, ou.raw FROM ot CROSS JOIN en LEFT JOIN ou ON ou.page_id = ot.page_id AND ou.engine = en.engine),
    og AS (SELECT *, regexp_extract_all(coalesce(raw, ''), '[^ \t\n\r]+') AS rw, regexp_extract_all(ref, '[^ \t\n\r]+') AS fw FROM oj),
    ox AS (SELECT *, coalesce(list_max(map_values(list_histogram([rw[i] || ' ' || rw[i + 1] || ' ' || rw[i + 2] || ' ' || rw[i + 3] FOR i IN range(1, len(rw) - 2)]))), 0)::BIGINT AS loops,
           coalesce(list_max(map_values(list_histogram([fw[i] || ' ' || fw[i + 1] || ' ' || fw[i + 2] || ' ' || fw[i + 3] FOR i IN range(1, len(fw) - 2)]))), 0)::BIGINT AS ref_loops FROM og),
    sc AS (SELECT page_id, engine, tier, ref, raw, loops, CASE WHEN raw IS NULL THEN 'no_output' WHEN trim(raw) = '' THEN 'empty' WHEN loops >= 5 AND loops > 2 * ref_loops THEN 'loop'
           WHEN length(raw) > 1.15 * length(ref) THEN 'too_long' WHEN length(raw) < 0.85 * length(ref) THEN 'too_short' END AS reason FROM ox)
"""


def _engines(spark: SparkSession, d: str, reasons: bool = True) -> DataFrame:
    """Pages (documents, whole) with the outputs of three stand-in engines; a missing output is a row with no_output.

    The reason takes the first of: no_output, empty, loop (a run of four words five times, and more than twice as often
    as in the reference), too_long and too_short (by 15 %).
    """
    names = F.explode(F.array(*[F.struct(F.lit(n).alias("engine"), F.lit(i).alias("tier")) for i, n in enumerate(("alpha", "beta", "gamma"))])).alias("e")
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("page_id"), T.body(F.col("text")).alias("ref"), names).select("page_id", "ref", "e.engine", "e.tier")
    ship(spark)
    remainder = F.coalesce(F.pmod("page_id", F.lit(7 * 13 * 5)), F.lit(-1)).cast("int")
    rows = rows.select("page_id", "engine", "tier", "ref", outputs.stand_ins("engine", remainder, "ref").alias("raw"))
    if not reasons:
        return rows
    rows = rows.select("*", outputs.loop_counts("raw", "ref").alias("x")).select("*", "x.loops", "x.ref_loops").drop("x")
    n, m = F.length("raw"), F.length("ref")
    loop = (F.col("loops") >= 5) & (F.col("loops") > 2 * F.col("ref_loops"))
    reason = F.when(F.col("raw").isNull(), "no_output").when(F.trim("raw") == "", "empty").when(loop, "loop").when(n > 1.15 * m, "too_long").when(n < 0.85 * m, "too_short")
    return rows.withColumn("reason", reason).drop("ref_loops")


@query(f"WITH {ENGINES_SQL} SELECT page_id, engine, reason, length(raw) AS n_chars FROM sc")
def page_scores(spark, d):
    return _engines(spark, d).select("page_id", "engine", "reason", F.length("raw").cast("long").alias("n_chars"))


@query(f"WITH {ENGINES_SQL} SELECT page_id, engine, tier, r FROM (SELECT *, reason IS NOT NULL AS bad, row_number() OVER (PARTITION BY page_id ORDER BY reason IS NOT NULL, CASE WHEN reason IS NULL THEN tier ELSE -tier END) AS r FROM sc) WHERE r = 1")
def engine_cascade(spark, d):
    """For each page the first engine whose output is accepted; the last one if none is."""
    rows = _engines(spark, d).withColumn("bad", F.col("reason").isNotNull())
    best = F.min_by(F.struct("engine", "tier"), F.struct("bad", F.when(F.col("bad"), -F.col("tier")).otherwise(F.col("tier")))).alias("b")
    return rows.groupBy("page_id").agg(best).select("page_id", "b.engine", "b.tier", F.lit(1).cast("long").alias("r"))


@query(
    f"""WITH {ENGINES_SQL}, c AS (SELECT page_id, tier FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY reason IS NOT NULL, CASE WHEN reason IS NULL THEN tier ELSE -tier END) AS r FROM sc) WHERE r = 1),
        n AS (SELECT tier, count(*) AS n FROM c GROUP BY tier) SELECT en.tier::INTEGER AS tier, coalesce((SELECT sum(n) FROM n WHERE n.tier >= en.tier), 0) / (SELECT sum(n) FROM n) AS reach FROM en"""
)
def cascade_reach(spark, d):
    """Share of pages that end at a tier or beyond it."""
    ends = engine_cascade(spark, d).groupBy("tier").agg(F.count(F.lit(1)).alias("n"))
    tiers = spark.range(3).select(F.col("id").cast("int").alias("tier")).join(ends, "tier", "left").na.fill(0)
    up = Window.orderBy(F.desc("tier")).rowsBetween(Window.unboundedPreceding, 0)
    return tiers.select("tier", (F.sum("n").over(up) / F.sum("n").over(Window.partitionBy())).alias("reach"))


@query()
def engine_error_rates(spark, d):
    """Character and word error rates over whole texts, a page's distance capped at its reference."""
    ship(spark)
    rows = _engines(spark, d, reasons=False).withColumn("raw", T.body(F.col("raw")))
    n, words = F.length("ref"), T.word_count(F.col("ref"))
    rows = rows.select("engine", F.least(edit_distance("raw", "ref"), n).alias("dist"), n.alias("n"), F.least(word_distance("raw", "ref"), words).alias("word_dist"), words.alias("n_words"))
    rate = lambda a, b: F.sum(a) / F.nullif(F.sum(b), F.lit(0))
    return rows.groupBy("engine").agg(
        F.sum("dist").alias("dist"), F.sum("n").alias("n"), rate("dist", "n").alias("cer"), F.sum("word_dist").alias("word_dist"), F.sum("n_words").alias("n_words"), rate("word_dist", "n_words").alias("wer")
    )


@query(
    f"""WITH {ENGINES_SQL}, w AS (SELECT page_id, engine, 0 AS side, unnest(regexp_extract_all(lower(raw), '[\\p{{L}}\\p{{N}}]+')) AS t FROM sc WHERE raw IS NOT NULL
            UNION ALL SELECT page_id, engine, 1, unnest(regexp_extract_all(lower(ref), '[\\p{{L}}\\p{{N}}]+')) FROM sc WHERE raw IS NOT NULL),
        c AS (SELECT page_id, engine, t, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b FROM w GROUP BY ALL),
        f AS (SELECT page_id, engine, 2 * sum(least(a, b)) / sum(a + b) AS f1 FROM c GROUP BY ALL),
        s AS (SELECT page_id, engine, len(regexp_extract_all(ref, '[^ -~]'))::BIGINT AS special, length(coalesce(raw, '')) - length(regexp_replace(coalesce(raw, ''), '[^ -~]', '', 'g')) AS found FROM sc)
        SELECT engine, count(f1) AS pages, round(avg(f1), 9) AS bag_f1, sum(special)::BIGINT AS special, sum(least(special, found))::BIGINT AS special_found, sum(least(special, found)) / nullif(sum(special), 0) AS special_recall
        FROM s LEFT JOIN f USING (page_id, engine) GROUP BY engine"""
)
def engine_bags(spark, d):
    """Bag-of-words F1 of each output with its reference, averaged over pages, and how many special characters survive."""
    rows = _engines(spark, d, reasons=False).select("engine", outputs.bags_alike("raw", "ref").alias("x")).select("engine", "x.*")
    kept = F.sum(F.least("special", "found"))
    return rows.groupBy("engine").agg(
        F.count("f1").alias("pages"), F.round(F.avg("f1"), 9).alias("bag_f1"), F.sum("special").alias("special"), kept.alias("special_found"), (kept / F.nullif(F.sum("special"), F.lit(0))).alias("special_recall")
    )


@query(
    f"""WITH {ENGINES_SQL}, v AS (SELECT w FROM (SELECT DISTINCT page_id, unnest(regexp_extract_all(lower(ref), '[\\p{{L}}]+')) AS w FROM sc) GROUP BY w HAVING count(*) >= 2),
        t AS (SELECT engine, count(*) AS n_words, count(*) FILTER (w NOT IN (SELECT w FROM v)) AS unknown FROM (SELECT engine, unnest(regexp_extract_all(lower(raw), '[\\p{{L}}]+')) AS w FROM sc) GROUP BY engine),
        p AS (SELECT engine, page_id, raw, length(raw) AS n, median(length(raw)) OVER (PARTITION BY page_id) AS med, reason FROM sc WHERE raw IS NOT NULL)
        SELECT engine, count(*) AS pages, avg((n < 0.9 * med)::INTEGER) AS short_share, count(*) FILTER (reason = 'empty') AS empty, count(*) FILTER (reason = 'loop') AS loops, count(*) FILTER (reason = 'too_short') AS cut,
            1000 * sum(length(raw) - length(replace(raw, '?', ''))) / nullif(sum(n), 0) AS question_marks, any_value(unknown) / nullif(any_value(n_words), 0) AS unknown_rate FROM p LEFT JOIN t USING (engine) GROUP BY engine"""
)
def engine_lengths(spark, d):
    """Measures without a reference: lengths against the page's median over the engines, question marks for a thousand
    characters, counts of reasons, and the share of words that occur in fewer than two pages of the corpus."""
    rows = _engines(spark, d).where("raw IS NOT NULL").withColumn("n", F.length("raw"))
    words = lambda c: F.explode(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}]+)"), F.lit(1))).alias("w")
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(T.body(F.col("text"))), F.lit(r"([\p{L}]+)"), F.lit(1)))
    known = table(spark, d, "documents").select(F.explode(tokens).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df")).where("df >= 2").select("w", F.lit(1).alias("known"))
    # Only numbers are joined with the page's median, not the texts.
    used = _engines(spark, d, reasons=False).where("raw IS NOT NULL").select("engine", words("raw")).groupBy("engine", "w").agg(F.count(F.lit(1)).alias("k")).join(known, "w", "left")
    used = used.groupBy("engine").agg((F.sum(F.when(F.col("known").isNull(), F.col("k")).otherwise(0)) / F.sum("k")).alias("unknown_rate"))
    rows, _ = materialize(rows.select("page_id", "engine", "n", "reason", (F.length("raw") - F.length(F.replace("raw", F.lit("?"), F.lit("")))).alias("marks")), "sizes")
    med = rows.groupBy("page_id").agg(F.percentile("n", 0.5).alias("med"))
    is_ = lambda x: F.count_if(F.col("reason") == x)
    out = rows.join(med, "page_id").groupBy("engine").agg(
        F.count(F.lit(1)).alias("pages"), F.avg((F.col("n") < 0.9 * F.col("med")).cast("int")).alias("short_share"), is_("empty").alias("empty"), is_("loop").alias("loops"), is_("too_short").alias("cut"),
        (1000 * F.sum("marks") / F.nullif(F.sum("n"), F.lit(0))).alias("question_marks"),
    )
    return out.join(used, "engine", "left")


@query(f"WITH {ENGINES_SQL} SELECT engine, page_id, r AS rank FROM (SELECT engine, page_id, row_number() OVER (PARTITION BY engine ORDER BY coalesce(length(raw), 0), page_id) AS r FROM sc) WHERE r <= 10")
def worst_pages(spark, d):
    """The ten pages with least output for each engine."""
    k = F.row_number().over(Window.partitionBy("engine").orderBy(F.coalesce(F.length("raw"), F.lit(0)), "page_id"))
    return _engines(spark, d, reasons=False).select("engine", "page_id", k.alias("rank")).where("rank <= 10")


@query(
    f"""WITH {ENGINES_SQL}, w AS (SELECT page_id, engine, unnest(regexp_extract_all(lower(raw), '[\\p{{L}}]+')) AS t FROM sc WHERE engine IN ('alpha', 'gamma') AND raw IS NOT NULL),
        c AS (SELECT page_id, t, count(*) FILTER (engine = 'alpha') AS a, count(*) FILTER (engine = 'gamma') AS g FROM w GROUP BY ALL)
        SELECT page_id, 2 * sum(least(a, g)) / sum(a + g) AS dice FROM c GROUP BY page_id"""
)
def word_overlap(spark, d):
    """Dice overlap of the word multisets of two engines' outputs."""
    rows = _engines(spark, d, reasons=False).where("engine IN ('alpha', 'gamma') AND raw IS NOT NULL")
    w = rows.select("page_id", "engine", F.explode(F.regexp_extract_all(F.lower("raw"), F.lit(r"([\p{L}]+)"), F.lit(1))).alias("t"))
    c = w.groupBy("page_id", "t").agg(F.count_if(F.col("engine") == "alpha").alias("a"), F.count_if(F.col("engine") == "gamma").alias("g"))
    return c.groupBy("page_id").agg((2 * F.sum(F.least("a", "g")) / F.sum(F.col("a") + F.col("g"))).alias("dice"))


#: Resamples of the paired bootstrap, as in the reference.
RESAMPLES = 2000


@query()
def bootstrap_interval(spark, d):
    """Paired bootstrap of the difference of two engines' error rates over whole texts; a resample weighs pages by Poisson draws."""
    ship(spark)
    plain = lambda c: F.regexp_replace(T.body(F.col(c)), r"[^\x20-\x7E]", "")
    rows = _engines(spark, d, reasons=False).where("engine <> 'gamma'").select("page_id", "engine", edit_distance(plain("raw"), plain("ref")).alias("dist"), F.length(plain("ref")).alias("n"))
    pages = rows.groupBy("page_id").agg(F.sum(F.when(F.col("engine") == "alpha", F.col("dist")).otherwise(-F.col("dist"))).alias("diff"), F.max("n").alias("n"))

    def draw(batches):
        total = np.zeros((RESAMPLES, 2))
        for batch in batches:
            for page, diff, n in zip(batch["page_id"], batch["diff"], batch["n"], strict=True):
                weight = np.random.default_rng([17, int(page)]).poisson(1.0, RESAMPLES)
                total += weight[:, None] * np.array([[float(diff), float(n)]])
        yield pd.DataFrame({"i": range(RESAMPLES), "diff": total[:, 0], "n": total[:, 1]})

    sums = pages.mapInPandas(draw, "i int, diff double, n double").groupBy("i").agg((F.sum("diff") / F.sum("n")).alias("delta"))
    return sums.agg(F.percentile("delta", 0.025).alias("low"), F.percentile("delta", 0.975).alias("high"), F.count(F.lit(1)).alias("resamples"))


RUNS_SQL = f"""
    WITH {FUNNEL_SQL},
    ro AS (SELECT doc_id, codes, band FROM q WHERE doc_id % 10 <> 0),
    rn AS (SELECT doc_id, CASE WHEN symbol > 0.15 THEN list_concat(codes, ['strict_symbol']) ELSE list_filter(codes, lambda x: x <> 'few_sentences') END AS codes, band FROM q WHERE doc_id % 11 <> 0)
"""


def _runs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = with_status(spark, d).select("doc_id", F.col("reason_codes").alias("codes"), F.col("m.symbol").alias("symbol"))
    strict = F.when(F.col("symbol") > 0.15, F.concat("codes", F.array(F.lit("strict_symbol")))).otherwise(F.filter("codes", lambda x: x != "few_sentences"))
    return docs.where("doc_id % 10 <> 0").select("doc_id", "codes"), docs.where("doc_id % 11 <> 0").select("doc_id", strict.alias("codes"))


@query(
    RUNS_SQL
    + """SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN n.doc_id IS NULL THEN 'only_old' WHEN o.doc_id IS NULL THEN 'only_new' ELSE 'both' END AS side,
        array_to_string(list_sort(list_filter(coalesce(n.codes, []), lambda x: NOT list_contains(coalesce(o.codes, []), x))), ',') AS gained,
        array_to_string(list_sort(list_filter(coalesce(o.codes, []), lambda x: NOT list_contains(coalesce(n.codes, []), x))), ',') AS lost FROM ro o FULL JOIN rn n ON o.doc_id = n.doc_id"""
)
def paired_runs(spark, d):
    """Two runs over the same documents, document by document: codes gained and lost."""
    old, new = _runs(spark, d)
    both = old.select(F.col("doc_id").alias("o"), F.col("codes").alias("a")).join(new.select(F.col("doc_id").alias("n"), F.col("codes").alias("b")), F.col("o") == F.col("n"), "full_outer")
    none = F.array().cast("array<string>")
    a, b = F.coalesce("a", none), F.coalesce("b", none)
    side = F.when(F.col("n").isNull(), "only_old").when(F.col("o").isNull(), "only_new").otherwise("both")
    return both.select(
        F.coalesce("o", "n").alias("doc_id"), side.alias("side"), F.array_join(F.array_sort(F.array_except(b, a)), ",").alias("gained"), F.array_join(F.array_sort(F.array_except(a, b)), ",").alias("lost")
    )


@query(
    RUNS_SQL
    + """, ca AS (SELECT c AS code, count(*) AS n FROM (SELECT unnest(codes) AS c FROM ro) GROUP BY c), cb AS (SELECT c AS code, count(*) AS n FROM (SELECT unnest(codes) AS c FROM rn) GROUP BY c)
        SELECT coalesce(ca.code, cb.code) AS code, coalesce(ca.n, 0) AS n_old, coalesce(cb.n, 0) AS n_new, coalesce(cb.n, 0) - coalesce(ca.n, 0) AS delta FROM ca FULL JOIN cb ON ca.code = cb.code"""
)
def compare_audits(spark, d):
    old, new = _runs(spark, d)
    count = lambda df, name: df.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias(name))
    return count(old, "n_old").join(count(new, "n_new"), "code", "full_outer").na.fill(0, ["n_old", "n_new"]).withColumn("delta", F.col("n_new") - F.col("n_old"))


@query(
    f"""WITH {FUNNEL_SQL}, v AS (SELECT doc_id AS key, CASE WHEN doc_id % 13 = 0 THEN 'rights' WHEN doc_id % 5 = 0 THEN 'duplicate' ELSE 'kept' END AS verdict, CASE WHEN doc_id % 2 = 0 THEN 'exact' ELSE 'fuzzy' END AS kind FROM documents WHERE doc_id % 17 <> 0)
        SELECT doc_id, CASE WHEN status = 'kept' AND verdict = 'duplicate' THEN 'rejected:duplicate' WHEN status = 'kept' AND verdict = 'rights' THEN 'rejected:rights' ELSE status END AS status,
               CASE WHEN status = 'kept' AND verdict = 'duplicate' THEN 'global_' || kind END AS final_kind FROM st LEFT JOIN v ON v.key = st.doc_id"""
)
def apply_verdict(spark, d):
    chunks = with_status(spark, d).select("doc_id", "status")
    key = F.col("doc_id")
    verdict = F.when(F.pmod(key, F.lit(13)) == 0, "rights").when(F.pmod(key, F.lit(5)) == 0, "duplicate").otherwise("kept")
    known = table(spark, d, "documents").where("doc_id % 17 <> 0").select("doc_id", verdict.alias("verdict"), F.when(F.pmod(key, F.lit(2)) == 0, "exact").otherwise("fuzzy").alias("kind"))
    return dedup.apply_verdict(chunks, known, "doc_id")


@query(
    """WITH l AS (SELECT doc_id AS id, n_chars + (doc_id % 50 = 0)::INTEGER AS size FROM documents WHERE doc_id % 20 <> 0), r AS (SELECT doc_id AS id, length(text) AS size FROM documents WHERE doc_id % 30 <> 1)
        SELECT coalesce(l.id, r.id) AS doc_id, CASE WHEN r.id IS NULL THEN 'missing' WHEN l.id IS NULL THEN 'extra' WHEN l.size <> r.size THEN 'size' ELSE 'same' END AS state FROM l FULL JOIN r ON l.id = r.id"""
)
def reconcile_log(spark, d):
    """A log against what is there: missing, extra, of another size, or the same."""
    docs = table(spark, d, "documents")
    log = docs.where("doc_id % 20 <> 0").select(F.col("doc_id").alias("l"), (F.col("n_chars") + (F.pmod("doc_id", F.lit(50)) == 0).cast("int")).alias("a"))
    raw = docs.where("doc_id % 30 <> 1").select(F.col("doc_id").alias("r"), F.length("text").alias("b"))
    state = F.when(F.col("r").isNull(), "missing").when(F.col("l").isNull(), "extra").when(F.col("a") != F.col("b"), "size").otherwise("same")
    return log.join(raw, F.col("l") == F.col("r"), "full_outer").select(F.coalesce("l", "r").alias("doc_id"), state.alias("state"))


@query("SELECT source, count(*) AS pending FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY source")
def pending_work(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return docs.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti").groupBy("source").agg(F.count(F.lit(1)).alias("pending"))


@query(
    """WITH f AS (SELECT o_orderkey AS file, 'g' || o_custkey AS stem, 'p' || (o_orderkey % 4) AS galley FROM orders), g AS (SELECT DISTINCT 'g' || o_custkey AS stem, 'p' || (o_orderkey % 4) AS galley FROM orders WHERE o_orderkey % 3 <> 0),
        m AS (SELECT stem, list(galley) AS galleys FROM g GROUP BY stem), t AS (SELECT 'g' || c_custkey AS stem, c_name AS title, c_mktsegment AS journal FROM customer WHERE c_custkey % 5 <> 0)
        SELECT file, f.stem, title, journal, coalesce(list_contains(galleys, galley), false) AS galley_match, title IS NOT NULL AS has_metadata FROM f LEFT JOIN m USING (stem) LEFT JOIN t USING (stem)"""
)
def metadata_join(spark, d):
    """Files with the metadata of their stem, and whether the metadata lists the file's galley; files without any stay.

    Orders stand for files, customers for papers: metadata is unique by stem, galleys are a list for each stem.
    """
    orders, key = table(spark, d, "orders"), F.col("o_orderkey")
    stem, galley = F.concat(F.lit("g"), F.col("o_custkey").cast("string")), F.concat(F.lit("p"), F.pmod(key, F.lit(4)).cast("string"))
    files = orders.select(key.alias("file"), stem.alias("stem"), galley.alias("galley"))
    listed = orders.where("o_orderkey % 3 <> 0").select(stem.alias("stem"), galley.alias("galley")).groupBy("stem").agg(F.collect_set("galley").alias("galleys"))
    papers = table(spark, d, "customer").where("c_custkey % 5 <> 0").select(F.concat(F.lit("g"), F.col("c_custkey").cast("string")).alias("stem"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("journal"))
    rows = files.join(listed, "stem", "left").join(papers, "stem", "left")
    return rows.select("file", "stem", "title", "journal", F.coalesce(F.array_contains("galleys", F.col("galley")), F.lit(False)).alias("galley_match"), F.col("title").isNotNull().alias("has_metadata"))


@query(
    """WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 100 = 0),
        s AS (SELECT q.vec_id AS query, e.vec_id AS id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 9) AS cosine FROM q, embeddings e WHERE q.vec_id <> e.vec_id)
        SELECT query, id, r::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY cosine DESC, id) AS r FROM s) WHERE r <= 5"""
)
def cosine_neighbours(spark, d):
    """The five nearest vectors of every vector whose id is divisible by 100, against all vectors."""
    rows = table(spark, d, "embeddings")
    return vectors.cosine_neighbours(rows, rows.where("vec_id % 100 = 0"), "vec_id", "embedding").select("query", "id", "rank")


@query()
def pca_points(spark, d):
    return vectors.principal_components(table(spark, d, "embeddings"), "vec_id", "embedding")


@query()
def cluster_stats(spark, d):
    """Clusters, their sizes and commonest label, and the share of noise."""
    rows = vectors.cluster_by_density(table(spark, d, "embeddings"), "vec_id", "embedding").join(table(spark, d, "embeddings").select("vec_id", "label"), "vec_id")
    return rows.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), F.mode("label", True).alias("label"))


@query(
    r"""WITH w AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}]+')) AS t FROM documents) GROUP BY ALL),
        f AS (SELECT t, count(*) AS df FROM w GROUP BY t HAVING count(*) >= 2 ORDER BY df DESC, t LIMIT 20000),
        x AS (SELECT doc_id, t, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS v FROM w JOIN f USING (t)),
        n AS (SELECT doc_id, sqrt(sum(v * v)) AS s FROM x GROUP BY doc_id)
        SELECT doc_id, count(*) AS n_words, round(max(v / s), 6) AS heaviest FROM x JOIN n USING (doc_id) GROUP BY doc_id"""
)
def tfidf_weights(spark, d):
    tokens = F.regexp_extract_all(F.lower(T.body(F.col("text"))), F.lit(r"([\p{L}]+)"), F.lit(1))
    w = vectors.tfidf(table(spark, d, "documents"), "doc_id", tokens)
    return w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words"), F.round(F.max("weight"), 6).alias("heaviest"))


@query()
def singular_vectors(spark, d):
    """TF-IDF of the documents in the space of 64 singular vectors, as unit vectors: their first two coordinates."""
    tokens = F.regexp_extract_all(F.lower(T.body(F.col("text"))), F.lit(r"([\p{L}]+)"), F.lit(1))
    weights = vectors.tfidf(table(spark, d, "documents"), "doc_id", tokens)
    made = vectors.svd_vectors(weights, "doc_id")
    return made.select("doc_id", F.size("vector").alias("dimensions"), F.round(F.get("vector", F.lit(0)), 6).alias("first"), F.round(F.get("vector", F.lit(1)), 6).alias("second"))


@query()
def text_embeddings(spark, d):
    """The embedding hook with hashed words as the model; the nearest documents of every hundredth one."""
    made, _ = materialize(vectors.embed(table(spark, d, "documents").where("doc_id IS NOT NULL"), "doc_id", "text", vectors.hashed_words), "embeddings")
    return vectors.cosine_neighbours(made, made.where("doc_id % 100 = 0"), "doc_id", "embedding", k=3).select("query", "id", "rank")


@query()
def cluster_space(spark, d):
    """The space that clusters are found in: as many principal components as the vectors allow, fifty at most; the plane of
    UMAP isn't one, and its coordinates are null without that library."""
    rows = table(spark, d, "embeddings")
    points = vectors.principal_components(rows, "vec_id", "embedding", 50)
    return points.select("vec_id", *[F.round(f"pc{i}", 6).alias(f"pc{i}") for i in (1, 2, 50)], F.lit(None).cast("double").alias("umap_x"), F.lit(None).cast("double").alias("umap_y"))
