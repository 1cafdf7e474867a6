"""Queries over documents: metrics, quality, languages, families, lines, samples, privacy, contamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loam.functions import text as T
from loam.functions.edit import edit_distance
from loam.operators import dedup, language, quality
from loam.operators.order import numbered, order_statistics
from loam.plans.registry import query, table
from loam.session import materialize, ship

PROFILE = quality.Profile(min_words=20, min_alpha=0.55, languages=("en", "fr", "de", "es"), min_lang_score=0.65, web_checks=True)
_PHRASES = ", ".join(f"'{p}'" for p in quality.BOILERPLATE)
_ENDS = " OR ".join(f"ends_with(x, '{e}')" for e in quality.ENDINGS)

METRICS_SQL = rf"""
    b AS (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents),
    p1 AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(text, '(?s)```.*?```', ' ', 'g'), '(?s)\\\[.*?\\\]', ' ', 'g'), '(?s)\\\(.*?\\\)', ' ', 'g') AS q FROM b),
    p2 AS (SELECT *, CASE WHEN len(regexp_extract_all(q, '\$\$')) % 2 = 0 THEN regexp_replace(q, '(?s)\$\$.*?\$\$', ' ', 'g') ELSE q END AS prose FROM p1),
    p3 AS (SELECT *, regexp_extract_all(text, '[^ \t\n\r]+') AS w, regexp_extract_all(prose, '[^ \t\n\r]+') AS pw,
                  list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ln,
                  len(regexp_extract_all(prose, '[^ \t\n\r]')) AS solid, len(regexp_extract_all(text, '[^ \t\n\r]')) AS whole,
                  len(regexp_extract_all(prose, '\p{{L}}')) AS al FROM p2),
    p4 AS (SELECT *, list_filter(ln, lambda x: regexp_matches(x, '\p{{L}}')) AS worded,
                  [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] AS tri,
                  [pw[i] || ' ' || pw[i + 1] || ' ' || pw[i + 2] FOR i IN range(1, len(pw) - 1)] AS ptri FROM p3),
    m AS (SELECT doc_id, source, lang, text, len(w)::INTEGER AS words, len(pw)::INTEGER AS prose_words,
        CASE WHEN whole = 0 THEN 0.0 ELSE greatest(0.0, 1 - solid / whole) END AS math_share,
        al / greatest(solid, 1) AS alpha,
        len(regexp_extract_all(prose, '\p{{Nd}}')) / greatest(solid, 1) AS digit,
        len(regexp_extract_all(prose, '[^\p{{L}}\p{{N}} \t\n\r]')) / greatest(solid, 1) AS symbol,
        len(regexp_extract_all(prose, '\p{{Lu}}')) / greatest(al, 1) AS upper,
        len(regexp_extract_all(text, chr(65533))) / greatest(whole, 1) AS replacement,
        solid / greatest(len(pw), 1) AS mean_word_len,
        len(regexp_extract_all(text, 'https?://[^ \t\n\r]+|www\.[^ \t\n\r]+')) / greatest(len(w), 1) AS url,
        CASE WHEN len(worded) < 5 THEN 0.0 ELSE 1 - len(list_distinct(worded)) / len(worded) END AS dup_line,
        len(list_filter(ln, lambda x: len(regexp_extract_all(x, '[^ \t\n\r]+')) < 5)) / greatest(len(ln), 1) AS short_line,
        len(list_filter(ln, lambda x: regexp_matches(x, '^([-•*–·►▪]|[0-9]+[.)])[ \t]'))) / greatest(len(ln), 1) AS bullet,
        len(list_filter(ln, lambda x: {_ENDS})) / greatest(len(ln), 1) AS end_punct,
        len(list_filter(ln, lambda x: len(regexp_extract_all(x, '[^ \t\n\r]+')) < 15
            AND len(list_filter([{_PHRASES}], lambda f: contains(lower(x), f))) > 0)) / greatest(len(ln), 1) AS boilerplate_line,
        CASE WHEN len(ptri) < 30 THEN 0.0 ELSE 1 - len(list_distinct(ptri)) / len(ptri) END AS rep_trigram,
        CASE WHEN len(tri) < 30 THEN 0.0 ELSE 1 - len(list_distinct(tri)) / len(tri) END AS rep_trigram_raw,
        len(regexp_extract_all(lower(prose), '[{T.VI_LETTERS}]')) / greatest(len(regexp_extract_all(lower(prose), '\p{{L}}')), 1) AS vi_diacritic,
        len(ln)::INTEGER AS lines,
        len(regexp_extract_all(text, '[\x{{E000}}-\x{{F8FF}}]'))::INTEGER AS pua_chars,
        len(regexp_extract_all(text, '[\x{{0600}}-\x{{06FF}}\x{{0900}}-\x{{0EFF}}]'))::INTEGER AS junk_script_chars
        FROM p4)
"""
_LANGS = ", ".join(f"'{x}'" for x in PROFILE.languages)
SCORED_SQL = (
    METRICS_SQL
    + f""",
    k AS (SELECT *, prose_words < 20 AND math_share >= 0.3 AS mo FROM m),
    s AS (SELECT *,
        list_filter([CASE WHEN words = 0 THEN 'empty' END, CASE WHEN words > 0 AND words < {PROFILE.min_words} THEN 'too_short' END,
            CASE WHEN words > {PROFILE.max_words} THEN 'too_long' END, CASE WHEN coalesce(lang <> 'und' AND lang NOT IN ({_LANGS}), true) AND words > 0 THEN 'lang_not_allowed' END,
            CASE WHEN alpha < {PROFILE.min_alpha} AND NOT mo AND words > 0 THEN 'low_alpha' END, CASE WHEN replacement > 0.005 THEN 'replacement_chars' END,
            CASE WHEN (rep_trigram > 0.5 AND NOT mo) OR rep_trigram_raw >= 0.8 THEN 'repeated_ngrams' END, CASE WHEN dup_line > 0.5 THEN 'duplicate_lines' END,
            CASE WHEN pua_chars >= 5 THEN 'private_use_chars' END, CASE WHEN junk_script_chars >= 5 THEN 'math_font_junk' END], lambda x: x IS NOT NULL) AS hard,
        [{{'c': 'repetitive', 'p': 20, 'h': rep_trigram > 0.3 AND NOT mo}}, {{'c': 'dup_lines_some', 'p': 15, 'h': dup_line > 0.25}},
            {{'c': 'digit_heavy', 'p': 15, 'h': digit > 0.3 AND NOT mo}}, {{'c': 'symbol_heavy', 'p': 15, 'h': symbol > 0.35 AND NOT mo}},
            {{'c': 'mostly_upper', 'p': 15, 'h': upper > 0.5}}, {{'c': 'odd_word_length', 'p': 15, 'h': NOT (mean_word_len BETWEEN 2.5 AND 10) AND NOT mo}},
            {{'c': 'some_replacement_chars', 'p': 10, 'h': replacement > 0.0005}}, {{'c': 'lang_unknown', 'p': 0, 'h': lang = 'und'}},
            {{'c': 'low_lang_score', 'p': 10, 'h': false}}, {{'c': 'low_diacritic', 'p': 15, 'h': lang = 'vi' AND words >= 20 AND vi_diacritic < 0.05}},
            {{'c': 'url_heavy', 'p': 20, 'h': url > 0.1}}, {{'c': 'boilerplate', 'p': 20, 'h': boilerplate_line > 0.15}},
            {{'c': 'list_like', 'p': 15, 'h': short_line > 0.7 AND lines >= 5}}, {{'c': 'bullet_heavy', 'p': 10, 'h': bullet > 0.5 AND lines >= 5}},
            {{'c': 'few_sentences', 'p': 10, 'h': end_punct < 0.15 AND lines >= 5}}] AS soft FROM k),
    z AS (SELECT *, list_concat(hard, list_transform(list_filter(soft, lambda x: coalesce(x.h, false) AND words > 0), lambda x: x.c)) AS codes,
        greatest(0.0, 100.0 - coalesce(list_sum(list_transform(list_filter(soft, lambda x: coalesce(x.h, false)), lambda x: x.p)), 0)) AS fullscore FROM s),
    y AS (SELECT *, CASE WHEN words = 0 THEN 0.0 WHEN len(hard) > 0 THEN least(40.0, fullscore) ELSE fullscore END::DOUBLE AS score FROM z),
    q AS (SELECT *, CASE WHEN score >= 85 THEN 'A' WHEN score >= 70 THEN 'B' WHEN score >= 55 THEN 'C' ELSE 'D' END AS band FROM y)
"""
)
FUNNEL_SQL = (
    SCORED_SQL
    + """,
    f AS (SELECT *, min_by(doc_id, {'a': -score, 'b': doc_id}) OVER (PARTITION BY text) AS rep, count(*) OVER (PARTITION BY text) AS fam FROM q),
    st AS (SELECT *, CASE WHEN band = 'D' THEN 'rejected:quality' WHEN doc_id <> rep THEN 'rejected:duplicate' ELSE 'kept' END AS status FROM f)
"""
)


def scored_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = quality.with_metrics(table(spark, d, "documents"))
    return quality.scored(docs, F.col("lang"), F.lit(1.0), PROFILE)


def with_status(spark: SparkSession, d: str) -> DataFrame:
    """Scored documents, without their texts, with the representative of their family and their status.

    The scores are computed once and written to the shared scratch folder: the families and the rows read them there.
    """
    docs = scored_documents(spark, d)
    docs = docs.select("doc_id", "source", "lang", F.length("text").alias("n_chars"), F.sha2(T.body(F.col("text")), 256).alias("sha"), "m", "reason_codes", "quality_score", "quality_band")
    docs, _ = materialize(docs, "scored")
    docs = dedup.with_families(docs, "doc_id", "sha", [-F.col("quality_score"), F.col("doc_id")])
    status = F.when(F.col("quality_band") == "D", "rejected:quality").when(F.col("doc_id") != F.col("representative"), "rejected:duplicate").otherwise("kept")
    return docs.withColumn("status", status)


@query(f"WITH {METRICS_SQL} SELECT * EXCLUDE (text, source, lang) FROM m")
def doc_metrics(spark, d):
    return quality.with_metrics(table(spark, d, "documents")).select("doc_id", "m.*")


@query(f"WITH {SCORED_SQL} SELECT doc_id, score AS quality_score, band AS quality_band, array_to_string(codes, ',') AS reason_codes FROM q")
def doc_quality(spark, d):
    return scored_documents(spark, d).select("doc_id", "quality_score", "quality_band", F.array_join("reason_codes", ",").alias("reason_codes"))


@query(
    f"""WITH {FUNNEL_SQL} SELECT source, count(*) AS n_in, count(*) FILTER (status = 'kept') AS kept,
        count(*) FILTER (status = 'rejected:quality') AS rejected_quality, count(*) FILTER (status = 'rejected:duplicate') AS rejected_duplicate FROM st GROUP BY source"""
)
def doc_funnel(spark, d):
    is_ = lambda x: F.count_if(F.col("status") == x)
    return with_status(spark, d).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_in"), is_("kept").alias("kept"), is_("rejected:quality").alias("rejected_quality"), is_("rejected:duplicate").alias("rejected_duplicate")
    )


@query(f"WITH {SCORED_SQL} SELECT band AS quality_band, count(*) AS n FROM q GROUP BY band")
def band_counts(spark, d):
    return scored_documents(spark, d).groupBy("quality_band").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SCORED_SQL} SELECT source, code, count(*) AS n FROM (SELECT source, unnest(codes) AS code FROM q) GROUP BY ALL")
def reason_counts(spark, d):
    return scored_documents(spark, d).select("source", F.explode("reason_codes").alias("code")).groupBy("source", "code").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {FUNNEL_SQL} SELECT source, sum(words)::BIGINT AS words_in, coalesce(sum(words) FILTER (status = 'kept'), 0)::BIGINT AS words_kept,
        sum(ceil(length(text) / 4.0))::BIGINT AS tokens_in, coalesce(sum(ceil(length(text) / 4.0)) FILTER (status = 'kept'), 0)::BIGINT AS tokens_kept,
        CASE WHEN sum(words) FILTER (status = 'kept') > 0 THEN round(sum(ceil(length(text) / 4.0)) FILTER (status = 'kept') / sum(words) FILTER (status = 'kept'), 3) END AS tokens_per_word_kept
        FROM st GROUP BY source"""
)
def token_accounting(spark, d):
    docs = with_status(spark, d).withColumn("tokens", F.ceil(F.col("n_chars") / 4.0)).withColumn("words", F.col("m.words").cast("long"))
    kept = F.col("status") == "kept"
    words_kept, tokens_kept = F.sum(F.when(kept, F.col("words")).otherwise(0)), F.sum(F.when(kept, F.col("tokens")).otherwise(0))
    out = docs.groupBy("source").agg(F.sum("words").alias("words_in"), words_kept.alias("words_kept"), F.sum("tokens").alias("tokens_in"), tokens_kept.alias("tokens_kept"))
    return out.withColumn("tokens_per_word_kept", F.when(F.col("words_kept") > 0, F.round(F.col("tokens_kept") / F.col("words_kept"), 3)))


@query(
    """SELECT source, avg((coalesce(source, '') <> '' AND coalesce(text, '') <> '')::INTEGER) AS lineage_rate, count(*) AS n FROM documents GROUP BY source"""
)
def lineage_rate(spark, d):
    whole = (F.coalesce("source", F.lit("")) != "") & (T.body(F.col("text")) != "")
    return table(spark, d, "documents").groupBy("source").agg(F.avg(whole.cast("int")).alias("lineage_rate"), F.count(F.lit(1)).alias("n"))


_PHONE = r"(^|[^0-9])(0|\+84)[35789][0-9]{8}([^0-9]|$)"


@query(
    rf"""SELECT source, count(*) FILTER (regexp_matches(text, '{T.EMAIL}')) AS with_email, count(*) FILTER (regexp_matches(text, '{_PHONE}')) AS with_phone FROM documents GROUP BY source"""
)
def pii_counts(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(
        F.count_if(F.col("text").rlike(T.EMAIL)).alias("with_email"), F.count_if(F.col("text").rlike(_PHONE)).alias("with_phone")
    )


@query(rf"SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{T.EMAIL}', '<EMAIL>', 'g')) AS masked_sha256, len(regexp_extract_all(text, '{T.EMAIL}'))::INTEGER AS n_masked FROM documents")
def mask_email(spark, d):
    text = T.body(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.sha2(T.mask_email(text), 256).alias("masked_sha256"), T.count_of(text, T.EMAIL).alias("n_masked"))


_LEX = language.Lexicon(target="fr", other="en", letters="àâçèéêëîïôùûü", min_letters=0.03, target_words=("le", "la", "de", "et", "les", "des", "un", "une", "que", "qui"), min_share=0.05)


def _lid_sql(x: str) -> str:
    quoted = lambda ws: ", ".join(f"'{w}'" for w in ws)
    tokens = rf"regexp_extract_all(lower({x}), '[\p{{L}}]+')"
    share = lambda ws: f"len(list_filter({tokens}, lambda w: w IN ({quoted(ws)}))) / greatest(len({tokens}), 1)"
    dia = rf"len(regexp_extract_all(lower({x}), '[{_LEX.letters}]')) / greatest(len(regexp_extract_all(lower({x}), '\p{{L}}')), 1)"
    return f"""CASE WHEN len({tokens}) = 0 THEN 'und' WHEN {dia} >= {_LEX.min_letters} OR {share(_LEX.target_words)} >= {_LEX.min_share} THEN '{_LEX.target}'
        WHEN {share(_LEX.other_words)} >= {_LEX.min_share} THEN '{_LEX.other}' ELSE 'other' END"""


@query(f"SELECT doc_id, {_lid_sql('coalesce(text, chr(32))')} AS language FROM documents")
def lang_heuristic(spark, d):
    return table(spark, d, "documents").select("doc_id", language.heuristic(F.col("text"), _LEX).alias("language"))


@query(rf"SELECT doc_id, len(regexp_extract_all(lower(text), '[{T.VI_LETTERS}]')) / greatest(len(regexp_extract_all(lower(text), '\p{{L}}')), 1) AS vi_diacritic FROM documents")
def vi_diacritic_ratio(spark, d):
    return table(spark, d, "documents").select("doc_id", T.diacritic_share(F.col("text")).alias("vi_diacritic"))


def _mix_sql(segs: str) -> str:
    """Mixes over some of a document's segments, which are the list c."""
    return rf"""
    g AS (SELECT doc_id, list_filter(list_transform(CASE WHEN len(pa) > 1 THEN pa ELSE string_split(body, chr(10)) END, lambda x: trim(x)), lambda x: len(regexp_extract_all(x, '\p{{L}}')) > 0) AS wl
          FROM (SELECT doc_id, body, list_filter(regexp_split_to_array(body, '\n\n+'), lambda x: trim(x) <> '') AS pa FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents))),
    h AS (SELECT doc_id, CASE WHEN len(list_filter(wl, lambda x: len(regexp_extract_all(x, '\p{{L}}')) >= 10)) > 0
            THEN list_filter(wl, lambda x: len(regexp_extract_all(x, '\p{{L}}')) >= 10) ELSE wl END AS c FROM g),
    i AS (SELECT doc_id, {segs} AS segs FROM h),
    j AS (SELECT doc_id, seg, {_lid_sql('seg')} AS label, len(regexp_extract_all(seg, '\p{{L}}')) AS w FROM (SELECT doc_id, unnest(segs) AS seg FROM i)),
    k AS (SELECT doc_id, label, sum(w)::BIGINT AS w, count(*) AS n FROM j GROUP BY ALL
          UNION ALL SELECT doc_id, 'und', 0, 0 FROM i WHERE len(segs) = 0),
    l AS (SELECT doc_id, label, w, n, sum(w) OVER (PARTITION BY doc_id)::BIGINT AS total, sum(n) OVER (PARTITION BY doc_id)::BIGINT AS n_segments,
                 row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, label DESC) AS r FROM k),
    mx AS (SELECT doc_id, max(label) FILTER (r = 1) AS language, string_agg(label || '=' || printf('%.4f', round(w / greatest(total, 1), 4)), ',' ORDER BY label) AS mix,
                  any_value(n_segments) AS n_segments, coalesce(max(round(w / greatest(total, 1), 4)) FILTER (r = 2), 0) >= 0.2 AS mixed FROM l GROUP BY doc_id)
"""


#: Segments of the languages' counts, 50 of a document at most: their SQL has it so.
MIX_SQL = _mix_sql("CASE WHEN len(c) > 50 THEN [c[floor(j * (len(c) / 50))::INTEGER + 1] FOR j IN range(0, 50)] ELSE c END")


@query(f"WITH {_mix_sql('c')} SELECT * FROM mx")
def lang_mix(spark, d):
    return language.mixes(table(spark, d, "documents"), "doc_id", "text", _LEX)


@query(
    f"""WITH {MIX_SQL} SELECT source, language, count(*) AS n, count(*) FILTER (mixed) AS n_mixed FROM mx JOIN documents USING (doc_id) GROUP BY ALL"""
)
def language_stats(spark, d):
    docs = table(spark, d, "documents")
    mix = language.mixes(docs, "doc_id", "text", _LEX, most=50).join(docs.select("doc_id", "source"), "doc_id")
    return mix.groupBy("source", "language").agg(F.count(F.lit(1)).alias("n"), F.count_if("mixed").alias("n_mixed"))


@query(
    f"""WITH {FUNNEL_SQL} SELECT doc_id, rep AS representative, 'fam_' || substr(sha1(rep::VARCHAR), 1, 12) AS family_id, fam AS family_size,
        CASE WHEN doc_id <> rep THEN 'exact' END AS dup_kind FROM st"""
)
def exact_families(spark, d):
    return with_status(spark, d).select("doc_id", "representative", "family_id", "family_size", "dup_kind")


LINES_SQL = r"""
    li AS (SELECT doc_id, source, unnest(range(1, len(l) + 1)) AS place, unnest(l) AS line FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
    lw AS (SELECT *, trim(line) AS t, len(regexp_extract_all(line, '[^ \t\n\r]+')) AS n_words FROM li)
"""


def _lines(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    rows = docs.select("doc_id", "source", F.posexplode(F.split(T.body(F.col("text")), "\n")).alias("place", "line"))
    return rows.withColumn("place", (F.col("place") + 1).cast("long")).withColumn("t", F.trim("line")).withColumn("n_words", T.word_count(F.col("line")))


@query(
    f"""WITH {LINES_SQL} SELECT source, md5(t) AS line_md5, count(DISTINCT doc_id) AS n_docs, count(*) AS n_lines FROM lw WHERE n_words >= 3
        GROUP BY source, t HAVING count(DISTINCT doc_id) >= 3"""
)
def repeated_lines(spark, d):
    by_doc = _lines(spark, d).where("n_words >= 3").groupBy("source", "t", "doc_id").agg(F.count(F.lit(1)).alias("k"))
    by = by_doc.groupBy("source", "t").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("k").alias("n_lines")).where("n_docs >= 3")
    return by.select("source", F.md5("t").alias("line_md5"), "n_docs", "n_lines")


@query(
    f"""WITH {LINES_SQL}, n AS (SELECT source, greatest(3, ceil(0.0001 * count(*)))::BIGINT AS least FROM documents GROUP BY source),
        fl AS (SELECT source, t FROM lw WHERE t <> '' GROUP BY source, t HAVING count(DISTINCT doc_id) >= (SELECT least FROM n WHERE n.source = lw.source)),
        k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY place) AS clean, count(*) AS n_kept FROM lw WHERE NOT EXISTS (SELECT 1 FROM fl WHERE fl.source = lw.source AND fl.t = lw.t) GROUP BY doc_id)
        SELECT doc_id, sha256(coalesce(clean, '')) AS clean_sha256, len(string_split(coalesce(text, ''), chr(10))) - coalesce(n_kept, 0) AS lines_removed
        FROM documents LEFT JOIN k USING (doc_id)"""
)
def cross_doc_clean(spark, d):
    docs, rows = table(spark, d, "documents"), _lines(spark, d)
    least = docs.groupBy("source").agg(F.greatest(F.lit(3), F.ceil(0.0001 * F.count(F.lit(1)))).alias("least"))
    df = rows.where("t <> ''").select("source", "t", "doc_id").distinct().groupBy("source", "t").agg(F.count(F.lit(1)).alias("df"))
    flagged = df.join(least, "source").where("df >= least").select("source", "t")
    kept = rows.join(flagged, ["source", "t"], "left_anti").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("l"))
    kept = kept.select("doc_id", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("clean"), F.size("l").alias("n_kept"))
    all_lines = F.size(F.split(T.body(F.col("text")), "\n"))
    return docs.join(kept, "doc_id", "left").select(
        "doc_id", F.sha2(T.body(F.col("clean")), 256).alias("clean_sha256"), (all_lines - F.coalesce("n_kept", F.lit(0))).cast("long").alias("lines_removed")
    )


@query(
    f"""WITH {LINES_SQL}, c AS (SELECT source, t AS line, count(*) AS n FROM lw WHERE t <> '' GROUP BY ALL HAVING count(*) >= 2)
        SELECT source, md5(line) AS line_md5, left(line, 200) AS shown, n, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, line) AS r FROM c) WHERE r <= 30"""
)
def top_repeated_lines(spark, d):
    counts = _lines(spark, d).where("t <> ''").groupBy("source", F.col("t").alias("line")).agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), "line"))
    return counts.withColumn("rank", rank).where("rank <= 30").select("source", F.md5("line").alias("line_md5"), F.left("line", F.lit(200)).alias("shown"), "n", "rank")


@query(
    f"""WITH {LINES_SQL}, p AS (SELECT *, lag(t) OVER (PARTITION BY doc_id ORDER BY place) AS prev, row_number() OVER (PARTITION BY doc_id, t ORDER BY place) AS seen,
            count(*) OVER (PARTITION BY doc_id, t) AS total FROM lw)
        SELECT doc_id, count(*) FILTER (t <> '' AND t = prev) AS n_repeats, count(*) FILTER (t <> '' AND n_words < 10 AND total >= 3 AND seen > 1 AND NOT ends_with(t, ':')) AS n_short_repeats FROM p GROUP BY doc_id"""
)
def in_doc_repeats(spark, d):
    rows = _lines(spark, d)
    by_line = Window.partitionBy("doc_id", "t")
    rows = rows.withColumn("prev", F.lag("t").over(Window.partitionBy("doc_id").orderBy("place"))).withColumn("seen", F.row_number().over(by_line.orderBy("place"))).withColumn("total", F.count(F.lit(1)).over(by_line))
    short = (F.col("t") != "") & (F.col("n_words") < 10) & (F.col("total") >= 3) & (F.col("seen") > 1) & ~F.endswith(F.col("t"), F.lit(":"))
    return rows.groupBy("doc_id").agg(F.count_if((F.col("t") != "") & (F.col("t") == F.col("prev"))).alias("n_repeats"), F.count_if(short).alias("n_short_repeats"))


@query(
    r"""WITH a AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw FROM documents), LATERAL (SELECT trim(regexp_replace(raw, '[ \t\n\r]+', ' ', 'g')) AS p)
            WHERE len(regexp_extract_all(p, '[^ \t\n\r]+')) >= 20),
        n AS (SELECT doc_id, count(*) AS n FROM a GROUP BY doc_id),
        r AS (SELECT p FROM a GROUP BY p HAVING count(*) BETWEEN 2 AND 50),
        k AS (SELECT a.doc_id, a.p, n.n FROM a JOIN r USING (p) JOIN n USING (doc_id)),
        o AS (SELECT x.doc_id, x.n, y.doc_id AS other, y.n AS m, count(*) AS shared FROM k x JOIN k y ON x.p = y.p AND (y.n > x.n OR (y.n = x.n AND y.doc_id < x.doc_id)) WHERE x.n >= 3 GROUP BY ALL HAVING count(*) >= 0.8 * x.n)
        SELECT doc_id, other AS container, shared, n AS n_paras FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY shared DESC, m DESC, other) AS q FROM o) WHERE q = 1"""
)
def contained_docs(spark, d):
    return dedup.contained(table(spark, d, "documents"), "doc_id", "text")


@query(
    r"""WITH b AS (SELECT DISTINCT unnest([array_to_string(w[i : i + 12], ' ') FOR i IN range(1, len(w) - 11)]) AS g FROM (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark)),
        d AS (SELECT doc_id, source, unnest([array_to_string(w[i : i + 12], ' ') FOR i IN range(1, len(w) - 11)]) AS g FROM (SELECT doc_id, source, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents)),
        h AS (SELECT DISTINCT source, doc_id FROM d JOIN b USING (g))
        SELECT source, count(*) AS n_docs, array_to_string(list_sort(list(doc_id))[1:20], ',') AS first_ids FROM h GROUP BY source"""
)
def contaminated_docs(spark, d):
    words = lambda df: df.withColumn("w", F.regexp_extract_all(F.lower(T.body(F.col("text"))), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)))
    docs = words(table(spark, d, "documents").select("doc_id", "source", "text")).withColumn("sha", F.sha2(T.body(F.col("text")), 256)).drop("text")
    known = words(table(spark, d, "benchmark").select("text"))
    # Codes of the grams find the few texts worth a look; their grams are compared as such. The codes of the benchmark are
    # broadcast by the planner if their size allows it.
    codes = lambda df, *keep: df.select(*keep, F.explode(F.array_distinct(T.gram_codes(F.col("w"), 13))).alias("c"))
    likely = codes(docs, "sha").join(codes(known).distinct(), "c", "left_semi").select("sha").distinct()
    grams = lambda df, *keep: df.select(*keep, F.explode(T.ngrams(F.col("w"), 13)).alias("g"))
    some = docs.join(likely, "sha", "left_semi")
    hits = grams(some, "doc_id", "source").join(grams(known).distinct(), "g", "left_semi").select("doc_id", "source").distinct()
    return _first_ids(hits, 20)


def _first_ids(hits: DataFrame, k: int) -> DataFrame:
    """Counts of a source and its first k ids; at most k rows of a source are gathered."""
    counts = hits.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    first = hits.withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))).where(F.col("r") <= k)
    first = first.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), ",").alias("first_ids"))
    return counts.join(first, "source")


@query("SELECT doc_id, ('0x' || substr(sha1(doc_id::VARCHAR), 1, 8))::BIGINT % 100 AS bucket, ('0x' || substr(sha1('42:' || doc_id), 40, 1))::INTEGER % 2 = 0 AS tune FROM documents")
def split_buckets(spark, d):
    tune = F.pmod(F.conv(F.substring(F.sha1(F.concat(F.lit("42:"), F.col("doc_id").cast("string"))), 40, 1), 16, 10).cast("int"), F.lit(2)) == 0
    return table(spark, d, "documents").select("doc_id", T.hex_bucket(F.col("doc_id").cast("string")).alias("bucket"), tune.alias("tune"))


@query("SELECT doc_id, r AS rank FROM (SELECT doc_id, row_number() OVER (ORDER BY sha256('42:' || source || ':' || doc_id)) AS r FROM documents) WHERE r <= 100")
def stable_sample(spark, d):
    """The 100 smallest hashes: a sample that nests and doesn't depend on the order of the rows."""
    key = F.sha2(F.concat_ws(":", F.lit("42"), "source", F.col("doc_id").cast("string")), 256)
    top = table(spark, d, "documents").select("doc_id", key.alias("h")).orderBy("h").limit(100)
    return top.withColumn("rank", F.row_number().over(Window.orderBy("h"))).select("doc_id", "rank")


@query("SELECT source, doc_id, r AS rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256('42:' || doc_id)) AS r FROM documents) WHERE r <= 10")
def sample_per_source(spark, d):
    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.sha2(F.concat_ws(":", F.lit("42"), F.col("doc_id").cast("string")), 256)))
    return table(spark, d, "documents").select("source", "doc_id", rank.alias("rank")).where("rank <= 10")


@query(
    """WITH t AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256('42:' || doc_id)) AS depth FROM documents)
        SELECT doc_id, source, depth, row_number() OVER (ORDER BY depth, sha256('42:' || source || ':' || depth)) AS place FROM t WHERE depth <= 8"""
)
def nested_sample(spark, d):
    """Round robin over the sources: any prefix of the order holds each source about equally often."""
    depth = F.row_number().over(Window.partitionBy("source").orderBy(F.sha2(F.concat_ws(":", F.lit("42"), F.col("doc_id").cast("string")), 256)))
    rows = table(spark, d, "documents").select("doc_id", "source", depth.alias("depth")).where("depth <= 8")
    h = F.sha2(F.concat_ws(":", F.lit("42"), "source", F.col("depth").cast("string")), 256)
    return rows.withColumn("place", F.row_number().over(Window.orderBy("depth", h)))


@query(
    """WITH n AS (SELECT source, count(*) AS k FROM documents GROUP BY source), s AS (SELECT source, 1000 * k / (SELECT sum(k) FROM n) AS exact FROM n),
        f AS (SELECT source, floor(exact)::BIGINT AS base, exact - floor(exact) AS rest FROM s)
        SELECT source, base + (row_number() OVER (ORDER BY rest DESC, source) <= 1000 - (SELECT sum(base) FROM f))::INTEGER AS n_rows FROM f"""
)
def mix_counts(spark, d):
    """Weights to counts that add up to 1000, by the largest remainder."""
    n = table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("k"))
    all_ = Window.partitionBy()
    s = n.withColumn("exact", 1000 * F.col("k") / F.sum("k").over(all_)).withColumn("base", F.floor("exact")).withColumn("rest", F.col("exact") - F.col("base"))
    s = s.withColumn("left", 1000 - F.sum("base").over(all_)).withColumn("r", F.row_number().over(Window.orderBy(F.desc("rest"), "source")))
    return s.select("source", (F.col("base") + (F.col("r") <= F.col("left")).cast("int")).alias("n_rows"))


@query(
    r"""WITH w AS (SELECT DISTINCT source, doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}]+')) AS word FROM documents)
        SELECT word, count(DISTINCT source) AS n_sources, count(*) AS n_docs FROM w GROUP BY word HAVING count(*) >= 20"""
)
def word_frequencies(spark, d):
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(T.body(F.col("text"))), F.lit(r"([\p{L}]+)"), F.lit(1)))
    by = table(spark, d, "documents").select("source", F.explode(tokens).alias("word")).groupBy("word", "source").agg(F.count(F.lit(1)).alias("k"))
    return by.groupBy("word").agg(F.count(F.lit(1)).alias("n_sources"), F.sum("k").alias("n_docs")).where("n_docs >= 20")


@query(
    r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[\p{L}]+')) AS word FROM documents),
        f AS (SELECT lower(word) AS word, count(DISTINCT doc_id) AS df FROM w GROUP BY lower(word)),
        t AS (SELECT doc_id, count(*) AS n, count(*) FILTER (df < 3 AND NOT (w.word = upper(w.word) AND length(w.word) <= 6)) AS odd FROM w JOIN f ON f.word = lower(w.word) GROUP BY doc_id)
        SELECT doc_id, n AS n_tokens, odd AS n_odd, CASE WHEN n >= 50 THEN odd / n ELSE 0.0 END AS odd_word FROM t"""
)
def odd_words(spark, d):
    """Words of fewer than three documents, short all-capital ones exempt, as a share of a document's words."""
    tokens = F.regexp_extract_all(T.body(F.col("text")), F.lit(r"([\p{L}]+)"), F.lit(1))
    w = table(spark, d, "documents").select("doc_id", F.explode(tokens).alias("word")).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("k")).withColumn("low", F.lower("word"))
    df = w.select("low", "doc_id").distinct().groupBy("low").agg(F.count(F.lit(1)).alias("df"))
    odd = (F.col("df") < 3) & ~((F.col("word") == F.upper("word")) & (F.length("word") <= 6))
    t = w.join(df, "low").groupBy("doc_id").agg(F.sum("k").alias("n_tokens"), F.sum(F.when(odd, F.col("k")).otherwise(0)).alias("n_odd"))
    return t.withColumn("odd_word", F.when(F.col("n_tokens") >= 50, F.col("n_odd") / F.col("n_tokens")).otherwise(0.0))


@query(
    rf"""WITH w AS (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}]+')) AS word FROM documents),
        k AS (SELECT translate(word, '{T.MARKED}', '{T.BARE}') AS bare, count(*) FILTER (word <> translate(word, '{T.MARKED}', '{T.BARE}')) AS accented, count(*) FILTER (word = translate(word, '{T.MARKED}', '{T.BARE}')) AS plain FROM w GROUP BY 1)
        SELECT bare, accented, plain FROM k WHERE accented >= 5 AND plain <= 0.1 * accented ORDER BY accented DESC, bare LIMIT 300"""
)
def learned_unaccented(spark, d):
    """Bare spellings of words that are nearly always written with marks: the 300 most frequent."""
    w = table(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.lower(T.body(F.col("text"))), F.lit(r"([\p{L}]+)"), F.lit(1))).alias("word"))
    w = w.groupBy("word").agg(F.count(F.lit(1)).alias("k")).withColumn("bare", T.strip_marks(F.col("word")))
    marked = F.col("word") != F.col("bare")
    k = w.groupBy("bare").agg(F.sum(F.when(marked, F.col("k")).otherwise(0)).alias("accented"), F.sum(F.when(~marked, F.col("k")).otherwise(0)).alias("plain"))
    return k.where((F.col("accented") >= 5) & (F.col("plain") <= 0.1 * F.col("accented"))).orderBy(F.desc("accented"), "bare").limit(300)


@query(
    r"""SELECT doc_id, length(coalesce(text, '')) AS n_chars, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r]+')) AS n_words,
        length(regexp_replace(trim(regexp_replace(coalesce(text, ''), '[ \t]+', ' ', 'g')), '\n{3,}', chr(10) || chr(10), 'g')) AS n_chars_collapsed FROM documents"""
)
def text_counts(spark, d):
    text = T.body(F.col("text"))
    flat = F.regexp_replace(F.trim(F.regexp_replace(text, r"[ \t]+", " ")), "\n{3,}", "\n\n")
    return table(spark, d, "documents").select("doc_id", F.length(text).alias("n_chars"), T.word_count(text).alias("n_words"), F.length(flat).alias("n_chars_collapsed"))


@query(
    """WITH l AS (SELECT doc_id, source, length(coalesce(text, '')) AS n FROM documents), s AS (SELECT source, list_sort(list(n)) AS v FROM l GROUP BY source)
        SELECT source, v[least(len(v), floor(len(v) * 0.1)::INTEGER + 1)] AS p10, v[least(len(v), floor(len(v) * 0.5)::INTEGER + 1)] AS p50, v[least(len(v), floor(len(v) * 0.9)::INTEGER + 1)] AS p90 FROM s"""
)
def length_percentiles(spark, d):
    """Order statistics without interpolation: the element at floor(n * q) of the sorted values."""
    sizes = table(spark, d, "documents").select("source", F.length(T.body(F.col("text"))).alias("size"))
    return order_statistics(sizes, "source", "size", {"p10": 0.1, "p50": 0.5, "p90": 0.9}).drop("n")


@query(
    """SELECT least(greatest(floor(length(coalesce(text, '')) / 500), 0), 9)::INTEGER AS bin, count(*) AS n FROM documents GROUP BY 1"""
)
def length_histogram(spark, d):
    size = F.length(T.body(F.col("text")))
    return table(spark, d, "documents").groupBy(F.least(F.greatest(F.floor(size / 500), F.lit(0)), F.lit(9)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '\\[a-zA-Z]+'))::INTEGER AS n_commands, len(regexp_extract_all(text, '\$'))::INTEGER AS n_dollars FROM documents")
def latex_stats(spark, d):
    text = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.regexp_count(text, F.lit(r"\\[a-zA-Z]+")).alias("n_commands"), F.regexp_count(text, F.lit(r"\$")).alias("n_dollars"))


@query()
def latex_and_case(spark, d):
    """LaTeX counts, and the edit distance of the printable characters of a whole text to their capitals."""
    ship(spark)
    plain = F.regexp_replace("text", r"[^\x20-\x7E]", "")
    return table(spark, d, "documents").select(
        "doc_id", T.count_of(F.col("text"), r"\\[a-zA-Z]+").alias("n_commands"), T.count_of(F.col("text"), r"\$").alias("n_dollars"), edit_distance(plain, F.upper(plain)).alias("case_distance")
    )


@query(
    """WITH c AS (SELECT sha256(coalesce(text, '')) AS content_sha256, doc_id FROM documents), k AS (SELECT *, (row_number() OVER (PARTITION BY content_sha256 ORDER BY doc_id) - 1) // 100 AS piece, count(*) OVER (PARTITION BY content_sha256) AS n FROM c)
        SELECT content_sha256, piece, array_to_string(list_sort(list(doc_id)), ',') AS ids, any_value(n) AS n FROM k WHERE n >= 2 GROUP BY content_sha256, piece"""
)
def content_inventory(spark, d):
    """Documents of the same content, in pieces of 100 ids, smallest first; n is the number of all copies of the content.

    The place of an id is counted within ranges of (content, id), and the ranges' counts are added up, so that a content
    of any number of copies is numbered by several tasks.
    """
    rows = table(spark, d, "documents").select("doc_id", F.sha2(T.body(F.col("text")), 256).alias("content_sha256"))
    several = rows.groupBy("content_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(16)), F.lit(0)).cast("int"))
    salted = several.select("content_sha256", "n", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    ranked, _ = numbered(rows.join(salted, ["content_sha256", "salt"]).drop("salt"), ["content_sha256"], ["doc_id"], "place")
    pieces = ranked.groupBy("content_sha256", F.floor(F.col("place") / 100).cast("long").alias("piece"), "n").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    return pieces.select("content_sha256", "piece", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"), "n")


@query("SELECT content_sha256, doc_id, count(*) OVER (PARTITION BY content_sha256) AS n FROM (SELECT sha256(coalesce(text, '')) AS content_sha256, doc_id FROM documents)")
def content_copies(spark, d):
    """The whole inventory: a row for each document with its content and the number of its copies, however many."""
    rows = table(spark, d, "documents").select("doc_id", F.sha2(T.body(F.col("text")), 256).alias("content_sha256"))
    several = rows.groupBy("content_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # A content of many copies meets its count in several tasks.
    salted = several.select("content_sha256", "n", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    rows = rows.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(16)), F.lit(0)).cast("int"))
    return rows.join(salted, ["content_sha256", "salt"], "left").select("content_sha256", "doc_id", F.coalesce("n", F.lit(1).cast("long")).alias("n"))
