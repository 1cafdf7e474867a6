"""Queries over pages and damaged text, page cleaning, packing with prefixes, the second round of deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.functions import glyphs
from loam.functions import text as T
from loam.operators import compare, defects, fingerprints, language, packing, papers, quality, repair, words
from loam.plans.conversations import LINE_CHUNKS, SEGMENTS_SQL, _line_chunks
from loam.plans.documents import _LEX, PROFILE, SCORED_SQL, scored_documents
from loam.plans.registry import query, table
from loam.plans.runtime import Run
from loam.session import materialize, scratch_path, ship
from loam.sources import office, readers

#: Lines of a page where documents stand for extracted files.
PAGE_LINES = 12


def known_words(spark: SparkSession, d: str, least: int = 3, most: int = 20_000) -> frozenset[str]:
    """The most frequent words of at least least documents (by documents, then by word): a list of bounded size."""
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(T.body(F.col("text"))), F.lit(r"([\p{L}]+)"), F.lit(1)))
    words = table(spark, d, "documents").select(F.explode(tokens).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    return frozenset(r["w"] for r in words.where(F.col("df") >= least).orderBy(F.desc("df"), "w").limit(most).collect())


def with_pages(docs: DataFrame, text: str = "text", size: int = PAGE_LINES) -> DataFrame:
    """docs with the lines of a text as an array of pages of size lines."""
    made = docs.withColumn("__l", F.split(T.body(F.col(text)), "\n"))
    made = made.withColumn("__s", F.sequence(F.lit(1), F.size("__l"), F.lit(size)))
    return made.withColumn("pages", F.transform("__s", lambda i: F.array_join(F.slice("__l", i, size), "\n"))).drop("__l", "__s")


@query()
def defect_measures(spark, d):
    """Measures of damage of each document, with the corpus's frequent words as the lexicon."""
    ship(spark)
    words = known_words(spark, d)
    return table(spark, d, "documents").select("doc_id", defects.measures("text", defects.Lexicon(words)).alias("x")).select("doc_id", "x.*")


@query()
def full_quality(spark, d):
    """All metrics and codes in the order of the stage: native metrics, damage, mixed languages, odd words, perplexity."""
    ship(spark)
    docs = quality.with_metrics(table(spark, d, "documents")).withColumn("x", defects.measures("text", defects.Lexicon(known_words(spark, d))))
    docs = docs.withColumn("m", F.struct("m.*", "x.*")).drop("x")
    docs, _ = materialize(docs, "measured")
    mixed = language.mixes(docs, "doc_id", "text", _LEX).select("doc_id", "mixed")
    odd, ppl = _odd_words(docs), unigram_scores(docs)
    docs = docs.join(mixed, "doc_id", "left").join(odd, "doc_id", "left").join(ppl, "doc_id", "left")
    m = F.struct("m.*", F.coalesce("odd_word", F.lit(0.0)).alias("odd_word"), F.col("perplexity"), F.coalesce("mixed", F.lit(False)).alias("mixed"))
    made = quality.scored(docs.withColumn("m", m), F.col("lang"), F.lit(1.0), PROFILE)
    return made.select("doc_id", "quality_score", "quality_band", F.array_join("reason_codes", ",").alias("reason_codes"))


def _odd_words(docs: DataFrame, frequent: int = 200_000) -> DataFrame:
    """(doc_id, odd_word): share of words that fewer than three documents have, for documents of fifty words or more.

    Words of the list of frequent ones are never odd and go in the task; only the others are shuffled.
    """
    tokens = F.regexp_extract_all(T.body(F.col("text")), F.lit(r"([\p{L}]+)"), F.lit(1))
    sizes = docs.groupBy("doc_id").agg(F.sum(F.size(tokens)).alias("n"))
    known = words.surely_common(docs, "doc_id", F.transform(tokens, F.lower), frequent).withColumnRenamed("w", "low")
    w = docs.select("doc_id", F.explode(tokens).alias("word")).withColumn("low", F.lower("word")).join(F.broadcast(known), "low", "left_anti")
    w = w.groupBy("doc_id", "word", "low").agg(F.count(F.lit(1)).alias("k"))
    df = w.select("low", "doc_id").distinct().groupBy("low").agg(F.count(F.lit(1)).alias("df")).where("df < 3")
    odd = w.where(~((F.col("word") == F.upper("word")) & (F.length("word") <= 6))).join(df, "low").groupBy("doc_id").agg(F.sum("k").alias("odd"))
    t = sizes.where("n > 0").join(odd, "doc_id", "left")
    return t.select("doc_id", F.when(F.col("n") >= 50, F.coalesce("odd", F.lit(0)) / F.col("n")).otherwise(0.0).alias("odd_word"))


def unigram_scores(docs: DataFrame, first: int = 512, least: int = 8, frequent: int = 200_000) -> DataFrame:
    """(doc_id, perplexity): exp of the mean negative log-likelihood of the first tokens under the corpus's word counts, which
    stand in for a language model; null under least tokens. The counts of the frequent words go to the tasks, so of a document
    one sum is shuffled, and its other words.
    """
    tokens = T.words(F.lower("text"))
    counts, _ = materialize(docs.select(F.explode(tokens).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")), "counts")
    total = F.broadcast(counts.agg(F.sum("n").alias("total")))
    usual = F.broadcast(counts.where(F.col("n") >= words.least_of_frequent(counts, frequent)))
    head = docs.select("doc_id", F.explode(F.slice(tokens, 1, first)).alias("t"))
    rest = head.join(usual.select("t"), "t", "left_anti").groupBy("doc_id", "t").agg(F.count(F.lit(1)).alias("k")).join(counts, "t")
    each = head.join(usual, "t").select("doc_id", F.lit(1).cast("long").alias("k"), "n").unionByName(rest.select("doc_id", "k", "n")).join(total)
    scored = each.groupBy("doc_id").agg(F.sum("k").alias("k"), F.sum(F.col("k") * -F.ln(F.col("n") / F.col("total"))).alias("loss"))
    return scored.select("doc_id", F.when(F.col("k") >= least, F.exp(F.col("loss") / F.col("k"))).alias("perplexity"))


@query(
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^ \t\n\r]+') AS w FROM documents), c AS (SELECT t, count(*) AS n FROM (SELECT unnest(w) AS t FROM w) GROUP BY t),
        h AS (SELECT doc_id, t, count(*) AS k FROM (SELECT doc_id, unnest(w[1:512]) AS t FROM w) GROUP BY ALL),
        s AS (SELECT doc_id, sum(k) AS k, sum(k * -ln(n / (SELECT sum(n) FROM c))) AS loss FROM h JOIN c USING (t) GROUP BY doc_id)
        SELECT doc_id, round(CASE WHEN k >= 8 THEN exp(loss / k) END, 6) AS perplexity FROM s"""
)
def unigram_perplexity(spark, d):
    return unigram_scores(table(spark, d, "documents")).select("doc_id", F.round("perplexity", 6).alias("perplexity"))


@query()
def page_signal_plan(spark, d):
    """Signals of each page, and whether the page or, from 30 % of its pages on, the whole document is to be read again."""
    ship(spark)
    docs = with_pages(table(spark, d, "documents")).select("doc_id", F.posexplode("pages").alias("page", "t"))
    pages = docs.withColumn("signals", defects.signals("t", defects.Lexicon(known_words(spark, d))))
    # The plan reads the pages twice, so their signals are written once, without the texts.
    pages, _ = materialize(pages.select("doc_id", "page", (F.trim("t") != "").alias("has_text"), "signals"), "signals")
    return page_plan(pages).select("doc_id", "page", F.array_join("signals", ",").alias("signals"), "reason")


def page_plan(pages: DataFrame, share: float = 0.3) -> DataFrame:
    """pages (doc_id, page, has_text, signals) with the reason to read a page again: page, doc or null. One document's
    pages are aggregated and joined back, so a long document is no window."""
    odd = F.col("has_text") & (F.size("signals") > 0)
    docs = pages.groupBy("doc_id").agg(((F.count_if(odd) > 0) & (F.count_if(odd) >= share * F.count_if("has_text"))).alias("whole"))
    return pages.join(docs, "doc_id").withColumn("reason", F.when(odd, "page").when(F.col("whole") & F.col("has_text"), "doc")).drop("whole")


def _papers(spark: SparkSession, d: str) -> DataFrame:
    """Documents as papers: pages of twelve lines, each with a journal's header and its number."""
    docs = with_pages(table(spark, d, "documents"))
    headed = F.transform("pages", lambda x, i: F.concat(F.lit("Journal of "), F.col("source"), F.lit(" Letters and Notes "), (i + 1).cast("string"), F.lit("\n"), x))
    return docs.select("doc_id", F.concat_ws(" ", F.lit("Journal of"), "source").alias("title"), headed.alias("pages"))


@query()
def cleaned_papers(spark, d):
    """The cleaning of paper pages: what each step did, and the digest of what is left."""
    ship(spark)
    rows = _papers(spark, d).select("doc_id", papers.clean("pages", "title").alias("x"))
    return rows.select("doc_id", F.sha2(F.array_join("x.pages", "\f"), 256).alias("pages_sha256"), *[F.col(f"x.{c}") for c in papers.COUNTS])


@query()
def joined_pages(spark, d):
    """Pages joined to paragraphs, without repeated edge lines and bare numbers."""
    ship(spark)
    rows = _papers(spark, d).select("doc_id", papers.join_pages("pages").alias("x"))
    return rows.select("doc_id", F.sha2("x.text", 256).alias("text_sha256"), F.size(F.split("x.text", "\n\n")).alias("n_paragraphs"), "x.lines_removed")


@query()
def main_content(spark, d):
    """The main content of web pages beside all of their visible text."""
    ship(spark)
    rows = table(spark, d, "pages").select("page_id", office.page_content("html").alias("t"))
    return rows.select("page_id", F.sha2(T.body(F.col("t")), 256).alias("text_sha256"), F.length("t").alias("n_chars"))


@query(
    rf"""SELECT doc_id, sha256(translate(body, '{glyphs.TCVN3}', '{glyphs.TCVN3_LETTERS}')) AS tcvn3_sha256, n > 0 AND len(regexp_extract_all(body, '[{glyphs.TCVN3_MARKERS}]')) >= 0.05 * n AS is_tcvn3,
        length(regexp_replace(body, '[\x{{F020}}-\x{{F0FE}}]', '', 'g'))::INTEGER AS n_plain FROM (SELECT doc_id, body, len(regexp_extract_all(body, '\p{{L}}')) AS n FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents))"""
)
def legacy_fonts(spark, d):
    """Texts read as a legacy font's, whether they are such, and their length without Symbol characters."""
    text = T.body(F.col("text"))
    return table(spark, d, "documents").select(
        "doc_id", F.sha2(glyphs.from_tcvn3(text), 256).alias("tcvn3_sha256"), glyphs.is_tcvn3(text).alias("is_tcvn3"), F.length(F.regexp_replace(text, r"[\x{F020}-\x{F0FE}]", "")).alias("n_plain")
    )


@query()
def output_guards(spark, d):
    """Reasons against each document as a page's output, in their order; the first is the reason."""
    ship(spark)
    rows = table(spark, d, "documents").select("doc_id", compare.guarded("text", "text", F.when(F.pmod("doc_id", F.lit(17)) == 0, "length").otherwise("stop")).alias("r"))
    return rows.select("doc_id", F.get("r", F.lit(0)).alias("reason"), F.array_join("r", ",").alias("reasons"))


@query()
def edit_reports(spark, d):
    """Labelled documents against a cleaned version: how alike they are, what kind of edit it is, where it begins."""
    ship(spark)
    line = F.get(F.split(T.body(F.col("text")), "\n"), F.lit(0))
    rows = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id").distinct(), "doc_id")
    return rows.select("doc_id", compare.compared(line, T.mask_email(F.regexp_replace(line, r"^\s*\S+\s+", ""))).alias("x")).select("doc_id", F.round("x.similarity", 6).alias("similarity"), "x.kind", "x.excerpt")


@query()
def plain_outputs(spark, d):
    """Markdown and HTML tables of web pages as plain lines."""
    ship(spark)
    rows = table(spark, d, "pages").select("page_id", repair.markdown_to_plain("html").alias("t"))
    return rows.select("page_id", F.sha2("t", 256).alias("text_sha256"), F.size(F.split("t", "\n")).alias("n_lines"))


# Packing

#: Tokens of a sequence and of a prefix where documents' lines are packed.
_SEQ, _PREFIX = 256, 6


@query(
    f"""WITH RECURSIVE {SEGMENTS_SQL}, k AS (SELECT s.doc_id, s.first_index, s.break_reason = 'doc_end' AS doc_end, list(c.n ORDER BY c.idx) AS counts FROM sg s JOIN ks c ON c.doc_id = s.doc_id AND c.idx BETWEEN s.first_index AND s.last_index GROUP BY ALL),
        w AS (SELECT doc_id, first_index, doc_end, counts, 1 AS i, 0::BIGINT AS piece, 1 AS start, counts[1]::BIGINT AS tokens FROM k
              UNION ALL SELECT doc_id, first_index, doc_end, counts, i + 1,
                CASE WHEN tokens + counts[i + 1] + 1 + (doc_end AND i + 1 = len(counts))::INTEGER > {_SEQ - _PREFIX} THEN piece + 1 ELSE piece END,
                CASE WHEN tokens + counts[i + 1] + 1 + (doc_end AND i + 1 = len(counts))::INTEGER > {_SEQ - _PREFIX} THEN i + 1 ELSE start END,
                CASE WHEN tokens + counts[i + 1] + 1 + (doc_end AND i + 1 = len(counts))::INTEGER > {_SEQ - _PREFIX} THEN counts[i + 1] ELSE tokens + counts[i + 1] + 1 END
                FROM w WHERE i < len(counts)),
        p AS (SELECT doc_id, first_index, piece, min(start) - 1 AS first, max(i) AS "end", max_by(tokens, i) AS tokens, bool_or(doc_end AND i = len(counts)) AS eos FROM w GROUP BY doc_id, first_index, piece)
        SELECT doc_id, first_index, piece, first, "end", tokens, eos, tokens + {_PREFIX} + eos::INTEGER AS cost, tokens + {_PREFIX} + eos::INTEGER > {_SEQ} AS oversize FROM p"""
)
def segment_pieces(spark, d):
    """Segments of kept lines as pieces that fit a sequence with a prefix; the last one of a document has an end token."""
    return _segment_pieces(spark, d).select("doc_id", "first_index", F.col("piece").cast("long").alias("piece"), "first", "end", "tokens", "eos", "cost", "oversize")


def _segment_pieces(spark: SparkSession, d: str) -> DataFrame:
    rows = _line_chunks(spark, d)
    segments = packing.segments(rows, "doc_id", "idx", F.col("keep"), "t", "n").select("doc_id", "first_index", "last_index", "break_reason")
    own = rows.where("keep").join(segments, "doc_id").where(F.col("idx").between(F.col("first_index"), F.col("last_index")))
    counts = F.transform(F.array_sort(F.collect_list(F.struct("idx", "n"))), lambda x: x["n"])
    segments = own.groupBy("doc_id", "first_index", "break_reason").agg(counts.alias("counts"))
    return packing.split_segments(segments, "counts", F.col("break_reason") == "doc_end", _SEQ, _PREFIX)


@query()
def packed_pieces(spark, d):
    """The pieces packed into sequences by their cost; one row for each sequence, with its fill."""
    pieces = _segment_pieces(spark, d).select(F.concat_ws(":", "doc_id", "first_index", "piece").alias("key"), "cost")
    packed = packing.pack(pieces, "key", "cost", seq_len=_SEQ, buffer_tokens=100_000)
    return packed.groupBy("buffer", "sequence").agg(F.count(F.lit(1)).alias("pieces"), F.sum("cost").alias("used")).withColumn("fill", F.col("used") / _SEQ)


@query(
    f"""WITH {LINE_CHUNKS}, pl AS (SELECT doc_id, sum(n) FILTER (keep) AS kept, sum(n) AS all_tokens, count(*) AS chunks, count(*) FILTER (keep) AS kept_chunks FROM ks GROUP BY doc_id)
        SELECT count(*) AS docs, count(*) FILTER (chunks > 1) AS split, sum(chunks)::BIGINT AS chunks, sum(kept_chunks)::BIGINT AS kept_chunks, sum(all_tokens)::BIGINT AS tokens, coalesce(sum(kept), 0)::BIGINT AS kept_tokens FROM pl"""
)
def line_chunk_stats(spark, d):
    """How many documents were cut, how many chunks there are and how many stay."""
    by = _line_chunks(spark, d).groupBy("doc_id").agg(
        F.sum(F.when(F.col("keep"), F.col("n")).otherwise(0)).alias("kept"), F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("chunks"), F.count_if("keep").alias("kept_chunks")
    )
    return by.agg(
        F.count(F.lit(1)).alias("docs"), F.count_if(F.col("chunks") > 1).alias("split"), F.sum("chunks").alias("chunks"), F.sum("kept_chunks").alias("kept_chunks"), F.sum("tokens").alias("tokens"), F.sum("kept").alias("kept_tokens")
    )


# Round two


def _fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Two runs over the documents; the later one has dropped some, and sources have priorities and rights."""
    docs = table(spark, d, "documents").where("doc_id IS NOT NULL")
    number = F.coalesce(F.regexp_extract("source", r"(\d+)$", 1).try_cast("int"), F.lit(0))
    i = F.col("doc_id")
    made = lambda run, alive, at: fingerprints.of_documents(
        docs, "text", F.when(number < 15, "cpt").otherwise("sft"), F.col("source"), F.pmod(i, F.lit(100)).cast("double"), F.pmod(number, F.lit(4)), F.when(number == 2, "unknown").otherwise("open"), alive, F.lit(at)
    ).withColumn("run", F.lit(run))
    return made("a", F.lit(True), "2024-01-01 00:00:00").unionByName(made("b", F.pmod(i, F.lit(29)) != 0, "2024-02-01 00:00:00").where(F.pmod(i, F.lit(2)) == 0))


@query()
def global_verdict(spark, d):
    """The verdict of a second round over the fingerprints of two runs: latest rows, tombstones, rights, families."""
    return fingerprints.verdict(_fingerprints(spark, d), enforce=("open",))


@query()
def global_stats(spark, d):
    """Numbers of the second round for each group."""
    return fingerprints.stats(global_verdict(spark, d))


# Records


@query(
    r"""WITH p AS (SELECT source, doc_id, text, doc_id % 6 AS k FROM documents), c AS (SELECT source, min(doc_id) AS id, count(*) AS pages, count(*) FILTER (k = 0) AS needs_ocr, string_agg(CASE WHEN k = 0 THEN '' ELSE coalesce(text, '') END, chr(10) ORDER BY doc_id) AS body FROM p GROUP BY source)
        SELECT source AS stem, id AS doc_id, pages, needs_ocr, sha256(body) AS text_sha256, 'title of ' || source AS title, source <> 'src5' AS matched FROM c LEFT JOIN (SELECT DISTINCT source AS s FROM documents) ON s = source"""
)
def checkpoint_records(spark, d):
    """Extraction checkpoints (a source stands for a file, its documents for pages) as records with their metadata: pages that
    need recognition stay as empty ones, so that page numbers hold; files without metadata are kept and marked."""
    pages = table(spark, d, "documents").select("source", "doc_id", T.body(F.col("text")).alias("text"), F.when(F.pmod("doc_id", F.lit(6)) == 0, "needs_ocr").otherwise("layer").alias("method"))
    meta = table(spark, d, "documents").where("source <> 'src5'").select(F.col("source").alias("stem"), F.concat(F.lit("title of "), F.col("source")).alias("title")).distinct()
    made = readers.checkpoint_records(pages.withColumnRenamed("source", "stem"), "stem", "doc_id", "text", "method", meta)
    return made.select("stem", "doc_id", "pages", "needs_ocr", F.sha2("text", 256).alias("text_sha256"), F.coalesce("title", F.concat(F.lit("title of "), F.col("stem"))).alias("title"), "matched")


@query(
    f"""WITH {SCORED_SQL} SELECT 'band' AS kind, band AS key, count(*) AS n FROM q GROUP BY band UNION ALL SELECT 'source', source, count(*) FROM q GROUP BY source
        UNION ALL SELECT 'length', least(floor(words / 100), 20)::INTEGER::VARCHAR, count(*) FROM q GROUP BY 2 UNION ALL SELECT 'code', code, count(*) FROM (SELECT unnest(codes) AS code FROM q) GROUP BY code"""
)
def report_rows(spark, d):
    """What the report shows: counts of bands, sources, lengths and codes."""
    rows = scored_documents(spark, d).select("source", "quality_band", "reason_codes", F.least(F.floor(F.col("m.words") / 100), F.lit(20)).cast("int").cast("string").alias("length"))
    each = F.concat(
        F.array(F.struct(F.lit("band").alias("kind"), F.col("quality_band").alias("key")), F.struct(F.lit("source").alias("kind"), F.col("source").alias("key")), F.struct(F.lit("length").alias("kind"), F.col("length").alias("key"))),
        F.transform("reason_codes", lambda c: F.struct(F.lit("code").alias("kind"), c.alias("key"))),
    )
    return rows.select(F.explode(each).alias("x")).groupBy("x.kind", "x.key").agg(F.count(F.lit(1)).alias("n"))


@query(
    r"""WITH kw AS (SELECT w FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}]+')) AS w FROM documents) GROUP BY w HAVING count(*) >= 3),
        pg AS (SELECT doc_id, source AS book, lang, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}]+') AS ws FROM documents),
        pk AS (SELECT doc_id, count(*) FILTER (w IN (SELECT w FROM kw)) AS known FROM (SELECT doc_id, unnest(ws) AS w FROM pg) GROUP BY doc_id),
        bl AS (SELECT book, lang, count(*) AS n, sum(count(*)) OVER (PARTITION BY book) AS total FROM pg GROUP BY book, lang),
        mn AS (SELECT book, lang AS main FROM bl WHERE n >= 0.8 * total AND lang IS NOT NULL)
        SELECT pg.doc_id, CASE WHEN len(ws) >= 20 AND coalesce(known, 0) < 0.5 * len(ws) THEN 'few_known_words' WHEN main IS NOT NULL AND coalesce(lang, '') <> main THEN 'foreign_page' END AS reason
        FROM pg LEFT JOIN pk USING (doc_id) LEFT JOIN mn USING (book)"""
)
def book_filter(spark, d):
    """Pages (documents) that a book (source) would lose: few known words, or another language where four fifths of the book
    have one. The text isn't touched, so the plan can be made anew from it."""
    words = F.regexp_extract_all(F.lower(T.body(F.col("text"))), F.lit(r"([\p{L}]+)"), F.lit(1))
    pages = table(spark, d, "documents").select("doc_id", F.col("source").alias("book"), "lang", words.alias("ws"))
    used = pages.select("doc_id", F.explode("ws").alias("w")).groupBy("doc_id", "w").agg(F.count(F.lit(1)).alias("k"))
    known = used.groupBy("w").agg(F.count(F.lit(1)).alias("df")).where("df >= 3").select("w")
    share = used.join(known, "w").groupBy("doc_id").agg(F.sum("k").alias("known"))
    langs = pages.groupBy("book", "lang").agg(F.count(F.lit(1)).alias("n"))
    main = langs.groupBy("book").agg(F.max_by("lang", "n").alias("main"), F.max("n").alias("most"), F.sum("n").alias("total")).where("most >= 0.8 * total AND main IS NOT NULL").select("book", "main")
    rows = pages.select("doc_id", "book", "lang", F.size("ws").alias("n")).join(share, "doc_id", "left").join(main, "book", "left")
    few = (F.col("n") >= 20) & (F.coalesce("known", F.lit(0)) < 0.5 * F.col("n"))
    return rows.select("doc_id", F.when(few, "few_known_words").when(F.col("main").isNotNull() & (F.coalesce("lang", F.lit("")) != F.col("main")), "foreign_page").alias("reason"))


@query(
    f"""WITH {SCORED_SQL} SELECT 'ingest' AS stage, count(*) AS n_rows, false AS reused FROM q UNION ALL SELECT 'quality', count(*), false FROM q UNION ALL SELECT 'kept', count(*), false FROM q WHERE band <> 'D'
        UNION ALL SELECT 'again', count(*), true FROM q WHERE band <> 'D'"""
)
def stage_manifest(spark, d):
    """A run of stages into the scratch folder, and the same run again, which reads everything back."""
    run = Run(spark, scratch_path(spark, "run"))
    run.add("ingest", lambda df: df)
    run.add("quality", lambda df: quality.scored(quality.with_metrics(df), F.col("lang"), F.lit(1.0), PROFILE).drop("m"))
    run.add("kept", lambda df, bands: df.where(F.col("quality_band").isin(*bands)), bands=["A", "B", "C"])
    source, out = table(spark, d, "documents"), None
    for last in ("ingest", "quality", "kept"):
        rows, done = run.execute(source, "documents", until=last)
        one = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(last).alias("stage"), "n_rows", F.lit(done[-1]["reused"]).alias("reused"))
        out = one if out is None else out.unionByName(one)
    rows, done = run.execute(source, "documents")
    return out.unionByName(rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("again").alias("stage"), "n_rows", F.lit(all(x["reused"] for x in done)).alias("reused")))
