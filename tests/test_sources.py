"""Web pages and office files that are made here, records of checkpoints, lists of files, numbered rows, reports."""

import io
import zipfile

from pyspark.sql import functions as F

from loam.operators.order import numbered
from loam.sources import office, readers

PAGE = """<html><head><title>t</title><style>p {}</style></head><body><nav><a href=x>Home</a> <a>About us and more of us</a></nav>
<h2>The heading</h2><p>This first paragraph is long enough to be content of its own.</p><p>Short one.</p>
<div><a>link one</a><a>link two that is rather long but only a link in the end</a></div><p>Another paragraph, long enough to be taken as content too.</p>
<footer>All rights reserved by the makers of this long footer text.</footer><script>var x = 1;</script></body></html>"""


def _archive(files: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, body in files.items():
            archive.writestr(name, body)
    return out.getvalue()


W = 'xmlns:w="w"'
DOCX = {"word/document.xml": f"<w:document {W}><w:body><w:p><w:r><w:t>One</w:t><w:tab/><w:t>two</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p><w:r><w:t>End</w:t></w:r></w:p></w:body></w:document>"}
A = 'xmlns:a="a"'
PPTX = {"ppt/presentation.xml": "<x/>", "ppt/slides/slide2.xml": f"<s {A}><a:p><a:r><a:t>Second</a:t></a:r></a:p></s>", "ppt/slides/slide1.xml": f"<s {A}><a:p><a:r><a:t>First</a:t></a:r></a:p></s>", "ppt/slides/_rels/slide1.xml.rels": '<r Target="../notesSlides/notesSlide1.xml"/>', "ppt/notesSlides/notesSlide1.xml": f"<s {A}><a:p><a:r><a:t>a note</a:t></a:r></a:p><a:p><a:r><a:t>1</a:t></a:r></a:p></s>"}
EPUB = {"mimetype": "application/epub+zip", "META-INF/container.xml": '<c><rootfile full-path="o/p.opf"/></c>', "o/p.opf": '<p><item id="a" href="a.html"/><item id="b" href="b.html"/><itemref idref="b"/><itemref idref="a"/></p>', "o/a.html": "<p>Chapter A</p>", "o/b.html": "<p>Chapter B</p>"}


def test_main_content():
    assert office.main_content(PAGE) == "The heading\nThis first paragraph is long enough to be content of its own.\nShort one.\nAnother paragraph, long enough to be taken as content too."
    assert "All rights" in office.all_text(PAGE) and "var x" not in office.all_text(PAGE)
    assert office.main_content("<p>tiny</p>") == "tiny" and office.main_content(None) == "" and office.main_content("<nav><a>x</a></nav>") == "x"
    assert office.main_content(f"<article><p>Only the article's own paragraph is kept here.</p></article>{PAGE}").startswith("Only the article")


def test_office_files():
    assert office.docx_text(_archive(DOCX)) == "One\ttwo\na | b\nEnd"
    assert office.pptx_slides(_archive(PPTX)) == ["First\na note", "Second"]
    assert office.epub_text(_archive(EPUB)) == "Chapter B\n\nChapter A"
    assert [office.zip_kind(_archive(x)) for x in (DOCX, PPTX, EPUB, {"a": "b"})] == ["docx", "pptx", "epub", "zip"]
    assert office.zip_kind(b"no zip") is None and office.zip_kind(None) is None
    assert office.text_of(b"broken", "docx") is None and office.text_of(None, "txt") == "" and office.text_of(b"x", "pdf") is None


def test_files(spark, tmp_path):
    from loam.session import ship

    ship(spark)
    (tmp_path / "a.docx").write_bytes(_archive(DOCX))
    (tmp_path / ".cache").mkdir()
    (tmp_path / "b.txt").write_text("plain")
    rows = readers.files(spark, str(tmp_path)).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in rows] == ["a.docx", "b.txt"] and readers.files(spark, str(tmp_path), most=1).count() == 1
    read = spark.read.format("binaryFile").load(str(tmp_path)).select(office.file_text("content", F.regexp_extract("path", r"([a-z]+)$", 1)).alias("t"))
    assert {r["t"] for r in read.collect()} == {"One\ttwo\na | b\nEnd", "plain"}


def test_checkpoints(spark):
    pages = spark.createDataFrame([("a", 1, "x", "layer"), ("a", 2, "lost", "needs_ocr"), ("a", 3, None, "ocr"), ("b", 1, "y", "needs_ocr")], "stem string, page long, text string, method string")
    meta = spark.createDataFrame([("a", "T")], "stem string, title string")
    got = {r["stem"]: (r["pages"], r["needs_ocr"], r["text"], r["title"], r["matched"]) for r in readers.checkpoint_records(pages, "stem", "page", "text", "method", meta).collect()}
    assert got == {"a": (3, 1, "x\n\n", "T", True), "b": (1, 1, "", None, False)}


def test_capped_sample(spark):
    rows = spark.range(1000).withColumn("file", F.pmod("id", F.lit(4)))
    got = readers.capped_sample(rows, 30, F.col("file"), F.col("id"), per_file=10)
    assert got.count() == 30 and got.groupBy("file").count().where("count > 10").count() == 0 and got.columns == ["id", "file"]


def test_numbered_rows_of_a_hot_group(spark):
    rows = spark.range(2000).select(F.when(F.col("id") < 1900, 0).otherwise(F.col("id") % 5).alias("g"), F.col("id").alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None, 7), (None, None)], "g long, v long"))
    got = [(r["g"], r["v"], r["n"]) for r in numbered(rows, ["g"], ["v"], "n")[0].collect()]
    for g in {x[0] for x in got}:
        mine = sorted(((v is not None, v or 0), n) for h, v, n in got if h == g)
        assert [n for _, n in mine] == list(range(len(mine)))


def test_report_rows_are_written(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "n long, t string")
    readers.write_report_rows(rows, f"{tmp_path}/c", "csv")
    readers.write_report_rows(rows, f"{tmp_path}/j", "json")
    assert spark.read.option("header", "true").csv(f"{tmp_path}/c").first()["t"] == "a" and spark.read.json(f"{tmp_path}/j").first()["n"] == 1


def test_html_report(spark):
    from loam.plans import html

    rows = spark.createDataFrame([("band", "A", 3), ("band", "A", 2), ("band", "<b>", 1), ("source", None, 4)], "kind string, key string, n long")
    points = spark.createDataFrame([(0.0, 1.0, "a & b"), (2.0, None, "no")], "x double, y double, hint string")
    page = html.report(rows, points, "T")
    assert page.count("<rect") == 3 and ">5<" in page and "&lt;b&gt;" in page and "<b>" not in page and page.count("<circle") == 1 and "a &amp; b" in page
    assert html.bars("x", [(str(i), i) for i in range(50)]).count("<rect") == html.MOST_BARS + 1 and html.report(rows.limit(0)).count("<svg") == 0
