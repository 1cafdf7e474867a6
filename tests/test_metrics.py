"""Metrics of odd texts against the SQL, and their cost."""

import time

import pytest

from loam import plans
from loam.operators import quality
from tests.oracle import assert_same

ODD = [
    None, "", " \t\n\r", "word", "a b c d\x0be\x1cf\n　\ng", "```code``` open ``` left $$x$$ and $$ y", r"\[ a + b \] text \( c \) $$d$$", "one\r\ntwo\r\n\r\nthree. \r\n",
    "See https://x.y/z www.a.b http:// www. wwww.c\nCopyright 2020 All Rights Reserved\n- bullet\n12) item\n1.no item\n* \tstar\n• dot", "한국어 กข अआ  �� ²Ⅻ٤ \U0001d7ce\U00020000 ǅ",
    "Liên hỆ ĐĂNG NHẬP\n" * 6, "\n".join(["same line here"] * 5 + ["12 34", "²³"]), "the cat sat " * 40, "```the cat sat``` " * 40, "À ẤẼ İİ Σσς Kſ", "# - – · ►\n▪ x\n– y\n1) z\n99. q",
]


def test_metrics_of_odd_texts(spark, tmp_path):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(ODD)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("doc_metrics", "doc_quality"):
        assert assert_same(plans.QUERIES[name](spark, str(tmp_path)), plans.SQL[name], str(tmp_path)) == len(ODD)


@pytest.mark.parametrize("lines", [40, 400])
def test_metrics_run_once_and_fast(spark, tmp_path, lines):
    """8 MB of text within seconds, also where a filter looks at a metric."""
    text = "\n".join(f"Line {i} of this text holds some {i * 7919} plain words and ends here." for i in range(lines))
    docs = spark.range(8_000_000 // len(text)).select(quality.F.concat(quality.F.lit(text), quality.F.col("id").cast("string")).alias("text"))
    made = quality.with_metrics(docs).where("m.symbol < 0.5")
    assert made._jdf.queryExecution().optimizedPlan().toString().count("_metrics(") == 1
    spark.range(8).select(quality._metrics(quality.F.lit("warm"))).collect()
    began = time.monotonic()
    assert made.agg(quality.F.sum("m.words")).first()[0] == docs.count() * len(text.split())
    assert time.monotonic() - began < 8
