"""Page repairs on hand-written cases."""

import pytest
from pyspark.sql import functions as F

from loam.operators import repair


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("write to 0387654321 today", ("write to <PHONE> today", 1)),
        ("or 0287 655 431, or +84 387 654 321.", ("or <PHONE>, or <PHONE>.", 2)),
        ("+84387654321 and 84-387654321", ("<PHONE> and <PHONE>", 2)),
        ("1.5 0.25 0.125 0.75 0.5", ("1.5 0.25 0.125 0.75 0.5", 0)),
        ("sums of 84 387 654 321 and 0123", ("sums of 84 387 654 321 and 0123", 0)),
        ("id x0387654321 v1.0387654321", ("id x0387654321 v1.0387654321", 0)),
        ("", ("", 0)),
    ],
)
def test_phones(spark, text, want):
    row = spark.createDataFrame([(text,)], "t string").select(repair.mask_phones(F.col("t")).alias("m"), repair.phone_count(F.col("t")).alias("n")).first()
    assert (row["m"], row["n"]) == want


def test_repeats():
    assert repair.repeats("aaaa b c d e b c d e\nx\nx\nx") == {"char_run": 4, "gram4": 2, "line_run": 3}
    assert repair.repeats("") == {"char_run": 0, "gram4": 0, "line_run": 0}


def test_markdown():
    assert repair.plain_markdown("# Title\n\n**bold** [link](x)\n|a|b|\n|---|---|\n|1|2|") == "Title\nbold link\na | b\n1 | 2"
    assert repair.plain_markdown("<table><tr><td>a</td><td>b</td></tr></table>") == "a | b"


def test_udfs(spark):
    from loam.session import ship

    ship(spark)
    rows = spark.createDataFrame([("x",), (None,)], "t string")
    got = rows.select(repair.repeat_stats("t").alias("r"), repair.markdown_to_plain("t").alias("k")).collect()
    assert [(r["r"]["gram4"], r["k"]) for r in got] == [(0, "x"), (0, "")]
