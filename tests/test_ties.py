"""Ties and roundings that must fall as in the SQL."""

import pandas as pd

from loam import plans
from tests.oracle import assert_same


def test_first_row_of_the_same_number(spark, tmp_path):
    """Two suppliers for the same order and line of a part: the first row of the table counts, and none without a supplier."""
    rows = pd.DataFrame({"l_orderkey": [9, 5, 5, 7, 7, 3], "l_partkey": [1, 1, 1, 2, 2, 2], "l_suppkey": [8, 30, 20, 40, 60, None], "l_linenumber": [1, 2, 2, 1, 1, 1]})
    rows = rows.astype({"l_suppkey": "Int64", "l_linenumber": "int32"})
    rows.to_parquet(f"{tmp_path}/lineitem.parquet")
    pd.DataFrame({"p_partkey": [1, 2, 3], "p_brand": ["a", "b", "c"]}).to_parquet(f"{tmp_path}/part.parquet")
    assert assert_same(plans.QUERIES["smallest_id_join"](spark, str(tmp_path)), plans.SQL["smallest_id_join"], str(tmp_path)) == 3


def test_shares_round_as_in_the_sql(spark, tmp_path):
    """Shares of which the fifth digit is a 5: the scaled double decides, as in the SQL."""
    parts = [(a, total) for total in (160, 800, 2000, 4000) for a in range(11, total // 2, 7)]
    text = ["é" * a + "\n\n" + "b" * (total - a) for a, total in parts]
    pd.DataFrame({"doc_id": range(len(text)), "text": text, "source": "s", "lang": "en"}).to_parquet(f"{tmp_path}/documents.parquet")
    assert assert_same(plans.QUERIES["lang_mix"](spark, str(tmp_path)), plans.SQL["lang_mix"], str(tmp_path)) == len(parts)


def test_mix_of_all_segments(spark, tmp_path):
    """Two languages that alternate, so that every second of 100 segments would show only one."""
    text = "\n\n".join(["les enfants de la ville", "the children of the town"] * 50)
    pd.DataFrame({"doc_id": [1], "text": [text], "source": "s", "lang": "en"}).to_parquet(f"{tmp_path}/documents.parquet")
    assert assert_same(plans.QUERIES["lang_mix"](spark, str(tmp_path)), plans.SQL["lang_mix"], str(tmp_path)) == 1
    row = plans.QUERIES["lang_mix"](spark, str(tmp_path)).first()
    assert row["n_segments"] == 100 and row["mixed"] and row["mix"].count("=") == 2


def test_paragraphs_of_other_spaces_are_blank(spark, tmp_path):
    """The SQL's trim() takes off every space separator: a paragraph of no-break spaces isn't one."""
    text = "les enfants de la ville\nthe children of the town and the house\n\n\u00a0\u3000"
    pd.DataFrame({"doc_id": [1], "text": [text], "source": "s", "lang": "en"}).to_parquet(f"{tmp_path}/documents.parquet")
    assert assert_same(plans.QUERIES["lang_mix"](spark, str(tmp_path)), plans.SQL["lang_mix"], str(tmp_path)) == 1
