"""Codes of the whole quality stage on planted texts, and the same scores where none of the added rules applies."""

import pytest

from loam.plans import QUERIES

CLEAN = " ".join(f"sentence number {w} tells a different plain story about the {w} house and its garden." for w in "red blue green grey white black brown pink".split())
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def codes(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("quality"))
    entry = "[{0}] Nguyen V.A., Some long title of a work, Journal of Things, {1}, pp. 1-{0}"
    texts = {
        1: CLEAN,
        2: CLEAN + " " + "hoàá quảáng thàánh " * 10,
        3: CLEAN + " đ-ợc ng-ời tr-ờng",
        4: "cua nhung duoc khong nguoi nhieu mot voi " * 2 + " ".join(f"đường{chr(97 + i % 26)} nhà{chr(97 + i // 2)}" for i in range(40)),
        5: "\n".join(entry.format(i, 2000 + i) for i in range(1, 12)),
        6: " ".join(f"zq{chr(97 + i % 26)}x{chr(97 + i // 26)}v" for i in range(60)),
        7: None,
        8: "",
    }
    # The words of the other texts are common, as several documents have them.
    texts |= {100 + 10 * k + i: f"{texts[i]} copy {k}" for k in range(1, 4) for i in (1, 2, 3, 4, 5)}
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    whole = {r["doc_id"]: r for r in QUERIES["full_quality"](spark, folder).collect()}
    plain = {r["doc_id"]: r for r in QUERIES["doc_quality"](spark, folder).collect()}
    return whole, plain


@pytest.mark.parametrize(("doc", "code"), [(2, "garbled_font"), (3, "lost_letters"), (4, "lost_diacritics"), (5, "reference_list")])
def test_planted_damage_gets_its_code(codes, doc, code):
    whole, plain = codes
    assert code in whole[doc]["reason_codes"].split(",") and code not in plain[doc]["reason_codes"].split(",")
    assert code == "reference_list" or whole[doc]["quality_band"] == "D"


def test_clean_and_empty_texts_keep_their_scores(codes):
    whole, plain = codes
    for doc in (1, 7, 8):
        added = {"high_perplexity", "mixed_language"}
        assert [c for c in whole[doc]["reason_codes"].split(",") if c not in added] == plain[doc]["reason_codes"].split(",")
    assert whole[7]["quality_score"] == 0.0 and whole[7]["reason_codes"] == "empty" and len(whole) == len(plain) == 23


def test_rules_of_odd_words_are_the_profile_s(codes):
    whole, _ = codes
    assert "odd_words" not in whole[6]["reason_codes"]
