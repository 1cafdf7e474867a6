"""Measures over whole texts against brute force, on texts that differ only behind the usual prefixes."""

import random

from loam.functions.edit import distance
from loam.plans import QUERIES


def _brute_force(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _folder(spark, tmp_path, texts: dict[int, str | None]) -> str:
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_distance_matches_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcđ") for _ in range(rng.randint(0, 90))) for _ in range(2))
        assert distance(a, b) == _brute_force(a, b)


def test_bootstrap_sees_whole_texts(spark, tmp_path):
    text = "X1 " * 100 + "lower case " * 30
    folder = _folder(spark, tmp_path, {i: text for i in range(1, 60) if i % 7})
    row = QUERIES["bootstrap_interval"](spark, folder).first()
    delta = -_brute_force(text.upper()[: len(text) * 280 // 300], text) / len(text)
    assert row["resamples"] == 2000
    assert abs(row["low"] - delta) < 1e-9 and abs(row["high"] - delta) < 1e-9


def test_case_distance_sees_whole_texts(spark, tmp_path):
    texts = {1: "A1 " * 80 + "then lower case", 2: "lower first " * 20 + "THEN CAPITALS " * 9, 3: None, 4: "", 5: "đường " * 50}
    got = {r["doc_id"]: r["case_distance"] for r in QUERIES["latex_and_case"](spark, _folder(spark, tmp_path, texts)).collect()}
    plain = {i: None if t is None else "".join(c for c in t if " " <= c <= "~") for i, t in texts.items()}
    assert got == {i: None if t is None else _brute_force(t, t.upper()) for i, t in plain.items()}


def test_inventory_keeps_contents_of_many_copies(spark, tmp_path):
    texts = {i: "hot" for i in range(60)} | {i: "pair" for i in range(60, 62)} | {62: "single", 63: None}
    got = {r["doc_id"]: r["n"] for r in QUERIES["content_copies"](spark, _folder(spark, tmp_path, texts)).collect()}
    assert got == {i: 60 if i < 60 else 2 if i < 62 else 1 for i in texts}


def test_funnel_counts_repeated_and_missing_ids(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"word{i} of some prose" for i in range(40)) + "."
    rows = [(i, f"{long} {i}", "en", "s", 1) for i in (1, 1, 2, 2, 3, 3, 4, 4, 5, 5)] + [(None, f"{long} none {i}", "en", "s", 1) for i in range(5)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["doc_funnel"](spark, str(tmp_path)).first()
    assert (got["n_in"], got["kept"], got["rejected_duplicate"]) == (15, 15, 0)


def test_inventory_numbers_all_copies(spark, tmp_path):
    texts = {i: "hot" for i in range(250)} | {i: "pair" for i in range(250, 252)} | {252: "single", 253: None}
    got = QUERIES["content_inventory"](spark, _folder(spark, tmp_path, texts)).collect()
    ids = {n: sorted(int(x) for r in got if r["n"] == n for x in r["ids"].split(",")) for n in (2, 250)}
    assert ids == {2: [250, 251], 250: list(range(250))} and all(len(r["ids"].split(",")) <= 100 for r in got)


def test_word_distance():
    from loam.functions.edit import word_codes

    rng = random.Random(4)
    for _ in range(100):
        a, b = ([rng.choice("one two three four five".split()) for _ in range(rng.randint(0, 20))] for _ in range(2))
        assert distance(*word_codes(" ".join(a), " ".join(b))) == _brute_force(a, b)


def _outputs(page: int, text: str) -> dict[str, str | None]:
    """The stand-in engines' outputs, as the queries describe them."""
    upper = "".join(c.upper() if "a" <= c <= "z" else c for c in text)
    gamma = f"{text[:60]} " * 8 if page % 13 == 0 else text[: len(text) * (15 if page % 5 == 0 else 29) // 30] + " end"
    return {"alpha": text, "beta": None if page % 7 == 0 else upper[: len(text) * 28 // 30], "gamma": gamma}


def test_error_rates_of_whole_texts(spark, tmp_path):
    rng = random.Random(6)
    texts = {i: " ".join(rng.choice(["alpha", "bravo", "Charlie", "đêm", "x1"]) for _ in range(rng.randint(0, 90))) for i in range(1, 28)}
    got = {r["engine"]: r for r in QUERIES["engine_error_rates"](spark, _folder(spark, tmp_path, texts)).collect()}
    for engine in ("alpha", "beta", "gamma"):
        made = {i: _outputs(i, t)[engine] or "" for i, t in texts.items()}
        assert got[engine]["dist"] == sum(min(_brute_force(made[i], t), len(t)) for i, t in texts.items())
        assert got[engine]["word_dist"] == sum(min(_brute_force(made[i].split(), t.split()), len(t.split())) for i, t in texts.items())
        assert got[engine]["n"] == sum(map(len, texts.values()))
