"""Heuristic language identification by letters and stop words, and mixes over the segments of a text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions import text as T


@dataclass(frozen=True)
class Lexicon:
    """Stop words of the target and of the other language; letters that tell the target."""

    target: str = "vi"
    other: str = "en"
    letters: str = T.VI_LETTERS
    min_letters: float = 0.08
    target_words: tuple[str, ...] = ("và", "của", "là", "các", "có", "trong", "được", "cho", "với", "không")
    other_words: tuple[str, ...] = ("the", "of", "and", "to", "in", "is", "that", "for", "with", "are")
    min_share: float = 0.05


def heuristic(text: Column, lexicon: Lexicon = Lexicon()) -> Column:
    """target (by its letters or by its words), other, "other" or und, from whole texts."""
    tokens = F.regexp_extract_all(F.lower(T.body(text)), F.lit(r"([\p{L}]+)"), F.lit(1))
    return T.let(tokens, lambda x: _judged(text, x, lexicon))


def _judged(text: Column, tokens: Column, lexicon: Lexicon) -> Column:
    share = lambda words: T.ratio(F.size(F.filter(tokens, lambda w: w.isin(*words))), F.size(tokens))
    return (
        F.when(F.size(tokens) == 0, "und")
        .when((T.diacritic_share(text, lexicon.letters) >= lexicon.min_letters) | (share(lexicon.target_words) >= lexicon.min_share), lexicon.target)
        .when(share(lexicon.other_words) >= lexicon.min_share, lexicon.other)
        .otherwise("other")
    )


def segments(text: Column, most: int | None = None) -> Column:
    """Paragraphs, or lines where there is one paragraph at most, with ten letters at least (all worded ones if none has);
    all of them, or most of them evenly picked."""
    def chosen(worded: Column) -> Column:
        long = F.filter(worded, lambda x: T.letters(x) >= 10)
        some = F.when(F.size(long) > 0, long).otherwise(worded)
        return some if most is None else T.let(some, picked)

    def picked(x: Column) -> Column:
        step = F.size(x) / F.lit(most)
        even = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.element_at(x, F.floor(i * step).cast("int") + 1))
        return F.when(F.size(x) > most, even).otherwise(x)

    paragraphs = F.filter(F.split(T.body(text), r"\n\n+"), lambda x: F.trim(x, F.lit(T.SPACES)) != "")
    parts = T.let(paragraphs, lambda p: F.when(F.size(p) > 1, p).otherwise(F.split(T.body(text), "\n")))
    return T.let(F.filter(F.transform(parts, lambda x: F.trim(x, F.lit(T.SPACES))), lambda x: T.letters(x) > 0), chosen)


def mixes(docs: DataFrame, id_col: str, text_col: str, lexicon: Lexicon = Lexicon(), most: int | None = None) -> DataFrame:
    """(id, language, mix as "label=share" strings, n_segments, mixed): segments weighted by their letters.

    The heaviest label wins, the larger label on ties; a document without segments is und; mixed says that the second
    share is 0.2 or more. most limits the segments of a document.
    """
    parts = docs.select(F.col(id_col).alias("id"), F.explode_outer(segments(F.col(text_col), most)).alias("seg"))
    parts = parts.withColumn("label", F.when(F.col("seg").isNull(), "und").otherwise(heuristic(F.col("seg"), lexicon)))
    parts = parts.withColumn("weight", F.when(F.col("seg").isNull(), 0).otherwise(T.letters(F.col("seg"))))
    by = parts.groupBy("id", "label").agg(F.sum("weight").alias("w"), F.count("seg").alias("n"))
    docs_ = by.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("w", "label"))).alias("all"), F.sum("n").alias("n_segments"), F.sum("w").alias("total"))
    best = F.element_at("all", -1)
    share = lambda x: T.rounded(x["w"] / F.greatest(F.col("total"), F.lit(1)), 4)
    second = F.when(F.size("all") > 1, share(F.try_element_at("all", F.lit(-2)))).otherwise(F.lit(0.0))
    mix = F.array_join(F.transform(F.array_sort(F.transform("all", lambda x: F.struct(x["label"].alias("label"), share(x).alias("s")))), lambda x: F.concat_ws("=", x["label"], F.format_number(x["s"], 4))), ",")
    return docs_.select(F.col("id").alias(id_col), best["label"].alias("language"), mix.alias("mix"), "n_segments", (second >= 0.2).alias("mixed"))
