"""Text measures and edits as Column expressions; nothing here leaves the JVM.

Regular expressions name Unicode classes explicitly, so that they mean the same to other engines. Null text counts as
empty. Ratios divide by one at least.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\s]+"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
#: Vietnamese letters that no unaccented Latin text has.
VI_LETTERS = "ăâđêôơưàáảãạằắẳẵặầấẩẫậèéẻẽẹềếểễệìíỉĩịòóỏõọồốổỗộờớởỡợùúủũụừứửữựỳýỷỹỵ"
#: Vietnamese letters with their base letters in the same places.
MARKED = "ăâđêôơưàáảãạằắẳẵặầấẩẫậèéẻẽẹềếểễệìíỉĩịòóỏõọồốổỗộờớởỡợùúủũụừứửữựỳýỷỹỵ"
BARE = "aadeoouaaaaaaaaaaaaaaaeeeeeeeeeeiiiiiooooooooooooooouuuuuuuuuuyyyyy"
#: The space separators of Unicode, which the SQL's trim() takes off.
SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def let(value: Column, use) -> Column:
    """use(value) with the value computed once: inside a lambda an expression would be computed for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def body(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(body(text), F.lit(pattern))


def words(text: Column) -> Column:
    """Runs of characters other than blanks, tabs and line ends."""
    return F.regexp_extract_all(body(text), F.lit(r"([^ \t\n\r]+)"), F.lit(1))


def chars_of(text: Column, kind: str) -> Column:
    """How many characters belong to a class, given as the inside of brackets; the others are cut out, nothing is listed."""
    return F.length(F.regexp_replace(body(text), f"[^{kind}]+", ""))


def word_count(text: Column) -> Column:
    return count_of(text, r"[^ \t\n\r]+")


def lines(text: Column) -> Column:
    """Non-blank lines, trimmed."""
    return F.filter(F.transform(F.split(body(text), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def ratio(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def rounded(value: Column, places: int) -> Column:
    """The scaled double, not its decimal digits, to the nearest whole number (halves up), scaled back; for values from 0."""
    scale = float(10**places)
    return let(value * scale, lambda x: (F.floor(x) + (x - F.floor(x) >= 0.5).cast("int")) / scale)


def nonspace(text: Column) -> Column:
    return F.length(F.translate(body(text), " \t\n\r", ""))


def letters(text: Column) -> Column:
    return chars_of(text, r"\p{L}")


def repeated_share(items: Column, least: int) -> Column:
    """1 - distinct / all, 0 if there are fewer items than least."""
    return let(items, lambda x: F.when(F.size(x) < least, F.lit(0.0)).otherwise(1 - F.size(F.array_distinct(x)) / F.size(x)))


def distinct_loss(items: Column, least: int) -> Column:
    """As repeated_share(), of a column."""
    return F.when(F.size(items) < least, F.lit(0.0)).otherwise(1 - F.size(F.array_distinct(items)) / F.size(items))


def most_equal(codes: Column) -> Column:
    """How often the commonest value of an array of numbers occurs; 0 if it is empty."""
    start = F.struct(F.lit(None).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("run"), F.lit(0).cast("bigint").alias("best"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(s["last"] == x, s["run"] + 1).otherwise(F.lit(1).cast("bigint"))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(F.array_sort(codes), start, step, lambda s: s["best"])


def ngrams(items: Column, n: int) -> Column:
    def grams(x: Column) -> Column:
        some = F.transform(F.sequence(F.lit(1), F.greatest(F.size(x) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(x, i, n), " "))
        return F.when(F.size(x) < n, F.array().cast("array<string>")).otherwise(some)

    return let(items, grams)


def gram_codes(items: Column, n: int) -> Column:
    """64-bit codes of the n-grams: for counting distinct ones, where the grams themselves aren't needed."""

    def codes(x: Column) -> Column:
        some = F.transform(F.sequence(F.lit(0), F.greatest(F.size(x) - n, F.lit(0))), lambda i: F.xxhash64(*[F.get(x, i + k) for k in range(n)]))
        return F.when(F.size(x) < n, F.array().cast("array<bigint>")).otherwise(some)

    return let(items, codes)


def any_of(phrases: list[str], text: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in phrases], F.lit(False))


def mask_email(text: Column) -> Column:
    return F.regexp_replace(text, EMAIL, "<EMAIL>")


def strip_marks(text: Column) -> Column:
    """Base letters for lower-case Vietnamese ones."""
    return F.translate(text, MARKED, BARE)


def diacritic_share(text: Column, alphabet: str = VI_LETTERS) -> Column:
    lower = F.lower(body(text))
    return ratio(chars_of(lower, alphabet), letters(lower))


def unfenced(text: Column) -> Column:
    """Text without code fences and bracketed math."""
    out = F.regexp_replace(body(text), r"(?s)```.*?```", " ")
    out = F.regexp_replace(out, r"(?s)\\\[.*?\\\]", " ")
    return F.regexp_replace(out, r"(?s)\\\(.*?\\\)", " ")


def without_display_math(text: Column) -> Column:
    """Text without what stands between double dollars, if their number is even."""
    doubles = (F.length(text) - F.length(F.replace(text, F.lit("$$"), F.lit("")))) / 2
    return F.when(F.pmod(doubles, F.lit(2)) == 0, F.regexp_replace(text, r"(?s)\$\$.*?\$\$", " ")).otherwise(text)


def math_free(text: Column) -> Column:
    """Text without code fences, display math and bracketed math."""
    return without_display_math(unfenced(text))


def math_share(text: Column) -> Column:
    whole = nonspace(text)
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), 1 - nonspace(math_free(text)) / whole))


def hex_bucket(value: Column, digest: str = "sha1", buckets: int = 100) -> Column:
    """First 8 hex digits of a digest as a number, modulo buckets."""
    made = F.sha1(value) if digest == "sha1" else F.sha2(value, 256)
    return F.pmod(F.conv(F.substring(made, 1, 8), 16, 10).cast("long"), F.lit(buckets))


def family_id(representative: Column) -> Column:
    return F.concat(F.lit("fam_"), F.substring(F.sha1(representative.cast("string")), 1, 12))


def excerpt(text: Column, needle: Column, around: int = 100, default: int = 240) -> Column:
    """Characters around the first hit, else the beginning."""
    at = F.instr(text, needle)
    begin = F.greatest(at - around, F.lit(1))
    return F.when(at > 0, F.substring(text, begin, F.least(at, F.lit(around + 1)) - 1 + F.length(needle) + around)).otherwise(F.substring(text, 1, default))


def year_of(value: Column) -> Column:
    """A plausible year (1900 to 2100, not the epoch's 1970), else null."""
    year = F.expr("try_cast(NULL AS INT)") if value is None else value.try_cast("int")
    return F.when(year.between(1900, 2100) & (year != 1970), year)


def wilson(hits: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson interval; 0 and 1 without rows."""
    p, zz = hits / n, z * z
    half = z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
    mid = (p + zz / (2 * n)) / (1 + zz / n)
    return F.when(n == 0, F.lit(0.0)).otherwise(mid - half), F.when(n == 0, F.lit(1.0)).otherwise(mid + half)
