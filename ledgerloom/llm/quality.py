"""Quality rules, line first: clean the lines, then judge the document by what it lost.

Every line is tested against punctuation, navigation and boilerplate rules; lines that fail, and
copies of an earlier line, are removed. A document that fails the base rules, or loses more than
``max_loss`` of its word characters, is rejected. Everything is a column expression on one row:
no shuffle, no Python.

Defined results: a null or blank text has no words and is rejected; a text of any length is judged
whole; repeated rows and equal ids are judged row by row; an empty table gives an empty table; other
columns are carried by ``clean`` and ignored by ``judge``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BREAKS = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
NOT_MARKS = r"[^#*$%&|<>!]+"
NOT_BARS = r"[^|»›>]+"
BOILERPLATE = (
    r"(?i)\b(all rights reserved|privacy policy|cookie policy|we use cookies|accept (all )?cookies|terms (of use|of service|and conditions)"
    r"|enable javascript|javascript (is )?(disabled|required)|sign up for our|subscribe to our|click here to|powered by|skip to (main )?content"
    r"|back to top|lorem ipsum)\b"
)
MAX_BOILERPLATE = 300


def _left(text: Column, drop: str) -> Column:
    return F.length(F.regexp_replace(text, drop, ""))


def has_word(line: Column) -> Column:
    return line.rlike(WORD_CHAR)


def punctuation_fails(line: Column) -> Column:
    """Symbols and exclamation marks make up more than an eighth of the line (three at least)."""
    marks = _left(line, NOT_MARKS)
    return (marks >= 3) & (marks * 8 > F.length(line))


def navigation_fails(line: Column) -> Column:
    """Three separators or more, with fewer than 30 characters to each."""
    bars = _left(line, NOT_BARS)
    return (bars >= 3) & (F.length(line) < bars * 30)


def boilerplate_fails(line: Column) -> Column:
    """A short line with a stock phrase of web pages."""
    return (F.length(line) <= MAX_BOILERPLATE) & line.rlike(BOILERPLATE)


def line_passes(line: Column) -> Column:
    return ~(punctuation_fails(line) | navigation_fails(line) | boilerplate_fails(line))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add ``_repeats``: words inside 3-word windows that are found twice or more in ``_words``.

    Windows are sorted by a hash that carries the position in its low bits; neighbours with equal
    hashes are candidates, and only these are compared as texts, so a collision of hashes cannot count.
    """
    n = F.size("_words")
    bits = F.when(n > 2, F.ceil(F.log2(n.cast("double"))).cast("int")).otherwise(1)
    df = df.withColumn("_bits", bits)
    df = df.withColumn("_place", F.expr("shiftleft(1L, _bits)"))

    def key(i: Column) -> Column:
        hashed = F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))
        return hashed.bitwiseAND(-F.col("_place")) + i

    spots = F.when(n > 2, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_keys", F.sort_array(F.transform(spots, key)))

    def twin(k: Column, i: Column) -> Column:
        near = lambda j: F.coalesce(k.bitwiseXOR(F.get("_keys", j)).bitwiseAND(-F.col("_place")) == 0, F.lit(False))
        return near(i - 1) | near(i + 1)

    spots = F.transform(F.filter("_keys", twin), lambda k: k.bitwiseAND(F.col("_place") - 1).cast("int"))
    df = df.withColumn("_spots", spots)
    gram = lambda i: F.concat_ws(" ", F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))
    df = df.withColumn("_grams", F.sort_array(F.transform("_spots", lambda i: F.struct(gram(i).alias("g"), i.alias("i")))))

    def same(x: Column, i: Column) -> Column:
        before, after = F.get("_grams", i - 1)["g"], F.get("_grams", i + 1)["g"]
        return F.coalesce(x["g"] == before, F.lit(False)) | F.coalesce(x["g"] == after, F.lit(False))

    starts = F.transform(F.filter("_grams", same), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
    return df.withColumn("_repeats", F.size(F.array_distinct(F.flatten(starts))))


def held_back(condition: Column) -> Column:
    """The same condition, which a filter on it cannot carry below the projections it is computed in.

    The optimizer would write the whole computation into the filter once for every mention of a column.
    """
    return condition & (F.monotonically_increasing_id() >= 0)


def _judged(docs: DataFrame, text: str, min_words: int, max_repeat: int, max_loss: int) -> DataFrame:
    """``docs`` with the measures, ``_base_failed``, ``_kept`` and the cleaned text ``_clean``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_whole", whole)
    df = df.withColumn("_words", F.array_remove(F.split("_whole", BREAKS, -1), ""))
    df = df.withColumn("_lines", F.filter(F.split("_whole", "\n", -1), has_word))
    df = df.withColumn("_distinct", F.array_distinct("_lines"))
    df = df.withColumn("_good", F.filter("_distinct", line_passes))
    df = _repeat_words(df)
    chars = lambda lines: F.length(F.regexp_replace(F.array_join(lines, "\n"), BREAKS, ""))
    df = df.withColumns({
        "_n_words": F.size("_words").cast("long"),
        "_word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "_n_symbols": _left(F.col("_whole"), NOT_SYMBOLS).cast("long"),
        "_n_dup_lines": (F.size("_lines") - F.size("_distinct")).cast("long"),
        "_n_repeat_words": F.col("_repeats").cast("long"),
        "_touched": F.size("_good") < F.size("_lines"),
    })
    df = df.withColumn("_left_chars", F.when(F.col("_touched"), chars("_good")).otherwise(F.col("_word_chars")).cast("long"))
    failed = (F.col("_n_words") < min_words) | (F.col("_n_repeat_words") * 100 > F.col("_n_words") * max_repeat)
    df = df.withColumn("_base_failed", failed)
    lost = F.col("_word_chars") - F.col("_left_chars")
    df = df.withColumn("_kept", ~F.col("_base_failed") & (lost * 100 <= F.col("_word_chars") * max_loss))
    return df.withColumn("_clean", F.when(F.col("_touched"), F.array_join("_good", "\n")).otherwise(F.col(text)))


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = 50, max_repeat: int = 50, max_loss: int = 40) -> DataFrame:
    """One row per row of ``docs``: measures, the base verdict, the verdict, and the cleaned text."""
    df = _judged(docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")), "_text", min_words, max_repeat, max_loss)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "left_chars"]
    return df.select(F.col("_id").alias(id), *[F.col(f"_{x}").alias(x) for x in names], F.col("_clean").alias("clean_text"))


def clean(docs: DataFrame, text: str = "text", min_words: int = 50, max_repeat: int = 50, max_loss: int = 40) -> DataFrame:
    """The documents kept, their text cleaned; the other columns as they were."""
    df = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text"))
    df = _judged(df, "_text", min_words, max_repeat, max_loss)
    df = df.withColumn("_kept", held_back(F.col("_kept"))).filter("_kept")
    return df.select(*[(F.col("_clean") if x == text else F.col("_row")[x]).alias(x) for x in docs.columns])
