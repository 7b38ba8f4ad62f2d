"""The suffix-stripping stemmer of Porter (1980) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The suffixes of steps 2 to 4 and what replaces them.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent",
    "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]

# a consonant run and a vowel run; a leading y is written Y and is a consonant
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_ONE = f"^(?:{_C})?{_V}{_C}"  # a measure of one or more
_TWO = f"^(?:{_C})?{_V}{_C}{_V}{_C}"  # of two or more
_JUST_ONE = f"^(?:{_C})?{_V}{_C}(?:{_V})?$"
_VOWEL = f"^(?:{_C})?[aeiouy]"
_SHORT = f"^{_C}[aeiouy][^aeiouwxyY]$"  # consonant, vowel, consonant


def _cut(word: Column, suffixes: list[str]) -> tuple[Column, Column]:
    """Stem and the longest of the suffixes a word ends in; both empty without one."""
    pattern = f"^(.*?)({'|'.join(sorted(suffixes, key=len, reverse=True))})$"
    return F.regexp_extract(word, pattern, 1), F.regexp_extract(word, pattern, 2)


def with_stem(rows: DataFrame, word: str, out: str) -> DataFrame:
    """Add the stem of ``word`` as ``out``. Words of under three letters, or with other signs than a to z, stay as they are.

    Each step is a projection of its own, so that none is written into the next one as often as that mentions it.
    """
    w, stem, end = F.col("_w"), F.col("_stem"), F.col("_end")
    plain = F.col(word).rlike("^[a-z]{3,}$")
    rows = rows.withColumn("_w", F.when(plain, F.regexp_replace(word, "^y", "Y")))
    # 1a: plurals
    rows = rows.withColumn("_w", F.when(w.rlike("(?:ss|i)es$"), F.regexp_replace(w, "es$", "")).otherwise(F.regexp_replace(w, "^(.+[^s])s$", "$1")))
    # 1b: past and progressive
    parts = _cut(w, ["eed", "ed", "ing"])
    rows = rows.withColumn("_stem", parts[0]).withColumn("_end", parts[1])
    taken = end.isin("ed", "ing") & stem.rlike(_VOWEL)
    mended = (
        F.when(stem.rlike("(?:at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(stem.rlike(r"([^aeiouylsz])\1$"), F.regexp_replace(stem, ".$", ""))
        .when(stem.rlike(_SHORT), F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )
    rows = rows.withColumn("_w", F.when((end == "eed") & stem.rlike(_ONE), F.concat(stem, F.lit("ee"))).when(taken, mended).otherwise(w))
    # 1c
    rows = rows.withColumn("_stem", F.regexp_extract("_w", "^(.+?)y$", 1))
    rows = rows.withColumn("_w", F.when(stem.rlike(_VOWEL), F.concat(stem, F.lit("i"))).otherwise(w))
    for table in (STEP_2, STEP_3):
        parts = _cut(w, list(table))
        rows = rows.withColumn("_stem", parts[0]).withColumn("_end", parts[1])
        given = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
        rows = rows.withColumn("_w", F.when((end != "") & stem.rlike(_ONE), F.concat(stem, F.try_element_at(given, end))).otherwise(w))
    parts = _cut(w, STEP_4)
    rows = rows.withColumn("_stem", parts[0]).withColumn("_end", parts[1])
    ion = F.regexp_extract("_w", "^(.+?[st])ion$", 1)
    step = F.when(end != "", F.when(stem.rlike(_TWO), stem).otherwise(w)).when(ion.rlike(_TWO), ion).otherwise(w)
    rows = rows.withColumn("_w", step)
    # 5: a last e, then a double l
    rows = rows.withColumn("_stem", F.regexp_extract("_w", "^(.+?)e$", 1))
    rows = rows.withColumn("_w", F.when(stem.rlike(_TWO) | (stem.rlike(_JUST_ONE) & ~stem.rlike(_SHORT)), stem).otherwise(w))
    rows = rows.withColumn("_w", F.when(w.rlike("ll$") & w.rlike(_TWO), F.regexp_replace(w, ".$", "")).otherwise(w))
    return rows.withColumn(out, F.when(plain, F.regexp_replace("_w", "^Y", "y")).otherwise(F.col(word))).drop("_w", "_stem", "_end")
