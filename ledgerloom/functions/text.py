"""Text expressions inside the JVM; only words are counted in Arrow."""

from __future__ import annotations

from collections.abc import Iterator
from html.entities import name2codepoint

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

# The English stop words the classifier and the search drop.
STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# White space as a Unicode-aware matcher sees it.
SPACE_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)])
) + "".join(map(chr, [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# What a byte of a text is to ``clean_tokens``: a small letter, a blank, or nothing.
_LETTERS = np.zeros(256, np.uint8)
_LETTERS[[ord(c) for c in SPACE_CHARS if c < "\x80"]] = 0x20
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_WIDE_BLANKS = {n: [int.from_bytes(c.encode(), "big") for c in SPACE_CHARS if len(c.encode()) == n] for n in (2, 3)}
SLICE_BYTES = 4 << 20  # of text that are cut into words at a time

# Blocks whose text is not content; each one separates the text around it.
HIDDEN = r"(?is)" + "|".join(
    [rf"<{tag}\b[^>]*>.*?</{tag}\s*>" for tag in ("script", "style", "template")]
    + ["<!--.*?-->", "<![a-z][^>]*>", r"<\?[^>]*>"]
)
TAG = r"""</?[A-Za-z][^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>"""
BLANK = r" \t\n\r\f\x{a0}"


def or_null(col: Column | str) -> Column:
    """Empty string to null."""
    return F.nullif(_c(col), F.lit(""))


def first_non_empty(*cols: Column | str) -> Column:
    return F.coalesce(*[or_null(c) for c in cols])


def truncate(col: Column | str, n: int) -> Column:
    return F.substring(_c(col), 1, n)


def join_non_empty(sep: str, *cols: Column | str) -> Column:
    return or_null(F.concat_ws(sep, *[or_null(c) for c in cols]))


def full_text(name: Column | str, description: Column | str) -> Column:
    """``name description`` with nulls read as empty."""
    return F.concat_ws(" ", F.coalesce(_c(name), F.lit("")), F.coalesce(_c(description), F.lit("")))


def strip_html(col: Column | str) -> Column:
    """Markup to text: every text node trimmed, nodes joined by one blank."""
    text = F.regexp_replace(or_null(col), "(?i)&nbsp;|&#160;|&#xa0;", "\xa0")
    text = F.regexp_replace(F.regexp_replace(text, HIDDEN, "\x01"), TAG, "\x01")
    # Blanks after a marker, then blanks before it. The look-behind keeps long
    # runs of blanks linear.
    text = F.regexp_replace(text, rf"\x01[{BLANK}\x01]*", "\x01")
    text = F.regexp_replace(text, rf"(?<![{BLANK}])[{BLANK}]*\x01", " ")
    return unescape(F.regexp_replace(text, rf"^[{BLANK}]+|(?<![{BLANK}])[{BLANK}]+$", ""))


def unescape(col: Column) -> Column:
    """Decode named (HTML 4) and numeric character references."""
    parts = F.split(col, "&", -1)
    # Cheap guard: most texts carry no reference at all.
    return F.when(
        F.contains(col, F.lit("&")),
        F.concat(
            parts[0],
            F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), _reference), ""),
        ),
    ).otherwise(col)


def _reference(piece: Column) -> Column:
    names = F.create_map(*[F.lit(x) for n, cp in sorted(name2codepoint.items()) for x in (n, chr(cp))])
    name = F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]*);", 1)
    dec = F.regexp_extract(piece, "^#([0-9]{1,7});", 1)
    hexa = F.regexp_extract(piece, "^#[xX]([0-9A-Fa-f]{1,6});", 1)
    code = F.when(dec != "", F.hex(dec.cast("bigint"))).when(hexa != "", hexa)
    symbol = F.when(name != "", F.try_element_at(names, name)).when(
        code.isNotNull() & (F.conv(code, 16, 10).cast("bigint") <= 0x10FFFF),
        F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32"),
    )
    return F.when(symbol.isNotNull(), F.concat(symbol, F.regexp_replace(piece, "^[^;]*;", ""))).otherwise(
        F.concat(F.lit("&"), piece)
    )


def clean_tokens(col: Column | str, stopwords: list[str] = STOPWORDS) -> Column:
    """Lower-case ASCII words of two letters or more, stop words dropped.

    Characters other than letters and white space are deleted before the split,
    so they join the letters around them.
    """
    # A translation is several times faster than a pattern of all these blanks;
    # runs of them leave empty words, which the length test drops.
    text = F.translate(_c(col), SPACE_CHARS, " " * len(SPACE_CHARS))
    words = F.split(F.lower(F.regexp_replace(text, "[^a-zA-Z ]+", "")), " ")
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(stopwords))


def word_tokens(col: Column | str, stopwords: list[str] | None = STOPWORDS, min_length: int = 2) -> Column:
    """Lower-case runs of letters, digits and underscores."""
    words = F.split(F.lower(F.coalesce(_c(col), F.lit(""))), r"[^\p{L}\p{N}_]+")
    if stopwords:
        return F.filter(words, lambda w: (F.length(w) >= min_length) & ~w.isin(stopwords))
    return F.filter(words, lambda w: F.length(w) >= min_length)


def search_pattern(query: str, regex: bool = False) -> str:
    """A case-insensitive pattern; a literal query is quoted."""
    body = query if regex else "\\Q" + query.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    return "(?iu)" + body


def match_count(col: Column | str, query: str, regex: bool = False) -> Column:
    return F.regexp_count(F.coalesce(_c(col), F.lit("")), F.lit(search_pattern(query, regex)))


def with_term_counts(df: DataFrame, tokens: Column, out: str = "terms", without: str | None = None) -> DataFrame:
    """Add ``array<struct<term, tf>>`` counted inside each row, in the order of the terms' first use in their batch.

    Words are numbered by a batch of rows and counted as numbers. No (document, term) pair is ever shuffled.
    The text, named by ``without``, is left behind. Unnest the result with ``unnest``.
    """
    words = df.withColumn(out, tokens).drop(*([without] if without else []))
    counted = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType())]))
    return words.mapInArrow(_count_words, T.StructType([*words.schema.fields[:-1], T.StructField(out, counted)]))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(batch.num_columns - 1)
        offsets = words.offsets.to_numpy().astype(np.int64)
        coded = words.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        size = max(len(coded.dictionary), 1)
        row = np.repeat(np.arange(len(words), dtype=np.int64) * size, np.diff(offsets))
        pairs, tf = np.unique(row + coded.indices.to_numpy(), return_counts=True)
        ends = np.searchsorted(pairs, np.arange(len(words) + 1, dtype=np.int64) * size)
        items = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(pairs % size)), pa.array(tf, pa.int32())], ["term", "tf"])
        # a row without a list keeps none
        terms = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items, mask=words.is_null() if words.null_count else None)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], terms], names=batch.schema.names)


def with_clean_term_counts(df: DataFrame, text: str) -> DataFrame:
    """``with_term_counts`` of ``clean_tokens(text)``, with the text left behind: its bytes are cut into words in Arrow."""
    counted = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType())]))
    rows = df.select(*[c for c in df.columns if c != text], text)
    return rows.mapInArrow(_count_clean_words, T.StructType([*rows.schema.fields[:-1], T.StructField("terms", counted)]))


def _count_clean_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        ends = _offsets(whole.column(whole.num_columns - 1))
        cuts = np.flatnonzero(np.diff((ends[:-1] - ends[0]) // SLICE_BYTES)) + 1
        for a, b in zip([0, *cuts], [*cuts, whole.num_rows], strict=True):
            batch = whole.slice(a, b - a)
            texts = batch.column(batch.num_columns - 1)
            row, coded = _clean_words(texts)
            size = max(len(coded.dictionary), 1)
            pairs, tf = np.unique(row * size + coded.indices.to_numpy(), return_counts=True)
            kept = (pc.greater(pc.binary_length(coded.dictionary), 1)).to_numpy(False) & ~pc.is_in(coded.dictionary, pa.array(STOPWORDS)).to_numpy(False)
            on = kept[pairs % size]
            pairs, tf = pairs[on], tf[on]
            ends_of_rows = np.searchsorted(pairs, np.arange(len(texts) + 1, dtype=np.int64) * size)
            items = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(pairs % size)), pa.array(tf, pa.int32())], ["term", "tf"])
            # a row without a text has no list
            terms = pa.ListArray.from_arrays(pa.array(ends_of_rows, pa.int32()), items, mask=texts.is_null() if texts.null_count else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], terms], names=[*batch.schema.names[:-1], "terms"])


def _offsets(texts: pa.Array) -> np.ndarray:
    """Where the texts of a slice start and end in their bytes."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    held = texts.buffers()[1]
    if held is None or not held.size:
        return np.zeros(1, np.int64)
    return np.frombuffer(held, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def _clean_words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(row, word) of all runs of letters: other characters but white space are left out, so they join the letters around them."""
    ends = _offsets(texts)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held is not None else np.empty(0, np.uint8)
    ends = ends - ends[0]
    kind, data = _LETTERS[data], np.append(data, np.zeros(2, np.uint8))
    # a lead byte is only ever the first of a character; white space of several bytes is a blank in its place
    lead = np.flatnonzero(data == 0xC2)
    kind[lead[np.isin(0xC200 | data[lead + 1].astype(np.int64), _WIDE_BLANKS[2])]] = 0x20
    lead = np.flatnonzero((data >= 0xE1) & (data <= 0xE3))
    code = (data[lead].astype(np.int64) << 16) | (data[lead + 1].astype(np.int64) << 8) | data[lead + 2]
    kind[lead[np.isin(code, _WIDE_BLANKS[3])]] = 0x20
    kept = np.flatnonzero(kind)
    chars, cut = kind[kept], np.searchsorted(kept, ends)
    letter = chars != 0x20
    first, last = np.ones(len(chars), bool), np.ones(len(chars), bool)
    first[1:], last[:-1] = ~letter[:-1], ~letter[1:]
    first[cut[cut < len(chars)]] = last[cut[cut > 0] - 1] = True  # words end with their row
    starts = np.flatnonzero(letter & first)
    places = np.append(0, np.cumsum(np.flatnonzero(letter & last) + 1 - starts)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(chars[letter]))
    return np.searchsorted(cut, starts, "right") - 1, words.dictionary_encode()


def unnest(df: DataFrame, keep: list[str], array: Column, out: str) -> DataFrame:
    """One row per element of a computed array.

    The outer form keeps the optimizer from testing the array's size in a filter
    below, which would compute the array (and whatever it is made of) once more.
    """
    return df.select(*keep, F.explode_outer(array).alias(out)).filter(F.col(out).isNotNull())


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
