"""Text normalisation as column expressions.

Everything is a built-in expression except Unicode NFC, which Spark lacks. That one is an Arrow UDF
which only ever receives the texts a cheap JVM-side check could not prove to be normalised already.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Mapping
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values -------------------------------------------------------------------------
TONE_MARKS = {
    "òa": "oà", "óa": "oá", "ỏa": "oả", "õa": "oã", "ọa": "oạ",
    "òe": "oè", "óe": "oé", "ỏe": "oẻ", "õe": "oẽ", "ọe": "oẹ",
    "ùy": "uỳ", "úy": "uý", "ủy": "uỷ", "ũy": "uỹ", "ụy": "uỵ",
}
EMOJI_RANGES = (
    (0x1F600, 0x1F64F), (0x1F300, 0x1F5FF), (0x1F680, 0x1F6FF), (0x1F700, 0x1F77F),
    (0x1F780, 0x1F7FF), (0x1F800, 0x1F8FF), (0x1F900, 0x1F9FF), (0x1FA00, 0x1FA6F),
    (0x1FA70, 0x1FAFF), (0x2600, 0x26FF), (0x2700, 0x27BF), (0xFE00, 0xFE0F),
    (0x1F1E0, 0x1F1FF), (0x200D, 0x200D), (0x20E3, 0x20E3),
)
EXTRA_TEXT_RANGES = ((0x00C0, 0x024F), (0x1E00, 0x1EFF), (0x0300, 0x036F))
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
TRANSLATE_SUFFIX = "translate"
# ---- end of fixed values ------------------------------------------------------------------

# Unicode whitespace; Java's \s is ASCII only.
SPACE_RANGES = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
SPACE_CHARS = "".join(chr(c) for lo, hi in SPACE_RANGES for c in range(lo, hi + 1))

# The same characters as a class both Java and RE2 read.
SPACE_CLASS = "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in SPACE_RANGES)

# A word character: letter, number or underscore. Java's \w is ASCII only.
WORD = r"[\p{L}\p{N}_]"


def _ranges(pairs) -> str:
    return "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in pairs)


def _rare(pairs) -> str:
    """Character class of ranges most characters lie outside of.

    One comparison with the span of all ranges rejects an ordinary character; only characters inside
    the span are tried range by range.
    """
    return rf"[{_ranges([(min(lo for lo, _ in pairs), max(hi for _, hi in pairs))])}&&[{_ranges(pairs)}]]"


_LATIN_SPACE = [r for r in SPACE_RANGES if r[1] < 0x100]
_OTHER_SPACE = [r for r in SPACE_RANGES if r[1] >= 0x100]
SPACE = f"[{_ranges(_LATIN_SPACE)}{_rare(_OTHER_SPACE)}]"



def _as_ranges(points: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for p in points:
        if out and p == out[-1][1] + 1:
            out[-1] = (out[-1][0], p)
        else:
            out.append((p, p))
    return out


@lru_cache(maxsize=1)
def nfc_doubtful_ranges() -> tuple[tuple[int, int], ...]:
    """Code points that can occur in text which is not NFC.

    These are the ones that change on their own, have a combining class, or compose with what precedes them:
    second parts of canonical pairs and the vowels and tails of Hangul."""
    points = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if unicodedata.combining(ch):
            points.add(cp)
        parts = unicodedata.decomposition(ch)
        if parts and parts[0] != "<":
            if unicodedata.normalize("NFC", ch) != ch:
                points.add(cp)
            points.update(int(part, 16) for part in parts.split()[1:])
    return tuple(_as_ranges(sorted(points)))


@lru_cache(maxsize=1)
def _not_surely_nfc() -> str:
    """The doubtful code points as a class; the widest gaps between them are rejected first."""
    ranges = nfc_doubtful_ranges()
    gaps = [(a[1] + 1, b[0] - 1) for a, b in zip(ranges, ranges[1:])]
    wide = sorted(sorted(gaps, key=lambda g: g[0] - g[1])[:8])
    return f"[[^{_ranges([(0, ranges[0][0] - 1), *wide])}]&&[{_ranges(ranges)}]]"


_EMOJI = _rare(EMOJI_RANGES)
_INVALID = rf"[^\p{{L}}\p{{N}}_{_ranges(EXTRA_TEXT_RANGES)}{_ranges(SPACE_RANGES)}]"
# One pass for emoji, invalid characters, punctuation and whitespace runs together, as a single
# character class: a repeated group of alternatives would recurse once per character in Java.
# Dingbat digits are numbers, so the emoji ranges have to be united with the negated class.
_NOISE = rf"[[^\p{{L}}\p{{N}}{_ranges(EXTRA_TEXT_RANGES)}]{_EMOJI}]+"


def _compose() -> Callable[[Column], Column]:
    # A nested function travels to the executors by value, so they need no copy of this package.
    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    return F.pandas_udf(compose, T.StringType())


def nfc(col: Column) -> Column:
    """Unicode NFC. Only texts with a code point that may not be composed leave the JVM."""
    doubtful = F.when(col.rlike(_not_surely_nfc()), col)
    return F.coalesce(_compose()(doubtful), col)


def lowercase(col: Column) -> Column:
    return F.lower(col)


def tone_marks(col: Column) -> Column:
    """Move the tone mark of oa, oe and uy to the second vowel."""
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), TONE_MARKS.items(), col)


def strip_emoji(col: Column) -> Column:
    return F.regexp_replace(col, _EMOJI, " ")


def strip_invalid(col: Column) -> Column:
    return F.regexp_replace(col, _INVALID, " ")


def strip_punctuation(col: Column) -> Column:
    return F.translate(col, ASCII_PUNCTUATION, " " * len(ASCII_PUNCTUATION))


def strip_space(col: Column) -> Column:
    """Trim every kind of whitespace, not only blanks."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def collapse_ws(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, rf"{SPACE}+", " "))


def normalize_sentence(col: Column) -> Column:
    """Emoji, invalid characters, punctuation and repeated whitespace to single blanks."""
    return F.trim(F.regexp_replace(col, _NOISE, " "))


def preprocess(col: Column) -> Column:
    """NFC, lower case, tone marks, sentence clean-up; missing or blank text becomes ''."""
    return F.coalesce(normalize_sentence(tone_marks(lowercase(nfc(col)))), F.lit(""))


def rewrite_text(
    df: DataFrame, rewrite: Callable[[Column], Column], text_col: str = "text", observation: Observation | None = None
) -> DataFrame:
    """Apply a text function to a column.

    An observation receives ``rows`` and ``changed`` while the result is computed for its own sake, so
    reporting them needs no second pass.
    """
    old, new = F.col(text_col), rewrite(F.col(text_col))
    if observation is None:
        return df.withColumn(text_col, new)
    changed = F.count_if(~F.col("_before").eqNullSafe(F.col(text_col)))
    marked = df.withColumns({"_before": old, text_col: new})
    return marked.observe(observation, F.count("*").alias("rows"), changed.alias("changed")).drop("_before")


def preprocess_table(df: DataFrame, text_col: str = "text", observation: Observation | None = None) -> DataFrame:
    """Clean a text column and keep what it was as ``text_original``."""
    return rewrite_text(df.withColumn("text_original", F.col(text_col)), preprocess, text_col, observation)


def strip_translate_suffix(col: Column) -> Column:
    """Drop a trailing 'translate' button caption; other texts stay as they are."""
    bare = strip_space(col)
    cut = strip_space(bare.substr(F.lit(1), F.length(bare) - len(TRANSLATE_SUFFIX)))
    return F.when(has_translate_suffix(col), cut).otherwise(col)


def has_translate_suffix(col: Column) -> Column:
    return strip_space(col).endswith(TRANSLATE_SUFFIX)


def teencode(col: Column, dictionary: Mapping[str, str]) -> Column:
    """Replace whole words and phrases by the dictionary, ignoring case.

    The text is cut into pieces that concatenate back to it; a piece equal to a key is looked up.
    Single-word keys can only match a whole run of word characters, so phrases alone have to be
    spelled out in the cutting pattern.
    """
    table = {str(k).lower(): str(v) for k, v in dictionary.items()}
    if not table:
        return col
    pieces = rf"{WORD}+|[^\p{{L}}\p{{N}}_]"
    if any(not re.fullmatch(r"\w+", key) for key in table):
        edge = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
        keys = "|".join(r"\Q" + key.replace(r"\E", r"\E\\E\Q") + r"\E" for key in table)
        pieces = rf"{edge}(?iu:{keys}){edge}|{pieces}"
    lookup = F.create_map(*[F.lit(part) for pair in table.items() for part in pair])

    def swap(piece: Column) -> Column:
        key = F.lower(piece)
        return F.when(key.isin(*table), F.try_element_at(lookup, key)).otherwise(piece)

    return F.array_join(F.transform(F.regexp_extract_all(col, F.lit(f"({pieces})"), F.lit(1)), swap), "")


def text_length(col: Column) -> Column:
    return F.length(col)


def humanize(col: Column) -> Column:
    """Display form of a name: underscores to blanks, first letter in upper case."""
    spaced = F.replace(col, F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(spaced, 1, 1)), spaced.substr(F.lit(2), F.length(spaced)))


def tokens(col: Column) -> Column:
    """Whitespace tokens, empty ones dropped."""
    return F.array_remove(F.split(col, f"{SPACE}+"), "")
