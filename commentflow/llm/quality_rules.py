"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

``measures`` turns each whole text into counts, ``kept`` compiles a rule table over these counts into one
boolean expression. There is no shuffle: the plan is scan, projection, projection.

Edge cases: a null or empty text has no words and fails the base rule; repeated rows give repeated results;
other columns of the input are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentflow.llm.tables import BLANKS, let, text_words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50

#: Frequent function words of the four languages of the corpus (fixed values).
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "as", "with", "by", "this",
    "de", "la", "que", "el", "en", "y", "los", "se", "las", "un", "para", "su", "una", "es", "con", "no",
    "le", "et", "les", "des", "est", "dans", "qui", "sur", "pas", "au", "avec", "il", "elle", "par",
    "der", "die", "und", "das", "ist", "von", "mit", "den", "zu", "nicht", "ein", "eine", "sich", "auf",
)


@dataclass(frozen=True)
class Rule:
    """Bounds, both inclusive, on ``numerator / denominator`` of two counted columns; an empty denominator passes."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


#: Thresholds of the kept verdict.
RULES = (
    Rule("mean_word_chars", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.2),
    Rule("stop_word_share", "n_stop_words", "n_words", 0.02, None),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", None, 0.5),
)


def _covered(starts: Column) -> Column:
    """Size of the union of the intervals ``[i, i + 3)`` for an array of starts."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    return F.aggregate(
        F.sort_array(starts), zero,
        lambda acc, i: F.struct((acc["n"] + i + 3 - F.greatest(acc["end"], i)).alias("n"), (i + 3).alias("end")),
        lambda acc: acc["n"],
    )


def _repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window which the text holds twice or more.

    Each window becomes one 64-bit number, its hash above and its position in the low bits; equal hashes are
    neighbours once the numbers are sorted, and their words are compared. Should different windows share a hash,
    the text takes the slower way that sorts the words themselves. The union of the repeats' intervals is
    counted in one pass."""

    def of(w: Column) -> Column:
        def equal(i: Column, j: Column) -> Column:
            i, j = i.cast("int"), j.cast("int")
            return (F.get(w, i) == F.get(w, j)) & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2))

        def packed(m: Column) -> Column:
            high, low = -m, m - 1
            hashes = F.transform(
                F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

            def paired(s: Column) -> Column:
                ks = F.filter(
                    F.sequence(F.lit(0), F.size(s) - 2),
                    lambda k: F.get(s, k).bitwiseXOR(F.get(s, k + 1)).bitwiseAND(high) == 0)
                return F.transform(ks, lambda k: F.struct(
                    F.get(s, k).bitwiseAND(low).alias("i"), F.get(s, k + 1).bitwiseAND(low).alias("j")))

            def judged(r: Column) -> Column:
                clash = F.filter(r, lambda x: ~equal(x["i"], x["j"]))
                both = F.array_distinct(F.flatten(F.transform(r, lambda x: F.array(x["i"], x["j"]))))
                return (
                    F.when(F.size(r) == 0, F.lit(0).cast("bigint"))
                    .when(F.size(clash) == 0, _covered(both))
                    .otherwise(_repeat_words_sorted(w))
                )

            def numbered(h: Column) -> Column:
                numbers = F.transform(h, lambda x, i: x.bitwiseAND(high).bitwiseOR(i.cast("bigint")))
                repeats = let(F.sort_array(numbers), lambda s: let(paired(s), judged))
                return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(repeats)

            return let(hashes, numbered)

        bits = F.pow(F.lit(2.0), F.length(F.bin(F.size(w).cast("bigint")))).cast("bigint")
        return F.when(F.size(w) < 4, F.lit(0).cast("bigint")).otherwise(let(bits, packed))

    return let(words, of)


def _repeat_words_sorted(w: Column) -> Column:
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.cast("bigint").alias("i")),
    )

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    return let(F.sort_array(windows), lambda s: _covered(F.transform(
        F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1))), lambda x: x["i"])))


def measures(docs: DataFrame, stop_words: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """doc_id and the counts of each whole text: words, characters in words, symbols, lines, repeats, stop words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.ltrim(line, F.lit(BLANKS)) != "")

    def counted(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*stop_words))).cast("bigint").alias("n_stop_words"),
        )

    by_line = let(lines, lambda x: F.struct(
        F.size(x).cast("bigint").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
    ))
    return docs.select(
        F.col("doc_id"),
        let(text_words(text), counted).alias("w"),
        by_line.alias("l"),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))).cast("bigint").alias("n_symbols"),
    ).select("doc_id", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines", "w.n_stop_words")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """One boolean expression for a rule table."""
    verdict = F.lit(True)
    for rule in rules:
        ratio = F.col(rule.numerator) / F.nullif(F.col(rule.denominator), F.lit(0).cast("bigint"))
        if rule.low is not None:
            verdict = verdict & F.coalesce(ratio >= rule.low, F.lit(True))
        if rule.high is not None:
            verdict = verdict & F.coalesce(ratio <= rule.high, F.lit(True))
    return verdict


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, base verdict and final verdict of every document."""
    return measures(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & compiled(rules)).alias("kept"),
        "n_lines", "n_stop_words",
    )


def _sql() -> str:
    words = ", ".join(f"'{w}'" for w in STOP_WORDS)
    clauses = []
    for rule in RULES:
        ratio = f"{rule.numerator} / nullif({rule.denominator}, 0)"
        if rule.low is not None:
            clauses.append(f"coalesce({ratio} >= {rule.low}, true)")
        if rule.high is not None:
            clauses.append(f"coalesce({ratio} <= {rule.high}, true)")
    return f"""
with w as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls
  from documents
), tri as (
  select doc_id, i, [ws[i], ws[i + 1], ws[i + 2]] as g
  from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)
), rep as (
  select doc_id, i, count(*) over (partition by doc_id, g) as n from tri
), cover as (
  select doc_id, count(distinct i + k) as n_repeat_words
  from rep, (values (0), (1), (2)) o(k) where n > 1 group by doc_id
), counted as (
  select w.doc_id, cast(len(ws) as bigint) as n_words,
         cast(length(t) - length(regexp_replace(t, '[^\\x20\\x09-\\x0D]', '', 'g')) as bigint) as word_chars,
         cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
         cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
         cast(len(ls) as bigint) as n_lines,
         cast(len(list_filter(ws, lambda x: lower(x) in ({words}))) as bigint) as n_stop_words
  from w left join cover on w.doc_id = cover.doc_id
), judged as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words as base_failed from counted
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and {' and '.join(clauses)} as kept, n_lines, n_stop_words
from judged"""


SQL = _sql()
