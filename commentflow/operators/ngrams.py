"""Most frequent word n-grams, overall and per group.

The top lists are found level by level, exactly. No n-gram occurs more often than the n-grams it is made of, so those
that can be among the first ``top_n`` of their size are known before they are counted:

1. Words are counted.
2. N-grams made of the most frequent words alone are counted. The count of the last of the ``top_n`` best ones is a
   lower bound for what the true list holds, for every size and group.
3. Size by size, occurrences are counted only if the n-grams at their front and at their end reach the bound.

Counts are partially aggregated in the tasks; a bounded set of n-grams to keep is broadcast, and where it is larger than
the bound all occurrences are counted. The texts are split into words once. N-grams do not cross from one text to the
next, ties are broken by the n-gram.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentflow.functions.text import tokens
from commentflow.operators.ranking import top_counted
from commentflow.plans.scratch import stored

Tokenizer = Callable[[Column], Column]

#: Words of a group whose n-grams give the lower bounds.
SEED_WORDS = 256
#: Bytes of n-grams that may be broadcast to cut off the others.
KEEP_BYTES = 8 << 20


def _names(width: int) -> list[str]:
    return [f"w{k}" for k in range(1, width + 1)]


def word_windows(words: str, width: int) -> Column:
    """For every token a struct of it and its followers ``w1 … w<width>``, null past the end."""
    shifted = [F.slice(words, k, F.size(words)) if k > 1 else F.col(words) for k in range(1, width + 1)]
    return F.arrays_zip(*[w.alias(name) for w, name in zip(shifted, _names(width))])


def split_words(df: DataFrame, by: Sequence[str], text_col: str, tokenizer: Tokenizer) -> DataFrame:
    """The groups and the words (``_words``) of every row that has a text and a group."""
    return df.dropna(subset=[*by, text_col]).select(*by, tokenizer(F.col(text_col)).alias("_words"))


def count_ngrams(
    df: DataFrame, by: Sequence[str] = (), sizes: Sequence[int] = (1, 2, 3), text_col: str = "text", tokenizer: Tokenizer = tokens
) -> DataFrame:
    """Occurrences of every n-gram per group as (group…, n, ngram, count).

    A token is exploded once, together with its followers. Grouping sets over the word columns count
    all sizes in one pass, and words are joined into a string only after counting.
    """
    by, width = list(by), max(sizes)
    words = _names(width)
    placed = split_words(df, by, text_col, tokenizer).select(*by, F.inline(word_windows("_words", width)))
    sets = [[F.col(c) for c in [*by, *words[:n]]] for n in sizes]
    counted = placed.groupingSets(sets, *by, *words).agg(
        F.grouping_id(*by, *words).alias("_gid"), F.count("*").alias("count")
    )
    # A set over the first n words leaves the bits of the last (width - n) columns on. N-grams that
    # would run past the end of the text have no last word.
    size_of = F.coalesce(*[F.when(F.col("_gid") == (1 << (width - n)) - 1, F.lit(n)) for n in sizes])
    whole = F.coalesce(*[F.when(F.col("n") == n, F.col(f"w{n}").isNotNull()) for n in sizes])
    return counted.withColumn("n", size_of).filter(whole).select(
        *by, "n", F.concat_ws(" ", *words).alias("ngram"), "count"
    )


def _occurrences(words: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    if n == 1:
        return words.select(*by, F.explode("_words").alias("w1"))
    return words.select(*by, F.inline(word_windows("_words", n))).filter(F.col(f"w{n}").isNotNull())


def _counted(occurrences: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    return occurrences.groupBy(*by, *_names(n)).agg(F.count("*").alias("count"))


def _bytes(parts: DataFrame, width: int) -> int:
    """Bytes of n-grams with their groups, about."""
    row = parts.agg(F.sum(sum((F.octet_length(c) for c in _names(width)), F.lit(32 + 16 * width)))).first()
    return row[0] or 0


def _having(found: DataFrame, part: DataFrame) -> DataFrame:
    """Rows of ``found`` whose values are in ``part``, and hardly any others: one hash of the values is looked up.

    A row too many does no harm here, as what is left is counted by its words. Collated strings are compared themselves,
    as equal ones need not have one hash."""
    cols = part.columns
    if any("collate" in kind for name, kind in found.dtypes if name in cols):
        return found.join(F.broadcast(part), cols, "left_semi")
    return found.withColumn("_hash", F.xxhash64(*cols)).join(
        F.broadcast(part.select(F.xxhash64(*cols).alias("_hash"))), "_hash", "left_semi").drop("_hash")


def lower_bounds(words: DataFrame, by: Sequence[str], counted: DataFrame, sizes: Sequence[int], top_n: int) -> DataFrame:
    """(group…, least_<n>…) from n-grams of the most frequent words: the top lists hold no count below ``least_<n>``.

    Groups with fewer such n-grams have no bound, which is null, or no row."""
    by, width = list(by), max(sizes)
    best = Window.partitionBy(*by).orderBy(F.desc("count"), "w1")
    ranked = counted.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= SEED_WORDS)
    seeds = stored(ranked.select(*by, "w1"), "seed-words")
    names = _names(width)
    found = words.select(*by, F.inline(word_windows("_words", width)))
    if _bytes(seeds, 1) > KEEP_BYTES:  # very many groups
        found = found.filter(F.lit(False))
    for k, name in enumerate(names, 1):
        part = seeds.withColumnRenamed("w1", name)
        if k <= 2:
            found = _having(found, part)
        else:
            found = found.join(F.broadcast(part.withColumn("_seed", F.lit(True))), [*by, name], "left").withColumn(name, F.when(F.col("_seed"), F.col(name))).drop("_seed")
    cells = stored(found.groupBy(*by, *names).agg(F.count("*").alias("count")), "seed-ngrams")  # read once for every size
    bounds = []
    for n in sizes:
        whole = cells.filter(" and ".join(f"{c} is not null" for c in names[:n])).groupBy(*by, *names[:n]).agg(F.sum("count").alias("count"))
        place = Window.partitionBy(*by).orderBy(F.desc("count"))
        last = whole.select(*by, "count").withColumn("_rank", F.row_number().over(place)).filter(F.col("_rank") == top_n)
        bounds.append(last.select(*by, F.col("count").alias(f"least_{n}")))
    return reduce(lambda a, b: a.join(b, list(by), "full"), bounds)


def top_ngrams(
    df: DataFrame, by: Sequence[str] = (), sizes: Sequence[int] = (1, 2, 3), top_n: int = 20, text_col: str = "text",
    tokenizer: Tokenizer = tokens,
) -> DataFrame:
    """``top_n`` n-grams of every size and group as (group…, n, ngram, count, rank)."""
    by, width = list(by), max(sizes)
    words = split_words(df, by, text_col, tokenizer)
    keys = by or ["_all"]  # one group is a group like others
    if not by:
        words = words.withColumn("_all", F.lit(0))
    if width > 1:
        words = stored(words, "words")
    level = _counted(_occurrences(words, keys, 1), keys, 1)
    levels = {1: level}
    if width > 1:
        level = levels[1] = stored(level, "ngrams-1")
        bounds = stored(lower_bounds(words, keys, level, range(2, width + 1), top_n), "ngram-bounds")
    for n in range(2, width + 1):
        # What is counted here serves the longer n-grams too, so the least of their bounds holds.
        least = F.array_min(F.array(*[F.coalesce(F.col(f"least_{m}"), F.lit(1)) for m in range(n, width + 1)]))
        kept = level.join(bounds, keys, "left").filter(F.col("count") >= least).select(*keys, *_names(n - 1))
        kept = stored(kept, f"ngrams-kept-{n - 1}")
        occurrences = _occurrences(words, keys, n)
        if _bytes(kept, n - 1) <= KEEP_BYTES:
            for shift in (0, 1):
                occurrences = _having(occurrences, kept.toDF(*keys, *[f"w{k + shift}" for k in range(1, n)]))
        level = _counted(occurrences, keys, n)
        levels[n] = level = stored(level, f"ngrams-{n}") if n < width else level
    told = [
        levels[n].select(*by, F.lit(n).alias("n"), F.concat_ws(" ", *_names(n)).alias("ngram"), "count") for n in sizes]
    return top_counted(reduce(DataFrame.unionByName, told), [*by, "n"], "ngram", top_n)


def ngrams_global(df: DataFrame, top_n: int = 20, text_col: str = "text", tokenizer: Tokenizer = tokens) -> DataFrame:
    return top_ngrams(df, (), (1, 2, 3), top_n, text_col, tokenizer)


def ngrams_by_label(df: DataFrame, top_n: int = 20, text_col: str = "text", tokenizer: Tokenizer = tokens) -> DataFrame:
    return top_ngrams(df, ["label"], (1, 2, 3), top_n, text_col, tokenizer)


def ngrams_by_source(df: DataFrame, top_n: int = 20, text_col: str = "text", tokenizer: Tokenizer = tokens) -> DataFrame:
    return top_ngrams(df, ["source"], (1, 2, 3), top_n, text_col, tokenizer)


def unigrams_label_source(df: DataFrame, top_n: int = 20, text_col: str = "text", tokenizer: Tokenizer = tokens) -> DataFrame:
    return top_ngrams(df, ["label", "source"], (1,), top_n, text_col, tokenizer)


def unigrams_topic_label(df: DataFrame, top_n: int = 20, text_col: str = "text", tokenizer: Tokenizer = tokens) -> DataFrame:
    return top_ngrams(df, ["topic", "label"], (1,), top_n, text_col, tokenizer)
