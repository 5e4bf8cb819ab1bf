"""Spelling variants of a vocabulary, found by probing all edits of a word in Bloom filters.

The words of a table are counted in its tasks and summed by word. Two words are near if they differ by one inserted,
deleted or replaced code point. Every word probes what it becomes by deleting or replacing one of its code points
(an insertion is a deletion seen from the other word; a replacement is tried in one direction only). The hashes of
all these edits come from running sums of the word's polynomial hash, for many words at once and without making the
strings. They are looked up in blocked Bloom filters: eight bits in one block of 512 bits, a run of blocks for each
word length, so a word needs the blocks of its own length and the length below only. Only hits become strings and are
shuffled to a join with the exact vocabulary, which removes the false ones.

Filters are broadcast in rounds of at most ``ROUND_BYTES``; a larger vocabulary takes more rounds, in each of which
only the words that need its lengths take part. Near pairs are aggregated by word; a word has at most a bounded number
of them, as edits of one code point are. Roots are found by doubling: a form has at least twice the count of its word,
so chains are no longer than the logarithm of the largest count.

Edge cases: null and empty texts have no words; a null doc_id is written as an empty one where it is hashed; texts are
worked off whole, but words under ``MIN_CHARS`` code points never count; repeated rows count each; other columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentflow.llm.tables import partitions, stored
from commentflow.llm.wordhash import mixed

MIN_CHARS, MIN_COUNT, TYPO = 5, 3, 97
#: Bits of filter for each word, bits of a block, bits set in it.
WORD_BITS, BLOCK_BITS, SET_BITS = 16, 512, 8
#: Words of this length or longer share one run of blocks.
LONG = 64
#: Bytes of filters that are broadcast at a time.
ROUND_BYTES = 1 << 25
#: Distinct words a task holds before it hands its counts on, and edits hashed in one step.
HELD, EDITS = 1 << 18, 1 << 21
_BITMAP = 32768

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SALTS = np.array([0x9FB21C651E98DF25, 0xA0761D6478BD642F], dtype=np.uint64)


def _table() -> bytes:
    """Of Latin-1 code points the letters, A-Z in lower case, and blanks for the rest."""
    table = bytearray(b" " * 256)
    table[ord("a"):ord("z") + 1] = table[ord("A"):ord("Z") + 1] = b"abcdefghijklmnopqrstuvwxyz"
    table[0xC0:] = range(0xC0, 0x100)
    return bytes(table)


TABLE = _table()
#: Every code point a word can have.
LETTERS = np.array(sorted(set(TABLE) - {0x20}), dtype=np.uint8)


def words_of(text: str) -> Counter:
    """Lower-cased runs of letters, as Latin-1 bytes, and how often each occurs; other code points become '?'."""
    return Counter(text.encode("latin-1", "replace").translate(TABLE).split())


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, typo: int = TYPO) -> DataFrame:
    """(word, n) of all words with ``min_chars`` code points and ``min_count`` occurrences or more.

    A run whose hash, with the document's id, is divisible by ``typo`` loses one code point."""

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                for name, text in zip(*(c.to_pylist() for c in part.columns)):
                    seed = crc32(f"{name or ''}:".encode())
                    for word, n in words_of(text or "").items():
                        if len(word) < min_chars:
                            continue
                        h = crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                        if h % typo == 0:
                            gone = h % len(word)
                            word = word[:gone] + word[gone + 1:]
                            if len(word) < min_chars:
                                continue
                        total[word] += n
                if len(total) > HELD:
                    yield told(total)
                    total = Counter()
        yield told(total)

    def told(total):
        return pa.record_batch(
            [pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    counted = docs.select(F.col("doc_id").cast("string").alias("name"), "text").mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# Hashes of words and of their edits.

def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def hashes(codes: np.ndarray) -> np.ndarray:
    """A polynomial of the code points of each row; rows have equal lengths."""
    return (codes.astype(np.uint64) * _powers(_BASE, codes.shape[1])).sum(axis=1, dtype=np.uint64)


def deletions(codes: np.ndarray) -> np.ndarray:
    """(rows, length) hashes of each row without its code point i."""
    terms = codes.astype(np.uint64) * _powers(_BASE, codes.shape[1])
    upto = np.cumsum(terms, axis=1)
    return upto - terms + (upto[:, -1:] - upto) * _INVERSE


def replacements(codes: np.ndarray, low: int, high: int) -> np.ndarray:
    """(rows, positions low to high - 1, letters) hashes of each row with another letter there."""
    powers = _powers(_BASE, codes.shape[1])
    change = (LETTERS.astype(np.uint64) - codes[:, low:high, None].astype(np.uint64)) * powers[low:high, None]
    return hashes(codes)[:, None, None] + change


def places(h: np.ndarray, length: int, first: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash in a run of blocks, and a number from which the bits there are taken."""
    x = mixed(h ^ np.uint64(length * int(_SALTS[0]) & 0xFFFFFFFFFFFFFFFF))
    block = (x % np.uint64(blocks)).astype(np.int64) + first
    return block, mixed(x + _SALTS[1])


def _bit(bits: np.ndarray, k: int) -> np.ndarray:
    # Nine bits from every eighth bit on; the last of them end with the 64th.
    return ((bits >> np.uint64(min(8 * k, 55))) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)


def _class(length: int) -> int:
    return min(length, LONG)


def _by_length(words: list[str]) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for w in words:
        out.setdefault(len(w), []).append(w)
    return out


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), length)


# The filters.

def directory(counts: dict[int, int]) -> dict[int, int]:
    """Blocks of each class of lengths, from its number of words."""
    return {c: max(1, -(-n * WORD_BITS // BLOCK_BITS)) for c, n in sorted(counts.items())}


def rounds(blocks: dict[int, int], most: int) -> list[dict[int, tuple[int, int, int]]]:
    """Rounds of filters of at most ``most`` blocks: for each class its blocks, and the first and the end of those held."""
    out, free = [{}], most
    for c, n in blocks.items():
        at = 0
        while at < n:
            if not free:
                out.append({})
                free = most
            stop = min(n, at + free)
            out[-1][c] = (n, at, stop)
            free -= stop - at
            at = stop
    return out


def build(words: DataFrame, held: dict[int, tuple[int, int, int]]) -> np.ndarray:
    """The filters of one round as bits, classes one after another. Tasks set bits, which are merged in Spark."""
    start = _starts(held)

    def run(batches):
        for batch in batches:
            found = []
            for length, some in _by_length(batch.column(0).to_pylist()).items():
                n, low, high = held[_class(length)]
                block, bits = places(hashes(_codes(some, length)), length, 0, n)
                inside = (block >= low) & (block < high)
                at = (block[inside] - low + start[_class(length)]) * BLOCK_BITS
                found += [at + _bit(bits[inside], k) for k in range(SET_BITS)]
            yield pa.record_batch([pa.array(np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64))], names=["at"])

    least = F.least(F.length("word"), F.lit(LONG))
    bits = words.where(least.isin(*held)).select("word").mapInArrow(run, "at bigint")
    merged = bits.groupBy((F.col("at") / _BITMAP).cast("int").alias("part")).agg(F.bitmap_construct_agg(F.col("at") % _BITMAP).alias("bits"))
    size = -(-sum(high - low for _, low, high in held.values()) * BLOCK_BITS // _BITMAP)
    out = np.zeros((size, _BITMAP // 8), dtype=np.uint8)
    for part, data in merged.collect():  # ROUND_BYTES at most
        out[part] = np.frombuffer(data, dtype=np.uint8)
    return out.reshape(-1)


def _starts(held: dict[int, tuple[int, int, int]]) -> dict[int, int]:
    out, at = {}, 0
    for c, (_, low, high) in held.items():
        out[c] = at
        at += high - low
    return out


class Probe:
    """The filters of a round, to be asked for hashes."""

    def __init__(self, held: dict[int, tuple[int, int, int]], bits: np.ndarray):
        self.held, self.bits, self.start = held, bits, _starts(held)

    def __call__(self, h: np.ndarray, length: int) -> np.ndarray:
        """Positions of the hashes, in the flat array, that may be those of words of this length."""
        c = _class(length)
        if c not in self.held:
            return np.zeros(0, dtype=np.int64)
        n, low, high = self.held[c]
        block, bits = places(h.reshape(-1), length, 0, n)
        alive = np.arange(len(block)) if (low, high) == (0, n) else np.flatnonzero((block >= low) & (block < high))
        for k in range(SET_BITS):
            at = (block[alive] - low + self.start[c]) * BLOCK_BITS + _bit(bits[alive], k)
            alive = alive[(self.bits[at >> 3] >> (at & 7)) & 1 == 1]
        return alive


def hits(words: list[str], probe: Probe) -> tuple[list[int], list[str]]:
    """(position of a word, edit of it) for all edits that may be words."""
    place: dict[str, int] = {w: k for k, w in enumerate(words)}
    who, what = [], []
    for length, same in _by_length(words).items():
        step = max(1, EDITS // (length * len(LETTERS)))
        for k in range(0, len(same), step):
            some = same[k:k + step]
            codes = _codes(some, length)
            for at in probe(deletions(codes), length - 1).tolist():
                row, i = divmod(at, length)
                who.append(place[some[row]])
                what.append(some[row][:i] + some[row][i + 1:])
            wide = max(1, EDITS // (len(some) * len(LETTERS)))
            for low in range(0, length, wide):  # a very long word in stretches
                high = min(length, low + wide)
                found = probe(replacements(codes, low, high), length)
                row, rest = np.divmod(found, (high - low) * len(LETTERS))
                i, letter = np.divmod(rest, len(LETTERS))
                ahead = LETTERS[letter] > codes[row, i + low]  # the other direction is found from the other word
                for r, j, c in zip(row[ahead].tolist(), (i[ahead] + low).tolist(), LETTERS[letter[ahead]].tolist()):
                    who.append(place[some[r]])
                    what.append(some[r][:j] + chr(c) + some[r][j + 1:])
    return who, what


def near_pairs(words: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, n, other, other_n) for all pairs of near words, in one direction, from a stored vocabulary (word, n)."""
    spark = words.sparkSession
    length = F.least(F.length("word"), F.lit(LONG))
    counts = {row[0]: row[1] for row in words.groupBy(length).count().collect()}  # one row for each class of lengths
    found = None
    for held in rounds(directory(counts), round_bytes * 8 // BLOCK_BITS):
        shared = spark.sparkContext.broadcast(build(words, held) if held else np.zeros(0, dtype=np.uint8))

        def run(batches, held=held, shared=shared):
            probe = Probe(held, shared.value)
            for batch in batches:
                for k in range(0, batch.num_rows, 4096):
                    part = batch.slice(k, 4096)
                    who, what = hits(part.column(0).to_pylist(), probe)
                    at = pa.array(who, pa.int64())
                    yield pa.record_batch([part.column(0).take(at), part.column(1).take(at), pa.array(what, pa.string())], names=["word", "n", "other"])

        # A word is asked for words of its own length and of one less.
        asked = sorted(set(held) | {c + 1 for c in held if c < LONG})
        some = words.where(length.isin(*asked)).repartition(partitions(spark)).mapInArrow(run, "word string, n bigint, other string")
        found = some if found is None else found.unionByName(some)
    # One edit may be found in several ways, as two equal letters in a row can both be deleted.
    exact = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return found.dropDuplicates(["word", "other"]).join(exact, "other").select("word", "n", "other", "other_n")


def roots(forms: DataFrame, largest: int) -> DataFrame:
    """(word, root) for all rows (word, form): the last word of the chain of forms that starts at the word."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    # Every form has twice the count of its word or more.
    for _ in range(max(0, largest.bit_length() - 1).bit_length()):
        further = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        at = stored(at.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
    return at


def spelling_variants(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, typo: int = TYPO, round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    ``form`` is the most frequent near word (ties: the first in code-point order) if it occurs at least twice as often
    as the word, ``root`` the last word of the chain of forms."""
    words = stored(vocabulary(docs, min_chars, min_count, typo), "vocabulary")
    pairs = stored(near_pairs(words, round_bytes), "near-words")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = F.min(F.struct((-F.col("other_n")).alias("least"), "other"))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("_best"))
    told = words.join(near, "word", "left")
    enough = -F.col("_best.least") >= 2 * F.col("n")
    told = stored(told.select(
        "word", F.when(enough, F.col("_best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, -F.col("_best.least")).alias("form_n")), "forms")
    largest = told.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    rooted = roots(told.where("form is not null"), largest)
    return told.join(rooted, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = """
with crc_table as (
    select list(c order by i) as t from (
        select i, list_reduce(list_concat([i], [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
            lambda a, x: case when a & 1 = 1 then xor(a >> 1, 3988292384::bigint) else a >> 1 end) as c
        from (select unnest(range(256))::bigint as i))),
runs as (
    select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
    from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{C0}-\\x{FF}]+')) as run from documents)
    group by all),
hashed as (
    select run, n, xor(list_reduce(
        list_concat([4294967295::bigint], list_transform(range(1, 1 + length(h) // 2), lambda k:
            16 * (instr('0123456789ABCDEF', h[2 * k - 1]) - 1) + instr('0123456789ABCDEF', h[2 * k]) - 1)),
        lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295::bigint) as crc
    from (select run, n, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as h from runs where length(run) >= 5), crc_table),
written as (
    select case when crc % 97 = 0 then substr(run, 1, (crc % length(run))::int) || substr(run, (crc % length(run))::int + 2) else run end as word, n
    from hashed),
words as (select word, sum(n)::bigint as n from written where length(word) >= 5 group by word having sum(n) >= 3),
cuts as (
    select word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) as cut
    from (select word, n, unnest(range(1, 1 + length(word)))::int as k from words)),
pairs as (
    select c.word, w.word as other, w.n as other_n from cuts c join words w on c.cut = w.word
    union select w.word, c.word, c.n from cuts c join words w on c.cut = w.word
    union select a.word, b.word, b.n from cuts a join cuts b on a.cut = b.cut and a.k = b.k and a.word <> b.word),
ranked as (
    select word, other, other_n, count(*) over (partition by word) as n_near,
        row_number() over (partition by word order by other_n desc, encode(other)) as place
    from pairs),
forms as (
    select w.word, w.n, coalesce(r.n_near, 0)::bigint as n_near,
        case when r.other_n >= 2 * w.n then r.other end as form, case when r.other_n >= 2 * w.n then r.other_n end as form_n
    from words w left join (select * from ranked where place = 1) r using (word)),
chains as (
    with recursive chain as (
        select word, word as root, form as next from forms
        union all select c.word, f.word, f.form from chain c join forms f on c.next = f.word)
    select word, root from chain where next is null)
select word, form, root, n, n_near, form_n from forms join chains using (word)
"""
