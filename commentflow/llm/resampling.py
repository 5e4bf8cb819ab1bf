"""Importance resampling of documents towards a target text distribution by hashed word n-grams.

A 256-byte table lower-cases A-Z and blanks every separator of a UTF-8 text, ``bytes.split`` gives the words. The
CRC-32 of a word seeds that of the next, so all n-grams of a text take one chained call a level; counters reduce
them to distinct features, whose CRC-32 modulo the number of buckets is their bucket. A bucket's gain is the log
ratio of its smoothed shares in the target and the corpus; a document weighs the mean gain of its features. Gumbel
noise from a hash of the id makes the highest scores a draw without replacement in proportion to exp(weight).

Tasks keep one vector of buckets; only these vectors, and later one narrow row for each document, are shuffled. The
driver holds the two vectors of ``buckets`` numbers. Ranks come from range-partitioned blocks, so no task sorts all.

Edge cases: a null or empty text has no feature, weight 0 and a score, but is never drawn; texts are worked off in
pieces cut at blanks, so their length is not bounded; a null doc_id is hashed like an empty one and comes first
among ties; repeated rows are ranked each; other columns are ignored, whatever their names; without target texts all
gains follow from the smoothing alone; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentflow.llm.tables import fresh, partitions, stored
from commentflow.operators.ranking import BLOCK_ROWS, with_rank

BUCKETS = 10_000
MAX_WORDS = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
SCALE = 1000
#: Bytes of a text worked off at a time, and distinct features a task holds before it adds them to its vector.
PIECE, HELD = 1 << 20, 1 << 18


def _table() -> bytes:
    table = bytearray(b" " * 128) + bytes(range(128, 256))
    for first, last in (b"09", b"az"):
        table[first:last + 1] = bytes(range(first, last + 1))
    table[ord("A"):ord("Z") + 1] = b"abcdefghijklmnopqrstuvwxyz"
    return bytes(table)


TABLE = _table()


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, in pieces."""
    at = 0
    while at < len(data):
        stop = at + PIECE
        while stop < len(data) and TABLE[data[stop]] != 0x20:  # only a blank ends a piece
            stop += 1
        yield data[at:stop].translate(TABLE).split()
        at = stop


def count_features(data: bytes, max_words: int, counts: Counter) -> int:
    """Add the CRC-32s of all runs of 1 to ``max_words`` words to the counts; the number of words."""
    n_words, carried = 0, []
    for words in _words(data):
        n_words += len(words)
        seeds = list(map(crc32, words))
        counts.update(seeds)
        if max_words > 1:
            # Runs that begin in the piece before end in this one.
            words = carried + words
            seeds = list(map(crc32, words))
            follow = [b" " + w for w in words]
            for size in range(2, max_words + 1):
                seeds = list(map(crc32, follow[size - 1:], seeds))
                counts.update(seeds[max(0, len(carried) - size + 1):])
            carried = words[-(max_words - 1):]
    return n_words


def _vector(counts: Counter, buckets: int) -> np.ndarray:
    crcs = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
    times = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
    out = np.zeros(buckets, dtype=np.int64)
    np.add.at(out, crcs % buckets, times)
    return out


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> DataFrame:
    """(bucket, n) over all rows of a table with a column text."""

    def run(batches):
        total, counts = np.zeros(buckets, dtype=np.int64), Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                count_features(text.as_py() or b"", max_words, counts)
                if len(counts) > HELD:
                    total += _vector(counts, buckets)
                    counts.clear()
        total += _vector(counts, buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Scaled log ratio of each bucket's smoothed share in the target and in the corpus, rounded down."""
    size = len(corpus)
    s_all, t_all = float(corpus.sum() + size), float(target.sum() + size)
    return np.array(
        [math.floor(scale * math.log(float(t + 1) * s_all / (float(s + 1) * t_all))) for s, t in zip(corpus.tolist(), target.tolist())],
        dtype=np.int64)


def noise(doc_id: str | None, seed: int = SEED, scale: int = SCALE) -> int:
    """Gumbel noise from a hash of the id, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, max_words: int = MAX_WORDS, seed: int = SEED, scale: int = SCALE) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # a number for each bucket

    def run(batches):
        gain = shared.value
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                rows = []
                for name, text in zip(part.column(1).to_pylist(), part.column(2).cast(pa.binary())):
                    counts: Counter = Counter()
                    n_words = count_features(text.as_py() or b"", max_words, counts)
                    n = counts.total()
                    weight = 0
                    if n:
                        crcs = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
                        times = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
                        weight = int(gain[crcs % len(gain)] @ times) // n
                    rows.append((n_words, n, weight, weight + noise(name, seed, scale)))
                yield pa.record_batch(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in zip(*rows))],
                    names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select("doc_id", F.col("doc_id").cast("string").alias("name"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint, score bigint")


def _collected(counted: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, dtype=np.int64)
    for row in counted.collect():  # at most one row for each bucket
        out[row["bucket"]] = row["n"]
    return out


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS,
    max_words: int = MAX_WORDS, seed: int = SEED, scale: int = SCALE,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank, which is null for rows that are not drawn.

    ``percent`` of the rows with ``min_words`` words or more are drawn, those with the highest scores."""
    gain = gains(*(_collected(bucket_counts(t, buckets, max_words), buckets) for t in (docs, target)), scale)
    rows = stored(scored(docs, gain, max_words, seed, scale), "scores")
    enough = rows.where(F.col("n_words") >= min_words)
    n = enough.count()
    # As many blocks as there are shuffle partitions, more where blocks would grow beyond the usual size.
    blocks = max(partitions(docs.sparkSession), -(-n // BLOCK_ROWS))
    ranked = with_rank(enough, (), [F.desc("score"), F.asc_nulls_first("doc_id")], out="rank", block_rows=max(1, -(-n // blocks)))
    drawn = ranked.withColumn("rank", F.when(F.col("rank") < n * percent // 100, F.col("rank") + 1))
    rest = rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return drawn.unionByName(rest)


def drawn(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of the input, with all their columns, whose doc_id is drawn."""
    name, = fresh(docs, "drawn")
    taken = resample(docs, target, **settings).where("rank is not null").select(F.col("doc_id").alias(name))
    return docs.join(taken, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")


#: CRC-32 by a table made from its polynomial, over the bytes of each distinct word.
SQL = """
with crc_table as (
    select list(c order by i) as t from (
        select i, list_reduce(list_concat([i], [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
            lambda a, x: case when a & 1 = 1 then xor(a >> 1, 3988292384::bigint) else a >> 1 end) as c
        from (select unnest(range(256))::bigint as i))),
texts as (
    select 'd' as side, row_number() over () as r, doc_id, coalesce(text, '') as text from documents
    union all select 'b', 0, null, coalesce(text, '') from benchmark),
words as (
    select side, r, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as w
    from texts),
distinct_words as (select distinct w from words),
buckets as (
    select w, xor(list_reduce(
        list_concat([4294967295::bigint], list_transform(range(1, 1 + length(h) // 2), lambda k:
            16 * (instr('0123456789ABCDEF', h[2 * k - 1]) - 1) + instr('0123456789ABCDEF', h[2 * k]) - 1)),
        lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295::bigint) % 10000 as bucket
    from (select w, hex(encode(w)) as h from distinct_words), crc_table),
counted as (
    select bucket, count(*) filter (where side = 'd') as s, count(*) filter (where side = 'b') as t
    from words join buckets using (w) group by bucket),
totals as (select coalesce(sum(s), 0) as s_all, coalesce(sum(t), 0) as t_all from counted),
gains as (
    select bucket, floor(1000 * ln((t + 1)::double * (s_all + 10000)::double / ((s + 1)::double * (t_all + 10000)::double)))::bigint as gain
    from counted, totals),
weighed as (
    select r, count(*) as n, floor(sum(gain)::double / count(*))::bigint as weight
    from words join buckets using (w) join gains using (bucket) where side = 'd' group by r),
scored as (
    select d.r, d.doc_id, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(d.doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
    from (select r, doc_id from texts where side = 'd') d left join weighed using (r)),
ranked as (
    select r, row_number() over (order by score desc, doc_id nulls first) as k, count(*) over () as n from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when k <= 10 * n // 100 then k end as rank
from scored left join ranked using (r)
"""
