"""Removal of repeated byte strings with suffix arrays sorted in two stages.

Every byte that lies in a string of ``LENGTH`` bytes which also starts elsewhere, in the same or another text, goes.

Windows of ``LENGTH`` bytes fall into runs by content-chosen anchors; only runs whose anchor hash occurs again are
looked at, and equal windows always meet under one anchor hash. Equal runs are merged and counted. A run without a
different one under its anchor is repeated if it was counted twice, and needs no sorting. Otherwise the different
runs of an anchor are laid end to end in blocks of bounded size, and the block's suffixes are sorted in two
stages: only the suffixes smaller than their successors are sorted directly; the others are induced by scanning
the buckets of first bytes in order. Neighbours in the suffix array with a common prefix of ``LENGTH`` bytes or
more are repeats.

Anchors with very many runs are salted into several blocks. Such blocks also report digests of their windows,
which are counted in Spark, so a repeat across blocks is found as well.

Edge cases: a null text counts as empty; texts under ``LENGTH`` bytes stay whole; each of several equal rows is a
text of its own, so their strings repeat; other columns are ignored, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentflow.llm.tables import maybe_in, partitions, sieved, stored
from commentflow.llm.windows import anchored_runs, byte_grams, covered

LENGTH = 200
GRAM = 24
#: Runs of one anchor that share a block, and the bytes of a block.
GROUP_RUNS, BLOCK_BYTES = 8192, 1 << 21
#: A byte that UTF-8 never has ends every run.
_END = 0xFF


# The suffix array of one block.

def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last, followed by nothing, is not."""
    n = len(text)
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    # Equal neighbours take the answer of the next unequal pair.
    known = np.flatnonzero(step)
    out = np.zeros(n, dtype=bool)
    if len(known):
        nxt = np.searchsorted(known, np.arange(n))
        inside = nxt < len(known)
        out[inside] = step[known[nxt[inside]]] > 0
    return out


def _packed(text: np.ndarray, depth: int) -> np.ndarray:
    """At each offset the eight bytes from there as one big-endian number, zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(depth + 8, dtype=np.uint8)])
    out = np.zeros(len(padded) - 7, dtype=np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k:len(padded) - 7 + k]
    return out


def sort_directly(at: np.ndarray, packed: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes ``at`` ordered by their first ``depth`` bytes: eight bytes at a time, ties only."""
    if not len(at):
        return at
    key = packed[at]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
    for low in range(8, depth, 8):
        tied = np.zeros(len(at), dtype=bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        where = np.flatnonzero(tied)
        if not len(where):
            break
        word = packed[at[where] + low]
        g = group[where]
        order = np.lexsort((word, g))
        at[where] = at[where][order]
        word = word[order]
        split = np.zeros(len(at), dtype=np.int64)
        split[where[1:]] = (g[1:] == g[:-1]) & (word[1:] != word[:-1])
        group = group + np.cumsum(split)
    return at


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes of ``text`` ordered by their first ``depth`` bytes at least, in two stages."""
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    packed = _packed(text, depth + 8)
    small = smaller_than_next(text)
    direct = sort_directly(np.flatnonzero(small), packed, depth)
    by_first = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[n - 1]].append(np.array([n - 1], dtype=np.int64))
    done = []

    def induce(found: np.ndarray, c: int) -> None:
        """Predecessors that are larger than their successors go to the buckets of their first bytes, in order."""
        before = found[found > 0] - 1
        before = before[text[before] > c]
        if len(before):
            first = text[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            cuts = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(before, cuts):
                waiting[text[part[0]]].append(part)

    for c in range(256):
        bucket = waiting[c]
        k = 0
        while k < len(bucket):  # runs of one byte: a suffix that starts with c c ... puts its predecessor into this bucket
            found = bucket[k]
            k += 1
            before = found[found > 0] - 1
            before = before[text[before] == c]
            if len(before):
                bucket.append(before)
        large = np.concatenate(bucket) if bucket else np.zeros(0, dtype=np.int64)
        both = np.concatenate([large, direct[by_first[c]:by_first[c + 1]]])
        waiting[c] = []
        if len(both):
            induce(both, c)
            done.append(both)
    return np.concatenate(done)


def neighbours_equal(order: np.ndarray, packed: np.ndarray, length: int) -> np.ndarray:
    """For each suffix but the first, whether it shares its first ``length`` bytes with the one before."""
    equal = np.zeros(max(0, len(order) - 1), dtype=bool)
    alive = np.arange(len(equal))
    for low in range(0, length, 8):
        a, b = packed[order[alive] + low], packed[order[alive + 1] + low]
        if low + 8 > length:
            drop = np.uint64(8 * (low + 8 - length))
            a, b = a >> drop, b >> drop
        alive = alive[a == b]
        if not len(alive):
            return equal
    equal[alive] = True
    return equal


def repeated_windows(runs: list[bytes], counts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each run a mask over its windows: those that occur twice or more in these runs, taken ``counts`` times."""
    sizes = np.array([len(r) for r in runs], dtype=np.int64)
    text = np.frombuffer(b"".join(r + bytes([_END]) for r in runs), dtype=np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    windows = np.zeros(len(text), dtype=bool)
    weight = np.zeros(len(text), dtype=np.int64)
    for b, s, c in zip(begin, sizes, counts):
        windows[b:b + s - length + 1] = True
        weight[b:b + s - length + 1] = c
    order = suffix_array(text, length)
    order = order[windows[order]]
    equal = neighbours_equal(order, _packed(text, length + 8), length)
    kind = np.concatenate([[0], np.cumsum(~equal)]) if len(order) else np.zeros(0, dtype=np.int64)
    total = np.bincount(kind, weights=weight[order]) if len(order) else np.zeros(0)
    mask = np.zeros(len(text), dtype=bool)
    mask[order] = total[kind] >= 2
    return [mask[b:b + s - length + 1] for b, s in zip(begin, sizes)]


# The Spark job.

def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, laid end to end, and the bounds of its rows; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    low, high = (int(bounds[0]), int(bounds[-1])) if len(bounds) else (0, 0)
    return data[low:high], bounds - low


def _row_key():
    return F.xxhash64("doc_id", "text")


def _anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """anchor, row_key, first, n of every run of windows."""

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                keys = np.asarray(part.column(0))
                data, bounds = _buffers(part.column(1))
                for text, first, n, anchor in anchored_runs(byte_grams(data, gram), bounds, length, gram):
                    yield pa.record_batch(
                        [pa.array(anchor), pa.array(keys[text]), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
                        names=["anchor", "row_key", "first", "n"])

    return docs.select(_row_key().alias("row_key"), "text").mapInArrow(run, "anchor bigint, row_key bigint, first int, n int")


def _runs(docs: DataFrame, length: int, gram: int, group_runs: int) -> DataFrame:
    """anchor, salt, salted, row_key, first, n (windows), d1, d2 (digest) and bytes of each run whose anchor occurs twice."""
    anchors = _anchors(docs, length, gram)
    again = stored(anchors.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1"), "anchors")
    found = sieved(anchors, "anchor", again.select("anchor")).join(again, "anchor")
    wanted = stored(found.groupBy("row_key").agg(F.collect_set(F.struct("anchor", "times", "first", "n")).alias("runs")), "wanted-runs")
    texts = sieved(docs.select(_row_key().alias("row_key"), "text"), "row_key", wanted.select("row_key")).join(wanted, "row_key")

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                rows = []
                for key, text, runs in zip(*(c.to_pylist() for c in batch.slice(k, 64).columns)):
                    data = (text or "").encode("utf-8")
                    for r in runs:
                        piece = data[r["first"]:r["first"] + r["n"] + length - 1]
                        digest = xxhash.xxh3_128_intdigest(piece)
                        high, low = digest >> 64, digest & 0xFFFFFFFFFFFFFFFF
                        salts = -(-r["times"] // group_runs)
                        rows.append((r["anchor"], low % salts, salts > 1, key, r["first"], r["n"], _signed(high), _signed(low), piece))
                        if len(rows) >= 4096:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    return texts.select("row_key", "text", "runs").mapInArrow(run, ", ".join(f"{n} {t}" for n, t, _ in _RUN_FIELDS))


_RUN_FIELDS = (
    ("anchor", "bigint", pa.int64()), ("salt", "int", pa.int32()), ("salted", "boolean", pa.bool_()), ("row_key", "bigint", pa.int64()),
    ("first", "int", pa.int32()), ("n", "int", pa.int32()), ("d1", "bigint", pa.int64()), ("d2", "bigint", pa.int64()), ("bytes", "binary", pa.binary()))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, (_, _, t) in zip(zip(*rows), _RUN_FIELDS)], names=[n for n, _, _ in _RUN_FIELDS])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _spans(mask: np.ndarray) -> list[int]:
    """Starts and ends of the true stretches, one after another."""
    edges = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edges).tolist()


_FOUND = "d1 bigint, d2 bigint, spans array<int>, window binary, at int, known boolean"


def _judge(distinct: DataFrame, length: int) -> DataFrame:
    """For each different run the spans of its repeated windows; salted blocks also report digests of windows.

    Rows with ``window`` null are verdicts; the others are a window of a salted block, known to be repeated or not."""
    dealt = distinct.repartition(partitions(distinct.sparkSession), "anchor", "salt").sortWithinPartitions("anchor", "salt", "d1", "d2")

    def run(batches):
        block: list[tuple] = []  # whole groups (anchor, salt) up to the size of a block, then the open group
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if block and row[:2] != block[-1][:2] and size >= BLOCK_BYTES:
                    yield from judged(block)
                    block, size = [], 0
                block.append(row)
                size += len(row[5])
        yield from judged(block)

    def judged(block):
        # Runs without a different one under their anchor have their verdict already; the others are sorted together.
        alone: dict[tuple, int] = {}
        for row in block:
            alone[row[:2]] = alone.get(row[:2], 0) + 1
        masks: list[np.ndarray | None] = [None] * len(block)
        many = [k for k, row in enumerate(block) if alone[row[:2]] > 1]
        for k, mask in zip(many, repeated_windows([block[k][5] for k in many], [block[k][6] for k in many], length) if many else ()):
            masks[k] = mask
        out, told = [], set()
        for row, mask in zip(block, masks):
            if mask is None and not row[2]:
                continue
            if mask is None:
                mask = np.full(len(row[5]) - length + 1, row[6] > 1)
            if mask.any():
                out.append((row[3], row[4], _spans(mask), None, None, None))
            if row[2]:
                data = row[5]
                for s, known in enumerate(mask.tolist()):
                    window = xxhash.xxh3_128_digest(data[s:s + length])
                    if not known or window not in told:  # of windows known to repeat, one for the block will do
                        told.add(window)
                        out.append((row[3], row[4], None, window, s, known))
            if len(out) >= 4096:
                yield found(out)
                out = []
        if out:
            yield found(out)

    def found(out):
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.int32(), pa.bool_())
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["d1", "d2", "spans", "window", "at", "known"])

    return dealt.select("anchor", "salt", "salted", "d1", "d2", "bytes", "times").mapInArrow(run, _FOUND)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_runs: int = GROUP_RUNS) -> DataFrame:
    """row_key and spans (flat start, end, start, ...; in bytes, may overlap) of the repeated strings of each text."""
    runs = stored(_runs(docs, length, gram, group_runs), "runs")
    # One narrow row for each block tells whether it holds different runs; the bytes of others stay where they are.
    ends = [f(c).alias(f"{name}_{c}") for c in ("d1", "d2") for name, f in (("low", F.min), ("high", F.max))]
    kinds = stored(
        runs.groupBy("anchor", "salt", "salted").agg(*ends, F.count("*").alias("times"), F.max("n").alias("n")), "kinds")
    differ = F.col("salted") | (F.col("low_d1") != F.col("high_d1")) | (F.col("low_d2") != F.col("high_d2"))
    lone = kinds.where(~differ & (F.col("times") > 1)).select(
        F.col("low_d1").alias("d1"), F.col("low_d2").alias("d2"), F.array(F.lit(0), F.col("n")).alias("spans"))
    block = F.xxhash64("anchor", "salt")
    mixed = sieved(runs.withColumn("block", block), "block", kinds.where(differ).select(block.alias("block")))
    distinct = mixed.groupBy("anchor", "salt", "salted", "d1", "d2").agg(F.count("*").alias("times"), F.first("bytes").alias("bytes"))
    found = stored(_judge(distinct, length), "verdicts")
    # Windows of salted blocks: repeated if another run of any block holds them too.
    loose = found.where("window is not null")
    twice = loose.groupBy("window").agg(F.count("*").alias("n")).where("n > 1")
    extra = loose.where("not known").join(twice, "window", "left_semi").select("d1", "d2", F.array("at", F.col("at") + 1).alias("spans"))
    verdicts = found.where("window is null").select("d1", "d2", "spans").unionByName(lone).unionByName(extra)
    placed = runs.select("d1", "d2", "row_key", "first").join(verdicts, ["d1", "d2"])
    # A window that starts at s covers s, ..., s + length - 1.
    moved = F.transform("spans", lambda x, i: x + F.col("first") + F.when(i % 2 == 1, F.lit(length - 1)).otherwise(0))
    return placed.select("row_key", moved.alias("spans")).groupBy("row_key").agg(
        F.flatten(F.collect_list("spans")).alias("spans"))


def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """The rows with the spans of their row_key, null for none; texts that have none are not moved."""
    told = maybe_in(rows, "row_key", spans.select("row_key"), "_maybe")
    whole = told.where("not _maybe").withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    return whole.unionByName(told.where("_maybe").join(spans, "row_key", "left")).drop("_maybe")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_runs: int = GROUP_RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept, the remaining bytes, of every text."""
    spans = stored(repeated_spans(docs, length, gram, group_runs), "spans")
    rows = with_spans(docs.select("doc_id", _row_key().alias("row_key"), "text"), spans).select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                n_bytes, removed, n_spans, digests, rest = [], [], [], [], []
                for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    data = (text or "").encode("utf-8")
                    union = covered(list(zip(spans[::2], spans[1::2]))) if spans else []
                    kept, at = [], 0
                    for low, high in union:
                        kept.append(data[at:low])
                        at = high
                    kept.append(data[at:])
                    left = b"".join(kept)
                    n_bytes.append(len(data))
                    removed.append(len(data) - len(left))
                    n_spans.append(len(union))
                    digests.append(hashlib.sha256(left).hexdigest())
                    rest.append(left)
                yield pa.record_batch(
                    [part.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                     pa.array(digests, pa.string()), pa.array(rest, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
