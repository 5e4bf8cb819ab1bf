"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are taken over whole texts. Two fingerprints within four bits of each other agree on at least two of
six bit fields, so every pair meets in one of fifteen tables keyed by two fields. Inside a table the members of a
key are compared in slices: the 64 bit planes of a run of fingerprints are stored vertically, one machine word
holds one bit of 64 fingerprints, the planes of a run and of the run moved by ``d`` rows are combined by exclusive
or, and a carry-save counter adds them up for 64 pairs at once. Blocks of 64 pairs are abandoned as soon as all
exceed the radius.

Equal fingerprints are one class from the start. A key with many classes is cut into chunks, and the pairs of
chunks are spread over tasks. A task reports links that span the groups it finds, not all pairs. Components
follow from joins.

Edge cases: a null or empty text has fingerprint zero and is linked like any other; a null doc_id is never a
component's name unless all of them are null; repeated rows are one class; other columns are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentflow.llm.graph import components
from commentflow.llm.tables import fresh, partitions, stored

SHINGLE_WORDS = 4
RADIUS = 4
XXH_SEED = 42
#: Six bit fields, of which two must agree, and the classes of one key that are compared in one piece.
FIELDS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
CHUNK = 1024

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_TALLY = 1 << 14


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 values of the word shingles of a text lower-cased in A-Z; 0 without words."""
    words = _WORD.findall((text or "").translate(_ASCII_LOWER))
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) < size:
        values = [hashed(" ".join(words), XXH_SEED)]
    else:
        values = [hashed(" ".join(words[k:k + size]), XXH_SEED) for k in range(len(words) - size + 1)]
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(values), _TALLY):
        part = np.array(values[k:k + _TALLY], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, row_key (a hash of doc_id and text), fp (the 64 bits as a signed number) of every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = np.array([fingerprint(t, size) for t in batch.column(2).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out)], names=["doc_id", "row_key", "fp"])

    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, row_key bigint, fp bigint")


def _planes(fps: np.ndarray) -> np.ndarray:
    """Row b holds bit b of all fingerprints, 64 to a word, with one empty word after the last."""
    words = -(-len(fps) // 64) + 1
    bits = np.zeros((words * 64, 8), dtype=np.uint8)
    bits[:len(fps)] = fps.astype("<u8").view(np.uint8).reshape(-1, 8)
    flat = np.unpackbits(bits, axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(flat.T), axis=1, bitorder="little").view("<u8")


def _moved(planes: np.ndarray, at: np.ndarray, d: int) -> np.ndarray:
    """The words ``at`` of the planes after moving all rows down by ``d`` places."""
    word, bit = divmod(d, 64)
    last = planes.shape[-1] - 1
    low = planes[..., np.minimum(at + word, last)]
    if not bit:
        return low
    high = planes[..., np.minimum(at + word + 1, last)]
    return (low >> np.uint64(bit)) | (high << np.uint64(64 - bit))


def bit_sliced(fps: np.ndarray, ends: np.ndarray, radius: int = RADIUS):
    """Pairs (i, j) of rows, i < j < ends[i], whose fingerprints differ in ``radius`` bits or fewer, by growing j - i.

    ``ends[i]`` is the end of the run of rows that row i is compared with. ``radius`` is below 32."""
    n = len(fps)
    if n < 2:
        return
    planes = _planes(fps)
    width = ends - np.arange(n)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    lanes = np.zeros(planes.shape[1] * 64, dtype=np.uint8)
    for d in range(1, int(width.max())):
        lanes[:n] = width > d
        alive = np.packbits(lanes, bitorder="little").view("<u8")
        at = np.flatnonzero(alive)
        if not len(at):
            return
        over = ~alive[at]
        tally = [np.zeros(len(at), dtype=np.uint64) for _ in range(max(3, (radius + 1).bit_length()))]
        for b in range(64):
            x = planes[b, at] ^ _moved(planes[b], at, d)
            for plane in tally:
                carry = plane & x
                plane ^= x
                x = carry
            over |= x
            if b % 8 == 7 and b < 63:
                live = (over | _beyond(tally, radius)) != full
                if not live.all():
                    at, over, tally = at[live], over[live], [plane[live] for plane in tally]
                    if not len(at):
                        break
        if len(at):
            hit = ~(over | _beyond(tally, radius))
            if hit.any():
                bits = np.unpackbits(hit.view(np.uint8), bitorder="little").reshape(-1, 64)
                rows, columns = np.nonzero(bits)
                i = at[rows] * 64 + columns
                yield i, i + d


def _beyond(tally, radius):
    """Lanes whose counter, given by its bit planes from the lowest, is above the radius."""
    above, same = np.zeros_like(tally[0]), np.full_like(tally[0], 0xFFFFFFFFFFFFFFFF)
    for k, plane in reversed(list(enumerate(tally))):
        if radius >> k & 1:
            same = same & plane
        else:
            above |= same & plane
            same = same & ~plane
    return above


def _spanning(fps: np.ndarray, groups: np.ndarray, ends: np.ndarray, radius: int):
    """Links (i, j) that span the same groups as all the near pairs of these rows; i is the least row of the group."""
    label = np.arange(len(fps))

    def merge(i, j):
        nonlocal label
        while True:
            a, b = label[i], label[j]
            differ = a != b
            if not differ.any():
                return
            np.minimum.at(label, np.maximum(a[differ], b[differ]), np.minimum(a[differ], b[differ]))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up

    left, right, held = [], [], 0
    for i, j in bit_sliced(fps, ends, radius):
        left.append(i)
        right.append(j)
        held += len(i)
        if held > 1 << 16:
            merge(np.concatenate(left), np.concatenate(right))
            left, right, held = [], [], 0
    if held:
        merge(np.concatenate(left), np.concatenate(right))
    j = np.flatnonzero(label != np.arange(len(fps)))
    return label[j], j


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) of fingerprints from distinct ``classes(fp)`` that span all groups of near fingerprints."""
    spark = classes.sparkSession

    def field(k: int):
        start, size = FIELDS[k]
        return F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << size) - 1))

    keys = F.array(*[
        F.lit(t << 22).cast("bigint") + field(a) * F.lit(1 << FIELDS[b][1]) + field(b)
        for t, (a, b) in enumerate(combinations(range(len(FIELDS)), 2))])
    keyed = classes.select("fp", F.explode(keys).alias("key"))
    # Chunks of a key: every pair of chunks becomes a group of its own; nearly all keys have one chunk.
    sizes = keyed.groupBy("key").count().where(F.col("count") > 1)
    counted = keyed.join(sizes, "key").withColumn("n", F.ceil(F.col("count") / CHUNK).cast("int"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    met = counted.withColumn("c", chunk).select(
        "key", "fp", "c", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("o")).select(
            "key", F.least("c", "o").alias("x"), F.greatest("c", "o").alias("y"), "fp")
    dealt = met.repartition(partitions(spark), "key", "x", "y").sortWithinPartitions("key", "x", "y", "fp")

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.concat_batches([*held, batch]) if held else batch
            code = _codes(table)
            start = int(np.flatnonzero(code == code[-1])[0])  # the last group may go on in the next batch
            if start:
                yield from found(table.slice(0, start), code[:start])
            held = [table.slice(start)]
        if held:
            yield from found(held[0], _codes(held[0]))

    def found(table, code):
        fps = np.asarray(table.column("fp")).view(np.uint64)
        last = np.append(np.flatnonzero(np.diff(code)), len(code) - 1)
        ends = last[np.searchsorted(last, np.arange(len(code)))] + 1
        i, j = _spanning(fps, code, ends, radius)
        yield pa.record_batch([pa.array(fps[i].view(np.int64)), pa.array(fps[j].view(np.int64))], names=["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _codes(table: pa.RecordBatch) -> np.ndarray:
    """A number for each row that changes where the group (key, x, y) changes."""
    change = np.zeros(table.num_rows, dtype=bool)
    for name in ("key", "x", "y"):
        values = np.asarray(table.column(name))
        change[1:] |= values[1:] != values[:-1]
    return np.cumsum(change)


def near_classes(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, row_key, fp, root, component_id for each input row; root is the same within a component only."""
    signed = stored(fingerprints(docs), "simhash")
    classes = stored(signed.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    near = stored(links(classes.select("fp"), radius), "simhash-links")
    named = components(near)
    grouped = classes.join(named, classes["fp"] == named["node"], "left").select("fp", "rep", F.coalesce("component", "fp").alias("root"))
    best = grouped.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_class = stored(grouped.join(best, "root").select("fp", "root", "component_id"), "simhash-components")
    return signed.join(of_class, "fp").select("doc_id", "row_key", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the least doc_id reachable, of every document."""
    return near_classes(docs, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of the input, with all their columns, that stay: of each component one with the least doc_id."""
    key, = fresh(docs, "row_key")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    stay = near_classes(docs, radius).groupBy("root").agg(F.min(first).alias("_f")).select(F.col("_f.row_key").alias(key))
    return docs.withColumn(key, F.xxhash64("doc_id", "text")).join(stay, key, "left_semi").dropDuplicates([key]).drop(key)
