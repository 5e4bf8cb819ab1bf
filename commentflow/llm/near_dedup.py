"""Near-duplicate documents by the Jaccard likeness of five-word shingles, compared as bit-sliced SimHashes.

Two texts are linked if their sets of word shingles, lower-cased in A-Z, are alike by ``MIN_JACCARD`` or more.
Texts with equal sets are one class. Classes that share a band of MinHash minima are put together by joins: at a
likeness of 0.8, one pair in twenty thousand shares none of the 25 bands, and fewer the more alike they are. (Bit
fields of a SimHash would need more than a hundred tables to bring 99 of 100 such pairs together.) The classes of
one band are compared in chunks of bounded size: their 64-bit SimHashes of the same shingles bit-sliced with a radius
of 26, where pairs at 0.8 differ in about ten bits, and of the pairs left the four low bits of all 250 minima. Pairs at
0.8 agree in about 203 of them, give or take six; ``LEAST_SAME`` of 174 misses few in a million, while of pairs at 0.5,
such as pages of one template, fewer than one in a million get so far. Only classes joined by such pairs form a group.
Inside a group SimHashes are compared again and what is left is verified by the Jaccard coefficient of the whole sets.
A pair is not verified if earlier links already join it, so the copies of one text are not compared all with all.
Texts move for the classes of such groups only; what moves for a band is 160 bytes a class.

Edge cases: null and empty texts, and all others without words, are one class; a text shorter than a shingle has one
shingle, all its words; a null doc_id is kept only where its whole component has none; repeated rows count once;
other columns pass through, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentflow.llm.fingerprints import MinHash
from commentflow.llm.graph import components
from commentflow.llm.simhash import _codes, bit_sliced
from commentflow.llm.tables import fresh, partitions, sieved, stored
from commentflow.llm.wordhash import mixed

SHINGLE_WORDS = 5
MIN_JACCARD = 0.8
#: Bands of minima of which one must agree, and the minima of a band.
BANDS, BAND_ROWS = 25, 5
RADIUS = 26
#: Further minima are only compared, four bits of each; so many of all minima must agree before a text moves.
MINIMA, LEAST_SAME = 250, 174
#: Classes of one band whose SimHashes, and classes of one group whose texts are compared in one piece.
BAND_CHUNK, CHUNK = 1024, 256
_TALLY = 1 << 14


def _hasher() -> MinHash:
    return MinHash(MINIMA, SHINGLE_WORDS)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8").lower()  # bytes are lower-cased in A-Z only


def shingle_set(text: str | None, hasher: MinHash) -> np.ndarray:
    """The distinct shingle hashes of a text in ascending order."""
    return np.unique(hasher.shingles(_bytes(text)))


def simhash_of(grams: np.ndarray) -> int:
    """Majority bits of shingle hashes; 0 without any."""
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(grams), _TALLY):
        part = np.ascontiguousarray(grams[k:k + _TALLY]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(grams), bitorder="little").view("<u8")[0])


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One number for each band, made from its place and its minima."""
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in signature[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).T:
        keys = mixed(keys * np.uint64(0xD6E8FEB86659FD93) + column.astype(np.uint64))
    return keys


def sketch(signature: np.ndarray) -> np.ndarray:
    """Four bits of each minimum, sixteen minima to a word; what is left of the last word is zero."""
    low = np.zeros(-(-len(signature) // 16) * 16, dtype=np.uint8)
    low[:len(signature)] = signature & 15
    return (low[::2] | low[1::2] << 4).view("<u8")


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many minima agree in each of the paired rows of two arrays of sketches."""
    x = a ^ b
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    x &= np.uint64(0x1111111111111111)
    return MINIMA - np.bitwise_count(x).sum(axis=1, dtype=np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard coefficient of two ascending sets; 1 if both are empty."""
    both = np.concatenate([a, b])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (len(both) - shared) if len(both) else 1.0


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, row_key (a hash of doc_id and text), cid (a hash of the shingle set), fp (SimHash), sketch and band keys."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = _hasher()

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                cids, fps, sketches, keys = [], [], [], []
                for text in part.column(2).to_pylist():
                    grams = shingle_set(text, made)
                    cids.append(xxhash.xxh64_intdigest(grams.tobytes()))
                    fps.append(simhash_of(grams))
                    signature = made.minima(grams)
                    sketches.append(sketch(signature).tobytes())
                    keys.append(band_keys(signature).view(np.int64) if len(grams) else np.empty(0, dtype=np.int64))
                numbers = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (cids, fps)]
                yield pa.record_batch(
                    [part.column(0), part.column(1), *numbers, pa.array(sketches, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "row_key", "cid", "fp", "sketch", "keys"])

    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, row_key bigint, cid bigint, fp bigint, sketch binary, keys array<bigint>")


def _dealt(members: DataFrame, values: list[str]) -> DataFrame:
    """(key, x, y, cid, c, values): each pair of the ``n`` chunks of a ``key`` is a group of its own, in one task."""
    chunk = F.pmod(F.xxhash64("cid"), F.col("n")).cast("int")
    spread = members.withColumn("c", chunk).select(
        "key", "cid", "c", *values, F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("o")).select(
            "key", F.least("c", "o").alias("x"), F.greatest("c", "o").alias("y"), "cid", "c", *values)
    return spread.repartition(partitions(members.sparkSession), "key", "x", "y").sortWithinPartitions("key", "x", "y", "cid")


def _spanning_links(dealt: DataFrame, rows_at_once: int, prepared) -> DataFrame:
    """Links (a, b) that span the groups of ``dealt``. ``prepared(table)`` gives ``keep(i, j)`` for its rows, which tells
    of pairs whose SimHashes are near whether they are linked; it is asked only for pairs not joined so far."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for k in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(k, rows_at_once)
                table = pa.concat_batches([*held, part]) if held else part
                code = _codes(table)
                start = int(np.flatnonzero(code == code[-1])[0])  # the last group may go on in the next batch
                if start:
                    yield found(table.slice(0, start), code[:start])
                held = [table.slice(start)]
        if held:
            yield found(held[0], _codes(held[0]))

    def found(table, code):
        cids, fps, x, y, c = (np.asarray(table.column(n)) for n in ("cid", "fp", "x", "y", "c"))
        last = np.append(np.flatnonzero(np.diff(code)), len(code) - 1)
        ends = last[np.searchsorted(last, np.arange(len(code)))] + 1
        label = np.arange(len(code))
        keep = prepared(table)
        left, right = [], []
        for i, j in bit_sliced(fps.view(np.uint64), ends, RADIUS):
            # Pairs inside a chunk belong to the piece of that chunk alone.
            own = (label[i] != label[j]) & ((x[i] == y[i]) | (c[i] != c[j]))
            for p, q in keep(i[own], j[own], label):
                if label[p] != label[q]:
                    low, high = sorted((label[p], label[q]))
                    group = slice(int(np.searchsorted(code, code[p])), int(ends[p]))
                    label[group][label[group] == high] = low
                    left.append(cids[p])
                    right.append(cids[q])
        return pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _alike(table: pa.RecordBatch):
    """Pairs whose minima agree in ``LEAST_SAME`` places or more."""
    held = b"".join(table.column(table.schema.get_field_index("sketch")).to_pylist())
    sketches = np.frombuffer(held, dtype="<u8").reshape(table.num_rows, -1)

    def keep(i, j, label):
        near = agreeing(sketches[i], sketches[j]) >= LEAST_SAME
        return zip(i[near].tolist(), j[near].tolist())

    return keep


def _groups(classes: DataFrame) -> DataFrame:
    """(cid, grp) of the classes that a chain of pairs alike by their minima joins with another class."""
    keyed = classes.select("cid", "fp", "sketch", F.explode("keys").alias("key"))
    sizes = stored(keyed.groupBy("key").count().where("count > 1").select(
        "key", F.ceil(F.col("count") / BAND_CHUNK).cast("int").alias("n")), "near-keys")
    met = sieved(keyed, "key", sizes.select("key")).join(sizes, "key")
    joined = stored(_spanning_links(_dealt(met, ["fp", "sketch"]), BAND_CHUNK, _alike), "near-candidates")
    return components(joined.distinct()).toDF("cid", "grp")


def links(docs: DataFrame, rows: DataFrame, least: float = MIN_JACCARD) -> DataFrame:
    """Links (a, b) of classes alike by ``least`` or more that span all groups of such classes."""
    one = rows.groupBy("cid").agg(*[F.min_by(F.col(c), "row_key").alias(c) for c in ("fp", "sketch", "keys")], F.min("row_key").alias("row_key"))
    classes = stored(one, "near-classes")
    grouped = stored(_groups(classes), "near-groups")
    sizes = grouped.groupBy("grp").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("n"))
    wanted = stored(classes.select("cid", "fp", "row_key").join(grouped, "cid").join(sizes, "grp").select(
        "row_key", F.col("grp").alias("key"), "cid", "fp", "n"), "near-members")
    texts = sieved(docs.select(F.xxhash64("doc_id", "text").alias("row_key"), "text"), "row_key", wanted.select("row_key"))
    # Rows with one key are repeated rows, one of them speaks for its class.
    members = texts.groupBy("row_key").agg(F.first("text").alias("text")).join(wanted, "row_key")
    made = _hasher()

    def verified(table: pa.RecordBatch):
        texts = table.column(table.schema.get_field_index("text"))
        sets: dict[int, np.ndarray] = {}

        def grams(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = shingle_set(texts[k].as_py(), made)
            return sets[k]

        def keep(i, j, label):
            for p, q in zip(i.tolist(), j.tolist()):
                if label[p] != label[q] and jaccard(grams(p), grams(q)) >= least:
                    yield p, q

        return keep

    return _spanning_links(_dealt(members, ["fp", "text"]), CHUNK, verified)


def keep_one(docs: DataFrame, least: float = MIN_JACCARD) -> DataFrame:
    """The rows of the input, with all their columns, that stay: of each component one with the least doc_id."""
    key, = fresh(docs, "row_key")
    rows = stored(signed(docs), "near-signed")
    named = components(stored(links(docs, rows, least), "near-links")).toDF("cid", "component")
    rooted = rows.select("doc_id", "row_key", "cid").join(named, "cid", "left").withColumn("root", F.coalesce("component", "cid"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    stay = rooted.groupBy("root").agg(F.min(first).alias("_f")).select(F.col("_f.row_key").alias(key))
    return docs.withColumn(key, F.xxhash64("doc_id", "text")).join(stay, key, "left_semi").dropDuplicates([key]).drop(key)
