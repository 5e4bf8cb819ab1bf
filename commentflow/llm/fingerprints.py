"""Document fingerprints: MinHash over word shingles.

A fingerprint holds, for each of many universal hash permutations, the least value over the shingles of a whole
text. Tasks compute them in numpy from Arrow batches. Bands of a fingerprint are joined in Spark to find near
pairs, and the pairs are verified by the Jaccard coefficient of their shingles.

Edge cases: a null text counts as empty; all texts without words share one fingerprint, unlike any other; a text
shorter than a shingle has one shingle, all its words. Rows with equal doc_id are ordered by text. A null doc_id
comes last. Repeated rows give repeated results; other columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentflow.llm.tables import partitions, stored
from commentflow.llm.wordhash import shingles, word_bounds, word_hashes

SHINGLE_WORDS = 5
PERMUTATIONS = 128
BAND_ROWS = 4
MIN_JACCARD = 0.8
SEED = 11
#: Shingles put through all permutations at once.
_BLOCK = 2048
EMPTY = 0xFFFF


class MinHash:
    """Signatures of ``permutations`` 16-bit minima; multiply-add-shift hashing with odd seeded multipliers."""

    def __init__(self, permutations: int = PERMUTATIONS, size: int = SHINGLE_WORDS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.size = size
        self.a = (rng.integers(0, 1 << 63, permutations, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.b = rng.integers(0, 1 << 63, permutations, dtype=np.uint64)
        self.n = permutations

    def shingles(self, data: bytes) -> np.ndarray:
        array = np.frombuffer(data, dtype=np.uint8)
        starts, ends = word_bounds(array)
        return shingles(word_hashes(array, starts, ends), self.size)

    def signature(self, data: bytes) -> np.ndarray:
        """The minima of the permuted shingles, reduced to 16 bits; all ones for a text without words."""
        return self.minima(self.shingles(data))

    def minima(self, x: np.ndarray) -> np.ndarray:
        least = np.full(self.n, np.iinfo(np.uint64).max, dtype=np.uint64)
        for k in range(0, len(x), _BLOCK):
            values = self.a[:, None] * x[None, k:k + _BLOCK]
            values += self.b[:, None]
            np.minimum(least, values.min(axis=1), out=least)
        if not len(x):
            return np.full(self.n, EMPTY, dtype=np.uint16)
        out = ((least ^ (least >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.uint16)
        out[out == EMPTY] = EMPTY - 1
        return out


def text_of(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.count_nonzero(a == b)) / len(a)


def fingerprints(docs: DataFrame, hasher: MinHash | None = None) -> DataFrame:
    """doc_id and fingerprint (four hex digits for each permutation) of every whole text."""
    made = hasher or MinHash()

    def run(batches):
        for batch in batches:
            out = [text_of(made.signature((t or "").encode("utf-8"))) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint string")


def _with_next(docs: DataFrame, groups: int) -> DataFrame:
    """Rows (grp, tail, doc_id, text) dealt so that each group holds a run of documents by descending id, and after
    its last row, marked as tail, the document that follows it.

    Only ids are read to find the borders: quantiles first, then the largest id of each group."""
    steps = [k / groups for k in range(1, groups)] or [0.5]
    found = docs.agg(F.percentile_approx("doc_id", steps, 10 * groups).alias("q")).first()["q"] if groups > 1 else None
    borders = np.unique(np.asarray(found or [], dtype=np.float64))

    @F.pandas_udf("int")
    def group_of(ids: pd.Series) -> pd.Series:
        values = ids.to_numpy(dtype=np.float64, na_value=-np.inf)
        group = len(borders) - np.searchsorted(borders, values, side="left")
        return pd.Series(np.where(np.isneginf(values), len(borders) + 1, group).astype(np.int32))

    heads = stored(
        docs.select("doc_id", group_of("doc_id").alias("grp")).groupBy("grp").agg(F.max("doc_id").alias("doc_id")), "heads")
    # One row for each group, at most as many as were asked for, so this table may be sent to every task.
    before = heads.selectExpr(
        "doc_id as _head", "coalesce(lag(grp) over (order by grp), max(grp) over ()) as _before")
    rows = docs.join(F.broadcast(before), F.col("doc_id").eqNullSafe(F.col("_head")), "left")
    places = F.array_compact(F.array(
        F.struct(group_of("doc_id").alias("grp"), F.lit(False).alias("tail")),
        F.when(F.col("_before").isNotNull(), F.struct(F.col("_before").alias("grp"), F.lit(True).alias("tail")))))
    dealt = rows.select("doc_id", "text", F.explode(places).alias("_p")).select("_p.grp", "_p.tail", "doc_id", "text")
    return dealt.repartition(groups, "grp").sortWithinPartitions(
        "grp", "tail", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_last())


def edited_fingerprints(docs: DataFrame, hasher: MinHash | None = None, groups: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document's, compared.

    The edited text has its last third of code points replaced by as many first ones of the next document by
    descending doc_id, or all it has; after the last document comes the first."""
    made = hasher or MinHash()
    table = _with_next(docs.select("doc_id", "text"), groups or 4 * partitions(docs.sparkSession))

    def run(batches):
        before = None  # the row that still needs its next document
        out: list[tuple] = []
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                for grp, tail, doc_id, text in zip(*(part.column(j).to_pylist() for j in range(4))):
                    text = text or ""
                    sign = made.signature(text.encode("utf-8"))
                    if before is not None and before[0] == grp:
                        out.append(compared(before, text, sign))
                    before = None if tail else (grp, doc_id, text, sign)
                if len(out) >= 512:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    def compared(row, next_text, next_sign):
        _, doc_id, text, sign = row
        third = len(text) // 3
        edited = (text[:len(text) - third] + next_text[:third]).encode("utf-8")
        edited_sign = made.signature(edited)
        return (doc_id, len(text), hashlib.sha256(edited).hexdigest(), text_of(sign), text_of(edited_sign),
                likeness(sign, edited_sign), likeness(sign, next_sign))

    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
              ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    id_type = pa.int32() if kind == "int" else pa.string() if kind == "string" else pa.int64()

    def batch_of(rows):
        columns = list(zip(*rows))
        return pa.record_batch(
            [pa.array(columns[0], id_type), *(pa.array(c, t) for c, (_, t) in zip(columns[1:], fields))],
            names=["doc_id", *(n for n, _ in fields)])

    return table.mapInArrow(run, (
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"))


def near_pairs(docs: DataFrame, least: float = MIN_JACCARD, hasher: MinHash | None = None) -> tuple[DataFrame, DataFrame]:
    """Near-duplicate pairs between classes of equal fingerprints, and the class of every document.

    Returns ``pairs(a, b, jaccard)`` with a < b and ``members(doc_id, class_id)``; a class is named by its least
    doc_id. Bands of equal minima are joined; a pair of classes counts where it first meets, and is kept if the
    Jaccard coefficient of the two texts' shingles reaches ``least``."""
    made = hasher or MinHash()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids, prints, sets = part.column(0), [], []
                for t in part.column(1).to_pylist():
                    data = (t or "").encode("utf-8")
                    prints.append(text_of(made.signature(data)))
                    sets.append(np.unique(made.shingles(data)).view(np.int64))
                yield pa.record_batch(
                    [ids, pa.array(prints, pa.string()), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "fingerprint", "grams"])

    signed = stored(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint string, grams array<bigint>"), "signed")
    classes = stored(signed.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id"), F.min_by("grams", "doc_id").alias("grams")), "classes")
    width = 4 * BAND_ROWS
    bands = F.transform(F.sequence(F.lit(0), F.lit(made.n // BAND_ROWS - 1)), lambda k: F.substring(F.col("fingerprint"), k * width + 1, F.lit(width)))
    banded = classes.select("class_id", bands.alias("bands"), F.posexplode(bands).alias("band", "key"))
    one = banded.select(F.col("class_id").alias("a"), F.col("bands").alias("abands"), "band", "key")
    two = banded.select(F.col("class_id").alias("b"), F.col("bands").alias("bbands"), "band", "key")
    met = one.join(two, ["band", "key"]).where("a < b").where(
        F.get(F.filter(F.transform(F.arrays_zip("abands", "bbands"), lambda z, i: F.when(z["abands"] == z["bbands"], i)), lambda x: x.isNotNull()), F.lit(0)) == F.col("band"))
    grams = classes.select("class_id", "grams")
    both = met.select("a", "b").join(grams.toDF("a", "ga"), "a").join(grams.toDF("b", "gb"), "b")
    shared = F.size(F.array_intersect("ga", "gb"))
    pairs = both.select("a", "b", (shared / F.nullif(F.size("ga") + F.size("gb") - shared, F.lit(0))).alias("jaccard")).where(F.col("jaccard") >= least)
    members = signed.join(classes.select("fingerprint", "class_id"), "fingerprint").select("doc_id", "class_id")
    return pairs, members
