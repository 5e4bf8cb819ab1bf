"""Removal of repeated word spans by De Bruijn compaction.

Every word that lies in a window of ``WINDOW`` words which also starts in a document with a smaller doc_id, goes.

Windows are the k-mers of a De Bruijn graph over words: a window is an edge between its first and its last k - 1
words. Consecutive k-mers that share a content-chosen anchor travel together as one run; runs whose anchor hash
occurs in one document only cannot repeat and are dropped at once. Equal runs are merged and keep the coordinates
of their least document. Where different runs share an anchor, their k-mers become rows and the least document of
each k-mer is counted.

Repeated paths are compacted by joins: if a run is always followed by the same run, and that one is always
preceded by it, both lie on one nonbranching path. Such runs lie side by side in their least document, so the
coordinates there number the paths, and a check that they do lie side by side verifies the path. Only the heads of
paths are then looked up in the documents.

Edge cases: a null text has no words; a null doc_id is neither smaller nor greater than another, so its row stays
whole and takes nothing from others; repeated rows, equal in doc_id, take nothing from each other; texts under
``WINDOW`` words stay whole; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commentflow.llm.suffix_dedup import _buffers, _signed, with_spans
from commentflow.llm.tables import sieved, stored
from commentflow.llm.windows import anchored_runs, covered
from commentflow.llm.wordhash import shingles, word_bounds, word_hashes

WINDOW = 50
GRAM = 10

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _row_key():
    return F.xxhash64("doc_id", "text")


def _anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """anchor, doc_id, row_key, first, n of every run of k-mers; positions count words."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                keys = np.asarray(part.column(1))
                data, bounds = _buffers(part.column(2))
                data = np.insert(data, bounds[1:], 10)  # words never cross rows
                bounds = bounds + np.arange(len(bounds))
                starts, ends = word_bounds(data)
                words = word_hashes(data, starts, ends)
                in_words = np.searchsorted(starts, bounds)

                def grams(p, q, words=words):
                    return shingles(words[p:q + gram - 1], gram)

                for text, first, n, anchor in anchored_runs(grams, in_words, window, gram):
                    yield pa.record_batch(
                        [pa.array(anchor), part.column(0).take(pa.array(text)), pa.array(keys[text]),
                         pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
                        names=["anchor", "doc_id", "row_key", "first", "n"])

    rows = docs.where("doc_id is not null").select("doc_id", _row_key().alias("row_key"), "text")
    return rows.mapInArrow(run, f"anchor bigint, doc_id {kind}, row_key bigint, first int, n int")


def _joined(text: bytes) -> tuple[bytes, np.ndarray]:
    """The words joined by one blank, and the offset of each word, with one more after the last."""
    words = _WORD.findall(text)
    offsets = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum([len(w) + 1 for w in words], out=offsets[1:])
    return b" ".join(words), offsets


def _runs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """anchor, row_key, doc_id, first, n, d1, d2 (digest of its words) of each run whose anchor occurs in two documents."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    anchors = _anchors(docs, window, gram)
    ends = anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    again = stored(ends.where("a < b").select("anchor"), "word-anchors")
    found = sieved(anchors, "anchor", again).join(again, "anchor", "left_semi")
    wanted = stored(found.groupBy("row_key").agg(F.collect_set(F.struct("anchor", "first", "n")).alias("runs")), "wanted-word-runs")
    keyed = sieved(docs.select(_row_key().alias("row_key"), "doc_id", "text"), "row_key", wanted.select("row_key"))
    texts = keyed.join(wanted, "row_key").select("row_key", "doc_id", "text", "runs")
    fields = [("anchor", "bigint", pa.int64()), ("row_key", "bigint", pa.int64()), ("doc_id", kind, None), ("first", "int", pa.int32()),
              ("n", "int", pa.int32()), ("d1", "bigint", pa.int64()), ("d2", "bigint", pa.int64())]

    def run(batches):
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            types = [t or id_type for _, _, t in fields]
            rows = []
            for k in range(0, batch.num_rows, 64):
                for key, doc_id, text, runs in zip(*(c.to_pylist() for c in batch.slice(k, 64).columns)):
                    line, at = _joined((text or "").encode("utf-8"))
                    for r in runs:
                        piece = line[at[r["first"]]:at[r["first"] + r["n"] + window - 1] - 1]
                        digest = xxhash.xxh3_128_intdigest(piece)
                        rows.append((r["anchor"], key, doc_id, r["first"], r["n"], _signed(digest >> 64), _signed(digest & 0xFFFFFFFFFFFFFFFF)))
                        if len(rows) >= 4096:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[f[0] for f in fields])
                            rows = []
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[f[0] for f in fields])

    return texts.mapInArrow(run, ", ".join(f"{n} {t}" for n, t, _ in fields))


def _kmers(docs: DataFrame, picked: DataFrame, window: int) -> DataFrame:
    """k1, k2 (digest), d1, d2, at and doc_id for every k-mer of the runs ``picked(row_key, runs(first, n, d1, d2))``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = sieved(docs.select(_row_key().alias("row_key"), "doc_id", "text"), "row_key", picked.select("row_key"))
    texts = keyed.join(picked, "row_key").select("doc_id", "text", "runs")

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 32):
                part = batch.slice(k, 32)
                high, low, d1, d2, places, of = [], [], [], [], [], []
                for i, (text, runs) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    line, at = _joined((text or "").encode("utf-8"))
                    at = at.tolist()
                    for r in runs:
                        for s in range(r["n"]):
                            begin = r["first"] + s
                            digest = xxhash.xxh3_128_intdigest(line[at[begin]:at[begin + window] - 1])
                            high.append(_signed(digest >> 64))
                            low.append(_signed(digest & 0xFFFFFFFFFFFFFFFF))
                            d1.append(r["d1"])
                            d2.append(r["d2"])
                            places.append(s)
                            of.append(i)
                yield pa.record_batch(
                    [pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                     pa.array(places, pa.int32()), part.column(0).take(pa.array(of, pa.int64()))],
                    names=["k1", "k2", "d1", "d2", "at", "doc_id"])

    return texts.mapInArrow(run, f"k1 bigint, k2 bigint, d1 bigint, d2 bigint, at int, doc_id {kind}")


def _sources(docs: DataFrame, runs: DataFrame, window: int) -> DataFrame:
    """For each different run its pieces: array of (at, n, doc_id), the least document that has these k-mers."""
    distinct = stored(runs.groupBy("anchor", "d1", "d2").agg(
        F.min(F.struct("doc_id", "row_key", "first", "n")).alias("src")).select("anchor", "d1", "d2", "src.*"), "distinct-runs")
    several = stored(distinct.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor"), "several-runs")
    picked = stored(distinct.join(several, "anchor", "left_semi").groupBy("row_key").agg(
        F.collect_list(F.struct("first", "n", "d1", "d2")).alias("runs")), "picked-runs")
    edges = _kmers(docs, picked, window)
    least = edges.groupBy("k1", "k2").agg(F.min("doc_id").alias("source"))
    judged = edges.join(least, ["k1", "k2"]).groupBy("d1", "d2").agg(
        F.collect_list(F.struct("at", F.lit(1).alias("n"), F.col("source").alias("doc_id"))).alias("pieces"))
    alone = distinct.join(several, "anchor", "left_anti").select(
        "d1", "d2", F.array(F.struct(F.lit(0).alias("at"), "n", "doc_id")).alias("pieces"))
    return alone.unionByName(judged)


def _paths(occurrences: DataFrame) -> DataFrame:
    """For each different run the path it lies on: d1, d2, path_key, path_no, offset of its first k-mer in the path.

    ``occurrences(row_key, doc_id, first, n, d1, d2)`` has one row for each place."""
    here = Window.partitionBy("row_key").orderBy("first")
    run = F.struct("d1", "d2")
    beside = occurrences.select(
        "*",
        F.when(F.lead("first").over(here) == F.col("first") + F.col("n"), F.lead(run).over(here)).alias("next"),
        F.when(F.lag(F.col("first") + F.col("n")).over(here) == F.col("first"), F.lag(run).over(here)).alias("before"))
    ways = beside.groupBy("d1", "d2").agg(
        F.min(F.struct("doc_id", "row_key", "first", "n")).alias("src"),
        F.count("*").alias("times"),
        F.count("next").alias("followed"), F.min("next").alias("next"), F.max("next").alias("other_next"),
        F.count("before").alias("preceded"), F.min("before").alias("before"), F.max("before").alias("other_before"))
    ways = stored(ways, "ways")
    leads = ways.where("followed = times and next = other_next").select(
        F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("next.d1").alias("q1"), F.col("next.d2").alias("q2"),
        F.col("src").alias("p_src"))
    follows = ways.where("preceded = times and before = other_before").select(
        F.col("before.d1").alias("p1"), F.col("before.d2").alias("p2"), F.col("d1").alias("q1"), F.col("d2").alias("q2"),
        F.col("src").alias("q_src"))
    # Source coordinates verify that the two runs lie side by side in one document.
    sided = F.expr("p_src.row_key = q_src.row_key and p_src.first + p_src.n = q_src.first")
    linked = leads.join(follows, ["p1", "p2", "q1", "q2"]).where(sided).select(
        F.col("q1").alias("d1"), F.col("q2").alias("d2"), F.lit(0).alias("opens"))
    marked = ways.join(linked, ["d1", "d2"], "left").select(
        "d1", "d2", F.col("src.row_key").alias("path_key"), F.col("src.first").alias("first"), F.coalesce("opens", F.lit(1)).alias("opens"))
    along = Window.partitionBy("path_key").orderBy("first", "d1", "d2").rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.withColumn("path_no", F.sum("opens").over(along))
    start = Window.partitionBy("path_key", "path_no")
    return numbered.select("d1", "d2", "path_key", "path_no", (F.col("first") - F.min("first").over(start)).alias("offset"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """row_key and spans, an array of (first, end) in words: what goes from each document."""
    runs = stored(_runs(docs, window, gram), "word-runs")
    occurrences = runs.select("row_key", "doc_id", "first", "n", "d1", "d2").dropDuplicates(["row_key", "first"])
    paths = stored(_paths(occurrences), "paths")
    pieces = _sources(docs, runs, window).join(paths, ["d1", "d2"]).groupBy("path_key", "path_no").agg(
        F.flatten(F.collect_list(F.transform("pieces", lambda p: F.struct(
            (F.col("offset") + p["at"]).alias("at"), p["n"].alias("n"), p["doc_id"].alias("doc_id"))))).alias("pieces"))
    heads = paths.where("offset = 0").join(pieces, ["path_key", "path_no"]).select("d1", "d2", "pieces")
    placed = occurrences.join(heads, ["d1", "d2"])
    gone = F.transform(
        F.filter("pieces", lambda p: p["doc_id"] < F.col("doc_id")),
        lambda p: F.struct((F.col("first") + p["at"]).alias("low"), (F.col("first") + p["at"] + p["n"] + (window - 1)).alias("high")))
    return placed.select("row_key", gone.alias("gone")).where(F.size("gone") > 0).groupBy("row_key").agg(
        F.flatten(F.collect_list("gone")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept, the remaining words joined by one blank, of every text."""
    spans = stored(repeated_spans(docs, window, gram), "word-spans")
    rows = with_spans(docs.select("doc_id", _row_key().alias("row_key"), "text"), spans).select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                n_words, removed, digests, rest = [], [], [], []
                for doc_id, text, spans in zip(*(c.to_pylist() for c in part.columns)):
                    words = _WORD.findall((text or "").encode("utf-8"))
                    kept, at = [], 0
                    if doc_id is not None:
                        for low, high in covered([(s["low"], s["high"]) for s in spans or ()]):
                            kept += words[at:low]
                            at = high
                    kept += words[at:]
                    left = b" ".join(kept)
                    n_words.append(len(words))
                    removed.append(len(words) - len(kept))
                    digests.append(hashlib.sha256(left).hexdigest())
                    rest.append(left.decode("utf-8"))
                yield pa.record_batch(
                    [part.column(0), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(rest, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
