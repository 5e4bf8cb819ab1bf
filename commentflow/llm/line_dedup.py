"""Line deduplication by a segment-partition edit join.

A line is removed if an equal line, or one within ``threshold`` edits, occurs earlier by (doc_id, line number).
Lines are the pieces between line feeds that hold a word; lines under ``MIN_NEAR`` characters only match exactly.

Near lines: two strings within t edits, cut into t + 1 even segments, share a segment. The segments of every line
are indexed under (length, number, content); a line probes, for each length from its own down to t less, only the
substrings at the few places where the segment can lie if the edits are shared out on both sides of it. Lines
under a key that no other line has are dropped at once; the others meet in a join whose condition is the edit
distance, so only true pairs leave it; a banded bit-parallel count of the edits then gives their distance.

All steps are built-in functions and joins. Equal lines are merged before anything is compared, a line is told by
two 64-bit hashes, and its text moves only if it shares a key.

Edge cases: a null or empty text has no lines; documents are told apart by doc_id and text, so repeated rows are
one document with repeated results; a null doc_id counts as earliest; texts with equal doc_id are ordered by a
hash; other columns are ignored by ``removed_lines`` and pass through ``dedup_lines``, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentflow.llm.tables import BLANKS, fresh, let, sieved, stored

THRESHOLD = 1
MIN_NEAR = 20


def _has_word(line: Column) -> Column:
    return F.ltrim(line, F.lit(BLANKS)) != ""


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _lines(docs: DataFrame) -> DataFrame:
    """row_key, doc_id, no, line, id1, id2 for every line with a word."""
    return (
        docs.select("doc_id", _row_key().alias("row_key"), F.posexplode(F.split(F.col("text"), "\n")).alias("no", "line"))
        .where(_has_word(F.col("line")))
        .withColumns({"id1": F.xxhash64("line"), "id2": F.xxhash64(F.lit(1), F.col("line"))})
    )


def _segment(line: Column, size: Column, k: int, pieces: int, shift: int) -> Column:
    """Segment ``k`` of a partition for length ``size``, taken from the line ``shift`` places on; null outside it."""
    start = F.floor(size * k / pieces) + shift
    width = F.floor(size * (k + 1) / pieces) - F.floor(size * k / pieces)
    piece = F.substring(line, (start + 1).cast("int"), width.cast("int"))
    return F.when((start >= 0) & (start + width <= F.char_length(line)), F.xxhash64(size, F.lit(k), piece))


def _keys(line: Column, threshold: int) -> Column:
    """Array of (key, indexed): the line's own segments are indexed, all of them probe. Keys outside the line are null."""
    pieces = threshold + 1
    out = []
    for less in range(threshold + 1):
        size = (F.char_length(line) - less).cast("int")
        for k in range(pieces):
            low = max(-k, less - (threshold - k))
            high = min(k, less + (threshold - k))
            for shift in range(low, high + 1):
                out.append(F.struct(_segment(line, size, k, pieces, shift).alias("key"), F.lit(less == 0 and shift == 0).alias("indexed")))
    return F.array(*out)


def edit_distance(a: Column, b: Column, threshold: int) -> Column:
    """Edit distance of two strings, or ``threshold`` + 1 if it is more, by banded bit-parallel steps.

    Bit r of ``state[d]`` says that the first j characters of ``b`` become the first j + r - t of ``a`` with at most
    d edits; the band has 2t + 1 bits, and one character of ``b`` moves all of it with a few bit operations."""
    t = threshold
    mask = (1 << (2 * t + 1)) - 1
    start = F.array(*[F.lit(sum(1 << (t + i) for i in range(d + 1)) & mask) for d in range(t + 1)])

    def run(x: Column) -> Column:
        chars_a, chars_b = x["a"], x["b"]

        def step(state: Column, j: Column) -> Column:
            equal = reduce(lambda p, q: p.bitwiseOR(q), [
                F.when((j + (r - t) >= 0) & (F.get(chars_a, j + (r - t)) == F.get(chars_b, j)), F.lit(1 << r)).otherwise(F.lit(0))
                for r in range(2 * t + 1)])

            def moved(e: Column) -> Column:
                new = [F.get(state, F.lit(0)).bitwiseAND(e)]
                for d in range(1, t + 1):
                    old, less = F.get(state, F.lit(d)), F.get(state, F.lit(d - 1))
                    new.append(old.bitwiseAND(e).bitwiseOR(less).bitwiseOR(F.shiftright(less, 1)).bitwiseOR(F.shiftleft(new[-1], 1)).bitwiseAND(F.lit(mask)))
                return F.array(*new)

            return let(equal, moved)

        # The cell of both whole strings lies |a| - |b| off the diagonal.
        place = F.pow(F.lit(2.0), F.size(chars_a) - F.size(chars_b) + t).cast("int")
        last = F.when(F.size(chars_b) == 0, start).otherwise(
            F.aggregate(F.sequence(F.lit(0), F.size(chars_b) - 1), start, step))
        return let(last, lambda s: reduce(
            lambda rest, d: F.when(F.get(s, F.lit(d)).bitwiseAND(place) != 0, d).otherwise(rest), reversed(range(t + 1)), F.lit(t + 1)))

    def chars(s: Column) -> Column:
        return F.filter(F.split(s, ""), lambda c: c != "")

    near = F.abs(F.char_length(a) - F.char_length(b)) <= t
    return F.when(near, let(F.struct(chars(a).alias("a"), chars(b).alias("b")), run)).otherwise(F.lit(t + 1))


def near_pairs(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a1, a2, b1, b2, distance) of the hashes of different lines within ``threshold`` edits."""
    lines = _lines(docs).where(F.char_length("line") >= MIN_NEAR)
    rows = lines.select("id1", "id2", F.explode(_keys(F.col("line"), threshold)).alias("k")).select(
        "id1", "id2", "k.key").where("key is not null")
    # Most keys belong to one line only; what cannot share one stays where it is.
    shared = stored(rows.groupBy("key").agg(F.min("id1").alias("x"), F.max("id1").alias("y")).where("x <> y").select("key"), "line-keys")
    wanted = stored(sieved(rows, "key", shared).join(shared, "key", "left_semi").select("id1", "id2").distinct(), "line-ids")
    # Equal lines merge in the map tasks before their text moves.
    merged = sieved(lines, "id1", wanted.select("id1")).groupBy("id1", "id2").agg(F.first("line").alias("line"))
    texts = merged.join(wanted, ["id1", "id2"], "left_semi")
    keyed = stored(texts, "line-texts").select(
        "id1", "id2", "line", F.explode(_keys(F.col("line"), threshold)).alias("k")).select("id1", "id2", "line", "k.*").where("key is not null")
    own = keyed.where("indexed").select("key", F.col("id1").alias("a1"), F.col("id2").alias("a2"), F.col("line").alias("a"))
    probes = keyed.select("key", F.col("id1").alias("b1"), F.col("id2").alias("b2"), F.col("line").alias("b"))
    longer = F.char_length("b") > F.char_length("a")
    once = (F.char_length("b") == F.char_length("a")) & F.expr("a1 < b1 or (a1 = b1 and a2 < b2)")
    met = own.join(
        probes, (own["key"] == probes["key"]) & (longer | once) & (F.levenshtein(F.col("a"), F.col("b"), threshold) >= 0))
    told = met.dropDuplicates(["a1", "a2", "b1", "b2"]).withColumn("distance", edit_distance(F.col("a"), F.col("b"), threshold))
    return told.where(F.col("distance") <= threshold).select("a1", "a2", "b1", "b2", "distance")


def _verdicts(docs: DataFrame, threshold: int) -> DataFrame:
    """row_key with the numbers of the lines that stay, and of the first occurrences that are near an earlier line."""
    first = F.struct("doc_id", "row_key", "no")
    classes = stored(_lines(docs).groupBy("id1", "id2").agg(F.min(first).alias("first")), "line-classes")
    pairs = stored(near_pairs(docs, threshold), "line-pairs")
    one = classes.select(F.col("id1").alias("a1"), F.col("id2").alias("a2"), F.col("first").alias("fa"))
    two = classes.select(F.col("id1").alias("b1"), F.col("id2").alias("b2"), F.col("first").alias("fb"))
    timed = pairs.join(one, ["a1", "a2"]).join(two, ["b1", "b2"])
    later = timed.select(
        F.when(F.col("fa") < F.col("fb"), F.col("b1")).otherwise(F.col("a1")).alias("id1"),
        F.when(F.col("fa") < F.col("fb"), F.col("b2")).otherwise(F.col("a2")).alias("id2")).distinct().withColumn("near", F.lit(True))
    marked = classes.join(later, ["id1", "id2"], "left").select(
        "first.row_key", "first.no", F.coalesce("near", F.lit(False)).alias("near"))
    return marked.groupBy("row_key").agg(
        F.array_compact(F.collect_list(F.when(~F.col("near"), F.col("no")))).alias("stay"),
        F.array_compact(F.collect_list(F.when(F.col("near"), F.col("no")))).alias("near"))


def removed_lines(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """For each document its lines with a word, the equal and near ones removed, and the numbers of the removed lines.

    doc_id, n_lines, n_equal, n_near, removed (line numbers from 0, comma separated)."""
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    worded = F.filter(F.transform(lines, lambda x, i: F.when(_has_word(x), i)), lambda i: i.isNotNull())
    rows = docs.select("doc_id", _row_key().alias("row_key"), worded.alias("worded"))
    joined = rows.join(_verdicts(docs, threshold), "row_key", "left")
    gone = F.array_except("worded", F.coalesce("stay", F.expr("cast(array() as array<int>)")))
    return joined.withColumn("gone", gone).select(
        "doc_id", F.size("worded").cast("bigint").alias("n_lines"),
        (F.size("gone") - F.coalesce(F.size("near"), F.lit(0))).cast("bigint").alias("n_equal"),
        F.coalesce(F.size("near"), F.lit(0)).cast("bigint").alias("n_near"),
        F.array_join(F.transform("gone", lambda i: i.cast("string")), ",").alias("removed"))


def dedup_lines(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The input with the removed lines cut out of ``text``; ``n_chars``, if there, follows the new text.

    Lines without a word stay. A document that loses all its lines stays as a row."""
    key, stay, near = fresh(docs, "row_key", "stay", "near")
    verdicts = _verdicts(docs, threshold).toDF(key, stay, near)
    joined = docs.withColumn(key, _row_key()).join(verdicts, key, "left")
    lines = F.split(F.col("text"), "\n")
    keep = F.coalesce(F.col(stay), F.expr("cast(array() as array<int>)"))
    text = F.array_join(F.filter(lines, lambda x, i: ~_has_word(x) | F.array_contains(keep, i)), "\n")
    out = joined.withColumn("text", F.when(F.col("text").isNotNull(), text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


SQL = f"""
with split as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) as no
  from documents
), lines as (
  select doc_id, no, line from split where regexp_matches(line, '[^\x20\x09-\x0D]')
), firsts as (
  select line, min([doc_id, no]) as f, length(line) as n from lines group by line
), long as (
  select * from firsts where n >= {MIN_NEAR}
), near as (
  select distinct x.line
  from long x join (select line, f, n, unnest(range(n - {THRESHOLD}, n + {THRESHOLD} + 1)) as m from long) y
    on x.n = y.m and y.f < x.f and levenshtein(x.line, y.line) <= {THRESHOLD}
), judged as (
  select l.doc_id, l.no, f.f <> [l.doc_id, l.no] as is_equal, f.f = [l.doc_id, l.no] and near.line is not null as is_near
  from lines l join firsts f on l.line = f.line left join near on l.line = near.line
), per as (
  select doc_id, count(*) as n_lines, count(*) filter (where is_equal) as n_equal, count(*) filter (where is_near) as n_near,
         string_agg(no, ',' order by no) filter (where is_equal or is_near) as removed
  from judged group by doc_id
)
select d.doc_id, cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(n_equal, 0) as bigint) as n_equal,
       cast(coalesce(n_near, 0) as bigint) as n_near, coalesce(removed, '') as removed
from documents d left join per on d.doc_id = per.doc_id"""
