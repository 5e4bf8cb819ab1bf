"""Packing of documents into sequences of several lengths, with no padding.

Every document is a run of token ids, closed by ``end_id``. Whole windows of the longest size are cut off its front;
what is left, its tail, is routed to the shortest context size that holds it. Then, from the longest size down:

* A tail routed to the longest size opens a window of its own and leaves a gap.
* These gaps are filled by the tails of the shorter sizes, the shortest first, cut where a gap ends.
* What is left of each shorter size is laid end to end and cut into windows of that size; what does not fill a window
  goes on to the next size. The last tokens fill windows of the powers of two below.
* If there are more gaps than short tails, the longest tails that find no filling are laid end to end themselves.

Windows of one size form step groups of equal token counts, and the groups of all sizes alternate evenly.

Only sums decide where a token goes: tasks number their rows and add up their own tokens, a row for each task is
summed over, and each document finds its place by arithmetic. Gaps and fillings meet by merging the borders of both
in stretches of the common line. Rows with ids are joined only if they lie in such a gap.

Edge cases: a null text is empty and has the closing id only; repeated rows are packed each; a null doc_id passes
through; texts are encoded whole; other columns are ignored, whatever their names; an empty
table gives an empty result. Which documents share a sequence depends on how the input is split.
"""

from __future__ import annotations

import os
import re
import unicodedata
from base64 import b64decode
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentflow.llm.tables import stored

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: The same vocabulary as ranks, and the pattern of byte-level BPE (a fixed value).
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_ID = 1
#: Context sizes, the longest first: powers of two.
SIZES = (2048, 1024, 512, 256)
#: Windows of the longest size whose tokens make a step group.
STEP_WINDOWS = 8
#: Tokens of a stretch in which the borders of gaps and fillings are merged.
STRETCH = 1 << 16

_PIECE = "struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint,window:bigint>"


class Encoder:
    """Ids of texts as the ``tokenizers`` library gives them, as little-endian 32-bit numbers.

    With a file of the same vocabulary as ranks, texts of long-settled characters go to ``tiktoken``, which gives the
    same ids in a quarter of the time; all others, and texts that spell out a special token, go to ``tokenizers``."""

    def __init__(self, path: str, ranks: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._slow = Tokenizer.from_file(path)
        self._quick = None
        if ranks is not None:
            import tiktoken

            with open(ranks, "rb") as file:
                table = {b64decode(piece): int(k) for piece, k in map(bytes.split, file)}
            added = {k: t.content for k, t in self._slow.get_added_tokens_decoder().items()}
            plain = {k: p for p, k in self._slow.get_vocab(with_added_tokens=True).items() if k not in added}
            if {k: len(p) for p, k in table.items()} != {k: len(p) for k, p in plain.items()}:
                raise ValueError(f"{ranks} and {path} are different vocabularies")
            self._quick = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
            self._odd = re.compile("|".join([f"[^{_settled()}]", r"\s{4096}", *map(re.escape, added.values())]))

    def __call__(self, text: str) -> bytes:
        if self._quick is not None and not self._odd.search(text):
            return self._quick.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        return np.asarray(self._slow.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()


def _settled() -> str:
    """Ranges of characters that have had one category since an early version of Unicode, so that libraries agree on them."""
    early = unicodedata.ucd_3_2_0.category
    same = [c for c in range(0x10000) if unicodedata.category(chr(c)) == early(chr(c)) not in ("Cn", "Cs", "Co")]
    starts = [c for k, c in enumerate(same) if k == 0 or same[k - 1] != c - 1]
    ends = [c for k, c in enumerate(same) if k == len(same) - 1 or same[k + 1] != c + 1]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends))


@lru_cache(maxsize=2)
def _encoder(path: str, ranks: str | None) -> Encoder:
    return Encoder(path, ranks)


def tokenized(
    docs: DataFrame, path: str = TOKENIZER, ranks: str | None = RANKS, end_id: int = END_ID, sizes: tuple[int, ...] = SIZES,
) -> DataFrame:
    """rid, doc_id, ids (little-endian 32-bit numbers), n, block and the sums of the task's earlier rows.

    ``full`` whole windows and a ``tail`` of the given ``size`` (0 for none) make up the n ids. ``full_at`` counts the
    windows before, ``tail_at`` the tail tokens of the same size, ``host_at`` and ``gap_at`` the tails of the longest
    size and the gaps they leave."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    longest, ascending = sizes[0], np.array(sizes[::-1])
    end = np.array([end_id], dtype="<i4").tobytes()

    def run(batches):
        block, at, full_at, host_at, gap_at, sums = TaskContext.get().partitionId(), 0, 0, 0, 0, dict.fromkeys((0, *sizes), 0)
        encode = _encoder(path, ranks)
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                ids = [encode(t or "") + end for t in part.column(1).to_pylist()]
                rows = []
                for data in ids:
                    n = len(data) // 4
                    full, tail = divmod(n, longest)
                    size = int(ascending[np.searchsorted(ascending, tail)]) if tail else 0
                    rows.append(((block << 33) + at, n, block, full, tail, size, full_at, sums[size], host_at, gap_at))
                    at, full_at, sums[size] = at + 1, full_at + full, sums[size] + tail
                    if size == longest:
                        host_at, gap_at = host_at + 1, gap_at + longest - tail
                yield pa.record_batch(
                    [part.column(0), pa.array(ids, pa.binary()), *(pa.array(c, pa.int64()) for c in zip(*rows))],
                    names=["doc_id", "ids", *_NUMBERS])

    fields = ", ".join(f"{c} bigint" for c in _NUMBERS)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary, {fields}")


_NUMBERS = ("rid", "n", "block", "full", "tail", "size", "full_at", "tail_at", "host_at", "gap_at")


def _sums(rows: DataFrame, sizes: tuple[int, ...]) -> tuple[DataFrame, dict]:
    """For each block the sums over all earlier blocks, and the totals of all rows.

    Only a row for each task of the tokenizer passes through the window."""
    longest = sizes[0]
    host = F.col("size") == longest
    named = {f"tail_{s}": F.sum(F.when(F.col("size") == s, F.col("tail")).otherwise(0)) for s in sizes}
    named |= {"full": F.sum("full"), "hosts": F.count_if(host), "gaps": F.sum(F.when(host, longest - F.col("tail")).otherwise(0))}
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored(rows.groupBy("block").agg(*[c.alias(k) for k, c in named.items()]).select(
        "block", *named, *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_{k}") for k in named]), "blocks")
    total = blocks.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in named]).first().asDict()
    return blocks.drop(*named), total


def _placed(rows: DataFrame, offsets: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """The rows with sums over all earlier rows instead of those of their block."""
    own = F.coalesce(*[F.when(F.col("size") == s, F.col(f"_tail_{s}")) for s in sizes], F.lit(0))
    return rows.join(offsets, "block").withColumns({
        "full_at": F.col("full_at") + F.col("_full"), "tail_at": F.col("tail_at") + own,
        "host_at": F.col("host_at") + F.col("_hosts"), "gap_at": F.col("gap_at") + F.col("_gaps")}).drop(*offsets.columns)


class Layout:
    """Where each part of the token line goes, from a few totals."""

    def __init__(self, sizes: tuple[int, ...], total: dict, filled: tuple[int, int, int] | None = None):
        self.sizes, longest = sizes, sizes[0]
        shorter = sizes[1:]
        self.full, self.fillers = total["full"], sum(total[f"tail_{s}"] for s in shorter)
        #: Tails of the longest size whose gap is filled, the tokens of their gaps and their own.
        self.hosts, self.gaps, self.host_tokens = filled or (total["hosts"], total["gaps"], total[f"tail_{longest}"])
        # Gaps take the shortest size first: where the tails of a size begin on the line of fillings, and how many tokens they give.
        self.base, self.used, at, left = {}, {longest: self.host_tokens}, 0, self.gaps
        for s in shorter[::-1]:
            self.base[s], self.used[s] = at, min(left, total[f"tail_{s}"])
            at, left = at + total[f"tail_{s}"], left - self.used[s]
        # What is left lies on a second line, the longest size first.
        self.rest, at = {}, 0
        for s in sizes:
            self.rest[s] = at
            at += total[f"tail_{s}"] - self.used[s]
        #: (window size, first place on the second line, first sequence, windows).
        self.stretches, start, sequence, have = [], 0, self.full + self.hosts, 0
        size = longest
        while size:
            have += total[f"tail_{size}"] - self.used[size] if size in sizes else 0
            windows, have = divmod(have, size)
            self.stretches.append((size, start, sequence, windows))
            start, sequence, size = start + windows * size, sequence + windows, size // 2
        #: Windows of each size.
        self.windows = {s: n + (self.full + self.hosts if s == longest else 0) for s, _, _, n in self.stretches}
        self.first = {s: 0 if s == longest else q for s, _, q, _ in self.stretches}

    def of(self, table: dict) -> Column:
        """The table's number for the size of the row."""
        return F.coalesce(*[F.when(F.col("size") == s, F.lit(v).cast("bigint")) for s, v in table.items()], F.lit(0).cast("bigint"))

    def cut(self, low: Column, high: Column, start: Column) -> Column:
        """Pieces of the places low, ..., high - 1 of the second line, whose first is number ``start`` of its document.

        The arguments are columns of the row, not expressions, as they are used many times."""
        stretches = _structs(("size", "first", "sequence", "windows"), [x for x in self.stretches if x[3]])
        if stretches is None:
            return _none()

        def within(s: Column) -> Column:
            a, b = F.greatest(low, s["first"]), F.least(high, s["first"] + s["windows"] * s["size"])

            def piece(w: Column) -> Column:
                begin, stop = F.greatest(a, s["first"] + w * s["size"]), F.least(b, s["first"] + (w + 1) * s["size"])
                return F.struct(
                    (start - low + begin).alias("start"), (stop - begin).alias("length"), (w + s["sequence"]).alias("sequence_id"),
                    (begin - s["first"] - w * s["size"]).alias("offset"), s["size"].alias("window")).cast(_PIECE)

            return F.when(b > a, F.transform(F.sequence(_div(a - s["first"], s["size"]), _div(b - s["first"] - 1, s["size"])), piece)).otherwise(_none())

        return F.flatten(F.transform(stretches, within))

    def step(self, windows_a_step: int) -> Column:
        """The step group of a piece, from its window size and sequence."""
        tokens = windows_a_step * self.sizes[0]
        groups = [(k, s, self.first[s], -(-n * s // tokens)) for k, (s, n) in enumerate(self.windows.items()) if n]
        tiers = _structs(("k", "size", "first", "n"), groups)
        if tiers is None:
            return F.lit(None).cast("bigint")

        def place(x: Column) -> Column:
            mine, own = x["tier"], x["own"]
            # Group i of n stands at (i + 1/2) / n; those of other sizes that stand before it are counted, at equal places those of longer ones.
            return own + F.aggregate(tiers, F.lit(0).cast("bigint"), lambda total, t: total + F.when(t["k"] == mine["k"], F.lit(0)).otherwise(
                F.least(_div((2 * own + 1) * t["n"] + mine["n"] - (t["k"] > mine["k"]).cast("int"), 2 * mine["n"]), t["n"])))

        mine = F.filter(tiers, lambda t: t["size"] == F.col("window"))
        known = F.transform(mine, lambda t: F.struct(t.alias("tier"), _div((F.col("sequence_id") - t["first"]) * t["size"], F.lit(tokens)).alias("own")))
        return F.get(F.transform(known, place), F.lit(0))


def _structs(names: tuple[str, ...], rows: list[tuple[int, ...]]) -> Column | None:
    """A constant array of structs of numbers, None for no row."""
    made = [F.struct(*[F.lit(v).cast("bigint").alias(n) for n, v in zip(names, row)]) for row in rows]
    return F.array(*made) if made else None


def _div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def _none() -> Column:
    return F.array().cast(f"array<{_PIECE}>")


def _filled(placed: DataFrame, longest: int, fillers: int) -> tuple[int, int, int]:
    """The tails of the longest size, from the first on, whose gaps the fillings fill: number, gap tokens, own tokens."""
    hosts = placed.where((F.col("size") == longest) & (F.col("gap_at") + longest - F.col("tail") <= fillers))
    return tuple(hosts.agg(
        F.count("*"), F.coalesce(F.sum(longest - F.col("tail")), F.lit(0)), F.coalesce(F.sum("tail"), F.lit(0))).first())


def _gap_pieces(placed: DataFrame, layout: Layout, stretch: int) -> DataFrame:
    """rid and the pieces (as an array) of the tails that fill gaps.

    Gaps and fillings cover the same line. The borders of both are sorted in stretches of the line; between two borders
    lies a piece of the latest filling in the latest gap."""
    longest = layout.sizes[0]
    x = F.col("tail_at") + layout.of(layout.base)
    fillings = placed.where(F.col("size").isin(*layout.sizes[1:]) & (x < layout.gaps)).select(
        x.alias("low"), F.least(x + F.col("tail"), F.lit(layout.gaps)).alias("high"), "rid", (F.col("full") * longest).alias("first"),
        F.lit(None).cast("bigint").alias("sequence_id"), F.lit(None).cast("bigint").alias("used"))
    gaps = placed.where((F.col("size") == longest) & (F.col("host_at") < layout.hosts)).select(
        F.col("gap_at").alias("low"), (F.col("gap_at") + longest - F.col("tail")).alias("high"), F.lit(None).cast("bigint").alias("rid"),
        F.lit(None).cast("bigint").alias("first"), (F.col("host_at") + layout.full).alias("sequence_id"), F.col("tail").alias("used"))
    both = fillings.unionByName(gaps).withColumn("part", F.explode(F.sequence(_div(F.col("low"), stretch), _div(F.col("high") - 1, stretch))))
    border = both.withColumn("at", F.greatest("low", F.col("part") * stretch))
    line = Window.partitionBy("part").orderBy("at")
    so_far = line.rowsBetween(Window.unboundedPreceding, 0)
    end = F.least((F.col("part") + 1) * stretch, F.lit(layout.gaps))
    merged = border.select(
        "at", F.coalesce(F.lead("at").over(line), end).alias("stop"),
        F.last(F.when(F.col("rid").isNotNull(), F.struct("rid", "low", "first")), ignorenulls=True).over(so_far).alias("f"),
        F.last(F.when(F.col("rid").isNull(), F.struct("sequence_id", "low", "used")), ignorenulls=True).over(so_far).alias("g"),
    ).where("stop > at")
    piece = F.struct(
        (F.col("f.first") + F.col("at") - F.col("f.low")).alias("start"), (F.col("stop") - F.col("at")).alias("length"),
        F.col("g.sequence_id").alias("sequence_id"), (F.col("g.used") + F.col("at") - F.col("g.low")).alias("offset"),
        F.lit(longest).cast("bigint").alias("window"))
    return merged.groupBy(F.col("f.rid").alias("rid")).agg(F.collect_list(piece.cast(_PIECE)).alias("gap_pieces"))


def pack(
    docs: DataFrame, path: str = TOKENIZER, ranks: str | None = RANKS, end_id: int = END_ID, sizes: tuple[int, ...] = SIZES,
    step_windows: int = STEP_WINDOWS, with_ids: bool = True, stretch: int = STRETCH,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window, step and, if asked for, ids of every piece.

    A piece is ``length`` ids of a document from its id number ``start`` on; it stands at ``offset`` of a sequence of
    ``window`` ids. ``step`` numbers the step groups in training order."""
    if any(s & (s - 1) for s in sizes) or list(sizes) != sorted(set(sizes), reverse=True):
        raise ValueError("sizes are powers of two, the longest first")
    longest = sizes[0]
    rows = stored(tokenized(docs, path, ranks, end_id, sizes), "tokens")
    offsets, total = _sums(rows, sizes)
    narrow, placed = (_placed(r, offsets, sizes) for r in (rows.drop("doc_id", "ids"), rows))
    fillers = sum(total[f"tail_{s}"] for s in sizes[1:])
    layout = Layout(sizes, total, _filled(narrow, longest, fillers) if fillers < total["gaps"] else None)

    # Tokens of a tail before ``used`` lie in gaps, the others on the second line.
    first, beyond = F.col("full") * longest, F.greatest(layout.of(layout.used) - F.col("tail_at"), F.lit(0))
    placed = placed.withColumns({"first": first, "beyond": beyond}).withColumns({
        "low": layout.of(layout.rest) + F.col("tail_at") + F.col("beyond") - layout.of(layout.used), "from": F.col("first") + F.col("beyond")})
    placed = placed.withColumn("high", F.col("low") + F.col("tail") - F.col("beyond"))
    whole = F.when(F.col("full") > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("full") - 1), lambda i: F.struct(
        (i * longest).alias("start"), F.lit(longest).alias("length"), (F.col("full_at") + i).alias("sequence_id"), F.lit(0).alias("offset"),
        F.lit(longest).alias("window")).cast(_PIECE))).otherwise(_none())
    hosted = (F.col("size") == longest) & (F.col("host_at") < layout.hosts)
    own = F.array(F.struct(
        F.col("first").alias("start"), F.col("tail").alias("length"), (F.col("host_at") + layout.full).alias("sequence_id"), F.lit(0).alias("offset"),
        F.lit(longest).alias("window")).cast(_PIECE))
    left = (F.col("size") > 0) & (F.col("beyond") < F.col("tail"))
    rest = F.when(left, layout.cut(F.col("low"), F.col("high"), F.col("from"))).otherwise(_none())
    pieces = F.concat(whole, F.when(hosted, own).otherwise(rest))

    in_gap = F.col("size").isin(*sizes[1:]) & (F.col("tail_at") < layout.of(layout.used))
    ready = placed.withColumn("pieces", pieces).withColumn("in_gap", in_gap).select("rid", "doc_id", "n", "ids", "pieces", "in_gap")
    alone = ready.where("not in_gap").drop("rid", "in_gap")
    joined = ready.where("in_gap").join(_gap_pieces(narrow, layout, stretch), "rid").select(
        "doc_id", "n", "ids", F.concat("pieces", "gap_pieces").alias("pieces"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids, pieces = [memoryview(x.as_buffer()) for x in part.column(2)], part.column(3)
                flat = pieces.flatten()
                at = np.repeat(np.arange(part.num_rows), np.asarray(pieces.value_lengths()))
                start, length = (np.asarray(flat.field(f)) for f in ("start", "length"))
                cut = [ids[k][4 * a:4 * (a + b)] for k, a, b in zip(at.tolist(), start.tolist(), length.tolist())]
                columns = [
                    part.column(0).take(pa.array(at)), flat.field("start"), flat.field("length"), pa.array(list(map(crc32, cut)), pa.int64()),
                    part.column(1).take(pa.array(at)), flat.field("sequence_id"), flat.field("offset"), flat.field("window")]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, dtype="<i4") for x in cut], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)

    fields = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, window bigint"
    out = alone.unionByName(joined).mapInArrow(run, fields + ", ids array<int>" * with_ids)
    return out.withColumn("step", layout.step(step_windows))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, window, step and ids of every sequence, from ``pack`` with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id", "window", "step").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
