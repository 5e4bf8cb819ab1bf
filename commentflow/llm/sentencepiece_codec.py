"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model protobuf is parsed here, field by field; from it the normaliser, the metaspace marker, the scores and
the byte fallback are rebuilt as a ``tokenizers`` pipeline. Unigram models keep their scores; of BPE models the
merges are derived from the scores. No piece of the supplied models has a marker after another character, so a
text may be cut in front of a blank that follows a non-blank: every distinct unit is encoded once and its ids are
kept. A model for which this does not hold is encoded uncut.

Tasks receive Arrow batches and encode the new units of a slice on several threads; nothing is shuffled. Decoding is
checked by the bytes of the pieces. ``parity`` compares with the ``sentencepiece`` library; ``round_trip`` compares
every unit it encodes, and whole texts once a unit has differed.

Edge cases: a null text encodes like an empty one, to no ids; control pieces written out in a text are ordinary
characters; repeated rows give repeated results; other columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from commentflow.llm.units import Units

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THREADS = 2
#: Characters encoded in one call.
GROUP_CHARS = 1 << 20

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


def parse_model(data: bytes) -> dict:
    """Pieces (text, score, type) and the settings that encoding needs."""
    model = {"pieces": [], "type": UNIGRAM, "byte_fallback": False, "unk_id": 0,
             "charsmap": b"", "dummy_prefix": True, "squeeze": True, "escape": True}
    for field, value in _fields(data):
        if field == 1:
            piece, score, kind = "", 0.0, NORMAL
            for f, v in _fields(value):
                if f == 1:
                    piece = v.decode("utf-8")
                elif f == 2:
                    score = float(np.frombuffer(v, "<f4")[0])
                elif f == 3:
                    kind = v
            model["pieces"].append((piece, score, kind))
        elif field == 2:
            for f, v in _fields(value):
                name = {3: "type", 35: "byte_fallback", 40: "unk_id"}.get(f)
                if name:
                    model[name] = bool(v) if f == 35 else v
        elif field == 3:
            for f, v in _fields(value):
                name = {2: "charsmap", 3: "dummy_prefix", 4: "squeeze", 5: "escape"}.get(f)
                if name:
                    model[name] = v if f == 2 else bool(v)
    return model


def _merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, the best score first."""
    known = {p: k for k, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
    found = []
    for piece, k in known.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in known and right in known:
                found.append((-pieces[k][1], k, known[left], known[right], left, right))
    found.sort()
    return [(row[4], row[5]) for row in found]


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        with open(path, "rb") as file:
            spec = parse_model(file.read())
        pieces = spec["pieces"]
        unknown = pieces[spec["unk_id"]][0]
        if spec["type"] == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in pieces], spec["unk_id"], spec["byte_fallback"])
        else:
            model = models.BPE(
                vocab={p: k for k, (p, _, _) in enumerate(pieces)}, merges=_merges(pieces), unk_token=unknown,
                fuse_unk=True, byte_fallback=spec["byte_fallback"])
        steps = [normalizers.Precompiled(spec["charsmap"])] if spec["charsmap"] else []
        if spec["squeeze"]:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        rest = list(steps)
        if spec["dummy_prefix"]:
            steps.append(normalizers.Prepend(" "))
        if spec["escape"]:
            steps.append(normalizers.Replace(" ", MARK))
            rest.append(normalizers.Replace(" ", MARK))
        inner = any(MARK in p.lstrip(MARK) for p, _, kind in pieces if kind in (NORMAL, USER))
        #: Texts may be cut in front of a blank that follows a non-blank.
        self.splits = not inner and spec["escape"]
        self.cuts = self.splits and not spec["squeeze"]

        def pipeline(normal: list) -> Tokenizer:
            made = Tokenizer(model)
            made.normalizer = normalizers.Sequence(normal)
            if self.splits:
                made.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
            made.decoder = decoders.Sequence([
                decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
                *([decoders.Strip(" ", 1, 0)] if spec["dummy_prefix"] else [])])
            return made

        self.first, self.later = pipeline(steps), pipeline(rest)
        self.spec, self.path = spec, path
        self.prefix = " " if spec["dummy_prefix"] else ""
        #: The bytes of every piece as they stand in a text.
        self.bytes = [
            bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode("utf-8") for p, _, kind in pieces]
        self._units = Units(self._one, self._many)
        self._other = None
        self.differs = False

    def _one(self, unit: str) -> list[int]:
        return self._many([unit])[0]

    def _many(self, units: list[str]) -> list[list[int]]:
        """Ids of units; with a model that puts a blank in front of texts, all of them begin with one."""
        ids = [e.ids for e in self.later.encode_batch_fast(units, add_special_tokens=False)]
        if self._other is not None and not self.differs:
            # The other library puts the prefix in front itself.
            plain = [u[1:] for u in units] if self.prefix else units
            self.differs = self._other.encode(plain, num_threads=1) != ids
        return ids

    def compare(self) -> None:
        """From now on compare with the ``sentencepiece`` library; ``differs`` tells whether a unit got other ids."""
        if self._other is None:
            import sentencepiece

            self._other = sentencepiece.SentencePieceProcessor(model_file=self.path)
            self._units = Units(self._one, self._many)

    def same(self, text: str, ids: np.ndarray) -> bool:
        """Whether the other library gives a text these ids."""
        return self._other.encode(text) == ids.tolist()

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, in order; groups of bounded size are encoded by several threads."""
        group: list[str] = []
        chars = 0
        for text in texts:
            group.append(text)
            chars += len(text)
            if chars >= GROUP_CHARS:
                yield from self._group(group)
                group, chars = [], 0
        yield from self._group(group)

    def _group(self, group: list[str]) -> Iterator[np.ndarray]:
        if self.cuts:
            # The prefix of a text is the blank of its first unit.
            for data in self._units.join([self.prefix + t if t else t for t in group]):
                yield np.frombuffer(data, dtype="<i4")
        else:
            for text, e in zip(group, self.first.encode_batch_fast(group, add_special_tokens=False)):
                yield np.asarray(e.ids if text else [], dtype=np.int32)

    def spells(self, ids: np.ndarray, text: str) -> bool:
        """Whether the pieces, byte by byte, are the text with its prefix."""
        return b"".join(map(self.bytes.__getitem__, ids.tolist())) == ((self.prefix + text).encode("utf-8") if text else b"")

    def decode(self, rows: list[np.ndarray]) -> list[str]:
        return self.first.decode_batch([row.tolist() for row in rows], skip_special_tokens=False)


@lru_cache(maxsize=2)
def codec(path: str, threads: int = THREADS) -> Codec:
    """The codec of this worker; the thread count must be set before the library starts its threads."""
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    return Codec(path)


def _texts(column: pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def encode(docs: DataFrame, path: str = MODEL, threads: int = THREADS) -> DataFrame:
    """doc_id and ids, the pieces of the whole text."""

    def run(batches):
        coder = codec(path, threads)
        for batch in batches:
            for part in _sliced(batch):
                ids = list(coder.encode(_texts(part.column(1))))
                lengths = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                values = np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)
                yield pa.record_batch([part.column(0), pa.ListArray.from_arrays(lengths, pa.array(values))], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str = MODEL, threads: int = THREADS) -> DataFrame:
    """doc_id and text from rows (doc_id, ids); null ids decode to an empty text."""

    def run(batches):
        coder = codec(path, threads)
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                rows = [np.asarray([] if x is None else x, dtype=np.int32) for x in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(coder.decode(rows), pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def _sliced(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def round_trip(docs: DataFrame, path: str = MODEL, threads: int = THREADS, with_ids: bool = False) -> DataFrame:
    """For each document the number of its pieces, a digest of the ids and two checks.

    doc_id, n_tokens, ids_sha256 (ids as 32-bit little-endian numbers), decoded (whether decoding gives the text back),
    parity (whether the ``sentencepiece`` library gives the same ids) and, if asked for, ids."""

    def run(batches):
        coder = codec(path, threads)
        coder.compare()
        for batch in batches:
            for part in _sliced(batch, 64):
                texts = _texts(part.column(1))
                ids = list(coder.encode(texts))
                if coder.cuts:
                    decoded = [coder.spells(row, text) for row, text in zip(ids, texts)]
                else:
                    decoded = [back == text for text, back in zip(texts, coder.decode(ids))]
                # Equal units make equal texts.
                equal = coder.cuts and not coder.differs
                same = [True] * len(ids) if equal else [coder.same(text, row) for text, row in zip(texts, ids)]
                digests = [hashlib.sha256(row.astype("<i4").tobytes()).hexdigest() for row in ids]
                columns = [
                    part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.bool_()),
                    pa.array(same, pa.bool_())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded", "parity"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded boolean, parity boolean" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, fields)


def parity(texts: list[str], path: str = MODEL) -> list[int]:
    """Positions of the texts whose ids differ from those of the ``sentencepiece`` library."""
    import sentencepiece

    other = sentencepiece.SentencePieceProcessor(model_file=path)
    return [k for k, (text, ids) in enumerate(zip(texts, codec(path).encode(texts))) if other.encode(text) != ids.tolist()]
