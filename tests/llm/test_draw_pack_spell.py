"""Importance resampling, packing and spelling variants."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict
from functools import lru_cache
from zlib import crc32

import numpy as np
import pytest
from fixtures import odd_rows, patchwork, table, with_clashing_columns

from commentflow.llm import packing, resampling, spelling
from commentflow.llm.units import Units


# ---- importance resampling ----------------------------------------------------------------

def features(text, max_words):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return w, [" ".join(w[i:i + n]) for n in range(1, max_words + 1) for i in range(len(w) - n + 1)]


def resampled(rows, target, percent, min_words, buckets, max_words):
    def count(texts):
        out = Counter()
        for t in texts:
            out.update(crc32(f.encode()) % buckets for f in features(t, max_words)[1])
        return out

    s, t = count(r[1] for r in rows), count(target)
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    out, able = [], []
    for k, (i, text, *_) in enumerate(rows):
        w, f = features(text, max_words)
        gain = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in (crc32(x.encode()) % buckets for x in f)]
        weight = sum(gain) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([i, len(f), weight, score, None])
        if len(w) >= min_words:
            able.append((-score, i is not None, i or 0, k))
    for rank, (*_, k) in enumerate(sorted(able)[:len(able) * percent // 100], 1):
        out[k][4] = rank
    return Counter(map(tuple, out))


def ranked(df):
    return Counter(tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect())


TARGETS = ["the quick brown fox", None, "", "Lazy dog and deep DARK wood, wood-fire", "né 漢字"]


@pytest.mark.parametrize("max_words, buckets", [(1, 10_000), (3, 97)])
def test_resampling_equals_brute_force(spark, max_words, buckets, monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", 1 << 12)
    # Equal rows share out neighbouring ranks, so their ranks are compared as a multiset.
    rows = odd_rows() + [(100 + k, t, "s") for k, t in enumerate(patchwork(3, 60, vocabulary="The fox, Dark é wood 7x".split()))]
    df, target = with_clashing_columns(table(spark, rows)), spark.createDataFrame([(t,) for t in TARGETS], "text string")
    got = ranked(resampling.resample(df, target, 40, 8, buckets, max_words))
    assert got == resampled(rows, TARGETS, 40, 8, buckets, max_words)


def test_pieces_of_a_text_lose_no_feature(monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", 16)
    rng = random.Random(5)
    text = "".join(rng.choice("abé 漢,.\n") for _ in range(3000))
    for size in (1, 2, 4):
        counts = Counter()
        n = resampling.count_features(text.encode(), size, counts)
        words, plain = features(text, size)
        assert n == len(words) and counts == Counter(crc32(f.encode()) for f in plain)


def test_drawn_rows_keep_their_columns(spark):
    rows = [(k, "alpha beta gamma " * (k + 1), "s") for k in range(40)]
    df = with_clashing_columns(table(spark, rows))
    target = spark.createDataFrame([("alpha",)], "text string")
    kept = resampling.drawn(df, target, percent=25, min_words=6)
    ids = {r.doc_id for r in resampling.resample(df, target, percent=25, min_words=6).where("rank is not null").collect()}
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == ids and len(ids) == 9


def test_resampling_without_rows_or_targets(spark):
    df, none = table(spark, odd_rows()), spark.createDataFrame([], "text string")
    assert resampling.resample(df.limit(0), none).collect() == []
    assert ranked(resampling.resample(df, none, 50, 5)) == resampled(odd_rows(), [], 50, 5, 10_000, 1)


# ---- packing ------------------------------------------------------------------------------

@lru_cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.TOKENIZER)


def plain_ids(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [1]


def check_packed(rows, packed, sizes, step_windows=packing.STEP_WINDOWS):
    """Every id in one piece, sequences without gaps and full but for none, steps of equal size."""
    docs = defaultdict(list)
    for r in packed:
        docs[r.doc_id, r.doc_tokens].append(r)
    want = Counter()
    for i, text, *_ in rows:
        want[i, tuple(plain_ids(text))] += 1
    have = Counter({k: sum(r.length for r in v) for k, v in docs.items()})
    for (i, ids), times in want.items():
        pieces = docs[i, len(ids)]
        for r in pieces:
            if list(ids[r.start:r.start + r.length]) == r.ids:
                assert r.ids_crc32 == crc32(np.array(r.ids, dtype="<i4").tobytes())
        cover = Counter(k for r in pieces for k in range(r.start, r.start + r.length))
        same = sum(t for (j, other), t in want.items() if j == i and len(other) == len(ids))
        assert set(cover.values()) == {same} and len(cover) == len(ids) and have[i, len(ids)] == same * len(ids)
    # The ids that stand in sequences are those of the documents.
    texts = Counter(k for (i, ids), t in want.items() for k in ids * t)
    assert texts == Counter(k for r in packed for k in r.ids)
    rows_of = defaultdict(list)
    for r in packed:
        rows_of[r.sequence_id, r.window].append(r)
    assert len({s for s, _ in rows_of}) == len(rows_of) and {s for s, _ in rows_of} == set(range(len(rows_of)))
    tokens = defaultdict(int)
    for (_, window), parts in rows_of.items():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))]
        assert len({r.step for r in parts}) == 1 and sum(r.length for r in parts) == window and window & (window - 1) == 0
        tokens[parts[0].step, window] += window
    assert sorted(s for s, _ in tokens) == list(range(len(tokens)))
    for window in {w for _, w in tokens}:
        full = sorted(n for (_, w), n in tokens.items() if w == window)
        assert set(full[1:]) <= {step_windows * sizes[0]} and full[0] <= step_windows * sizes[0]


def test_packing_of_odd_rows(spark):
    rows = odd_rows() + [(200 + k, t, "s") for k, t in enumerate(patchwork(11, 150, vocabulary="some words é 漢 here".split()))]
    packed = packing.pack(with_clashing_columns(table(spark, rows)), stretch=256)
    got = packed.collect()
    check_packed(rows, got, packing.SIZES)
    made = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    assert all(len(r.ids) == r.window for r in made.values()) and len(made) == len({r.sequence_id for r in got})


@pytest.mark.parametrize("words", [(20,), (20, 3), (25, 30, 31), (1, 2, 40, 70)])
def test_packing_of_all_mixtures_of_lengths(spark, words):
    """Too few fillings, none at all, too many, and whole windows."""
    rows = [(k, " ".join(["word"] * words[k % len(words)]), "s") for k in range(60)]
    check_packed(rows, packing.pack(table(spark, rows), sizes=(32, 16, 8), step_windows=2, stretch=16).collect(), (32, 16, 8), 2)


def test_packing_without_rows(spark):
    assert packing.pack(table(spark, odd_rows()).limit(0)).collect() == []
    with pytest.raises(ValueError):
        packing.pack(table(spark, odd_rows()), sizes=(100, 50))


BITS = ["word", "Ünï", "漢字", "'s", "don't", "12", "...", "\n", "\t", " ", "  ", " \n ", "<|endoftext|>", " ", " ", "!", ",", "x" * 60, "\u0301", "_",
        "\u00a0", "\u3000", "Ⅷ", "²", "🙂", "\u0e31", "\U00010400", "\x1c", "\x85", "ᲀ"]


def mixed_texts(seed, n=500):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) + rng.choice(["", " ", " ", "  "]) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_are_those_of_the_tokenizer():
    quick, slow = packing.Encoder(packing.TOKENIZER, packing.RANKS), packing.Encoder(packing.TOKENIZER, None)
    texts = mixed_texts(9) + [" " * 10_000 + "x", "\n" * 5000, "y" * 20_000]
    for bit in BITS:  # texts of few different characters, so that either library gets some
        texts += [bit, f" {bit}{bit} word{bit}", f"{bit} \n{bit}"]
    assert sum(quick._odd.search(t) is None for t in texts) > 30
    for text in texts:
        assert np.frombuffer(quick(text), dtype="<i4").tolist() == np.frombuffer(slow(text), dtype="<i4").tolist() == plain_ids(text)[:-1]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_ids_of_a_table_are_those_of_the_tokenizer(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    quick, slow = packing.Encoder(packing.TOKENIZER, packing.RANKS), packing.Encoder(packing.TOKENIZER, None)
    assert all(quick(t) == slow(t) for t in texts)


def test_units_give_the_ids_of_whole_texts():
    texts, one = mixed_texts(3), lambda t: tokenizer().encode(t, add_special_tokens=False).ids
    many = lambda units: [one(u) for u in units]
    units = Units(one, many)
    for _ in range(2):  # new units, then known ones
        for text, ids in zip(texts, units.join(texts)):
            assert np.frombuffer(ids, dtype="<i4").tolist() == plain_ids(text)[:-1]
    small = Units(one, many, most=3)
    assert [small.join([t])[0] for t in texts[:50]] == units.join(texts[:50])


# ---- spelling variants --------------------------------------------------------------------

def variants(rows, min_chars=5, min_count=3, typo=97):
    count = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % typo == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_chars:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= min_count}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    form, n_near = {}, {}
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        n_near[w] = len(others)
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n, n_near[w], words.get(form[w])) for w, n in words.items()}


def noisy_rows(seed, n=120):
    rng = random.Random(seed)
    base = ["color", "colour", "señor", "naïve", "straße", "letter", "lettter", "banana", "aaaaaa", "zebra", "÷×÷×÷", "çéàèù"]
    def noisy(w):
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abcé") + w[k:], w[:k] + rng.choice("abzé") + w[k + 1:]]) or "x"
        return rng.choice([w, w, w.upper() if w.isascii() else w])
    return [(k, "".join(noisy(rng.choice(base)) + rng.choice([" ", "-", "漢", "\n"]) for _ in range(30)), "s") for k in range(n)]


def told(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


@pytest.mark.parametrize("round_bytes", [spelling.ROUND_BYTES, 192])
def test_variants_equal_brute_force(spark, round_bytes):
    rows = noisy_rows(4) + odd_rows()
    df = with_clashing_columns(table(spark, rows))
    got = spelling.spelling_variants(df, round_bytes=round_bytes)
    want = variants(rows)
    assert told(got) == want and got.count() == len(want)
    assert any(r[1] and r[2] != r[1] for r in want), "no chain of forms in the fixture"


def test_very_long_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "EDITS", 1 << 12)
    long = "".join(random.Random(1).choice("abcdefgh") for _ in range(400))
    rows = [(k, " ".join([long, long[:200] + "z" + long[201:], long[:64], long[:63], long[:10] + long[11:]] * 3), "s") for k in range(2)]
    rows += [(k + 10, long, "s") for k in range(20)]
    assert told(spelling.spelling_variants(table(spark, rows))) == variants(rows)


def test_variants_without_rows(spark):
    assert spelling.spelling_variants(table(spark, odd_rows()).limit(0)).collect() == []


def test_hashes_of_edits_are_those_of_the_strings():
    words = ["hello", "wörld", "aaaaa"]
    codes = spelling._codes(words, 5)
    whole = {w: int(spelling.hashes(spelling._codes([w], len(w)))[0]) for w in ["ello", "helo", "wrld", "aaaa", "hexlo", "hello"]}
    cut = spelling.deletions(codes)
    assert int(cut[0, 0]) == whole["ello"] and int(cut[0, 2]) == int(cut[0, 3]) == whole["helo"] and int(cut[1, 1]) == whole["wrld"]
    letter = spelling.LETTERS.tolist().index(ord("x"))
    assert int(spelling.replacements(codes, 2, 4)[0, 0, letter]) == whole["hexlo"]


def test_rounds_hold_every_block_once():
    blocks = {5: 7, 6: 1, 64: 20}
    seen = Counter()
    for held in spelling.rounds(blocks, 6):
        assert sum(stop - low for _, low, stop in held.values()) <= 6
        for c, (n, low, stop) in held.items():
            assert n == blocks[c]
            seen.update((c, b) for b in range(low, stop))
    assert seen == Counter((c, b) for c, n in blocks.items() for b in range(n))
