"""Licences, toxicity, SentencePiece, quality rules and mixing."""

import os
import random

import numpy as np
import pytest
from fixtures import odd_rows, patchwork, sha, table, with_clashing_columns, words
from oracle import compare, duck
from pyspark.sql import functions as F

from commentflow.llm import catalog, license_scan, mixing, quality_rules, sentencepiece_codec, toxicity

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def frame_in_duck(df):
    con = duck("/nonexistent")
    con.register("documents_frame", df.toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}))
    con.execute("create view documents as select * from documents_frame")
    return con


@needs_tables
@pytest.mark.parametrize("key", sorted(catalog.SQL))
def test_query_equals_sql(spark, key):
    assert compare(catalog.QUERIES[key](spark, SF_DIR), duck(SF_DIR), catalog.SQL[key]) == []


# ---- licences -----------------------------------------------------------------------------

def test_license_bounds_never_lose_a_match():
    for n in (1, 4, 7, 60):
        low, high = license_scan.bounds(n, 0.8)
        for size in range(1, 200):
            best = 2 * min(n, size) / (n + size)
            assert (best >= 0.8) == (low <= size <= high) or abs(best - 0.8) < 1e-12


def test_licenses_in_lines_and_whole_texts(spark):
    mit = dict(license_scan.TEMPLATES[::-1])["MIT"]
    long = next(body for name, body in license_scan.TEMPLATES if name == "MIT" and len(body) > 200)
    rows = [
        (1, "some text\nReleased under the MIT License.\nmore", "s"), (2, long.replace(". ", ".\n").upper(), "s"),
        (3, "Licensed under the Apache License, Version 2.0 !!", "s"), (4, "nothing here", "s"), (5, None, "s"),
        (6, "Licensed under CC BY-NC 4.0.\nReleased under the MIT license", "s"), (7, long[:150], "s"),
    ]
    got = {r.doc_id: (r.n_licenses, r.license, r.licenses) for r in license_scan.license_scan(with_clashing_columns(table(spark, rows))).collect()}
    assert mit and got == {
        1: (1, "MIT", "MIT"), 2: (1, "MIT", "MIT"), 3: (1, "Apache-2.0", "Apache-2.0"), 4: (0, None, ""), 5: (0, None, ""),
        6: (2, "CC-BY-NC-4.0", "CC-BY-NC-4.0,MIT"), 7: (0, None, ""),
    }


def test_licenses_of_odd_rows(spark):
    df = table(spark, odd_rows())
    assert license_scan.license_scan(df).where("n_licenses = 0").count() == len(odd_rows())
    assert license_scan.license_scan(df.limit(0)).collect() == []


# ---- toxicity -----------------------------------------------------------------------------

def test_chain_uses_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    x = np.hstack([rng.random((600, 3)), np.ones((600, 1))])
    first = (x[:, 0] > 0.5).astype(float)
    y = np.stack([first, first * (x[:, 1] > 0.3), np.zeros(600)], axis=1)
    chain = toxicity.fit_chain(x, y, np.arange(600) % 3, {"=a": 0})
    p = chain.predict(x)
    assert [len(w) for w in chain.weights] == [4, 5, 6]
    assert ((p[:, 1] >= 0.5) == (y[:, 1] == 1)).mean() > 0.9 and p[:, 2].max() < 0.01


@pytest.fixture(scope="module")
def toxic_tables(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i, text in enumerate(patchwork(21, 400, vocabulary=[f"w{k}" for k in range(200)])):
        w = text.split() + ["plain", "words"]
        toxic, junk = int(i % 5 == 0), int(i % 7 == 0)
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(["idiot", "moron!"]))
        rows.append((i, " ".join(x + "###" * junk for x in w), "s"))
        labels.append((i, 1 - junk, toxic))
    return table(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_on_documents_not_trained_on(spark, toxic_tables):
    docs, labels = toxic_tables
    chain = toxicity.train(docs, labels.where("doc_id % 2 = 0"))
    said = {r.doc_id: r for r in toxicity.toxicity(with_clashing_columns(docs), chain).collect()}
    held = [r for r in labels.collect() if r.doc_id % 2]
    assert sum(said[r.doc_id].toxic == bool(r.toxic) for r in held) >= 0.97 * len(held)
    assert sum((said[r.doc_id].p_low_quality >= 0.5) == (r.quality == 0) for r in held) >= 0.97 * len(held)
    again = toxicity.train(docs.repartition(7), labels.where("doc_id % 2 = 0").repartition(5))
    assert again.vocabulary == chain.vocabulary and all(np.array_equal(a, b) for a, b in zip(again.weights, chain.weights))
    df = with_clashing_columns(docs)
    kept = toxicity.drop_toxic(df, chain)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in said.items() if not r.toxic}


def test_toxicity_of_odd_rows_and_labels(spark, toxic_tables):
    docs, labels = toxic_tables
    odd_labels = labels.unionByName(spark.createDataFrame([(None, 1, 1), (1, None, 0), (2, 1, None), (3, 1, 0), (3, 1, 0)], labels.schema))
    chain = toxicity.train(docs, odd_labels)
    assert toxicity.toxicity(table(spark, odd_rows()), chain).count() == len(odd_rows())
    assert toxicity.toxicity(docs.limit(0), chain).collect() == []
    for none in (labels.limit(0), labels.where("toxic = 0")):
        assert toxicity.toxicity(docs, toxicity.train(docs, none)).where("toxic").count() == 0
    assert toxicity.train(docs.limit(0), labels).vocabulary == {}


# ---- SentencePiece ------------------------------------------------------------------------

ODD_TEXTS = [
    "", " ", "  a  b\n\tc  ", "<s>hi</s> <unk> <0x0A>", "a\u0000b", "日本語 テキスト 🙂👍🏽", "x" * 3000, "  é é", " \n \n",
    "naïve café", "▁▁x ▁ y", "🙂" * 50, "tab\tand\r\nbreaks", "ﬁ ① Ａ", "​﻿",
]


def test_sentencepiece_parity():
    texts = ODD_TEXTS + patchwork(31, 200, vocabulary="the cat sat où été straße 漢字 42 ... a".split())
    assert sentencepiece_codec.parity(texts) == []


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "GROUP_CHARS", 200)
    texts = ["word  and   word " * 30, "x" * 500, " " * 300, "a " * 200 + "▁ b " * 50, *ODD_TEXTS]
    assert sentencepiece_codec.parity(texts) == []


def test_sentencepiece_round_trip(spark):
    rows = odd_rows() + [(100 + k, t, "s") for k, t in enumerate(ODD_TEXTS) if "▁" not in t]
    df = with_clashing_columns(table(spark, rows))
    encoded = sentencepiece_codec.encode(df)
    back = sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in sentencepiece_codec.decode(encoded).collect())
    assert back == sorted(((i is None, i or 0), t or "") for i, t, _ in rows)
    made = sentencepiece_codec.round_trip(df, with_ids=True).collect()
    assert all(r.decoded and r.n_tokens == len(r.ids) and r.ids_sha256 == sha(np.array(r.ids, "<i4").tobytes()) for r in made)
    assert sentencepiece_codec.round_trip(df.limit(0)).collect() == []


def test_unigram_models_keep_their_scores(tmp_path):
    import sentencepiece

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def chunk(field, data):
        return varint(field << 3 | 2) + varint(len(data)) + data

    def piece(text, score, kind=1):
        return chunk(1, chunk(1, text.encode()) + varint(2 << 3 | 5) + np.float32(score).tobytes() + varint(3 << 3) + varint(kind))

    # A hand-made model, not a trained one: pieces with scores, and the settings of its two specifications.
    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), ("▁", -3, 1), ("a", -4, 1), ("b", -4, 1), ("ab", -5, 1), ("▁ab", -6.5, 1), ("ba", -9, 1)]
    data = b"".join(piece(*p) for p in pieces) + chunk(2, varint(3 << 3) + varint(1)) + chunk(3, chunk(1, b"identity") + varint(4 << 3) + varint(0))
    path = tmp_path / "toy.model"
    path.write_bytes(data)
    texts = ["ab ab", "abab", "ba b a", "bab  ab", "a"]
    codec = sentencepiece_codec.Codec(str(path))
    other = sentencepiece.SentencePieceProcessor(model_file=str(path))
    assert [x.tolist() for x in codec.encode(texts)] == [other.encode(t) for t in texts]


# ---- quality rules ------------------------------------------------------------------------

def test_quality_rules_of_odd_rows(spark):
    rows = odd_rows() + [(100 + i, t, "s") for i, t in enumerate(patchwork(41, 60))] + [(300, "a b c a b c\na b\na b\n\n", "s")]
    df = table(spark, rows)
    unique = table(spark, list({r[0]: r for r in rows if r[0] is not None}.values()))
    assert compare(quality_rules.quality_rules(unique), frame_in_duck(unique), quality_rules.SQL) == []
    assert quality_rules.quality_rules(with_clashing_columns(df)).count() == len(rows)
    assert quality_rules.quality_rules(df.limit(0)).collect() == []
    r = quality_rules.quality_rules(df).where("doc_id = 300").first()
    assert (r.n_words, r.n_repeat_words, r.n_dup_lines, r.word_chars) == (10, 8, 1, 10)


def test_clashing_window_hashes_take_the_exact_way(spark):
    texts = [w for w in patchwork(43, 40)] + ["a b c " * 3, "a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    split = F.split("t", " ")
    rows = df.select(quality_rules._repeat_words(split).alias("fast"), quality_rules._repeat_words_sorted(split).alias("exact"), "t").collect()
    for r in rows:
        w = r.t.split(" ")
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        true = len({k + d for k, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)})
        assert r.fast == true and (len(w) < 3 or r.exact == true)


def test_rule_tables_compile(spark):
    df = spark.createDataFrame([(4, 2), (4, 0), (0, 0)], "a bigint, b bigint")
    rule = quality_rules.Rule("r", "b", "a", 0.25, 0.75)
    assert [r[0] for r in df.select(quality_rules.compiled((rule,))).collect()] == [True, False, True]


# ---- mixing -------------------------------------------------------------------------------

def plain_targets(sizes):
    """Iterative resharing of what is above three times a source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > 3 * sizes[s]}
        if not full:
            target.update({s: unit * weight[s] for s in open_})
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_share_all_words(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 5, 40, 3000, 100_000]) for s in ["a", "b", "é", "Z", "", None, "c", "d"][:rng.randint(1, 8)]}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size bigint")).collect()}
    assert got == pytest.approx(plain_targets(sizes))


@pytest.fixture(scope="module")
def mixed_table(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 30))), rng.choice(["a", "a", "a", "a", "b", "c", None])) for i in range(1500)]
    return table(spark, rows)


def test_mixture_is_near_its_targets_and_repeats(spark, mixed_table):
    con = frame_in_duck(mixed_table)
    assert compare(mixing.mixture(mixed_table), con, mixing.SQL) == []
    rows = mixing.mixture(mixed_table).collect()
    assert sorted(rows, key=str) == sorted(mixing.mixture(mixed_table.repartition(11)).collect(), key=str)
    taken = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source_size, r.target] = taken.get((r.source_size, r.target), 0) + r.taken
    assert all(abs(n - target) <= 16 for (_, target), n in taken.items())


def test_mixed_rows_and_shards(spark, mixed_table):
    df = with_clashing_columns(mixed_table)
    out = mixing.mix(df, shards=8)
    assert out.columns == df.columns
    copies = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    expected = {r.doc_id: r.taken // r.size for r in mixing.mixture(mixed_table).where("size > 0").collect()}
    assert {i: n for i, n in copies.items() if i in expected} == {i: n for i, n in expected.items() if n}
    table_, names = mixing.drawn(mixed_table, shards=8)
    draws = table_.select("doc_id", "source", F.explode(names["draws"]).alias("d")).select("doc_id", "source", "d.*").collect()
    assert len({(r.doc_id, r._copy) for r in draws}) == len(draws) and {r._shard for r in draws} == set(range(8))


def test_splitting_tree_keeps_quotas(spark):
    plan = spark.createDataFrame([("a", 2, 5 << 54), ("b", 0, (40 << 54) + 3), (None, 3, -1), ("e", 0, -1)], "source string, _copies bigint, _cut bigint")
    rows = mixing._shares(plan, 8, 1).select("_s", "_block", F.explode("_draws").alias("d")).select("_s", "_block", "d.*").collect()
    quota = {"a": 2 * 64 + 6, "b": 41, None: 3 * 64}
    assert len({(r._s, r._block, r._copy) for r in rows}) == len(rows)
    assert {s: sum(r._s == s for r in rows) for s in quota} == quota
    shard = [sum(r._shard == k for r in rows) for k in range(8)]
    assert max(shard) - min(shard) <= 1
    share = [sum(r._shard == k and r._s is None for r in rows) for k in range(8)]
    assert min(share) > 10  # about 24 of 46 in each shard


def test_mixing_odd_rows(spark):
    df = table(spark, odd_rows())
    got = mixing.mixture(with_clashing_columns(df)).collect()
    assert len(got) == len(odd_rows()) and all(r.size == len(words(t)) for r, t in zip(sorted(got, key=lambda r: r.size), sorted((t for _, t, _ in odd_rows()), key=lambda t: len(words(t)))))
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert mixing.mixture(df.limit(0)).collect() == [] and mixing.mix(df.limit(0)).collect() == []
