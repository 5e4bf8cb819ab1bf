"""The near-dedup stage against a plain version: components of texts whose five-word shingles are alike by 0.8 or more."""

import random

import corpus_pipeline
import numpy as np
import pytest
from fixtures import components, odd_rows, table, with_clashing_columns, words

from commentflow.llm import near_dedup, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_kept(rows):
    sets = [grams(t) for _, t, _ in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if likeness(sets[i], sets[j]) >= 0.8]
    groups = {}
    for (i, _, _), root in zip(rows, components(len(rows), near)):
        groups.setdefault(root, []).append((i is None, i or 0))
    return sorted(min(g) for g in groups.values())


def kept(frame):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in frame.collect())


def edited(rng, base, changes):
    w = list(base)
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("chunk", [256, 4])
def test_copies_from_0_8_to_0_95(spark, monkeypatch, chunk):
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    rng = random.Random(5)
    rows = []
    for k in range(30):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        rows.append((len(rows), " ".join(base), "s"))
        rows += [(len(rows) + n, edited(rng, base, c), "s") for n, c in enumerate((2, 3, 4, 5, 6, 8, 12))]
    # One large group of copies, each near its base and some of them near each other.
    base = [f"h{rng.randrange(5000)}" for _ in range(400)]
    rows += [(1000 + n, edited(rng, base, n % 7).upper(), "s") for n in range(60)]
    at = [likeness(grams(rows[8 * k][1]), grams(rows[8 * k + n][1])) for k in range(30) for n in range(1, 8)]
    assert sum(0.8 <= j < 0.95 for j in at) > 100 and min(at) < 0.8
    stage = dict(corpus_pipeline.STAGES)["simhash"]
    assert kept(stage(spark, table(spark, rows), "")) == plain_kept(rows)


def test_pages_of_one_template_form_no_group(spark):
    """Likeness near 0.5: bands are shared all over, but no text moves; two true copies among them are still found."""
    rng = random.Random(9)
    template = [f"t{rng.randrange(5000)}" for _ in range(150)]
    rows = [(k, " ".join(template + [f"p{rng.randrange(10**7)}" for _ in range(75)]), "s") for k in range(1500)]
    rows.append((1500, rows[700][1] + " and more", "s"))
    assert 0.45 < likeness(grams(rows[0][1]), grams(rows[1][1])) < 0.55
    frame = table(spark, rows)
    classes = near_dedup.signed(frame)
    shared = classes.selectExpr("explode(keys) as key").groupBy("key").count().where("count > 100").count()
    assert shared and near_dedup._groups(classes).count() == 2
    assert [n for _, n in kept(near_dedup.keep_one(frame))] == list(range(1500))


@pytest.mark.parametrize("size", [1, 2, 30, 1000])
def test_minima_of_pairs_at_0_8_agree_often_enough(size):
    rng = np.random.default_rng(size)
    made = near_dedup._hasher()
    for _ in range(40):
        both = np.unique(rng.integers(0, 1 << 63, 5 * size, dtype=np.uint64))
        own = max(1, len(both) // 10) if size > 2 else 0
        a, b = (near_dedup.sketch(made.minima(x))[None] for x in (both[own:], both[:len(both) - own]))
        assert near_dedup.agreeing(a, b)[0] >= near_dedup.LEAST_SAME


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_rows() + [(20, "One two three four", "s"), (21, "one  two three\nfour", "s"), (22, "one two three", "s")]
    frame = with_clashing_columns(table(spark, rows))
    out = near_dedup.keep_one(frame)
    assert out.columns == frame.columns
    assert kept(out) == plain_kept(rows)
    assert near_dedup.keep_one(frame.limit(0)).collect() == []


@pytest.mark.parametrize("radius", [7, 8, 24, 31])
def test_bit_sliced_pairs_of_a_wide_radius(radius):
    rng = np.random.default_rng(radius)
    fps = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    fps[75:] = fps[:75] ^ np.array([sum(1 << int(b) for b in rng.choice(64, k % 40, replace=False)) for k in range(75)], dtype=np.uint64)
    found = {(int(a), int(b)) for i, j in simhash.bit_sliced(fps, np.full(150, 150), radius) for a, b in zip(i, j)}
    assert found == {(i, j) for j in range(150) for i in range(j) if int(fps[i] ^ fps[j]).bit_count() <= radius}
