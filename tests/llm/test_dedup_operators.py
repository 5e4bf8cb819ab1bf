"""SimHash, MinHash, suffix arrays, line and substring removal against plain versions."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from fixtures import components, edit_distance, odd_rows, patchwork, repeated_bytes, repeated_words, sha, table, with_clashing_columns, words
from pyspark.sql import functions as F

from commentflow.llm import fingerprints, line_dedup, simhash, substring_dedup, suffix_dedup
from commentflow.llm.graph import components as graph_components

LOWER = {c: c + 32 for c in range(65, 91)}


# ---- SimHash ------------------------------------------------------------------------------

def plain_simhash(text):
    w = words((text or "").translate(LOWER))
    grams = [" ".join(w[k:k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_by_definition():
    for text in [None, "", "  \n", "one", "A b C d", "a b c d", "x " * 40_000, *patchwork(1, 20)]:
        assert simhash.fingerprint(text) == plain_simhash(text)
    assert simhash.fingerprint("A B") == simhash.fingerprint("a b") != simhash.fingerprint("É b")


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 6])
def test_bit_sliced_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64) for _ in range(7)]
    fps = np.concatenate([base, base ^ flips[0], base ^ flips[1] ^ flips[2] ^ flips[3], base ^ flips[4] ^ flips[5] ^ flips[6] ^ flips[0] ^ flips[1]])
    ends = np.repeat([100, len(fps)], [100, len(fps) - 100])  # two runs
    got = {(int(a), int(b)) for i, j in simhash.bit_sliced(fps, ends, radius) for a, b in zip(i, j)}
    expected = {(i, j) for i in range(len(fps)) for j in range(i + 1, ends[i]) if int(fps[i] ^ fps[j]).bit_count() <= radius}
    assert got == expected


def plain_groups(rows):
    fps = [plain_simhash(t) for _, t, _ in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    return fps, components(len(rows), near)


def test_near_duplicates(spark, monkeypatch):
    rng = random.Random(2)
    base = [[rng.choice("abcdefghij") * rng.randint(1, 5) for _ in range(80)] for _ in range(12)]
    rows = []
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(80)] = "new"
        rows.append((i, " ".join(w), "s"))
    rows += [r for r in odd_rows() if r[0] is None] + [(500 + (r[0] or 0), r[1], r[2]) for r in odd_rows()]
    fps, roots = plain_groups(rows)
    least = defaultdict(list)
    for (i, _, _), r in zip(rows, roots):
        if i is not None:
            least[r].append(i)
    expected = sorted(((i is None, i or 0), f"{fp:016x}", min(least[r], default=None)) for (i, _, _), fp, r in zip(rows, fps, roots))
    for chunk in (1024, 3):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        df = with_clashing_columns(table(spark, rows))
        got = sorted(((r.doc_id is None, r.doc_id or 0), r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect())
        assert got == expected
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(v) for v in least.values())


def test_simhash_of_an_empty_table(spark):
    empty = table(spark, odd_rows()).limit(0)
    assert simhash.near_duplicates(empty).collect() == [] and simhash.keep_one(empty).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(200)] + [(300, 300 + i) for i in range(1, 60)] + [(5, 5), (700, 701)]
    links += [(rng.randint(800, 900), rng.randint(800, 900)) for _ in range(90)]
    roots = components(1000, links)
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = {r.node: r.component for r in graph_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {n: roots[n] for n in nodes}


# ---- MinHash ------------------------------------------------------------------------------

def test_edited_texts_and_likeness(spark):
    rows = [r for r in odd_rows() if r[0] not in (None, 4, 5)] + [(20 + i, t, "s") for i, t in enumerate(patchwork(3, 40))]
    df = with_clashing_columns(table(spark, rows))
    order = sorted(rows, key=lambda r: -r[0])
    for groups in (1, 5, 40):
        got = {r.doc_id: r for r in fingerprints.edited_fingerprints(df, groups=groups).collect()}
        assert len(got) == len(rows)
        for k, (i, text, _) in enumerate(order):
            text, after = text or "", order[(k + 1) % len(order)][1] or ""
            third = len(text) // 3
            edited = text[:len(text) - third] + after[:third]
            r = got[i]
            assert (r.n_chars, r.edited_sha256) == (len(text), sha(edited))
            assert r.fingerprint == fingerprints.text_of(fingerprints.MinHash().signature(text.encode()))
            assert r.edited_fingerprint == fingerprints.text_of(fingerprints.MinHash().signature(edited.encode()))
            assert 0 <= r.near_edited <= 1 and (r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint)


def test_edited_texts_with_null_and_repeated_ids(spark):
    got = fingerprints.edited_fingerprints(table(spark, odd_rows()), groups=4).collect()
    assert len(got) == len(odd_rows())
    assert fingerprints.edited_fingerprints(table(spark, odd_rows()).limit(0)).collect() == []
    assert fingerprints.edited_fingerprints(table(spark, [(1, "a b c", "s")])).first().near_next == 1.0


def test_likeness_estimates_jaccard():
    rng = random.Random(8)
    made = fingerprints.MinHash()
    errors = []
    for share in (0.1, 0.5, 0.9):
        for _ in range(20):
            a = [f"{rng.random():.6f}" for _ in range(400)]
            b = a[:int(400 * share)] + [f"{rng.random():.6f}" for _ in range(400 - int(400 * share))]
            x, y = ({" ".join(t[k:k + 5]) for k in range(396)} for t in (a, b))
            true = len(x & y) / len(x | y)
            errors.append(fingerprints.likeness(*(made.signature(" ".join(t).encode()) for t in (a, b))) - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_near_pairs_against_all_pairs(spark):
    rng = random.Random(6)
    base = [[f"t{rng.randint(0, 10_000)}" for _ in range(120)] for _ in range(6)]
    rows = []
    for i in range(80):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(120)] = f"n{rng.random()}"
        rows.append((i, " ".join(w), "s"))
    pairs, members = fingerprints.near_pairs(table(spark, rows + [(90, None, "s"), (91, "", "s")]))
    of = {r.doc_id: r.class_id for r in members.collect()}
    assert of[91] == 90
    grams = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t, _ in rows)}
    expected = {}
    for i in {of[r[0]] for r in rows}:
        for j in {of[r[0]] for r in rows}:
            jaccard = len(grams[i] & grams[j]) / len(grams[i] | grams[j])
            if i < j and jaccard >= 0.8:
                expected[i, j] = jaccard
    got = {(r.a, r.b): r.jaccard for r in pairs.collect()}
    assert got == pytest.approx(expected)


# ---- suffix arrays ------------------------------------------------------------------------

def test_suffix_array_orders_all_suffixes():
    rng = random.Random(1)
    for letters in ([1, 2, 3, 255], [7, 7, 7, 8], [9]):
        for _ in range(60):
            text = np.array([rng.choice(letters) for _ in range(rng.randint(0, 60))], dtype=np.uint8)
            expected = sorted(range(len(text)), key=lambda i: bytes(text[i:]))
            assert suffix_dedup.suffix_array(text, 64).tolist() == expected


@pytest.mark.parametrize("hot", [8192, 3])
def test_removed_bytes(spark, hot):
    texts = patchwork(5, 120) + ["ab" * 40, "ab" * 40, "a" * 100, None, "", "é" * 30, "\x00" * 40]
    df = with_clashing_columns(table(spark, [(i, t, "s") for i, t in enumerate(texts)]))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, 20, 6, hot).collect()}
    assert got == dict(enumerate(repeated_bytes(texts, 20)))
    assert sum(v[1] for v in got.values()) > 1000


def test_removed_bytes_of_odd_rows(spark):
    rows = odd_rows()
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(table(spark, rows)).collect())
    assert [g[0] for g in got] == sorted(len((t or "").encode()) for _, t, _ in rows)
    short = [(i, None if t is None else t[:400], s) for i, t, s in rows]
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(table(spark, short), 30, 8).collect())
    assert got == sorted(repeated_bytes([t for _, t, _ in short], 30))
    assert suffix_dedup.remove_repeats(table(spark, rows).limit(0)).collect() == []


# ---- lines --------------------------------------------------------------------------------

def test_edit_distance_in_the_plan(spark):
    rng = random.Random(9)
    pairs = []
    for _ in range(800):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 9)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randint(0, len(b))
            b[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "é"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for t in (1, 2, 3):
        got = [r[0] for r in df.select(line_dedup.edit_distance(F.col("a"), F.col("b"), t)).collect()]
        assert got == [min(edit_distance(a, b), t + 1) for a, b in pairs]


def plain_lines(rows, threshold):
    """Removed line numbers for rows with different, non-null ids."""
    lines = [(i, n, x) for i, t, _ in sorted(rows, key=lambda r: r[0]) for n, x in enumerate((t or "").split("\n")) if words(x)]
    first = {}
    for i, n, x in lines:
        first.setdefault(x, (i, n))
    gone = defaultdict(list)

    def close(x, y):
        a, b = Counter(x), Counter(y)  # letters too many on either side are edits at least
        return max((a - b).total(), (b - a).total()) <= threshold and edit_distance(x, y) <= threshold

    for i, n, x in lines:
        near = len(x) >= 20 and any(
            f < (i, n) and abs(len(x) - len(y)) <= threshold and len(y) >= 20 and close(x, y) for y, f in first.items() if y != x)
        if first[x] != (i, n) or near:
            gone[i].append(n)
    return gone


@pytest.mark.parametrize("threshold", [1, 2])
def test_removed_lines(spark, threshold):
    rng = random.Random(threshold)
    base = ["".join(rng.choice("abc ") for _ in range(rng.randint(15, 40))) + "x" for _ in range(25)]
    rows = []
    for i in range(60):
        out = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                k = rng.randint(0, len(line))
                line[k:k + rng.randint(0, 1)] = rng.choice(["", "z", "é"])
            out.append("".join(line))
        rows.append((i, "\n".join(out), "s"))
    rows += [(100, None, "s"), (101, "", "s"), (102, "\n \n", "s"), (103, "\n".join(base[:3]) + "\n\n", "s")]
    df = with_clashing_columns(table(spark, rows))
    expected = plain_lines(rows, threshold)
    got = {r.doc_id: r for r in line_dedup.removed_lines(df, threshold).collect()}
    assert {i: r.removed for i, r in got.items()} == {i: ",".join(map(str, expected[i])) for i, _, _ in rows}
    assert all(r.n_equal + r.n_near == len(expected[i]) for i, r in got.items())
    cut = line_dedup.dedup_lines(df, threshold)
    assert cut.columns == df.columns
    for r in cut.collect():
        text = next(t for i, t, _ in rows if i == r.doc_id)
        assert r.text == (None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in expected[r.doc_id]))
        assert r.n_chars == (None if r.text is None else len(r.text))


def test_lines_of_odd_rows(spark):
    df = table(spark, odd_rows())
    assert line_dedup.removed_lines(df).count() == line_dedup.dedup_lines(df).count() == len(odd_rows())
    by_id = {(r.doc_id, r.n_lines): r for r in line_dedup.removed_lines(df).collect()}
    assert by_id[3, 1].removed == "0" and by_id[None, 1].removed == ""  # a null id counts as earliest
    assert by_id[9, 2].removed == "0,1"
    empty = df.limit(0)
    assert line_dedup.removed_lines(empty).collect() == [] and line_dedup.dedup_lines(empty).collect() == []


# ---- word spans ---------------------------------------------------------------------------

def test_removed_words(spark):
    rows = [(i, t, "s") for i, t in enumerate(patchwork(11, 120))] + [(500, None, "s"), (501, "", "s")]
    df = with_clashing_columns(table(spark, rows))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(df, 8, 3).collect()}
    assert got == dict(zip((r[0] for r in rows), repeated_words([r[:2] for r in rows], 8)))
    assert sum(v[1] for v in got.values()) > 500


def test_removed_words_of_odd_rows(spark):
    rows = odd_rows()
    got = sorted((r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(table(spark, rows), 10, 3).collect())
    assert got == sorted(repeated_words([r[:2] for r in rows], 10))
    assert substring_dedup.remove_repeats(table(spark, rows).limit(0)).collect() == []
