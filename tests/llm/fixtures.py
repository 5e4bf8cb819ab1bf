"""Small tables and plain versions of the operators for the tests of this folder."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names the operators use inside, to clash with.
EXTRA = ("_size", "_row_key", "fp", "row_key", "toxic", "_toxic", "line", "_draws", "id1", "grp", "tail", "spans", "_block")


def table(spark, rows):
    """documents from (doc_id, text, source) rows."""
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    prose = "the quick brown fox jumps over the lazy dog and runs far away into the deep dark wood"
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return [
        (1, None, "a"), (2, "", "a"), (3, prose, None), (None, prose, "b"), (None, None, None), (4, prose, "b"), (4, prose, "b"),
        (5, " \n\t ", "b"), (6, "one", "c"), (7, long, "c"), (8, "x" * 30_000, "c"), (9, prose + "\n" + prose, "c"),
        (10, "né e 漢字 \U0001f642 " * 40, None), (5, "other text of five", "b"),
    ]


def with_clashing_columns(df):
    for name in EXTRA:
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data.encode("utf-8") if isinstance(data, str) else data).hexdigest()


def components(n, links):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def repeated_bytes(texts, length):
    """(n_bytes, n_removed, n_spans, kept digest) of each text."""
    data = [(t or "").encode("utf-8") for t in texts]
    count = Counter(d[s:s + length] for d in data for s in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=bool)
        for s in range(len(d) - length + 1):
            if count[d[s:s + length]] > 1:
                gone[s:s + length] = True
        starts = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[:len(d)]).sum()) if len(d) else 0
        out.append((len(d), int(gone[:len(d)].sum()), starts, sha(bytes(b for b, g in zip(d, gone) if not g))))
    return out


def repeated_words(rows, window):
    """(n_words, n_removed, kept digest) for (doc_id, text) rows."""
    first = {}
    split = [(i, words(t)) for i, t in rows]
    for i, w in split:
        if i is not None:
            for s in range(len(w) - window + 1):
                key = tuple(w[s:s + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        if i is not None:
            for s in range(len(w) - window + 1):
                if first[tuple(w[s:s + window])] < i:
                    gone.update(range(s, s + window))
        out.append((len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def patchwork(seed, n, pieces=10, vocabulary="a b c dd é".split()):
    """Texts put together from common pieces and chance words."""
    rng = random.Random(seed)
    common = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 40))] for _ in range(pieces)]
    texts = []
    for _ in range(n):
        w = []
        for _ in range(rng.randint(0, 4)):
            piece = rng.choice(common)
            start = rng.randrange(len(piece))
            w += piece[start:start + rng.randint(1, 30)] + [rng.choice(vocabulary) for _ in range(rng.randint(0, 6))]
        texts.append(" ".join(w))
    return texts
