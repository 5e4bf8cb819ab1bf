"""The corpus pipeline, stage by stage, against plain versions; and the guard of the registry."""

import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
from fixtures import with_clashing_columns, words
from oracle import duck
from test_dedup_operators import plain_groups, plain_lines

from commentflow.llm import mixing, sentencepiece_codec, toxicity

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@needs_tables
def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    frames = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        frames.append(docs)
    assert all(f.columns == columns for f in frames[:-1])
    rows = [[(r.doc_id, r.text, r.source) for r in f.collect()] for f in frames[:-1]]
    start = spark.read.parquet(f"{SF_DIR}/documents.parquet")

    said = {r.doc_id: r.toxic for r in toxicity.toxicity(start, toxicity.train(start, toxicity.labelled(spark, SF_DIR))).collect()}
    truth = {r.doc_id: r.toxic for r in toxicity.labelled(spark, SF_DIR).collect()}
    assert {r[0] for r in rows[0]} == {i for i, t in said.items() if not t}
    assert sum(said[i] for i, t in truth.items() if not t) <= 0.02 * len(truth)

    gone = plain_lines(rows[0], 1)
    cut = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, t, _ in rows[0]}
    assert {r[0]: r[1] for r in rows[1]} == cut

    ordered = sorted(rows[1])
    _, roots = plain_groups(ordered)
    assert sorted(r[0] for r in rows[2]) == sorted(ordered[k][0] for k in set(roots))

    con = duck("/nonexistent")
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/2/*.parquet')")
    taken = {r[0]: (r[1], r[2]) for r in con.execute(f"select doc_id, size, taken from ({mixing.SQL})").fetchall()}
    copies = Counter(r[0] for r in rows[3])
    assert all(copies[i] * size == n for i, (size, n) in taken.items())
    assert all(size == len(words(next(t for j, t, _ in rows[2] if j == i))) for i, (size, _) in list(taken.items())[:20])

    texts = {r[0]: r[1] for r in rows[3]}
    last = frames[-1].collect()
    assert Counter(r.doc_id for r in last) == copies
    ids = list(texts)
    for i, encoded in zip(ids, sentencepiece_codec.codec(sentencepiece_codec.MODEL).encode([texts[i] for i in ids])):
        assert all(r.ids == encoded.tolist() and r.decoded for r in last if r.doc_id == i)
    assert sentencepiece_codec.parity([texts[i] for i in ids]) == []

    whole = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "ids_sha256").collect()
    assert Counter(map(tuple, whole)) == Counter((r.doc_id, r.ids_sha256) for r in last)


@needs_tables
def test_stages_of_clashing_and_empty_tables(spark):
    docs = with_clashing_columns(spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns, name
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).collect() == [], name


def test_the_registry_works_without_this_package(tmp_path):
    repo = Path(corpus_pipeline.__file__).parent
    for name in ("commentflow", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(repo / name) if name.endswith(".py") else None
    package = tmp_path / "commentflow"
    package.mkdir()
    for part in (repo / "commentflow").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (package / part.name).symlink_to(part)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'ngrams_global' in q and not any(k.startswith('op') or k == 'pipeline' for k in q), q"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
