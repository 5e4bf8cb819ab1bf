"""Ranks, caps and duplicate removal against brute force, with one group holding most of the rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from commentflow.operators import dedup, ranking
from commentflow.operators.sampling import stratified_kfold


@pytest.fixture(scope="module")
def skewed(spark):
    """6,000 rows; one url holds half of them and one is null."""
    rng = random.Random(3)
    rows = []
    for i in rng.sample(range(100_000), 6_000):
        url = "hot" if rng.random() < 0.5 else rng.choice([None, *(f"u{k}" for k in range(40))])
        rows.append((i, url, rng.choice([" Same ", "same", "Same", f"text {i % 700}", "x" * 90 + str(i % 3)])))
    df = spark.createDataFrame(rows, "id bigint, url string, text string").repartition(7).cache()
    return rows, df


@pytest.mark.parametrize("block_rows", [100, 1_000_000])
@pytest.mark.parametrize("n", [1, 50, 999, 1_000, 5_000])
def test_cap_rows(skewed, n, block_rows):
    rows, df = skewed
    groups = defaultdict(list)
    for i, url, _ in rows:
        groups[url].append(i)
    expected = {i for ids in groups.values() for i in sorted(ids)[:n]}
    assert {r.id for r in ranking.cap_rows(df, ["url"], "id", n, block_rows).collect()} == expected
    descending = ranking.cap_rows(df, ["url"], F.desc("id"), n, block_rows)
    assert {r.id for r in descending.collect()} == {i for ids in groups.values() for i in sorted(ids)[-n:]}


@pytest.mark.parametrize("block_rows", [40, 500, 1_000_000])
def test_exact_rank_inside_groups_and_overall(skewed, block_rows):
    rows, df = skewed
    groups = defaultdict(list)
    for i, url, _ in rows:
        groups[url].append(i)
    expected = {i: k for ids in groups.values() for k, i in enumerate(sorted(ids))}
    got = {r.id: r["rank"] for r in ranking.with_rank(df, ["url"], "id", block_rows=block_rows).collect()}
    assert got == expected
    overall = {r.id: r["rank"] for r in ranking.with_rank(df, (), "id", block_rows=block_rows).collect()}
    assert overall == {i: k for k, i in enumerate(sorted(i for i, _, _ in rows))}


def test_string_ids_are_ranked_in_their_order(spark, skewed):
    rows, df = skewed
    strings = df.withColumn("id", F.format_string("%08d", "id"))
    expected = {r.id: r["rank"] for r in ranking.with_rank(df, ["url"]).collect()}
    got = {int(r.id): r["rank"] for r in ranking.with_rank(strings, ["url"], block_rows=300).collect()}
    assert got == expected
    few = spark.createDataFrame([(f"{i:03d}", "https://h/video/7") for i in range(6)], "id string, url string")
    assert [r.comment_id for r in dedup.comment_key(few).orderBy("id").collect()] == [f"7_{i}" for i in range(6)]


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_null_ids_keep_their_row_and_rank(spark, kind):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (2, "b"), (None, None)], f"id {'bigint' if kind == 'bigint' else 'int'}, url string")
    df = df.withColumn("id", F.col("id").cast(kind))
    got = sorted(((r.url or "", r.id is not None, r["rank"]) for r in ranking.with_rank(df, ["url"], block_rows=1).collect()))
    assert got == [("", False, 0), ("a", False, 0), ("a", True, 1), ("b", True, 0)]
    assert ranking.with_rank(df.limit(0), ["url"]).count() == 0


def test_rank_survives_planning_without_broadcast(spark, skewed):
    _, df = skewed
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        ranked = ranking.with_rank(df, ["url"], "id", block_rows=400)
        assert ranked.count() == df.count()
        assert ranked.filter("url is null").count() == df.filter("url is null").count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_dedup_prefix(skewed):
    rows, df = skewed
    first = {}
    for i, _, text in sorted(rows):
        first.setdefault(text[:80].lower(), i)
    assert {r.id for r in dedup.dedup_prefix80(df).collect()} == set(first.values())


def test_dedup_inside_group(skewed):
    rows, df = skewed
    first = {}
    for i, url, text in sorted(rows, key=lambda r: r[0]):
        first.setdefault((url, text.strip()), i)
    assert {r.id for r in dedup.dedup_exact_in_group(df).collect()} == set(first.values())


def test_cap_posts_per_keyword(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "a", "a", "b"]), f"u{rng.randint(0, 30)}") for i in range(3_000)]
    df = spark.createDataFrame(rows, "id bigint, keyword string, url string").repartition(5)
    seen = defaultdict(list)
    for _, keyword, url in rows:
        if url not in seen[keyword]:
            seen[keyword].append(url)
    expected = {i for i, keyword, url in rows if url in seen[keyword][:10]}
    assert {r.id for r in dedup.cap_posts_per_keyword(df).collect()} == expected


def test_comment_key_counts_inside_a_video(spark):
    rows = [(i, f"https://h/video/{7 if i % 3 else i % 5}") for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, url string")
    index, expected = defaultdict(int), {}
    for i, url in rows:
        video = url.rsplit("/", 1)[1]
        expected[i] = f"{video}_{index[video]}"
        index[video] += 1
    assert {r.id: r.comment_id for r in dedup.comment_key(df).collect()} == expected


def test_folds_are_balanced_and_do_not_depend_on_partitioning(spark):
    rows = [(i, 0 if i % 10 else 1 + i % 2) for i in range(2_003)]
    df = spark.createDataFrame(rows, "id bigint, label int")
    one = {r.id: r.fold for r in stratified_kfold(df.repartition(3)).collect()}
    two = {r.id: r.fold for r in stratified_kfold(df.coalesce(1), prefix=1).collect()}
    assert one == two and set(one) == {i for i, _ in rows}
    sizes = defaultdict(lambda: [0] * 5)
    for i, label in rows:
        sizes[label][one[i]] += 1
    assert all(max(s) - min(s) <= 1 for s in sizes.values())


def test_top_counted_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("g", "b", 2), ("g", "a", 2), ("g", "c", 9), ("h", "z", 1)], "g string, v string, count int")
    got = [(r.g, r.v, r["rank"]) for r in ranking.top_counted(df, ["g"], "v", 2).orderBy("g", "rank").collect()]
    assert got == [("g", "c", 1), ("g", "a", 2), ("h", "z", 1)]


def test_rank_blocks_follow_the_width_of_rows(spark, monkeypatch):
    """Few rows that are wide are ranked in several blocks, so that no task reads them all."""
    monkeypatch.setattr(ranking, "BLOCK_BYTES", 100_000)
    written, stored = {}, ranking.stored
    monkeypatch.setattr(ranking, "stored", lambda df, name: written.setdefault(name, stored(df, name)))
    rng = random.Random(7)
    rows = [(i, rng.randbytes(1_000).hex()) for i in rng.sample(range(10_000), 600)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    got = {r["rank"]: (r.id, r.text) for r in ranking.with_rank(df).collect()}
    assert got == dict(enumerate(sorted(rows)))
    assert written["ranked"].select("_block").distinct().count() >= 4
    monkeypatch.setattr(ranking, "BLOCK_BYTES", 1 << 40)
    assert ranking._blocks(written["ranked"], 150) == 4 and ranking._blocks(written["ranked"].limit(0), 150) == 1
