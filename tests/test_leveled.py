"""Leveled tables and the digest index: few folders, interrupted merges, replays, and bytes read by a batch."""

import pytest
from pyspark.sql import functions as F

from commentflow.operators.joins import DIGEST, row_digest
from commentflow.sources.digest_index import DigestIndex, load_unknown, prefix
from commentflow.sources.leveled import Leveled

KEYS = ("text",)


def rows_of(spark, batch, n=3):
    return spark.createDataFrame([(batch, k, batch * 10 + k) for k in range(n)], "batch int, key int, value int").coalesce(1)


def newest(rows):
    return rows.groupBy("key").agg(F.max_by("value", "batch").alias("value"), F.max("batch").alias("batch"))


def held(df):
    return sorted(tuple(r[c] for c in ("batch", "key", "value")) for r in df.collect())


def expected(batches, n=3):
    return sorted((b, k, b * 10 + k) for b in range(1, batches + 1) for k in range(n))


def test_rows_of_all_batches_in_few_folders(spark, tmp_path):
    table = Leveled(spark, str(tmp_path / "t"))
    assert table.read() is None and table.batches() == 0
    for batch in range(1, 10):
        table.add(rows_of(spark, batch), batch)
        folders = table.folders(batch)
        assert len(folders) <= batch.bit_length() and table.batches() == batch
        on_disk = [p for p in (tmp_path / "t").iterdir() if p.name.startswith("level-")]
        assert len(on_disk) <= 2 * batch.bit_length()
        if batch in (1, 3, 4, 7, 8, 9):
            assert held(table.read()) == expected(batch)
            # Readers that began before the last batch still find their folders.
            assert batch == 1 or held(table.read(batch - 1)) == expected(batch - 1)
    with pytest.raises(ValueError):
        table.add(rows_of(spark, 25), 25)


def test_interrupted_and_repeated_batches_change_nothing(spark, tmp_path):
    plain, broken = Leveled(spark, str(tmp_path / "a"), newest), Leveled(spark, str(tmp_path / "b"), newest)

    class Crash(Exception):
        pass

    def crash(*_):
        raise Crash

    for batch in range(1, 6):
        plain.add(rows_of(spark, batch), batch)
        before = broken.read()
        before = None if before is None else held(before)
        publish, broken.publish = broken.publish, crash
        with pytest.raises(Crash):  # merged, but not published
            broken.add(rows_of(spark, batch), batch)
        broken.publish = publish
        after = broken.read()
        assert (None if after is None else held(after)) == before
        broken.add(rows_of(spark, batch), batch)
        if batch % 3 == 0:
            broken.add(rows_of(spark, batch), batch)  # published, but the batch is run again
        assert held(broken.read()) == held(plain.read()) == [(batch, k, batch * 10 + k) for k in range(3)]


def input_bytes(spark, action):
    """Bytes that the stages of an action read from files."""
    gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()

    def total():
        bus.waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(k).inputBytes() for k in range(stages.size()))

    before = total()
    action()
    return total() - before


def texts(spark, low, high):
    return spark.range(low, high, 1, 1).select(F.format_string("text %d", "id").alias("text"))


def digests_of(df):
    return df.select(row_digest(KEYS).alias(DIGEST))


def test_unknown_rows_against_base_and_batches(spark, tmp_path):
    index = DigestIndex(spark, str(tmp_path / "i"), rows_per_bucket=16)
    new = texts(spark, 0, 40)
    assert load_unknown(new, index, KEYS).count() == 40
    index.build(digests_of(texts(spark, 0, 100)))
    with pytest.raises(ValueError):
        index.build(digests_of(new))
    seen = 100
    for batch in range(1, 5):
        some = texts(spark, seen - 5, seen + 10)
        fresh = load_unknown(some, index, KEYS)
        got = sorted(r.text for r in fresh.collect())
        assert got == sorted(f"text {k}" for k in range(seen, seen + 10))
        index.add(digests_of(spark.createDataFrame([(t,) for t in got], "text string")), batch)
        # The batch itself, when it is run again, is compared with earlier ones only.
        assert index.unknown(some.withColumn(DIGEST, row_digest(KEYS)), batch - 1).count() == 10
        seen += 10
    assert load_unknown(texts(spark, 0, seen), index, KEYS).count() == 0
    assert load_unknown(spark.createDataFrame([(None,), ("text 3 ",)], "text string"), index, KEYS).collect()[0].text is None


def test_bytes_read_by_a_batch_do_not_follow_the_index(spark, tmp_path):
    small, large = (DigestIndex(spark, str(tmp_path / name), rows_per_bucket=512) for name in ("small", "large"))
    small.build(digests_of(texts(spark, 0, 20_000)))
    large.build(digests_of(texts(spark, 0, 160_000)))

    def read(index, low):
        return input_bytes(spark, lambda: load_unknown(texts(spark, low, low + 5), index, KEYS).collect())

    first, of_large = read(small, 0), read(large, 0)
    assert of_large < 1.3 * first
    per_batch = {}
    for batch in range(1, 21):
        low = 1_000_000 + 5 * batch
        if batch in (1, 20):
            per_batch[batch] = read(large, low)
        large.add(digests_of(texts(spark, low, low + 5)), batch)
    everything = sum(p.stat().st_size for p in (tmp_path / "large").rglob("*.parquet"))
    # What is added are the levels of 19 small batches, three of them.
    assert per_batch[20] < 3 * per_batch[1] and per_batch[20] < everything / 50


def test_prefixes_name_ranges_of_digests(spark):
    df = spark.createDataFrame([(bytes.fromhex("ff00aa11"),), (bytes.fromhex("00ffffff"),), (b"",)], "d binary")
    got = df.select(prefix(F.col("d"), 0).alias("none"), prefix(F.col("d"), 8).alias("byte"), prefix(F.col("d"), 1).alias("bit")).collect()
    assert [tuple(r) for r in got] == [(0, 255, 1), (0, 0, 0), (0, 0, 0)]
