"""Streams against the batch result, across restarts, replays and late rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from commentflow.operators.inference import lexicon_factory
from commentflow.streaming import counts, ingest, moderation, routing
from commentflow.streaming.sinks import late_rows, read_sink

ONCE = {"availableNow": True}
POST = "text string, topic string, keyword string, url string"
EVENT = "key int, ts timestamp, text string, platform string"


def put(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def at(day, hour=0):
    return datetime.datetime(2026, 6, day, hour)


def test_ingest_appends_unseen_rows_across_restarts(spark, tmp_path):
    source, sink, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    stored = spark.createDataFrame([("old", "t", "k", "u")], POST)

    def run():
        stream = spark.readStream.schema(POST).parquet(str(source))
        ingest.stream_ingest_dedup(stream, sink, state, stored, trigger=ONCE).awaitTermination()
        return sorted(r.text for r in read_sink(spark, sink).collect())

    put(spark, source, [("old ", "t", "k", "u"), ("a", "t", "k", "u"), ("a", "t", "k", "u")], POST)
    assert run() == ["a", "a"]
    put(spark, source, [("a", "t", "k", "u"), ("b", "t", "k", "u")], POST)
    assert run() == ["a", "a", "b"]
    assert run() == ["a", "a", "b"]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    source, sink, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    stream = lambda: spark.readStream.schema(POST).parquet(str(source))
    for text in ("a", "b"):
        put(spark, source, [(text, "t", "k", "u")], POST)
        ingest.stream_ingest_dedup(stream(), sink, str(state), trigger=ONCE).awaitTermination()
    before = sorted((r.text, r.batch_id) for r in read_sink(spark, sink).collect())
    # Forget that the last batch was committed, as if the driver had died right after writing it.
    last = max((p for p in (state / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.rename(tmp_path / "lost-commit")
    crc = last.with_name(f".{last.name}.crc")
    if crc.exists():
        crc.rename(tmp_path / "lost-commit.crc")
    ingest.stream_ingest_dedup(stream(), sink, str(state), trigger=ONCE).awaitTermination()
    assert sorted((r.text, r.batch_id) for r in read_sink(spark, sink).collect()) == before


def test_moderation_classifies_each_comment_once(spark, tmp_path):
    source, sink, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = spark.readStream.schema(EVENT).parquet(str(source))
        moderation.stream_moderation(
            stream, sink, state, lexicon_factory({"idiot": 1}), ["key"], trigger=ONCE
        ).awaitTermination()
        return sorted((r.key, r.text, r.is_target) for r in spark.read.parquet(sink).collect())

    put(spark, source, [(1, at(1), " an idiot ", "p"), (2, at(1), "fine", "p"), (3, at(1), " \n", "p"), (1, at(1), "an idiot", "p")], EVENT)
    first = run()
    assert [(k, flag) for k, _, flag in first] == [(1, True), (2, False)] and first[0][1] == "an idiot"
    put(spark, source, [(2, at(1), "fine", "p"), (4, at(1), "idiot", "p")], EVENT)
    assert [(k, flag) for k, _, flag in run()] == [(1, True), (2, False), (4, True)]


def test_daily_counts_over_restarts_with_late_rows(spark, tmp_path):
    source, sink, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = spark.readStream.schema(EVENT).parquet(str(source))
        started = counts.stream_daily_count(stream, sink, state, trigger=ONCE)
        started.awaitTermination()
        late.append(late_rows(started))
        return {(r.crawl_date.day, r.platform): r.total for r in counts.latest_counts(spark, sink).collect()}

    late = []
    put(spark, source, [(1, at(1, 23), "", "p"), (2, at(2, 0), "", "p"), (3, at(2, 5), "", "q")], EVENT)
    assert run() == {(1, "p"): 1, (2, "p"): 1, (2, "q"): 1}
    put(spark, source, [(4, at(2, 9), "", "p"), (5, at(9), "", "p")], EVENT)
    assert run() == {(1, "p"): 1, (2, "p"): 2, (2, "q"): 1, (9, "p"): 1}
    put(spark, source, [(6, at(2, 9), "", "p"), (7, at(9, 1), "", "p")], EVENT)
    assert run() == {(1, "p"): 1, (2, "p"): 2, (2, "q"): 1, (9, "p"): 2}
    assert late == [0, 0, 1]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh"])
def test_days_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.sql("select timestamp_ntz'2026-06-01 23:30:00' as ts union all select timestamp_ntz'1969-12-31 01:00:00'")
        days = df.select(counts.utc_day(counts.utc_instant(F.col("ts"))).alias("d")).collect()
        assert sorted(str(r.d) for r in days) == ["1969-12-31", "2026-06-01"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_every_row_is_kept_repeated_or_late(spark, tmp_path):
    source, sink, rest, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "rest"), str(tmp_path / "state")

    def run():
        stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(source))
        routing.stream_moderation_routed(
            stream, sink, rest, state, lexicon_factory({"idiot": 1}), ["key"], delay="1 hour", trigger=ONCE).awaitTermination()
        kept = sorted((r.key, r.ts.hour if r.ts else -1, r.is_target) for r in read_sink(spark, sink).collect())
        return kept, sorted((r.key, r.ts.hour if r.ts else -1, r.route) for r in read_sink(spark, rest).collect())

    put(spark, source, [(1, at(1, 5), "Idiot", "p"), (2, at(1, 5), "fine", "p"), (2, at(1, 5), "fine", "p"), (3, at(1, 5), " ", "p")], EVENT)
    assert run() == ([(1, 5, True), (2, 5, False)], [(2, 5, "repeated")])
    put(spark, source, [(1, at(1, 5), "again", "p"), (4, at(1, 8), "fine", "p"), (5, None, "fine", "p")], EVENT)
    put(spark, source, [(6, at(1, 7), "late", "p"), (4, at(1, 8), "fine", "p"), (2, at(1, 9), "after its time", "p"), (5, None, "x", "p")], EVENT)
    kept, others = run()
    assert kept == [(1, 5, True), (2, 5, False), (2, 9, False), (4, 8, False), (5, -1, False), (5, -1, False)]
    assert others == [(1, 5, "repeated"), (2, 5, "repeated"), (4, 8, "repeated"), (6, 7, "late")]


def test_count_sink_is_merged_as_it_grows(spark, tmp_path):
    source, sink, state = tmp_path / "in", tmp_path / "out", str(tmp_path / "state")
    for k in range(9):
        put(spark, source, [(k, at(1, k), "", "p"), (k, at(2, k), "", f"q{k}")], EVENT)
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(source))
    counts.stream_daily_count(stream, str(sink), state, trigger=ONCE).awaitTermination()
    table = counts.count_table(spark, str(sink), ["platform"])
    assert table.batches() >= 9 and len(table.folders(table.batches())) <= table.batches().bit_length()
    got = {(r.crawl_date.day, r.platform): r.total for r in counts.latest_counts(spark, str(sink)).collect()}
    assert got == {(1, "p"): 9} | {(2, f"q{k}"): 1 for k in range(9)}


def test_a_routed_key_asks_its_state_once():
    """Late rows ask nothing, a timer clears without asking, and a first row that gives way takes its timer along."""
    calls, held, timers, clock = [], [None], set(), [0]

    class Fake:
        getValueState = lambda self, *_: self
        getCurrentWatermarkInMs = lambda self: clock[0]
        get = lambda self: calls.append("get") or held[0]
        update = lambda self, value: held.__setitem__(0, value)
        clear = lambda self: held.__setitem__(0, None)
        registerTimer, deleteTimer = staticmethod(timers.add), staticmethod(timers.remove)

    judge = routing.FirstOfKey(["at"], 0, 10)
    judge.init(Fake())
    run = lambda *times: [r.route for r in judge.handleInputRows((1,), iter([(t,) for t in times]), Fake())]
    assert run(5, 6, 5) == ["kept", "repeated", "repeated"] and calls == ["get"] and timers == {15}
    clock[0] = 16
    assert run(16, 3) == ["late", "late"] and calls == ["get"]
    assert run(20, 4, 21) == ["kept", "late", "repeated"] and calls == ["get"] * 2 and timers == {30} and held == [(20,)]
    list(judge.handleExpiredTimer((1,), Fake(), None))
    assert held == [None] and calls == ["get"] * 2
