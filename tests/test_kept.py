"""Reports from kept tables equal a full recount after every load, read the kept tables only, and survive reruns."""

import random
from datetime import date

import pytest

from commentflow.operators import dashboard, lengths
from commentflow.plans.store import CommentStore
from commentflow.sources.kept import KeptReports

SCHEMA = "id string, text string, topic string, keyword string, label bigint, platform string, crawl_date date"
REPORTS = ("label_distribution", "daily_count", "platform_comparison", "topic_stats", "keyword_stats", "text_length_stats",
           "topic_label_distribution", "source_label_distribution", "source_topic_distribution", "topic_label_heatmap",
           "topic_distribution", "crawl_timeline", "dashboard_kpis", "summary", "platform_share")


def comments(seed, n=60):
    """Half of the rows have one topic; keys and texts may be null."""
    rng = random.Random(seed)
    return [(
        f"{seed}-{k}", rng.choice([None, "", "x" * rng.randrange(30), "á😀b"]), rng.choice(["hot", "hot", "a", None]),
        rng.choice(["k1", "k2", None]), rng.choice([-1, 0, 1, 2, None]), rng.choice(["threads", "tiktok"]),
        rng.choice([date(2024, 1, seed), date(2024, 2, 1), None])) for k in range(n)]


def answers(store):
    return {name: sorted(map(str, getattr(store, name)().collect())) for name in REPORTS}


class Plain(CommentStore):
    def __init__(self, spark, rows):
        super().__init__(spark, "nowhere")
        self.rows = rows

    def comments(self):
        return self.spark.createDataFrame(self.rows, SCHEMA)


def test_reports_equal_a_recount_after_every_load(spark, tmp_path):
    store = CommentStore(spark, str(tmp_path / "no-comments"), kept_root=str(tmp_path / "kept"))
    assert store.label_distribution().collect() == [] and store.dashboard_kpis().first().total_records == 0
    rows = []
    for batch in (1, 2, 3):
        new = comments(batch)
        store.kept.load(spark.createDataFrame(new, SCHEMA), batch)
        rows += new
    assert answers(store) == answers(Plain(spark, rows))
    assert all("/kept/" in f for f in store.summary().inputFiles() + store.text_length_stats().inputFiles())


def test_changed_rows_and_groups_that_disappear(spark, tmp_path):
    kept = KeptReports(spark, str(tmp_path / "kept"))
    old = comments(1)
    new = [(*r[:4], 2, *r[5:]) for r in old]
    kept.load(spark.createDataFrame(old, SCHEMA), 1)
    kept.load(spark.createDataFrame(new, SCHEMA), 2, removed=spark.createDataFrame(old, SCHEMA))
    found = dashboard.label_distribution(kept.counts()).collect()
    assert [(r.label, r.total) for r in found] == [(2, 60)]
    assert {r.label for r in lengths.text_length_stats(kept.lengths()).collect()} == {2}


def test_interrupted_load_is_run_again(spark, tmp_path, monkeypatch):
    kept = KeptReports(spark, str(tmp_path / "kept"))
    first, second = (spark.createDataFrame(comments(n), SCHEMA) for n in (1, 2))
    kept.load(first, 1)
    before = sorted(map(str, kept.counts().collect()))
    with monkeypatch.context() as broken:
        broken.setattr(kept._lengths, "add", lambda rows, batch: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.load(second, 2)
    # Readers still see the state after the first load, in both tables.
    assert kept.batches() == 1 and sorted(map(str, kept.counts().collect())) == before
    for _ in range(2):
        kept.load(second, 2)
        assert dashboard.dashboard_kpis(kept.counts()).first().total_records == 120
    assert sum(r.kept_rows for r in kept.lengths().collect()) == 120


def test_box_plots_from_kept_lengths(spark, tmp_path):
    rows = comments(4, 200)
    kept = KeptReports(spark, str(tmp_path / "kept"))
    plain = spark.createDataFrame(rows, SCHEMA)
    kept.load(plain, 1)
    for by in ([], ["label"], ["platform", "topic"]):
        made = [sorted(map(str, lengths.box_stats(df, by).collect())) for df in (kept.lengths(), plain)]
        assert made[0] == made[1]
