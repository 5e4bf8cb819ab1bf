"""Aggregates, evaluation, voting, pages and corpus operators against brute force."""

import math
import os
import random
import statistics
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from commentflow.operators import (
    baselines, corpus, dashboard, evaluation, exploration, filters, inference, joins, lengths, ngrams, pages, sampling, voting,
)


@pytest.fixture(scope="module")
def posts(spark):
    rng = random.Random(11)
    rows = []
    for i in range(1_500):
        words = [rng.choice("abcdefg") * rng.randint(1, 3) for _ in range(rng.randint(0, 12))]
        text = None if i % 97 == 0 else "  ".join(words)
        rows.append((i, text, rng.choice(["x", "x", "x", "y", None]), rng.choice(["tiktok", "threads"]),
                     rng.choice([-1, 0, 0, 1, 2, None])))
    df = spark.createDataFrame(rows, "id bigint, text string, topic string, platform string, label int")
    return rows, df.withColumn("source", F.col("platform")).repartition(4).cache()


# ---- lengths ------------------------------------------------------------------------------

def test_text_length_stats(posts):
    rows, df = posts
    got = {(r.label, r.platform): r for r in lengths.text_length_stats(df).collect()}
    groups = defaultdict(list)
    for _, text, _, platform, label in rows:
        groups[label, platform].append(text)
    assert set(got) == set(groups)
    for key, texts in groups.items():
        sizes = sorted(len(t) for t in texts if t is not None)
        row = got[key]
        assert row["count"] == len(texts)
        assert (row["min"], row["max"]) == (sizes[0], sizes[-1])
        assert row["mean"] == pytest.approx(statistics.mean(sizes))
        assert row["stddev"] == pytest.approx(statistics.stdev(sizes))
        for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            assert row[name] == sizes[math.ceil(p * len(sizes)) - 1]


def test_text_length_stats_of_groups_without_text(spark):
    df = spark.createDataFrame([(0, "a", None), (1, "a", "xy")], "label int, platform string, text string")
    rows = {r.label: r for r in lengths.text_length_stats(df).collect()}
    assert rows[0]["count"] == 1 and rows[0]["mean"] is None and rows[0]["median"] is None
    assert rows[1]["stddev"] is None and rows[1]["median"] == 2


@pytest.mark.parametrize("by", [(), ("source",), ("topic", "label")])
def test_box_stats(posts, by):
    rows, df = posts
    names = {"source": 3, "topic": 2, "label": 4}
    groups = defaultdict(list)
    for r in rows:
        key = tuple(r[names[b]] for b in by)
        if r[1] is not None and None not in key:
            groups[key].append(len(r[1]))
    got = {tuple(r[b] for b in by): r for r in lengths.box_stats(df, by).collect()}
    assert set(got) == set(groups)
    for key, sizes in groups.items():
        q1, median, q3 = np.percentile(sizes, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = [s for s in sizes if low <= s <= high]
        row = got[key]
        assert (row.q1, row.median, row.q3) == pytest.approx((q1, median, q3))
        assert (row.whisker_low, row.whisker_high) == (min(inside), max(inside))
        assert row.outliers == len(sizes) - len(inside) and row["count"] == len(sizes)


# ---- dashboards and exploration -----------------------------------------------------------

def test_null_groups_stay_on_dashboards_and_leave_exploration(posts):
    rows, df = posts
    topics = Counter(r[2] for r in rows)
    assert {r.topic: r.total for r in dashboard.topic_distribution(df).collect()} == topics
    del topics[None]
    assert {r.topic: r["count"] for r in exploration.eda_topic_counts(df).collect()} == topics


def test_heatmap_counts_every_row_of_the_topic(posts):
    rows, df = posts
    for r in dashboard.topic_label_heatmap(df).collect():
        labels = [label for _, _, topic, _, label in rows if topic == r.topic]
        assert r.offensive == pytest.approx(100 * labels.count(1) / len(labels), abs=0.051)
        assert r.binh_thuong + r.offensive + r.hate_speech < 100


def test_missing_labels_are_not_unlabelled(posts):
    rows, df = posts
    assert filters.drop_unlabelled(df).count() == sum(r[4] != -1 for r in rows)
    shares = {r.label: r for r in dashboard.label_share(df).collect()}
    assert shares[None].total == sum(r[4] is None for r in rows) and shares[None].label_name == "không xác định"
    pivot = {r.source: r for r in dashboard.source_label_pivot(df).collect()}
    assert pivot["tiktok"]["không_xác_định"] == sum(r[4] is None and r[3] == "tiktok" for r in rows)


def test_shares_sum_to_one_hundred(posts):
    _, df = posts
    assert sum(r.pct for r in dashboard.label_share(df.filter("label is not null")).collect()) == pytest.approx(100, abs=0.2)
    by_topic = exploration.share_of_total(exploration.topic_label_counts(df), ["topic"])
    for r in by_topic.groupBy("topic").agg(F.sum("pct").alias("s")).collect():
        assert r.s == pytest.approx(100)


def test_topic_source_label_matrix_is_complete(posts):
    _, df = posts
    rows = exploration.topic_source_label_pct(df).collect()
    assert len(rows) == 4 * 2
    assert sum(r.threads for r in rows) == pytest.approx(200, abs=0.01)


def test_top_topics_keep_all_rows_of_the_topic(posts):
    rows, df = posts
    assert filters.top_topics_semi(df, 1).count() == sum(r[2] == "x" for r in rows)


def test_empty_table(spark, posts):
    _, df = posts
    empty = df.filter("id < 0").withColumns({"keyword": F.lit("k"), "crawl_date": F.current_date()})
    assert dashboard.dashboard_kpis(empty).first().total_records == 0
    assert dashboard.summary_report(empty).count() == 0
    assert ngrams.ngrams_global(empty).count() == 0
    assert lengths.length_box_overall(empty).count() == 0
    assert corpus.pack_chunks(empty).count() == 0


# ---- n-grams ------------------------------------------------------------------------------

@pytest.mark.parametrize("sizes", [(1,), (2,), (1, 2, 3), (2, 4)])
@pytest.mark.parametrize("by", [(), ("label",)])
def test_ngram_counts(posts, sizes, by):
    rows, df = posts
    expected = Counter()
    for _, text, _, _, label in rows:
        if text is None or (by and label is None):
            continue
        words = text.split()
        for n in sizes:
            for i in range(len(words) - n + 1):
                expected[(*((label,) if by else ()), n, " ".join(words[i:i + n]))] += 1
    got = {(*[r[b] for b in by], r.n, r.ngram): r["count"] for r in ngrams.count_ngrams(df, by, sizes).collect()}
    assert got == expected
    groups = defaultdict(list)
    for key, count in expected.items():
        groups[key[:-1]].append((-count, key[-1]))
    best = {(*g, v, k + 1) for g, items in groups.items() for k, (_, v) in enumerate(sorted(items)[:20])}
    top = ngrams.top_ngrams(df, by, sizes).collect()
    assert {(*[r[b] for b in by], r.n, r.ngram, r["rank"]) for r in top} == best


@pytest.mark.parametrize("seeds, keep", [(2, 1 << 20), (256, 1 << 20), (256, 0)])
def test_level_wise_top_lists_equal_full_counts(spark, monkeypatch, seeds, keep):
    """Few seeds give weak bounds, no room for a kept set counts everything: the lists are the same."""
    monkeypatch.setattr(ngrams, "SEED_WORDS", seeds)
    monkeypatch.setattr(ngrams, "KEEP_BYTES", keep)
    rng = random.Random(7)
    words = [f"w{k}" for k in range(60)]
    rows = [(k % 3 if k % 11 else None, " ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randint(0, 30)))) for k in range(200)]
    rows.append((9, "a single row of its own group"))
    df = spark.createDataFrame(rows, "label int, text string")
    for by in ([], ["label"]):
        counted = defaultdict(list)
        for r in ngrams.count_ngrams(df, by).collect():
            counted[(*[r[b] for b in by], r.n)].append((-r["count"], r.ngram))
        want = {(*g, gram, -c, k) for g, items in counted.items() for k, (c, gram) in enumerate(sorted(items)[:5], 1)}
        got = ngrams.top_ngrams(df, by, top_n=5).collect()
        assert {(*[r[b] for b in by], r.n, r.ngram, r["count"], r["rank"]) for r in got} == want and len(got) == len(want)


def test_ngrams_of_another_tokenizer(spark):
    df = spark.createDataFrame([("ab-ab-cd",), ("ab cd-ab",)], "text string")
    got = ngrams.ngrams_global(df, 1, tokenizer=lambda text: F.split(text, "-")).collect()
    assert sorted((r.n, r.ngram, r["count"]) for r in got) == [(1, "ab", 3), (2, "ab ab", 1), (3, "ab ab cd", 1)]


# ---- joins and voting ---------------------------------------------------------------------

def test_incremental_anti_keeps_duplicates_and_compares_nulls(spark):
    schema = "text string, topic string, keyword string, url string"
    stored = spark.createDataFrame([(" a ", "t", "k", None), ("b", "t", "k", "u"), ("b", "t", "k", "u")], schema)
    new = spark.createDataFrame(
        [("a", "t", "k", None), ("a", "t", "k", ""), ("b ", "t", "k", "u"), ("c", "t", "k", "u"), ("c", "t", "k", "u"),
         (None, "t", "k", "u"), ("b", "tk", "", "u"), ("b", "t", None, "ku")], schema)
    kept = joins.incremental_anti(new, stored).collect()
    assert sorted((r.text or "", r.topic, r.keyword or "", r.url or "") for r in kept) == sorted(
        [("a", "t", "k", ""), ("c", "t", "k", "u"), ("c", "t", "k", "u"), ("", "t", "k", "u"), ("b", "tk", "", "u"), ("b", "t", "", "ku")])
    assert joins.incremental_anti(new, new).count() == 0
    assert joins.incremental_anti(new, stored.limit(0)).count() == new.count()


def test_vote_long_form_equals_columns(spark):
    rng = random.Random(2)
    rows = [(i, *(rng.randint(-1, 2) for _ in range(3))) for i in range(300)]
    wide = spark.createDataFrame(rows, "id int, a int, b int, c int")
    long = spark.createDataFrame([(r[0], k, v) for r in rows for k, v in enumerate(r[1:])], "id int, voter_rank int, label int")
    ours = {r.id: r.hard_voting_label for r in voting.hard_vote(wide, ["a", "b", "c"]).collect()}
    assert {r.id: r.hard_voting_label for r in voting.hard_vote_n(long).collect()} == ours
    with pytest.warns(UserWarning, match="no predictions"):
        filled = voting.missing_voter_default(wide.drop("c"), ["a", "b", "c"])
    assert filled.filter("c = -1").count() == 300


def test_align_predictions_by_id(spark):
    base = spark.createDataFrame([(1,), (2,)], "id int")
    tables = {"m": spark.createDataFrame([(2, 0), (1, 2)], "id int, label int")}
    assert {r.id: r.m for r in joins.align_predictions(base, tables).collect()} == {1: 2, 2: 0}


def test_left_join_dealt_is_a_left_join_in_order_of_its_ranges(spark):
    rows = spark.createDataFrame(
        [(i if i % 10 else None, f"t{i}", "r") for i in range(300)] + [(7, "again", "r"), (7, None, None)],
        "id bigint, text string, x string").repartition(5)
    facts = spark.createDataFrame(
        [(i, i % 3, None if i % 6 == 1 else "f") for i in range(0, 600, 2)] + [(8, 5, "twice"), (8, 5, "twice"), (None, 9, "n")]
        + [(7, None, None)], "id bigint, a int, b string").repartition(3)
    deal = {"odd": F.col("id") % 2, "part": F.col("id") % 7}
    got = joins.left_join_dealt(rows, facts, "id", deal)
    expected = rows.join(facts, "id", "left")
    assert got.columns == expected.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))
    # A directory spans neighbouring tasks only, so it has few files.
    at = got.select(*[c.alias(n) for n, c in deal.items()], F.spark_partition_id().alias("task")).distinct().collect()
    tasks = len({r.task for r in at})
    assert len(at) < len({(r.odd, r.part) for r in at}) + tasks
    assert joins.left_join_dealt(rows, facts.limit(0), "id", deal).count() == rows.count()
    assert joins.left_join_dealt(rows.limit(0), facts, "id", deal).count() == 0


def test_batch_predict_and_analyze(spark):
    df = spark.createDataFrame([(1, "You IDIOT"), (2, "scum, idiot"), (3, "idiots"), (4, " \n"), (5, None)], "id int, text string")
    factory = inference.lexicon_factory({"idiot": 1, "scum": 2})
    assert {r.id: r.predicted_label for r in inference.batch_predict(df, factory, batch_size=2).collect()} == {1: 1, 2: 2, 3: 0, 4: 0, 5: 0}
    assert {r.id: r.is_target for r in inference.analyze_text(df, factory).collect()} == {1: True, 2: True, 3: False}
    column = inference.lexicon_column({"idiot": 1, "scum": 2})
    assert {r.id: r.predicted_label for r in inference.batch_predict(df, column).collect()} == {1: 1, 2: 2, 3: 0, 4: 0, 5: 0}
    assert {r.id: r.is_target for r in inference.analyze_text(df, column).collect()} == {1: True, 2: True, 3: False}


def test_predictors_need_no_package_on_the_executors(tmp_path):
    payload = tmp_path / "predictor"
    payload.write_bytes(cloudpickle.dumps(inference.lexicon_factory({"idiot": 1})))
    code = "import pickle, sys; print(pickle.load(open(sys.argv[1], 'rb'))()(['an Idiot', 'x']))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code, str(payload)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == "[1, 0]", out.stderr


# ---- evaluation ---------------------------------------------------------------------------

def reference_report(pairs, classes=(0, 1, 2)):
    out = {}
    for c in classes:
        tp = sum(y == c == p for y, p in pairs)
        predicted, actual = sum(p == c for _, p in pairs), sum(y == c for y, _ in pairs)
        precision = tp / predicted if predicted else 0.0
        recall = tp / actual if actual else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        out[c] = (precision, recall, f1, actual)
    return out


@pytest.mark.parametrize("present", [(0, 1, 2), (0, 1), (0,)])
def test_class_report(spark, present):
    rng = random.Random(1)
    pairs = [(rng.choice(present), rng.choice((0, 1, 2) if len(present) > 1 else (0,))) for _ in range(200)]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    expected = reference_report(pairs)
    got = {r["class"]: r for r in evaluation.class_report(df).collect()}
    for c, name in evaluation.REPORT_NAMES.items():
        assert (got[name].precision, got[name].recall, got[name].f1, got[name].support) == pytest.approx(expected[c], abs=5e-5)
    assert got["macro avg"].f1 == pytest.approx(sum(v[2] for v in expected.values()) / 3, abs=5e-5)
    weighted = sum(v[2] * v[3] for v in expected.values()) / len(pairs)
    assert got["weighted avg"].f1 == pytest.approx(weighted, abs=5e-5)
    cells = evaluation.confusion_matrix(df).collect()
    assert len(cells) == 9 and sum(r["count"] for r in cells) == len(pairs)
    stored = evaluation.matrix_cells(evaluation.matrix_json(df), []).collect()
    assert {(r.actual, r.predicted, r["count"]) for r in stored} == {(r.actual, r.predicted, r["count"]) for r in cells}


def test_class_weights_sum_to_the_number_of_classes(spark):
    df = spark.createDataFrame([(0,)] * 90 + [(1,)] * 9 + [(2,)], "label int")
    rows = sampling.class_weights(df, digits=None).collect()
    assert sum(r.weight for r in rows) == pytest.approx(3)
    assert rows[2].weight / rows[0].weight == pytest.approx(90)


def test_fold_weights_count_an_absent_class_as_one(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)], "label int, fold int")
    rows = {(r.fold, r.label): r for r in sampling.fold_class_weights(df).collect()}
    assert rows[0, 2].train_count == 1 and rows[1, 2].train_count == 1
    train = [1, 1, 1]
    raw = [2 / (3 * c) for c in train]
    assert rows[0, 0].weight == pytest.approx(raw[0] / sum(raw) * 3, abs=1e-4)


def test_log_loss_and_perplexity(spark):
    rng = np.random.default_rng(0)
    scores, y = rng.normal(size=(50, 3)) * 300, rng.integers(0, 3, 50)
    shifted = scores - scores.max(1, keepdims=True)
    loss = np.log(np.exp(shifted).sum(1)) - shifted[np.arange(50), y]
    weights = np.array([0.5, 1.0, 1.5])
    df = spark.createDataFrame([(s.tolist(), int(c)) for s, c in zip(scores, y)], "logits array<double>, label int")
    table = spark.createDataFrame([(i, float(w)) for i, w in enumerate(weights)], "label int, weight double")
    got = evaluation.weighted_log_loss(df, table).first()[0]
    assert got == pytest.approx((weights[y] * loss).sum() / weights[y].sum(), abs=1e-3)
    small = df.select(F.lit(0.5).alias("loss"))
    assert evaluation.perplexity(small).first()[0] == pytest.approx(math.exp(0.5), abs=1e-4)


# ---- pages --------------------------------------------------------------------------------

HTML = (
    '<html><script>var t="<p>no</p>";</script><style>p{}</style><!-- <p>no</p> -->'
    '<a href="/a">x</a><A class="k" href="http://h/b">y</A><a href="/a">z</a>'
    "<p>First &amp; <b>best</b> one</p><p class=q>Open one<br><p>Trả lời</p><p>12,3k</p><p>8 giờ trước</p>"
    "<p>Đang trả lời @x</p><p>abc</p><p>&lt;tag&gt; text </p><p></p><p>First &amp; best one</p>"
)


def test_page_operators(spark):
    df = spark.createDataFrame([(1, "https://h.example/fr/1", HTML), (2, "https://g.example/", HTML)], "page_id int, url string, html string")
    links = pages.extract_anchors(df.limit(1), cap=5).orderBy("position").collect()
    assert [r.url for r in links] == ["https://www.tiktok.com/a", "http://h/b"]
    assert pages.extract_anchors(df.limit(1), pattern="^http").count() == 1
    texts = [r.text for r in pages.extract_segments(df.limit(1)).orderBy("position").collect()]
    assert texts == ["First & best one", "Open one", "<tag> text", "First & best one"]
    assert pages.extract_segments(df.limit(1), skip_first=True).count() == 3
    rows = pages.clean_crawl(df).collect()
    assert sorted(r.text for r in rows) == ["<tag> text", "First & best one", "Open one"]
    assert {(r.topic, r.keyword) for r in rows} == {("h.example", "fr")}
    assert [r.total for r in pages.crawl_totals(pages.clean_crawl(df)).collect()] == [3]


def test_crawl_filters_on_literal_cases(spark):
    df = spark.createDataFrame([(t,) for t in ("8 giờ", "8 giờ nữa đi chơi", "giờ 8", "4,2k", "1/2", "12 lần", "Thích")], "text string")
    assert [r.text for r in filters.drop_relative_time(df).collect()] == ["giờ 8", "4,2k", "1/2", "12 lần", "Thích"]
    assert [r.text for r in filters.drop_counters(df).collect()] == ["8 giờ", "8 giờ nữa đi chơi", "giờ 8", "12 lần", "Thích"]
    assert filters.drop_ui_labels(df).count() == 6


# ---- corpus -------------------------------------------------------------------------------

def test_pack_chunks_and_stats(spark, posts):
    rows, df = posts
    kept = sorted((r[0], r[1].split()[:7]) for r in rows if r[1] is not None)
    expected = {}
    for start in range(0, len(kept), 100):
        joined = [w for _, words in kept[start:start + 100] for w in words]
        for block in range(len(joined) // 7):
            expected[start // 100, block] = joined[block * 7:block * 7 + 7]
    got = {(r.batch, r.block): r.tokens for r in corpus.pack_chunks(df, max_len=7, batch_rows=100).collect()}
    assert got == expected
    stats = corpus.corpus_stats(df, max_len=7, batch_rows=100, test_percent=20).first()
    assert (stats.samples, stats.chunks) == (len(kept), len(expected))
    assert stats.train_rows + stats.test_rows == stats.samples and 0 < stats.test_rows < stats.train_rows


def test_split_is_stable(spark):
    df = spark.range(2_000).withColumnRenamed("id", "id")
    one = {r.id for r in sampling.train_test_split(df, 20).filter("split_set = 'test'").collect()}
    two = {r.id for r in sampling.train_test_split(df.repartition(9), 20).filter("split_set = 'test'").collect()}
    assert one == two and 300 < len(one) < 500


PAGES = {
    '<p title="a > b">one</p><p title=\'x>y\' class=z>two</p>': ["one", "two"],
    "<p>first<!-- never closed <p>hidden</p>": ["first"],
    "<p>a<!-- <p> --> b</p><!----><p>c</p>": ["a b", "c"],
    "<p>outer<p>inner</p>rest</p><div>no</div>": ["outer", "inner"],
    "<P>upper<br/>case</P >\n<pre>no</pre><param><p/>slash": ["uppercase", "slash"],
    "<script>if (a < b) { '<p>no</p>' }</script><p>yes</p><style>p > a {}</style>": ["yes"],
    "<script src='a>b'>document.write('<p>x</p>')": [],
    "<p>3 < 4 & 5 > 2 &lt;b&gt; &amp;lt;</p>": ["3 < 4 & 5 > 2 <b> &lt;"],
    "<p>un<b>bold</b> text, never closed": ["unbold text, never closed"],
    "<p title=\"open>still<p>next</p>": ["still", "next"],
    "": [], "no markup": [], "<": [], "<p": [], "\x01a\x02<p>\x01b\x02c</p>": ["bc"],
}
LINKS = {
    '<a data-href="/no" title="href=\'/no\'" href = "/x?a=1&amp;b=2">t</a>': ["https://www.tiktok.com/x?a=1&b=2"],
    "<a title='1 > 0' href=http://h/p>t</a><A\nHREF='/q'>": ["http://h/p", "https://www.tiktok.com/q"],
    "<a href='/one' href='/two'><abbr href='/no'><!-- <a href='/no'> --><a name=x>": ["https://www.tiktok.com/one"],
    "<script>'<a href=/no>'</script><a class=b href=/yes/>": ["https://www.tiktok.com/yes/"],
}


def test_page_tokens(spark):
    df = spark.createDataFrame([(k, h) for k, h in enumerate([*PAGES, *LINKS, None])], "page_id int, html string")
    texts = dict(df.select("html", pages.segment_array(F.col("html"))).collect())
    assert {h: texts[h] for h in PAGES} == PAGES and texts[None] is None
    links = defaultdict(list)
    for r in pages.extract_anchors(df).join(df, "page_id").orderBy("page_id", "position").collect():
        links[r.html].append(r.url)
    assert {h: links[h] for h in LINKS} == LINKS


def test_long_and_odd_pages_do_not_exhaust_the_stack(spark):
    attributes = " ".join(f'data-{k}="v > {k}"' for k in range(20_000))
    html = f"<p {attributes}>{'x<b>y</b>' * 20_000}</p><a {attributes} href='/z'>" + "<" * 50_000 + "<!--" + "-" * 100_000
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    [text] = df.select(pages.segment_array(F.col("html"))).first()[0]
    assert text == "xy" * 20_000 and [r.url for r in pages.extract_anchors(df).collect()] == ["https://www.tiktok.com/z"]


def test_cross_fitted_models_never_see_what_they_predict(spark):
    """Each fold has a word of its own that names the class; a model trained on it would know it."""
    rng = random.Random(2)
    rows = []
    for i in range(150):
        label, fold = i % 3, i // 3 % 3
        told = rng.choice(["good", "bad", "ugly"][label:label + 1] * 4 + ["noise"])
        rows.append((i, f"{told} filler words here", label, fold))
        rows.append((1000 + i, f"secret{fold}x{label}", (label + 1) % 3, fold))
    df = spark.createDataFrame(rows, "id int, text string, label int, fold int")
    got = {r.id: r.prediction for r in baselines.cross_fitted(df, k=3).collect()}
    assert len(got) == len(rows)
    clear = [(i, label) for i, text, label, _ in rows if "noise" not in text and i < 1000]
    assert sum(got[i] == label for i, label in clear) > 0.95 * len(clear)
    hidden = [(i, label) for i, _, label, _ in rows if i >= 1000]
    assert sum(got[i] == label for i, label in hidden) < 0.7 * len(hidden)
    with pytest.raises(Exception, match="not a fold"):
        baselines.cross_fitted(df.withColumn("fold", F.lit(None).cast("int")))


def test_cross_fitted_splits_texts_once(spark):
    """The models of all folds share the stored term counts and predict what models over the texts do."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices("abcdefghij", [1 + (k + i) % 3 for k in range(10)], k=9)), i % 3, i // 3 % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, text string, label int, fold int")
    seen = []

    def fit(train, text_col, y, weight_col):
        model = baselines.baseline_tfidf_lr(train, text_col, y, weight_col)
        plain = baselines.baseline_tfidf_lr(train.select(text_col, y, weight_col), text_col, y, weight_col)
        seen.append(([type(s).__name__ for s in model.stages], predicted(model), predicted(plain)))
        return model

    def predicted(model):
        return {r.id: r.prediction for r in baselines.predict(model, baselines.with_term_counts(df) if len(model.stages) == 2 else df).collect()}

    got = baselines.cross_fitted(df, fit, k=2)
    assert got.columns == [*df.columns, "prediction"]
    assert [stages for stages, _, _ in seen] == [["IDFModel", "LogisticRegressionModel"]] * 2
    assert all(shared == alone for _, shared, alone in seen)
    assert {r.id: r.prediction for r in got.collect()} == {i: seen[fold][1][i] for i, _, _, fold in rows}


def test_seed_ngrams_are_counted_once_and_lookups_lose_nothing(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(i % 2, rng.choices("abcd", k=30)) for i in range(20)], "g int, _words array<string>")
    counted = ngrams._counted(ngrams._occurrences(df, ["g"], 1), ["g"], 1)
    bounds = ngrams.lower_bounds(df, ["g"], counted, (2, 3), 3)
    assert "Generate" not in bounds._jdf.queryExecution().toString()
    found = spark.createDataFrame([("Ab", 1.0), ("x", 2.0), ("ab", -0.0)], "w1 string, v double")
    part = spark.createDataFrame([("ab", 0.0), ("x", 2.0), ("x", 3.0)], "w1 string, v double")
    assert sorted(r.w1 for r in ngrams._having(found, part).collect()) == ["ab", "x"]
    assert ngrams._having(found, part.select("w1")).count() == 2
    folded = [t.withColumn("w1", F.collate("w1", "UTF8_LCASE")) for t in (found, part)]
    assert ngrams._having(folded[0], folded[1].select("w1")).count() == 3
