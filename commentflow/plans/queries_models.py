"""Registered queries: labelling, voting, sampling, evaluation and baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentflow.operators import baselines, evaluation, inference, sampling, voting
from commentflow.plans.queries_crawl import lexicon_sql
from commentflow.plans.queries_store import _EVALUATED, OOF, evaluation_rows
from commentflow.plans.registry import query
from commentflow.plans.tables import LEXICON, MODELS, Tables
from commentflow.schema import CLASSES

_VOTERS = ("posts", "voters")
_FOLDS = ("posts", "voters", "folds")
_VOTE = "case when model_b = llm and model_a <> model_b then model_b else model_a end"
_NAME = """case label when -1 then 'chưa gán nhãn' when 0 then 'bình thường' when 1 then 'offensive'
 when 2 then 'hate speech' else 'không xác định' end"""


def _voted(t: Tables):
    return voting.hard_vote(t.voters(), MODELS)


# ---- voting and inference -----------------------------------------------------------------

@query("hard_vote", f"select id, model_a, model_b, llm, {_VOTE} as hard_voting_label from voters", _VOTERS)
def _(t: Tables):
    return _voted(t).select("id", *MODELS, "hard_voting_label")


@query("hard_vote_n", """
with v as (select id, 1 as vr, model_a as label from voters union all select id, 2, model_b from voters
           union all select id, 3, llm from voters),
c as (select id, label, count(*) as n, min(vr) as first from v group by id, label)
select id, label as hard_voting_label from (
  select *, row_number() over (partition by id order by n desc, first) as rn from c) where rn = 1""", _VOTERS)
def _(t: Tables):
    votes = t.voters().select(
        "id",
        F.inline(F.array(*[
            F.struct(F.lit(i).alias("voter_rank"), F.col(m).alias("label")) for i, m in enumerate(MODELS, 1)
        ])),
    )
    return voting.hard_vote_n(votes)


@query("missing_voter_default", """
select id, model_a, model_b, -1 as llm, case when model_b = -1 and model_a <> model_b then model_b else model_a end
  as hard_voting_label from voters""", _VOTERS)
def _(t: Tables):
    filled = voting.missing_voter_default(t.voters().select("id", "model_a", "model_b"), MODELS)
    return voting.hard_vote(filled, MODELS)


@query("vote_distribution", f"""
with v as (select *, {_VOTE} as hard_voting_label from voters)
select 'model_a' as model, model_a as label, count(*) as count from v group by 2
union all select 'model_b', model_b, count(*) from v group by 2
union all select 'llm', llm, count(*) from v group by 2
union all select 'hard_voting_label', hard_voting_label, count(*) from v group by 2""", _VOTERS)
def _(t: Tables):
    return voting.vote_distribution(_voted(t), [*MODELS, "hard_voting_label"])


@query("prediction_quality", f"""
with f as (select case when llm = -1 then 0 else llm end as label, llm from voters)
select label, {_NAME} as label_name, count(*) as count, (select count(*) filter (where llm = -1) from f) as unparsed,
       (select count(*) filter (where llm <> -1) from f) as parsed from f group by label""", _VOTERS)
def _(t: Tables):
    return voting.prediction_quality(t.voters(), "llm")


@query("batch_predict", f"select id, {lexicon_sql('text')} as predicted_label from posts")
def _(t: Tables):
    predicted = inference.batch_predict(t.posts().select("id", "text"), inference.lexicon_column(LEXICON))
    return predicted.select("id", "predicted_label")


@query("analyze_text", f"""
select conv_id, turn, {lexicon_sql('text')} as predicted_label, {lexicon_sql('text')} in (1, 2) as is_target
from conversations where regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> ''""", ())
def _(t: Tables):
    flagged = inference.analyze_text(t.table("conversations"), inference.lexicon_column(LEXICON))
    return flagged.select("conv_id", "turn", "predicted_label", "is_target")


# ---- sampling and weights -----------------------------------------------------------------

@query("class_counts", "select label, count(*) as count from posts where label is not null group by label")
def _(t: Tables):
    return sampling.class_counts(t.posts())


@query("class_weights", """
with c as (select label, count(*) as count from posts where label in (0, 1, 2) group by label),
w as (select label, count, sum(count) over () / (3.0::double * count) as w from c)
select label, count, round(w / sum(w) over () * 3, 4) as weight from w""")
def _(t: Tables):
    return sampling.class_weights(t.posts().filter(F.col("label") >= 0))


@query("fold_class_weights", """
with g as (select f.fold, l.label, greatest(count(*) filter (where p.label = l.label and p.fold <> f.fold), 1) as train_count,
                  count(*) filter (where p.fold <> f.fold) as n
           from folds p, (select unnest([0, 1, 2, 3, 4]) as fold) f, (select unnest([0, 1, 2]) as label) l group by f.fold, l.label),
w as (select *, n / (3.0::double * train_count) as w from g)
select fold, label, train_count, round(w / sum(w) over (partition by fold) * 3, 4) as weight from w""", _FOLDS)
def _(t: Tables):
    return sampling.fold_class_weights(t.folds())


@query("stratified_kfold", "select id, label, fold from folds", _FOLDS)
def _(t: Tables):
    return t.folds().select("id", "label", "fold")


# ---- metrics ------------------------------------------------------------------------------

def _cells(by: str) -> str:
    """Per class counts and scores of every group, complete over the three classes."""
    return f"""
cells as (select {by}, c, count(*) filter (where label = c and prediction = c) as tp, count(*) filter (where prediction = c) as pred,
                 count(*) filter (where label = c) as act, count(*) as n, count(*) filter (where label = prediction) as ok
          from oof, (select unnest([0, 1, 2]) as c) group by {by}, c),
scored as (select *, case when pred = 0 then 0 else tp / pred end as p, case when act = 0 then 0 else tp / act end as r,
                  case when pred + act = 0 then 0 else 2 * tp / (pred + act) end as f from cells)"""


@query("confusion_matrix", """
with g as (select model, a.a as actual, b.b as predicted, count(*) filter (where label = a.a and prediction = b.b) as count
           from oof, (select unnest([0, 1, 2]) as a) a, (select unnest([0, 1, 2]) as b) b group by model, a.a, b.b)
select model, actual, predicted, count, round(count / max(count) over (partition by model), 4) as intensity from g""", OOF)
def _(t: Tables):
    return evaluation.confusion_matrix(t.oof(), by=["model"])


@query("confusion_matrix_stored", """
select model, cast(a.a as int) as actual, cast(b.b as int) as predicted, count(*) filter (where label = a.a and prediction = b.b) as count
from oof, (select unnest([0, 1, 2]) as a) a, (select unnest([0, 1, 2]) as b) b group by model, a.a, b.b""", OOF)
def _(t: Tables):
    return evaluation.matrix_cells(evaluation.matrix_json(t.oof(), by=["model"]), ["model"])


@query("accuracy", "select model, round(avg(case when label = prediction then 1 else 0 end), 4) as accuracy from oof group by model", OOF)
def _(t: Tables):
    return evaluation.accuracy(t.oof(), by=["model"])


@query("class_report", f"""
with {_cells('model')}
select model, case c when 0 then 'clean' when 1 then 'offensive' else 'hate' end as class, round(p, 4) as precision,
       round(r, 4) as recall, round(f, 4) as f1, act as support from scored
union all select model, 'accuracy', null, null, round(max(ok) / max(n), 4), cast(max(n) as bigint) from scored group by model
union all select model, 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), cast(sum(act) as bigint) from scored group by model
union all select model, 'weighted avg', round(sum(p * act) / sum(act), 4), round(sum(r * act) / sum(act), 4),
       round(sum(f * act) / sum(act), 4), cast(sum(act) as bigint) from scored group by model""", OOF)
def _(t: Tables):
    return evaluation.class_report(t.oof(), by=["model"])


@query("macro_f1", f"with {_cells('model')} select model, round(avg(f), 4) as macro_f1 from scored group by model", OOF)
def _(t: Tables):
    return evaluation.macro_f1(t.oof(), by=["model"])


@query("weighted_f1", f"""
with {_cells('model')}
select model, round(sum(f * act) / sum(act), 4) as weighted_f1 from scored group by model""", OOF)
def _(t: Tables):
    return evaluation.weighted_f1(t.oof(), by=["model"])


_FOLD_SCORES = f"""
{_cells('model, fold')},
per as (select model, fold, max(ok) / max(n) as acc, avg(f) as f1_macro, max(case when c = 1 then r end) as recall_off,
               max(case when c = 2 then r end) as recall_hate from scored group by model, fold)"""


@query("fold_metrics", f"""
with {_FOLD_SCORES}
select model, fold, round(acc, 4) as acc, round(f1_macro, 4) as f1_macro, round(recall_off, 4) as recall_off,
       round(recall_hate, 4) as recall_hate from per""", OOF)
def _(t: Tables):
    return evaluation.fold_metrics(t.oof(), by=["model"])


@query("fold_summary", f"""
with {_FOLD_SCORES}
select model, round(avg(acc), 4) as acc_mean, round(stddev_samp(acc), 4) as acc_std, round(avg(f1_macro), 4) as f1_macro_mean,
       round(stddev_samp(f1_macro), 4) as f1_macro_std, round(avg(recall_off), 4) as recall_off_mean,
       round(stddev_samp(recall_off), 4) as recall_off_std, round(avg(recall_hate), 4) as recall_hate_mean,
       round(stddev_samp(recall_hate), 4) as recall_hate_std from per group by model""", OOF)
def _(t: Tables):
    return evaluation.fold_summary(t.oof(), by=["model"])


_OVERALL = """max(ok) / max(n) as acc, avg(f) as f1_macro, max(case when c = 0 then r end) as recall_clean,
       max(case when c = 1 then r end) as recall_off, max(case when c = 2 then r end) as recall_hate"""


@query("oof_evaluation", f"""
with {_cells('model')}, o as (select model, {_OVERALL} from scored group by model)
select model, 'oof_full' as dataset, round(acc, 4) as acc, round(f1_macro, 4) as f1_macro, round(recall_clean, 4) as recall_clean,
       round(recall_off, 4) as recall_off, round(recall_hate, 4) as recall_hate from o""", OOF)
def _(t: Tables):
    return evaluation.oof_evaluation(t.oof())


@query("model_summary_table", f"""
with {_cells('model, fold')},
fs as (select model, avg(f1) as m, stddev_samp(f1) as s from (select model, fold, avg(f) as f1 from scored group by model, fold) group by model),
tot as (select model, c, sum(tp) as tp, sum(pred) as pred, sum(act) as act, sum(n) as n, sum(ok) as ok from cells group by model, c),
o as (select model, max(ok) / max(n) as acc, avg(case when pred + act = 0 then 0 else 2 * tp / (pred + act) end) as f1,
             max(case when c = 0 then tp / act end) as r0, max(case when c = 1 then tp / act end) as r1,
             max(case when c = 2 then tp / act end) as r2 from tot group by model)
select model as "Model", 'oof_full' as "Dataset", round(acc, 4) as "OOF Acc", round(f1, 4) as "OOF F1 Macro",
       round(m, 4) as "Fold F1 Mean", round(s, 4) as "Fold F1 Std", round(r0, 4) as "Recall(clean)", round(r1, 4) as "Recall(off)",
       round(r2, 4) as "Recall(hate)" from o join fs using (model)""", OOF)
def _(t: Tables):
    return evaluation.model_summary_table(t.oof())


@query("model_best_flags", f"""{_EVALUATED}
select model_id, accuracy, macro_f1, target_hate_f1, accuracy = max(accuracy) over () as best_accuracy,
       macro_f1 = max(macro_f1) over () as best_macro_f1, target_hate_f1 = max(target_hate_f1) over () as best_target_hate_f1
from models""", OOF)
def _(t: Tables):
    return evaluation.model_best_flags(evaluation_rows(t))


@query("metric_radar", f"""{_EVALUATED}
, long as (unpivot (select model_id, accuracy, macro_f1, macro_precision, macro_recall, target_hate_f1, target_normal_f1 from models)
  on accuracy, macro_f1, macro_precision, macro_recall, target_hate_f1, target_normal_f1 into name metric value v)
select metric, max(round_even(v * 100, 1)) filter (model_id = 'model_a') as model_a,
       max(round_even(v * 100, 1)) filter (model_id = 'model_b') as model_b, max(round_even(v * 100, 1)) filter (model_id = 'llm') as llm
from long group by metric""", OOF)
def _(t: Tables):
    return evaluation.metric_radar(evaluation_rows(t), MODELS)


_LOSS = """ln(list_sum(list_transform(embedding, lambda s: exp(s::double - list_max(embedding)::double))))
       + list_max(embedding)::double - embedding[label + 1]::double"""


@query("weighted_log_loss", f"""
with c as (select label, count(*) as n from embeddings group by label),
w as (select label, sum(n) over () / (count(*) over () * n::double) as weight from c)
select round(sum(weight * ({_LOSS})) / sum(weight), 4) as weighted_log_loss from embeddings join w using (label)""", ())
def _(t: Tables):
    rows = t.table("embeddings").withColumnRenamed("embedding", "logits")
    return evaluation.weighted_log_loss(rows, sampling.class_weights(rows, classes=range(10), digits=None))


@query("perplexity", f"select round(exp(avg({_LOSS})), 4) as perplexity from embeddings", ())
def _(t: Tables):
    rows = t.table("embeddings")
    return evaluation.perplexity(rows.select(evaluation.log_loss("embedding", "label").alias("loss")))


# ---- baselines ----------------------------------------------------------------------------

def _training(t: Tables):
    rows = t.posts().filter(F.col("label") >= 0).select("id", "text", "label")
    return sampling.train_test_split(rows, 20)


def _baseline(t: Tables, fit):
    rows = _training(t)
    train = rows.filter(F.col("split_set") == "train").select("id", "text", "label")
    weighted = baselines.with_class_weight(train, sampling.class_weights(train))
    test = rows.filter(F.col("split_set") == "test").select("id", "text", "label")
    return baselines.predict(fit(weighted, weight_col="weight"), test).select("id", "label", "prediction")


@query("baseline_tfidf_lr")
def _(t: Tables):
    return _baseline(t, baselines.baseline_tfidf_lr)


@query("baseline_tfidf_svm")
def _(t: Tables):
    return _baseline(t, baselines.baseline_tfidf_svm)


# What of the baselines SQL can state: a prediction that is a class for every row of the test split.
_PREDICTED = "select id, label, true as is_class from split_posts where split_set = 'test' and label >= 0"


def _predicted(rows):
    return rows.select("id", "label", F.col("prediction").isin(*CLASSES).alias("is_class"))


@query("baseline_tfidf_lr_rows", _PREDICTED, ("posts", "split_posts"))
def _(t: Tables):
    return _predicted(_baseline(t, baselines.baseline_tfidf_lr))


@query("baseline_tfidf_svm_rows", _PREDICTED, ("posts", "split_posts"))
def _(t: Tables):
    return _predicted(_baseline(t, baselines.baseline_tfidf_svm))


# ---- cross-fitted predictions -------------------------------------------------------------

def _cross_fitted(t: Tables):
    folded = sampling.stratified_kfold(t.posts().filter(F.col("label").isin(*CLASSES)).select("id", "text", "label"))
    return baselines.cross_fitted(folded)


@query("cross_fitted_rows", "select id, label, fold, true as is_class from folds", _FOLDS)
def _(t: Tables):
    return _cross_fitted(t).select("id", "label", "fold", F.col("prediction").isin(*CLASSES).alias("is_class"))


@query("cross_fitted_report")
def _(t: Tables):
    """Per-class metrics of predictions by models that saw none of the rows they predict."""
    return evaluation.class_report(_cross_fitted(t))
