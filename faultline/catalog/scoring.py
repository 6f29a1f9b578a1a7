"""Metrics, curves, threshold sweeps, selections and operating profiles on fixed scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog import sql
from faultline.catalog.sql import shown
from faultline.operators import metrics, models, thresholds
from faultline.plans.workflows import final_evaluation_rows
from faultline.sources import bindings as b

QUERIES = {}
ORACLES = {}


def query(name, oracle=None):
    def add(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return add


_VOTE = """count(*) FILTER (label = 0 AND NOT probability > 0.5) AS true_negative,
    count(*) FILTER (label = 0 AND probability > 0.5) AS false_positive,
    count(*) FILTER (label = 1 AND NOT probability > 0.5) AS false_negative,
    count(*) FILTER (label = 1 AND probability > 0.5) AS true_positive"""

_ROUNDED_RATES = """round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1"""
_COUNTS = "true_negative, false_positive, false_negative, true_positive"


def _curve(rows: str, keys: str = "") -> str:
    """CTE ``curve``: cumulative counts per distinct score, high to low."""
    lead = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    return f"""
points AS (
  SELECT {lead}probability AS score, CAST(sum(label) AS BIGINT) AS p, CAST(sum(1 - label) AS BIGINT) AS n
  FROM {rows} GROUP BY {lead}probability),
curve AS (
  SELECT {lead}score, p, n,
    CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp,
    CAST(sum(p) OVER ({part.strip()}) AS DOUBLE) AS all_p, CAST(sum(n) OVER ({part.strip()}) AS DOUBLE) AS all_n
  FROM points WINDOW w AS ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


_RANKING = """round(sum(n * ((tp - p) + CAST(p AS DOUBLE) / 2)) / (max(all_p) * max(all_n)), 6) AS roc_auc,
  round(sum(p * CAST(tp AS DOUBLE) / (tp + fp)) / max(all_p), 6) AS average_precision"""


@query(
    "confusion_matrix",
    f"WITH {sql.SCORED} SELECT o_orderpriority, {_VOTE} FROM s GROUP BY o_orderpriority",
)
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(
        b.orders_scored(spark, sf), metrics.majority_vote(), group_by="o_orderpriority"
    )


@query(
    "classification_metrics",
    f"""WITH {sql.SCORED}, c AS (SELECT o_orderstatus, {_VOTE} FROM s GROUP BY o_orderstatus),
    r AS (SELECT o_orderstatus, {sql.RATES}, {_COUNTS} FROM c)
    SELECT o_orderstatus, {_ROUNDED_RATES}, {_COUNTS} FROM r""",
)
def classification_metrics(spark, sf):
    return shown(
        metrics.classification_metrics(b.orders_scored(spark, sf), group_by="o_orderstatus")
    )


@query(
    "roc_auc",
    f"WITH {sql.EVENTS}, {_curve('e')} SELECT {_RANKING.split('AS roc_auc')[0]} AS roc_auc FROM curve",
)
def roc_auc(spark, sf):
    return shown(metrics.roc_auc(b.events_scored(spark, sf)))


@query(
    "average_precision",
    f"WITH {sql.EVENTS}, {_curve('e')}"
    " SELECT round(sum(p * CAST(tp AS DOUBLE) / (tp + fp)) / max(all_p), 6) AS average_precision FROM curve",
)
def average_precision(spark, sf):
    return shown(metrics.average_precision(b.events_scored(spark, sf)))


@query(
    "ranking_bucketed",
    f"WITH {sql.MODELS}, {_curve('m', 'model')} SELECT model, {_RANKING} FROM curve GROUP BY model",
)
def ranking_bucketed(spark, sf):
    """The way of large tables: running totals by ordered buckets."""
    return shown(metrics.ranking_metrics(b.orders_models(spark, sf), "model", buckets=64))


@query(
    "ranking_by_user",
    f"""WITH {sql.EVENTS}, {_curve('e', 'user_id')},
    r AS (SELECT user_id, sum(n * ((tp - p) + CAST(p AS DOUBLE) / 2)) AS pairs,
        sum(p * CAST(tp AS DOUBLE) / (tp + fp)) AS steps, max(all_p) AS all_p, max(all_n) AS all_n
      FROM curve GROUP BY user_id)
    SELECT user_id,
      CASE WHEN all_p > 0 AND all_n > 0 THEN round(pairs / (all_p * all_n), 6) END AS roc_auc,
      CASE WHEN all_p > 0 THEN round(steps / all_p, 6) END AS average_precision FROM r""",
)
def ranking_by_user(spark, sf):
    """Exact AUC and AP of every user at once; a user without both classes gets NULL."""
    return shown(metrics.ranking_metrics(b.events_scored(spark, sf), "user_id"))


_COMPARISON = f"""{sql.MODELS}, {_curve('m', 'model')},
  soft AS (SELECT model, {_RANKING} FROM curve GROUP BY model),
  c AS (SELECT model, {_VOTE} FROM m GROUP BY model),
  r AS (SELECT model, {sql.RATES}, {_COUNTS} FROM c),
  comparison AS (SELECT r.model, {_ROUNDED_RATES}, roc_auc, average_precision, {_COUNTS}
    FROM r JOIN soft ON r.model = soft.model)"""


@query("evaluate_models", f"WITH {_COMPARISON} SELECT * FROM comparison")
def evaluate_models(spark, sf):
    return shown(metrics.evaluate_models(b.orders_models(spark, sf)))


@query(
    "best_model",
    f"WITH {_COMPARISON} SELECT * FROM comparison ORDER BY average_precision DESC, model LIMIT 1",
)
def best_model(spark, sf):
    return shown(models.best_model(metrics.evaluate_models(b.orders_models(spark, sf))))


@query(
    "tie_rule",
    f"""WITH {sql.SCORED}, h AS (SELECT label, round(probability * 2) / 2 AS p FROM s)
    SELECT count(*) AS row_count, count(*) FILTER (p = 0.5) AS ties, count(*) FILTER (p > 0.5) AS by_vote,
      count(*) FILTER (p >= 0.5) AS by_threshold FROM h""",
)
def tie_rule(spark, sf):
    """At exactly one half the vote says 0 and the threshold says 1."""
    halves = b.orders_scored(spark, sf).select(
        (F.round(F.col("probability") * 2) / 2).alias("probability")
    )
    return halves.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("probability") == 0.5).alias("ties"),
        F.count_if(metrics.majority_vote() == 1).alias("by_vote"),
        F.count_if(metrics.at_threshold(0.5) == 1).alias("by_threshold"),
    )


@query(
    "pr_curve",
    f"""WITH {sql.EVENTS}, {_curve('e')} SELECT round(score, 9) AS score, tp, fp,
      round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision, round(tp / all_p, 6) AS recall FROM curve""",
)
def pr_curve(spark, sf):
    return shown(metrics.pr_curve(b.events_scored(spark, sf)))


@query(
    "roc_curve",
    f"""WITH {sql.MODELS}, {_curve('m', 'model')} SELECT model, round(score, 9) AS score, tp, fp,
      round(tp / all_p, 6) AS tpr, round(fp / all_n, 6) AS fpr FROM curve""",
)
def roc_curve(spark, sf):
    return shown(metrics.roc_curve(b.orders_models(spark, sf), "model"))


@query(
    "classification_report",
    f"""WITH {sql.SCORED}, c AS (SELECT {_VOTE.replace('true_negative', 'tn').replace('false_positive', 'fp').replace('false_negative', 'fn').replace('true_positive', 'tp')} FROM s),
    k AS (
      SELECT '0' AS class, CAST(tn AS DOUBLE) / (tn + fn) AS precision, CAST(tn AS DOUBLE) / (tn + fp) AS recall,
        CAST(2 * tn AS DOUBLE) / (2 * tn + fn + fp) AS f1, tn + fp AS support FROM c
      UNION ALL
      SELECT '1', CAST(tp AS DOUBLE) / (tp + fp), CAST(tp AS DOUBLE) / (tp + fn),
        CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), tp + fn FROM c)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM k
    UNION ALL SELECT 'macro', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
      CAST(sum(support) AS BIGINT) FROM k
    UNION ALL SELECT 'weighted', round(sum(precision * support) / sum(support), 6),
      round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
      CAST(sum(support) AS BIGINT) FROM k""",
)
def classification_report(spark, sf):
    return shown(metrics.classification_report(b.orders_scored(spark, sf)))


_SWEEP = f"WITH {sql.SCORED}, {sql.sweep('s')}"
_BY_PRIORITY = f"WITH {sql.SCORED}, {sql.sweep('s', 'o_orderpriority')}"
_COST = "round(total_cost, 6) AS total_cost"


def _costed(spark, sf, group_by=()):
    return thresholds.costed_sweep(b.orders_scored(spark, sf), group_by=group_by)


@query("threshold_sweep", f"{_SWEEP} SELECT {sql.THRESHOLD_ROW} FROM sweep")
def threshold_sweep(spark, sf):
    return shown(metrics.threshold_sweep(b.orders_scored(spark, sf)))


@query(
    "threshold_sweep_by_user",
    f"WITH {sql.EVENTS}, {sql.sweep('e', 'user_id')} SELECT user_id, {sql.THRESHOLD_ROW} FROM sweep",
)
def threshold_sweep_by_user(spark, sf):
    return shown(metrics.threshold_sweep(b.events_scored(spark, sf), group_by="user_id"))


@query(
    "threshold_costs",
    f"{_BY_PRIORITY} SELECT o_orderpriority, {sql.THRESHOLD_ROW}, {_COST} FROM sweep",
)
def threshold_costs(spark, sf):
    return shown(_costed(spark, sf, "o_orderpriority"))


def _first(order: str, where: str = "", keys: str = "") -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    return f"SELECT *, row_number() OVER ({part}ORDER BY {order}) AS place FROM sweep {where}"


_F1 = "f1 DESC, recall DESC, precision DESC, threshold DESC"
_PRECISE = "precision DESC, f1 DESC, recall DESC, threshold DESC"
_CHEAP = "total_cost, recall DESC, precision DESC, f1 DESC, threshold DESC"


@query(
    "best_f1_threshold",
    f"{_BY_PRIORITY} SELECT o_orderpriority, {sql.THRESHOLD_ROW}, {_COST}"
    f" FROM ({_first(_F1, keys='o_orderpriority')}) WHERE place = 1",
)
def best_f1_threshold(spark, sf):
    rows = _costed(spark, sf, "o_orderpriority")
    return shown(thresholds.best_f1_threshold(rows, "o_orderpriority"))


@query(
    "min_recall_threshold",
    f"""{_BY_PRIORITY}, b AS ({_first(_PRECISE, 'WHERE recall >= 0.8', 'o_orderpriority')}),
    g AS (SELECT DISTINCT o_orderpriority FROM sweep)
    SELECT g.o_orderpriority, {sql.THRESHOLD_ROW}, {_COST}, threshold IS NOT NULL AS eligible
    FROM g LEFT JOIN b ON g.o_orderpriority = b.o_orderpriority AND place = 1""",
)
def min_recall_threshold(spark, sf):
    """Priorities without a positive have recall 0 everywhere and no eligible row."""
    rows = _costed(spark, sf, "o_orderpriority")
    return shown(thresholds.min_recall_threshold(rows, 0.8, "o_orderpriority"))


@query(
    "lowest_cost_threshold",
    f"{_BY_PRIORITY} SELECT o_orderpriority, {sql.THRESHOLD_ROW}, {_COST}"
    f" FROM ({_first(_CHEAP, keys='o_orderpriority')}) WHERE place = 1",
)
def lowest_cost_threshold(spark, sf):
    rows = _costed(spark, sf, "o_orderpriority")
    return shown(thresholds.lowest_cost_threshold(rows, "o_orderpriority"))


@query(
    "selected_thresholds",
    f"""{_SWEEP} SELECT selection, {sql.THRESHOLD_ROW}, {_COST} FROM (
      SELECT 'default_0_5' AS selection, *, 1 AS place FROM sweep WHERE threshold = 0.5
      UNION ALL SELECT 'best_f1', * FROM ({_first(_F1)})
      UNION ALL SELECT 'minimum_recall', * FROM ({_first(_PRECISE, 'WHERE recall >= 0.8')})
      UNION ALL SELECT 'lowest_cost', * FROM ({_first(_CHEAP)})) WHERE place = 1""",
)
def selected_thresholds(spark, sf):
    return shown(thresholds.selected_thresholds(_costed(spark, sf)))


def _profile(met: str, if_met: str, otherwise: str, keys: str = "") -> str:
    """Ranked sweep: rows that meet the target first and in their own order."""
    part = f"PARTITION BY {keys} " if keys else ""
    a, z = if_met.split(), otherwise.split()
    order = ", ".join(
        f"CASE WHEN {met} THEN {x} ELSE {y} END DESC" for x, y in zip(a, z, strict=True)
    )
    return (
        f"SELECT *, {met} AS met, row_number() OVER ({part}ORDER BY {met} DESC, {order}) AS place"
        " FROM sweep"
    )


def _recall_profile(keys=""):
    return _profile(
        "recall >= 0.85", "precision f1 recall threshold", "recall precision f1 threshold", keys
    )


def _precision_profile(keys=""):
    return _profile(
        "precision >= 0.7", "recall f1 precision threshold", "precision recall f1 threshold", keys
    )


@query(
    "profile_high_recall",
    f"{_BY_PRIORITY} SELECT o_orderpriority, {sql.THRESHOLD_ROW}, {_COST}, met AS recall_target_met"
    f" FROM ({_recall_profile('o_orderpriority')}) WHERE place = 1",
)
def profile_high_recall(spark, sf):
    rows = _costed(spark, sf, "o_orderpriority")
    return shown(thresholds.profile_high_recall(rows, group_by="o_orderpriority"))


@query(
    "profile_conservative",
    f"{_BY_PRIORITY} SELECT o_orderpriority, {sql.THRESHOLD_ROW}, {_COST}, met AS precision_target_met"
    f" FROM ({_precision_profile('o_orderpriority')}) WHERE place = 1",
)
def profile_conservative(spark, sf):
    rows = _costed(spark, sf, "o_orderpriority")
    return shown(thresholds.profile_conservative(rows, group_by="o_orderpriority"))


_EXTRA = """round(CAST(false_positive AS DOUBLE)
    / (true_negative + false_positive + false_negative + true_positive), 6) AS false_positive_rate_overall,
  round(CASE WHEN false_negative + true_positive = 0 THEN CAST(0 AS DOUBLE)
    ELSE CAST(false_negative AS DOUBLE) / (false_negative + true_positive) END, 6)
    AS false_negative_rate_among_actual_positives"""


@query(
    "profile_rates",
    f"{_BY_PRIORITY} SELECT o_orderpriority, {sql.THRESHOLD_ROW}, {_COST}, {_EXTRA} FROM sweep",
)
def profile_rates(spark, sf):
    return shown(thresholds.profile_rates(_costed(spark, sf, "o_orderpriority")))


def _profiles(keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    body = f"""{lead}threshold, precision, recall, f1, {_COUNTS}, predicted_positive_count,
      predicted_positive_rate, total_cost"""
    return f"""
profiles AS (
  SELECT CAST(1 AS INTEGER) AS ord, 'high_recall' AS profile, {body}, met AS recall_target_met,
    CAST(NULL AS BOOLEAN) AS precision_target_met FROM ({_recall_profile(keys)}) WHERE place = 1
  UNION ALL SELECT 2, 'balanced', {body}, NULL, NULL FROM ({_first(_F1, keys=keys)}) WHERE place = 1
  UNION ALL SELECT 3, 'conservative', {body}, NULL, met FROM ({_precision_profile(keys)}) WHERE place = 1)"""


_PROFILE_ROW = f"""ord, profile, round(threshold, 6) AS threshold, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1, {_COUNTS}, predicted_positive_count,
  round(predicted_positive_rate, 6) AS predicted_positive_rate, {_EXTRA},
  round(total_cost, 6) AS illustrative_total_cost, recall_target_met, precision_target_met"""


@query("operating_profiles", f"{_SWEEP}, {_profiles()} SELECT {_PROFILE_ROW} FROM profiles")
def operating_profiles(spark, sf):
    return shown(thresholds.operating_profiles(_costed(spark, sf)))


@query(
    "operating_profiles_by_priority",
    f"{_BY_PRIORITY}, {_profiles('o_orderpriority')}"
    f" SELECT o_orderpriority, {_PROFILE_ROW} FROM profiles",
)
def operating_profiles_by_priority(spark, sf):
    rows = _costed(spark, sf, "o_orderpriority")
    return shown(thresholds.operating_profiles(rows, group_by="o_orderpriority"))


@query(
    "shared_thresholds",
    f"""{_BY_PRIORITY}, {_profiles('o_orderpriority')}
    SELECT o_orderpriority, round(threshold, 6) AS threshold,
      string_agg(profile, ',' ORDER BY ord) AS profiles
    FROM profiles GROUP BY o_orderpriority, threshold HAVING count(*) > 1""",
)
def shared_thresholds(spark, sf):
    rows = _costed(spark, sf, "o_orderpriority")
    profiles = thresholds.operating_profiles(rows, group_by="o_orderpriority")
    return shown(thresholds.shared_thresholds(profiles, "o_orderpriority"))


def _at(threshold: str, rows: str = "s") -> str:
    return f"""SELECT CAST({threshold} AS DOUBLE) AS threshold,
      count(*) FILTER (label = 0 AND probability < {threshold}::DOUBLE) AS true_negative,
      count(*) FILTER (label = 0 AND probability >= {threshold}::DOUBLE) AS false_positive,
      count(*) FILTER (label = 1 AND probability < {threshold}::DOUBLE) AS false_negative,
      count(*) FILTER (label = 1 AND probability >= {threshold}::DOUBLE) AS true_positive FROM {rows}"""


_RATED = f"""r AS (SELECT *, {sql.RATES}, false_positive + true_positive AS predicted_positive_count,
    CAST(false_positive + true_positive AS DOUBLE)
      / (true_negative + false_positive + false_negative + true_positive) AS predicted_positive_rate
  FROM c)"""


@query(
    "fixed_threshold_metrics",
    f"WITH {sql.SCORED}, c AS ({_at('0.37')}), {_RATED} SELECT {sql.THRESHOLD_ROW} FROM r",
)
def fixed_threshold_metrics(spark, sf):
    return shown(metrics.fixed_threshold_metrics(b.orders_scored(spark, sf), 0.37))


@query(
    "final_evaluation_rows",
    f"""WITH {sql.SCORED}, {_curve('s')}, soft AS (SELECT {_RANKING} FROM curve),
    c AS (SELECT 'default_0_5' AS operating_point, * FROM ({_at('0.5')})
      UNION ALL SELECT 'selected_balanced_threshold', * FROM ({_at('0.8')})), {_RATED}
    SELECT operating_point, roc_auc, average_precision, {sql.THRESHOLD_ROW} FROM r, soft""",
)
def final_evaluation_fixed(spark, sf):
    return shown(final_evaluation_rows(b.orders_scored(spark, sf), 0.8))
