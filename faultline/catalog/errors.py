"""Error analysis on fixed scores."""

from __future__ import annotations

from faultline.catalog import sql
from faultline.catalog.sql import shown
from faultline.operators import errors, metrics
from faultline.operators.scoring import join_predictions, predict_scored
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


THRESHOLD = 0.7
FEATURES = b.ORDERS.numeric
CATEGORIES = b.ORDERS.categorical

_JUDGED = f"""{sql.SCORED},
  j AS (SELECT *, label AS actual, CAST(probability >= CAST({THRESHOLD} AS DOUBLE) AS INTEGER) AS predicted FROM s),
  o AS (SELECT *, CASE WHEN actual = 0 AND predicted = 0 THEN 'true_negative'
      WHEN actual = 0 THEN 'false_positive' WHEN predicted = 0 THEN 'false_negative'
      ELSE 'true_positive' END AS outcome FROM j)"""
_ORDERS_CTES = sql.ORDERS.replace(sql.FLAGS, "").lstrip(",")
_TABLE = f"""{_JUDGED}, {_ORDERS_CTES},
  x AS (SELECT t.*, actual, predicted, probability, outcome FROM t JOIN o ON t.o_orderkey = o.o_orderkey)"""
_EVERY = "k AS (SELECT * FROM (VALUES ('true_negative'), ('false_positive'), ('false_negative'), ('true_positive')) v(outcome))"


def _judged(spark, sf):
    return errors.classify_outcomes(b.orders_scored(spark, sf), THRESHOLD)


def _table(spark, sf):
    scores = b.orders_scored(spark, sf).select("o_orderkey", "label", "probability")
    return errors.error_table(b.orders_table(spark, sf), scores, "o_orderkey", THRESHOLD)


def _long(columns, rows: str = "x") -> str:
    return " UNION ALL ".join(
        f"SELECT outcome, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {rows}" for c in columns
    )


@query(
    "classify_outcomes",
    f"WITH {_JUDGED} SELECT o_orderkey, o_orderpriority, o_orderstatus, label,"
    " round(probability, 9) AS probability, actual, predicted, outcome FROM o",
)
def classify_outcomes(spark, sf):
    return shown(_judged(spark, sf))


@query(
    "error_table",
    f"WITH {_TABLE} SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, order_month, order_weekday,"
    " line_count, quantity_sum, round(discount_mean, 6) AS discount_mean, actual, predicted,"
    " round(probability, 9) AS probability,"
    " outcome FROM x",
)
def error_table(spark, sf):
    return shown(
        _table(spark, sf).select(
            "o_orderkey", *FEATURES, "actual", "predicted", "probability", "outcome"
        )
    )


@query(
    "outcome_summary",
    f"""WITH {_JUDGED}, {_EVERY} SELECT k.outcome, count(o.outcome) AS count,
      round(100.0 * CAST(count(o.outcome) AS DOUBLE) / (SELECT count(*) FROM o), 6) AS percent,
      round(avg(probability), 6) AS mean_probability,
      round(quantile_cont(probability, 0.5), 6) AS median_probability
    FROM k LEFT JOIN o ON k.outcome = o.outcome GROUP BY k.outcome""",
)
def outcome_summary(spark, sf):
    return shown(errors.outcome_summary(_judged(spark, sf)))


@query(
    "outcome_summary_by_priority",
    f"""WITH {_JUDGED}, {_EVERY},
    g AS (SELECT o_orderpriority, count(*) AS n FROM o GROUP BY 1)
    SELECT g.o_orderpriority, k.outcome, count(o.outcome) AS count,
      round(100.0 * CAST(count(o.outcome) AS DOUBLE) / max(n), 6) AS percent,
      round(avg(probability), 6) AS mean_probability,
      round(quantile_cont(probability, 0.5), 6) AS median_probability
    FROM g CROSS JOIN k LEFT JOIN o ON k.outcome = o.outcome AND g.o_orderpriority = o.o_orderpriority
    GROUP BY g.o_orderpriority, k.outcome""",
)
def outcome_summary_by_priority(spark, sf):
    """Low priorities never fail: their positive outcomes are present and empty."""
    return shown(errors.outcome_summary(_judged(spark, sf), "o_orderpriority"))


_SEVEN = """round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
      round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q1,
      round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3,
      round(max(value), 6) AS max"""


@query(
    "numeric_by_outcome",
    f"WITH {_TABLE}, v AS ({_long(FEATURES)}) SELECT outcome, feature,"
    f" {_SEVEN} FROM v GROUP BY outcome, feature",
)
def numeric_by_outcome(spark, sf):
    table = _table(spark, sf)
    out = errors.numeric_by_outcome(table, FEATURES).drop("_rows")
    return shown(out)


@query(
    "category_by_outcome",
    f"""WITH {_JUDGED}, v AS (SELECT outcome, 'o_orderpriority' AS "column", o_orderpriority AS value FROM o
      UNION ALL SELECT outcome, 'o_orderstatus', o_orderstatus FROM o),
    c AS (SELECT outcome, "column", value, count(*) AS n FROM v GROUP BY ALL)
    SELECT outcome, "column", value, n AS count,
      round(100.0 * CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY outcome, "column"), 6) AS percent FROM c""",
)
def category_by_outcome(spark, sf):
    return shown(
        errors.category_by_outcome(_judged(spark, sf), ("o_orderpriority", "o_orderstatus"))
    )


def _focus(outcome: str) -> str:
    stats = ("mean", "std", "min", "q1", "median", "q3", "max")
    return (
        f"WITH {_TABLE}, w AS (SELECT * FROM x WHERE outcome = '{outcome}'),"
        f" v AS ({_long(('probability', *FEATURES), 'w')}),"
        f" n AS (SELECT feature, {_SEVEN} FROM v GROUP BY feature),"
        " c AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS col, '{c}=' || {c} AS name, count(*) AS n FROM w GROUP BY {c}" for c in CATEGORIES
        )
        + ")"
        f" SELECT 'rows' AS section, '{outcome}' AS name, 'count' AS statistic,"
        " CAST((SELECT count(*) FROM w) AS DOUBLE) AS value"
        f" UNION ALL SELECT 'rows', '{outcome}', 'percent_of_rows',"
        " round(100.0 * CAST((SELECT count(*) FROM w) AS DOUBLE) / (SELECT count(*) FROM x), 6)"
        + "".join(
            f" UNION ALL SELECT CASE WHEN feature = 'probability' THEN 'probability' ELSE 'numeric' END,"
            f" feature, '{s}', {s} FROM n" + (" WHERE feature <> 'probability'" if s == "std" else "")
            for s in stats
        )
        + " UNION ALL SELECT 'category', name, 'count', CAST(n AS DOUBLE) FROM c"
        " UNION ALL SELECT 'category', name, 'percent',"
        " round(100.0 * CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY col), 6) FROM c"
    )


@query("false_positive_summary", _focus("false_positive"))
def false_positive_summary(spark, sf):
    return shown(
        errors.error_focus(_table(spark, sf), FEATURES, CATEGORIES, "false_positive")
    )


@query("false_negative_summary", _focus("false_negative"))
def false_negative_summary(spark, sf):
    return shown(
        errors.error_focus(_table(spark, sf), FEATURES, CATEGORIES, "false_negative")
    )


@query(
    "mean_differences",
    f"WITH {_TABLE} "
    + " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS feature,
          round(avg({c}) FILTER (outcome = 'false_positive'), 6) AS error_mean,
          round(avg({c}) FILTER (outcome = 'true_negative'), 6) AS correct_mean,
          round(avg({c}) FILTER (outcome = 'false_positive')
            - avg({c}) FILTER (outcome = 'true_negative'), 6) AS difference FROM x"""
        for i, c in enumerate(FEATURES)
    ),
)
def mean_differences(spark, sf):
    return shown(errors.mean_differences(_table(spark, sf), FEATURES, "false_positive"))


def _top(outcome: str) -> str:
    return (
        f"WITH {_JUDGED} SELECT o_orderkey, o_orderpriority, o_orderstatus, label,"
        " round(probability, 9) AS probability, actual, predicted, outcome FROM ("
        f"SELECT * FROM o WHERE outcome = '{outcome}' ORDER BY probability DESC, o_orderkey LIMIT 10)"
    )


@query("top_false_positives", _top("false_positive"))
def top_false_positives(spark, sf):
    return shown(errors.top_errors(_judged(spark, sf), "o_orderkey", "false_positive"))


@query("top_false_negatives", _top("false_negative"))
def top_false_negatives(spark, sf):
    return shown(errors.top_errors(_judged(spark, sf), "o_orderkey", "false_negative"))


@query(
    "top_false_positives_by_status",
    f"""WITH {_JUDGED}, r AS (SELECT *, row_number() OVER (
        PARTITION BY o_orderstatus ORDER BY probability DESC, o_orderkey) AS place
      FROM o WHERE outcome = 'false_positive')
    SELECT o_orderkey, o_orderpriority, o_orderstatus, label, round(probability, 9) AS probability,
      actual, predicted, outcome FROM r WHERE place <= 5""",
)
def top_false_positives_by_status(spark, sf):
    return shown(
        errors.top_errors(_judged(spark, sf), "o_orderkey", "false_positive", 5, "o_orderstatus")
    )


@query(
    "threshold_error_summary",
    f"""WITH {sql.SCORED}, {sql.sweep('s')}, n AS (
      SELECT *, true_negative + false_positive + false_negative + true_positive AS total FROM sweep)
    SELECT {sql.THRESHOLD_ROW},
      round(100.0 * CAST(false_positive AS DOUBLE) / total, 6) AS false_positive_rate,
      round(100.0 * CAST(false_negative AS DOUBLE) / (false_negative + true_positive), 6)
        AS false_negative_rate_actual_positives,
      predicted_positive_count || ' of ' || total || ' rows would be flagged for review' AS workload
    FROM n""",
)
def threshold_error_summary(spark, sf):
    rows = metrics.threshold_sweep(b.orders_scored(spark, sf))
    return shown(errors.threshold_error_summary(rows))


_STUDIED = {"default_0_5": 0.5, "best_f1": 0.8, "minimum_recall": 0.7, "lowest_cost": 0.7}


@query(
    "error_cases",
    f"WITH {sql.SCORED}, d AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{n}', CAST({t} AS DOUBLE))" for n, t in _STUDIED.items())
    + """) v(selection, threshold))
    SELECT selection, round(threshold, 6) AS threshold,
      CASE WHEN label = 1 THEN 'false_negative' ELSE 'false_positive' END AS outcome,
      round(probability, 9) AS probability, o_orderkey, o_orderpriority, o_orderstatus
    FROM s JOIN d ON CAST(probability >= threshold AS INTEGER) <> label""",
)
def error_cases(spark, sf):
    """Two selections share a threshold and both give rows."""
    return shown(
        errors.error_cases(
            b.orders_scored(spark, sf),
            _STUDIED,
            ("o_orderkey", "o_orderpriority", "o_orderstatus"),
        )
    )


@query(
    "batch_predict",
    f"""WITH {sql.SCORED} SELECT o_orderkey, round(probability, 9) AS failure_probability,
      CAST(probability >= CAST(0.8 AS DOUBLE) AS INTEGER) AS predicted_failure FROM s""",
)
def batch_predict(spark, sf):
    return shown(predict_scored(b.orders_scored(spark, sf), "o_orderkey", 0.8))


@query(
    "predictions_joined",
    """SELECT d.doc_id, lang, source, n_chars,
      round(CASE WHEN l.doc_id IS NOT NULL THEN n_chars / CAST(25000 AS DOUBLE) END, 9)
        AS failure_probability,
      CASE WHEN l.doc_id IS NOT NULL
        THEN CAST(n_chars / CAST(25000 AS DOUBLE) >= CAST(0.2 AS DOUBLE) AS INTEGER) END AS predicted_failure
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def predictions_joined(spark, sf):
    """Predictions exist for the reviewed documents; the others keep NULLs."""
    documents = b.read(spark, sf, "documents").drop("text")
    reviewed = documents.join(b.read(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    scored = reviewed.selectExpr("doc_id", "n_chars / 25000D AS probability")
    return shown(join_predictions(documents, predict_scored(scored, "doc_id", 0.2), "doc_id"))
