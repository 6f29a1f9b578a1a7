"""SQL texts shared by the oracles: the analysis tables, written without Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame

from faultline.functions.columns import quoted

FLAGS = """
flags AS (
  SELECT *,
    CAST(o_totalprice > 450000 AND o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS at_risk,
    CAST(o_totalprice > 450000 AS INTEGER) AS large_order,
    CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS urgent_order
  FROM orders)"""

ORDERS = (
    FLAGS
    + """,
line_facts AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS line_count, sum(l_quantity) AS quantity_sum,
    round(avg(l_discount), 6) AS discount_mean
  FROM lineitem GROUP BY l_orderkey),
t AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_totalprice,
    CAST(month(o_orderdate) AS DOUBLE) AS order_month,
    CAST(isodow(o_orderdate) - 1 AS DOUBLE) AS order_weekday,
    line_count, quantity_sum, discount_mean, at_risk, large_order, urgent_order
  FROM flags LEFT JOIN line_facts ON o_orderkey = l_orderkey)"""
)

SCORE = """(CAST(0.7 AS DOUBLE) * (o_totalprice / CAST(500000 AS DOUBLE))
    + CAST(0.3 AS DOUBLE) * (CAST((o_custkey * 37) % 100 AS DOUBLE) / CAST(100 AS DOUBLE)))"""

SCORED = (
    FLAGS
    + f""",
s AS (
  SELECT o_orderkey, o_orderpriority, o_orderstatus, at_risk AS label, {SCORE} AS probability
  FROM flags)"""
)

MODELS = (
    FLAGS
    + f""",
m AS (
  SELECT 'blend' AS model, o_orderkey, at_risk AS label, {SCORE} AS probability FROM flags
  UNION ALL
  SELECT 'price_only', o_orderkey, at_risk,
    least(o_totalprice / CAST(500000 AS DOUBLE), CAST(1 AS DOUBLE)) FROM flags
  UNION ALL
  SELECT 'customer_only', o_orderkey, at_risk,
    CAST((o_custkey * 37) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) FROM flags)"""
)

LINES = """
t AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linestatus, l_quantity, l_extendedprice, l_discount,
    l_tax, CAST(l_returnflag = 'R' AS INTEGER) AS returned
  FROM lineitem)"""

DOCUMENTS = """
t AS (
  SELECT d.doc_id, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars, l.toxic, l.quality
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

EVENTS = """
e AS (
  SELECT event_id, user_id, CAST(event_type = 'error' AS INTEGER) AS label,
    least(value / CAST(600 AS DOUBLE), CAST(1 AS DOUBLE)) AS probability
  FROM events)"""

GRID = """
grid AS (SELECT CAST(k AS DOUBLE) / CAST(20 AS DOUBLE) AS threshold FROM range(1, 20) r(k))"""


def sweep(rows: str, keys: str = "", name: str = "sweep") -> str:
    """CTEs ``grid`` and ``<name>``: threshold rows by cross join, the slow plain way."""
    lead = f"{keys}, " if keys else ""
    return f"""{GRID},
{name}_counts AS (
  SELECT {lead}threshold,
    count(*) FILTER (label = 0 AND probability < threshold) AS true_negative,
    count(*) FILTER (label = 0 AND probability >= threshold) AS false_positive,
    count(*) FILTER (label = 1 AND probability < threshold) AS false_negative,
    count(*) FILTER (label = 1 AND probability >= threshold) AS true_positive
  FROM {rows}, grid GROUP BY {lead}threshold),
{name} AS (
  SELECT {lead}threshold, {RATES}, true_negative, false_positive, false_negative, true_positive,
    false_positive + true_positive AS predicted_positive_count,
    CAST(false_positive + true_positive AS DOUBLE)
      / (true_negative + false_positive + false_negative + true_positive)
      AS predicted_positive_rate,
    CAST(10 AS DOUBLE) * false_negative + CAST(1 AS DOUBLE) * false_positive AS total_cost
  FROM {name}_counts)"""


RATES = """
    CAST(true_negative + true_positive AS DOUBLE)
      / (true_negative + false_positive + false_negative + true_positive) AS accuracy,
    CASE WHEN true_positive + false_positive = 0 THEN CAST(0 AS DOUBLE)
      ELSE CAST(true_positive AS DOUBLE) / (true_positive + false_positive) END AS precision,
    CASE WHEN true_positive + false_negative = 0 THEN CAST(0 AS DOUBLE)
      ELSE CAST(true_positive AS DOUBLE) / (true_positive + false_negative) END AS recall,
    CASE WHEN 2 * true_positive + false_positive + false_negative = 0 THEN CAST(0 AS DOUBLE)
      ELSE CAST(2 * true_positive AS DOUBLE)
        / (2 * true_positive + false_positive + false_negative) END AS f1"""

THRESHOLD_ROW = """round(threshold, 6) AS threshold, round(accuracy, 6) AS accuracy,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  true_negative, false_positive, false_negative, true_positive, predicted_positive_count,
  round(predicted_positive_rate, 6) AS predicted_positive_rate"""


def split(rows: str, key: str, label: str) -> str:
    """CTE ``parts``: key, label and split by plain ranks over each class."""
    return f"""
sizes AS (
  SELECT {label} AS y, count(*) AS n, sum(count(*)) OVER () AS total FROM {rows} GROUP BY {label}),
test_share AS (
  SELECT y, n, total, ceil(0.2 * total) AS wanted,
    floor(ceil(0.2 * total) * n / total) AS base,
    ceil(0.2 * total) * n / total - floor(ceil(0.2 * total) * n / total) AS rest
  FROM sizes),
test_size AS (
  SELECT y, n, total, wanted,
    base + CASE WHEN row_number() OVER (ORDER BY rest DESC, y) <= wanted - sum(base) OVER ()
      THEN 1 ELSE 0 END AS n_test
  FROM test_share),
val_share AS (
  SELECT y, n_test, ceil(0.25 * (total - wanted)) AS wanted,
    floor(ceil(0.25 * (total - wanted)) * (n - n_test) / (total - wanted)) AS base,
    ceil(0.25 * (total - wanted)) * (n - n_test) / (total - wanted)
      - floor(ceil(0.25 * (total - wanted)) * (n - n_test) / (total - wanted)) AS rest
  FROM test_size),
val_size AS (
  SELECT y, n_test,
    base + CASE WHEN row_number() OVER (ORDER BY rest DESC, y) <= wanted - sum(base) OVER ()
      THEN 1 ELSE 0 END AS n_val
  FROM val_share),
ranked AS (
  SELECT {key}, {label} AS y, row_number() OVER (
      PARTITION BY {label} ORDER BY md5(CAST({key} AS VARCHAR) || ':42'), {key}) AS place
  FROM {rows}),
parts AS (
  SELECT {key}, ranked.y AS label,
    CASE WHEN place <= n_test THEN 'test' WHEN place <= n_test + n_val THEN 'validation'
      ELSE 'train' END AS split
  FROM ranked JOIN val_size ON ranked.y = val_size.y)"""


def folds(rows: str, key: str, label: str, k: int) -> str:
    """CTE ``folds``: key, label and fold, by dealing ranked rows like cards."""
    return f"""
fold_places AS (
  SELECT {key}, {label} AS label,
    row_number() OVER (PARTITION BY {label} ORDER BY md5(CAST({key} AS VARCHAR) || ':42'), {key}) AS place,
    row_number() OVER (ORDER BY {label}, md5(CAST({key} AS VARCHAR) || ':42'), {key}) - 1 AS card
  FROM {rows}),
dealt AS (
  SELECT label, CAST(card % {k} AS INTEGER) AS fold,
    row_number() OVER (PARTITION BY label ORDER BY card % {k}, card) AS place
  FROM fold_places),
folds AS (
  SELECT {key}, f.label, fold FROM fold_places f JOIN dealt d ON f.label = d.label AND f.place = d.place)"""


# A score built from cents and hundredths has nine decimals; rounding it to six would
# meet ties, which the two engines may break differently.
SCORES = ("probability", "score", "failure_probability")


def shown(df: DataFrame, **digits: int) -> DataFrame:
    """Doubles rounded, as in the oracles: sums of doubles depend on their order."""
    places = {**dict.fromkeys(SCORES, 9), **digits}
    return df.selectExpr(
        *[
            f"round({quoted(c)}, {places.get(c, 6)}) AS {quoted(c)}" if kind == "double" else quoted(c)
            for c, kind in df.dtypes
        ]
    )
