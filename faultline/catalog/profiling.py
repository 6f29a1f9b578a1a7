"""Scans, checks, profiles and exploration."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog import sql
from faultline.catalog.sql import shown
from faultline.operators import checks, explore, profile
from faultline.operators.thresholds import costed_sweep
from faultline.sources import bindings as b
from faultline.sources.tables import conform, load_prediction_input

QUERIES = {}
ORACLES = {}


def query(name, oracle=None):
    def add(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return add


NUMERIC = b.ORDERS.numeric


def _long(table: str, columns, keep: str = "") -> str:
    lead = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {table}" for c in columns
    )


@query(
    "scan_required",
    f"WITH {sql.ORDERS} SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus,"
    " round(o_totalprice, 6) AS o_totalprice, order_month, order_weekday, line_count, quantity_sum,"
    " round(discount_mean, 6) AS discount_mean, at_risk, large_order, urgent_order FROM t",
)
def scan_required(spark, sf):
    table = b.orders_table(spark, sf)
    checks.require_unique_columns(table)
    checks.require_columns(table, b.ORDERS)
    return shown(conform(table, b.ORDERS))


@query(
    "prediction_input",
    f"WITH {sql.ORDERS} SELECT o_orderkey, o_orderpriority, o_orderstatus,"
    " round(o_totalprice, 6) AS o_totalprice, order_month, order_weekday, line_count, quantity_sum,"
    " round(discount_mean, 6) AS discount_mean FROM t",
)
def prediction_input(spark, sf):
    rows = b.orders_table(spark, sf).select(b.ORDERS.key, *b.ORDERS.features)
    return shown(load_prediction_input(rows, b.ORDERS))


@query(
    "feature_projection",
    f"WITH {sql.ORDERS} SELECT o_orderkey, o_orderpriority, o_orderstatus,"
    " round(o_totalprice, 6) AS o_totalprice, order_month, order_weekday, line_count, quantity_sum,"
    " round(discount_mean, 6) AS discount_mean, at_risk FROM t",
)
def feature_projection(spark, sf):
    return shown(checks.feature_projection(b.orders_table(spark, sf), b.ORDERS))


@query(
    "target_check",
    f"""WITH {sql.DOCUMENTS}, c AS (
      SELECT CASE WHEN toxic IS NULL THEN '<NA>' WHEN toxic = 0 THEN '0' WHEN toxic = 1 THEN '1'
        ELSE 'other' END AS label, count(*) AS n FROM t GROUP BY 1),
    k AS (SELECT * FROM (VALUES ('0'), ('1'), ('other'), ('<NA>')) v(label))
    SELECT k.label, coalesce(n, 0) AS count,
      CASE WHEN k.label = 'other' AND n > 0 THEN 'not_binary'
        WHEN k.label = '<NA>' AND n > 0 THEN 'missing_label'
        WHEN k.label IN ('0', '1') AND coalesce(n, 0) = 0 THEN 'absent_class'
        WHEN k.label IN ('0', '1') AND n < 3 THEN 'too_few_rows' END AS violation
    FROM k LEFT JOIN c ON k.label = c.label""",
)
def target_check(spark, sf):
    return checks.target_check(b.documents_table(spark, sf), "toxic")


@query(
    "score_check",
    f"""WITH {sql.DOCUMENTS}, x AS (
      SELECT lang, toxic AS label, n_chars / CAST(15000 AS DOUBLE) AS p FROM t)
    SELECT lang, count(*) AS row_count, count(*) FILTER (label IS NULL) AS missing_labels,
      count(*) FILTER (label NOT IN (0, 1)) AS other_labels,
      count(*) FILTER (label = 0) AS negatives, count(*) FILTER (label = 1) AS positives,
      count(*) FILTER (p IS NULL) AS unusable_probabilities,
      count(*) FILTER (p < 0 OR p > 1) AS probabilities_out_of_range,
      count(*) FILTER (label IS NULL OR label NOT IN (0, 1) OR p IS NULL OR p < 0 OR p > 1) = 0
        AND count(*) FILTER (label = 0) > 0 AND count(*) FILTER (label = 1) > 0 AS valid
    FROM x GROUP BY lang""",
)
def score_check(spark, sf):
    rows = b.documents_table(spark, sf).select(
        "lang", F.col("toxic").alias("label"), (F.col("n_chars") / 15000.0).alias("probability")
    )
    return checks.score_check(rows, group_by="lang")


@query(
    "split_integrity",
    """WITH p AS (SELECT l_orderkey, l_linenumber,
        CASE WHEN substr(md5(CAST(l_partkey AS VARCHAR)), 1, 1) < '4' THEN 'test' ELSE 'train' END AS split
      FROM lineitem)
    SELECT l_orderkey, l_linenumber, count(*) AS copies,
      CASE WHEN count(DISTINCT split) > 1 THEN 'in_several_parts' ELSE 'repeated_key' END AS violation
    FROM p GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def split_integrity(spark, sf):
    part = F.substring(F.md5(F.col("l_partkey").cast("string")), 1, 1) < "4"
    rows = b.read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(part, "test").otherwise("train").alias("split")
    )
    return checks.split_integrity(rows, ("l_orderkey", "l_linenumber"))


@query(
    "alignment_check",
    """SELECT count(*) FILTER (d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL) AS matched,
      count(*) FILTER (l.doc_id IS NULL) AS features_only,
      count(*) FILTER (d.doc_id IS NULL) AS scores_only, CAST(0 AS BIGINT) AS repeated
    FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""",
)
def alignment_check(spark, sf):
    return checks.alignment_check(
        b.read(spark, sf, "documents"), b.read(spark, sf, "labels"), "doc_id"
    )


@query(
    "threshold_audit",
    f"""WITH {sql.MODELS}, {sql.sweep("m", "model")},
    bad AS (
      SELECT model, threshold,
        true_negative + CASE WHEN threshold = 0.5 THEN 1 ELSE 0 END AS tn, false_positive AS fp,
        false_negative AS fn, true_positive AS tp,
        CASE WHEN threshold = CAST(0.3 AS DOUBLE) THEN precision + 0.01 ELSE precision END AS precision,
        CASE WHEN model = 'blend' AND threshold = CAST(0.7 AS DOUBLE) THEN 1.5 ELSE recall END AS recall,
        f1, predicted_positive_count AS k, predicted_positive_rate AS r,
        CASE WHEN threshold = CAST(0.9 AS DOUBLE) THEN -1.0 ELSE total_cost END AS total_cost
      FROM sweep
      UNION ALL
      SELECT model, threshold, true_negative, false_positive, false_negative, true_positive,
        precision, recall, f1, predicted_positive_count, predicted_positive_rate, total_cost
      FROM sweep WHERE threshold = CAST(0.25 AS DOUBLE) AND model <> 'blend'),
    w AS (SELECT *, tn + fp + fn + tp AS total, count(*) OVER (PARTITION BY model, threshold) AS copies,
        min(fn + tp) OVER g AS p0, max(fn + tp) OVER g AS p1,
        min(tn + fp) OVER g AS n0, max(tn + fp) OVER g AS n1
      FROM bad WINDOW g AS (PARTITION BY model))
    SELECT model, round(threshold, 6) AS threshold, violation FROM (
      SELECT model, threshold, 'rate_outside_0_1' AS violation FROM w
        WHERE recall > 1 OR precision > 1 OR f1 > 1 OR r > 1
      UNION ALL SELECT model, threshold, 'bad_cost' FROM w WHERE total_cost < 0
      UNION ALL SELECT model, threshold, 'flagged_mismatch' FROM w WHERE k <> fp + tp
      UNION ALL SELECT model, threshold, 'flagged_rate_mismatch' FROM w
        WHERE abs(r - k / CAST(total AS DOUBLE)) > 1e-8 + 1e-5 * k / CAST(total AS DOUBLE)
      UNION ALL SELECT model, threshold, 'precision_mismatch' FROM w
        WHERE abs(precision - CASE WHEN fp + tp = 0 THEN 0 ELSE tp / CAST(fp + tp AS DOUBLE) END)
          > 1e-8 + 1e-5 * CASE WHEN fp + tp = 0 THEN 0 ELSE tp / CAST(fp + tp AS DOUBLE) END
      UNION ALL SELECT model, threshold, 'recall_mismatch' FROM w
        WHERE abs(recall - tp / CAST(fn + tp AS DOUBLE)) > 1e-8 + 1e-5 * tp / CAST(fn + tp AS DOUBLE)
      UNION ALL SELECT model, threshold, 'repeated_threshold' FROM w WHERE copies > 1
      UNION ALL SELECT model, threshold, 'totals_differ' FROM w WHERE p0 <> p1 OR n0 <> n1)""",
)
def threshold_audit(spark, sf):
    rows = costed_sweep(b.orders_models(spark, sf), group_by="model")
    t = F.col("threshold")
    again = rows.where((t == 0.25) & (F.col("model") != "blend"))
    spoilt = rows.withColumns(
        {
            "true_negative": F.col("true_negative") + (t == 0.5).cast("int"),
            "precision": F.when(t == 0.3, F.col("precision") + 0.01).otherwise(F.col("precision")),
            "recall": F.when((F.col("model") == "blend") & (t == 0.7), 1.5).otherwise(F.col("recall")),
            "total_cost": F.when(t == 0.9, -1.0).otherwise(F.col("total_cost")),
        }
    )
    return shown(checks.threshold_audit(spoilt.unionByName(again), "model"))


@query(
    "metadata_audit",
    f"""WITH {sql.FLAGS}, r AS (
      SELECT o_custkey, count(*) AS n, count(*) FILTER (at_risk = 0) AS n0,
        count(*) FILTER (at_risk = 1) AS n1
      FROM flags GROUP BY o_custkey)
    SELECT o_custkey, 'threshold' AS violation FROM r WHERE n % 20 = 0
    UNION ALL SELECT o_custkey, 'class_sum' FROM r WHERE o_custkey % 3 = 0
    UNION ALL SELECT o_custkey, 'checksum' FROM r WHERE o_custkey % 5 = 0
    UNION ALL SELECT o_custkey, 'timestamp' FROM r WHERE o_custkey % 7 = 0
    UNION ALL SELECT o_custkey, 'version_unsupported' FROM r WHERE o_custkey % 11 = 0
    UNION ALL SELECT o_custkey, 'version_format' FROM r WHERE o_custkey % 11 = 0""",
)
def metadata_audit(spark, sf):
    """A registry of one artifact per customer, with some fields spoilt by rule."""
    from faultline.operators.artifact import build_metadata

    spec = b.ORDERS
    base = build_metadata(spec, 0.5, {0: 1, 1: 1})
    key = F.col("o_custkey")
    counts = (
        b.orders_scored_by_customer(spark, sf)
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("label") == 0).alias("n0"),
            F.count_if(F.col("label") == 1).alias("n1"),
        )
    )
    fixed = {
        f: F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(v)
        for f, v in base.items()
        if not isinstance(v, dict)
    }
    digest = F.sha2(key.cast("string"), 256)
    registry = counts.withColumns(
        {
            **fixed,
            "operating_threshold": (F.col("n") % 20) / 20.0,
            "development_row_count": F.col("n") + (key % 3 == 0).cast("int"),
            "development_class_distribution": F.create_map(
                F.lit("0"), F.col("n0"), F.lit("1"), F.col("n1")
            ),
            "model_sha256": F.when(key % 5 == 0, F.substring(digest, 1, 60)).otherwise(digest),
            "training_timestamp_utc": F.when(key % 7 == 0, "2024-05-01T10:00:00+02:00").otherwise(
                "2024-05-01T10:00:00+00:00"
            ),
            "artifact_version": F.when(key % 11 == 0, "1.0").otherwise("1.0.0"),
        }
    )
    return checks.metadata_audit(registry, spec, ("o_custkey",))


@query(
    "dataset_summary",
    f"""WITH {sql.LINES}, g AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linestatus, l_quantity, l_extendedprice,
        l_discount, l_tax, returned, count(*) AS n FROM t GROUP BY ALL)
    SELECT 'row_count' AS metric, CAST(sum(n) AS BIGINT) AS value FROM g
    UNION ALL SELECT 'column_count', CAST(9 AS BIGINT)
    UNION ALL SELECT 'duplicate_row_count', CAST(sum(n - 1) AS BIGINT) FROM g""",
)
def dataset_summary(spark, sf):
    return profile.dataset_summary(b.lines_table(spark, sf))


@query(
    "duplicate_rows",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_row_count FROM (
      SELECT COLUMNS(*), count(*) AS n FROM lineitem GROUP BY ALL)""",
)
def duplicate_rows(spark, sf):
    """Whole rows of the table with all its columns."""
    return profile.duplicate_rows(b.read(spark, sf, "lineitem"))


@query(
    "duplicate_lines",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_row_count FROM (
      SELECT l_linestatus, l_quantity, l_discount, l_tax, count(*) AS n
      FROM lineitem GROUP BY ALL)""",
)
def duplicate_lines(spark, sf):
    """Four columns, so that most rows are repeated ones."""
    table = b.read(spark, sf, "lineitem")
    return profile.duplicate_rows(table.select("l_linestatus", "l_quantity", "l_discount", "l_tax"))


_ROLES = b.ORDERS.roles()


@query(
    "missing_values",
    f"WITH {sql.ORDERS} "
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column, '{role}' AS role,"
        f" count(*) FILTER ({c} IS NULL) AS missing_count,"
        f" round(100.0 * CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) / count(*), 2) AS missing_percent FROM t"
        for i, (c, role) in enumerate(_ROLES)
    ),
)
def missing_values(spark, sf):
    return profile.missing_values(conform(b.orders_table(spark, sf), b.ORDERS), b.ORDERS)


@query(
    "schema_summary",
    f"WITH {sql.ORDERS} "
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column, '{role}' AS role,"
        f" '{b.ORDERS.type_of(c).simpleString()}' AS type, count({c}) AS filled FROM t"
        for i, (c, role) in enumerate(_ROLES)
    ),
)
def schema_summary(spark, sf):
    return profile.schema_summary(conform(b.orders_table(spark, sf), b.ORDERS), b.ORDERS)


@query(
    "target_summary",
    f"""WITH {sql.DOCUMENTS}, c AS (SELECT toxic, count(*) AS n FROM t WHERE toxic IS NOT NULL GROUP BY 1)
    SELECT CAST(toxic AS VARCHAR) AS label, n AS count,
      round(100.0 * CAST(n AS DOUBLE) / sum(n) OVER (), 2) AS percent,
      round(CAST(max(n) OVER () AS DOUBLE) / min(n) OVER (), 6) AS imbalance_ratio FROM c""",
)
def target_summary(spark, sf):
    return shown(profile.target_summary(b.documents_table(spark, sf), "toxic"))


_STATS = """count(value) AS count, count(*) - count(value) AS missing,
      round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
      round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q1,
      round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3,
      round(max(value), 6) AS max"""


@query(
    "numeric_summary",
    f"WITH {sql.ORDERS}, v AS ({_long('t', NUMERIC)}) SELECT feature, {_STATS} FROM v GROUP BY feature",
)
def numeric_summary(spark, sf):
    return shown(profile.numeric_summary(b.orders_table(spark, sf), NUMERIC))


@query(
    "numeric_summary_bucketed",
    f"WITH {sql.LINES}, v AS ({_long('t', b.LINES.numeric)}) SELECT feature, {_STATS} FROM v GROUP BY feature",
)
def numeric_summary_bucketed(spark, sf):
    """The way of large tables: quantiles by ordered buckets, no group in one task."""
    return shown(profile.numeric_summary(b.lines_table(spark, sf), b.LINES.numeric, buckets=64))


@query(
    "describe_numeric",
    f"WITH {sql.LINES}, v AS ({_long('t', b.LINES.numeric)}) SELECT feature, {_STATS} FROM v GROUP BY feature",
)
def describe_numeric(spark, sf):
    return shown(explore.describe_numeric(b.lines_table(spark, sf), b.LINES.numeric))


@query(
    "numeric_by_supplier",
    f"WITH {sql.LINES}, v AS ({_long('t', b.LINES.numeric, 'l_suppkey')})"
    f" SELECT l_suppkey, feature, {_STATS} FROM v GROUP BY l_suppkey, feature",
)
def numeric_by_supplier(spark, sf):
    """Any number of groups, by ordered buckets and without a broadcast."""
    return shown(
        profile.numeric_summary(
            b.lines_table(spark, sf), b.LINES.numeric, "l_suppkey", few_groups=False, buckets=16
        )
    )


@query(
    "categorical_summary",
    f"WITH {sql.DOCUMENTS}, v AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, coalesce(CAST({c} AS VARCHAR), '<NA>') AS value FROM t"
        for c in ("lang", "source", "toxic")
    )
    + """), c AS (SELECT "column", value, count(*) AS n FROM v GROUP BY ALL)
    SELECT "column", value, n AS count,
      round(100.0 * CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY "column"), 2) AS percent FROM c""",
)
def categorical_summary(spark, sf):
    return profile.categorical_summary(
        b.documents_table(spark, sf), ("lang", "source", "toxic")
    )


@query(
    "constant_columns",
    f"WITH {sql.ORDERS}, r AS (SELECT *, o_totalprice < 0 AS is_refund FROM t) SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column FROM r"
        f" HAVING count(DISTINCT {c}) + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END = 1"
        for i, c in enumerate([*(c for c, _ in _ROLES), "is_refund"])
    )
    + ")",
)
def constant_columns(spark, sf):
    table = conform(b.orders_table(spark, sf), b.ORDERS)
    return profile.constant_columns(table.withColumn("is_refund", F.col("o_totalprice") < 0))


@query(
    "unexpected_categories",
    """SELECT 'o_orderstatus' AS column, o_orderstatus AS value, count(*) AS count FROM orders
    WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY ALL""",
)
def unexpected_categories(spark, sf):
    orders = b.read(spark, sf, "orders").select("o_orderpriority", "o_orderstatus")
    return profile.unexpected_categories(orders, b.ORDERS)


@query(
    "data_warnings",
    f"""WITH {sql.DOCUMENTS}, f AS (SELECT lang, source, toxic, quality FROM t),
    k AS (SELECT toxic, count(*) AS n FROM f WHERE toxic IS NOT NULL GROUP BY toxic),
    facts AS (SELECT
      (SELECT count(*) FROM f WHERE toxic IS NULL) AS gaps,
      (SELECT CAST(max(n) AS DOUBLE) / min(n) FROM k) AS ratio,
      (SELECT count(*) FROM k) AS classes,
      (SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM f GROUP BY lang, source, toxic, quality)) AS copies,
      (SELECT sum((lang IS NULL)::INT + (source IS NULL)::INT + (toxic IS NULL)::INT + (quality IS NULL)::INT)
        FROM f) AS cells,
      (SELECT count(DISTINCT lang) FROM f WHERE lang NOT IN ('de', 'en', 'fr')) AS odd,
      (SELECT count(*) FROM f WHERE lang NOT IN ('de', 'en', 'fr')) AS odd_rows)
    SELECT CAST(1 AS INTEGER) AS ord, 'missing_target' AS code,
      'target has ' || gaps || ' missing values' AS message FROM facts WHERE gaps > 0
    UNION ALL SELECT 4, 'imbalanced_target',
      'largest class outnumbers the smallest by ' || CAST(CAST(ratio AS DECIMAL(20, 2)) AS VARCHAR)
      FROM facts WHERE classes > 1 AND ratio >= 10
    UNION ALL SELECT 5, 'duplicate_rows', copies || ' duplicate rows' FROM facts WHERE copies > 0
    UNION ALL SELECT 6, 'missing_cells', cells || ' missing cells' FROM facts WHERE cells > 0
    UNION ALL SELECT 8, 'unexpected_categories',
      odd || ' unexpected category values in ' || odd_rows || ' rows' FROM facts WHERE odd > 0""",
)
def data_warnings(spark, sf):
    table = b.documents_table(spark, sf).select("lang", "source", "toxic", "quality")
    return profile.data_warnings(table, b.DOCUMENTS)


_V = f"v AS ({_long('t', NUMERIC)})"
_VT = f"v AS ({_long('t', NUMERIC, 'at_risk')})"


@query(
    "numeric_by_target",
    f"""WITH {sql.ORDERS}, {_VT} SELECT at_risk, feature, round(avg(value), 6) AS mean,
      round(quantile_cont(value, 0.5), 6) AS median, round(stddev_samp(value), 6) AS std,
      round(min(value), 6) AS min, round(max(value), 6) AS max FROM v GROUP BY ALL""",
)
def numeric_by_target(spark, sf):
    return shown(explore.numeric_by_target(b.orders_table(spark, sf), NUMERIC, "at_risk"))


@query(
    "category_failure_rate",
    f"""WITH {sql.FLAGS}, c AS (SELECT o_orderpriority AS value, count(*) AS n, avg(at_risk) AS p
      FROM flags GROUP BY 1)
    SELECT value, n AS count, round(100.0 * CAST(n AS DOUBLE) / sum(n) OVER (), 3) AS percent,
      round(p * 100, 3) AS failure_percent FROM c""",
)
def category_failure_rate(spark, sf):
    rows = b.orders_flags(spark, sf).select("o_orderpriority", "at_risk")
    return explore.category_rates(rows, "o_orderpriority", "at_risk")


@query(
    "target_table",
    f"""WITH {sql.DOCUMENTS}, c AS (SELECT coalesce(CAST(toxic AS VARCHAR), '<NA>') AS label,
      count(*) AS n FROM t GROUP BY 1)
    SELECT label, n AS count, round(100.0 * CAST(n AS DOUBLE) / sum(n) OVER (), 3) AS percent FROM c""",
)
def target_table(spark, sf):
    return explore.target_table(b.documents_table(spark, sf), "toxic")


_CORR = (*NUMERIC, "at_risk")


@query(
    "correlation_matrix",
    f"WITH {sql.ORDERS} "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr(CAST({min(x, y)} AS DOUBLE), CAST({max(x, y)} AS DOUBLE)), 6) AS r FROM t"
        for x in _CORR
        for y in _CORR
    ),
)
def correlation_matrix(spark, sf):
    return shown(explore.correlation_matrix(b.orders_table(spark, sf), _CORR))


_FENCES = """f AS (SELECT {k}feature, min(value) AS lo, quantile_cont(value, 0.25) AS q1,
      quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3, max(value) AS hi
    FROM v WHERE value IS NOT NULL GROUP BY {k}feature),
    g AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lower_fence, q3 + 1.5::DOUBLE * (q3 - q1) AS upper_fence FROM f)"""


@query(
    "range_review",
    f"""WITH {sql.ORDERS}, {_V}, {_FENCES.format(k="")}
    SELECT feature, round(lo, 6) AS min, round(q1, 6) AS q1, round(median, 6) AS median,
      round(q3, 6) AS q3, round(hi, 6) AS max, round(q3 - q1, 6) AS iqr,
      round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence FROM g""",
)
def range_review(spark, sf):
    return shown(explore.range_review(b.orders_table(spark, sf), NUMERIC))


@query(
    "outlier_counts",
    f"""WITH {sql.ORDERS}, {_V}, {_FENCES.format(k="")}
    SELECT v.feature, count(*) FILTER (value < lower_fence OR value > upper_fence) AS outliers
    FROM v JOIN g ON v.feature = g.feature WHERE value IS NOT NULL GROUP BY v.feature""",
)
def outlier_counts(spark, sf):
    return explore.outlier_counts(b.orders_table(spark, sf), NUMERIC)


@query(
    "box_stats",
    f"""WITH {sql.ORDERS}, {_VT}, {_FENCES.format(k="at_risk, ")}
    SELECT v.at_risk, v.feature, round(max(q1), 6) AS q1, round(max(median), 6) AS median,
      round(max(q3), 6) AS q3,
      round(min(value) FILTER (value >= lower_fence AND value <= upper_fence), 6) AS lower_whisker,
      round(max(value) FILTER (value >= lower_fence AND value <= upper_fence), 6) AS upper_whisker,
      count(*) FILTER (value < lower_fence OR value > upper_fence) AS outliers
    FROM v JOIN g ON v.feature = g.feature AND v.at_risk = g.at_risk
    WHERE value IS NOT NULL GROUP BY v.at_risk, v.feature""",
)
def box_stats(spark, sf):
    return shown(
        explore.box_stats(b.orders_table(spark, sf), NUMERIC, "at_risk")
    )


@query(
    "histogram",
    f"""WITH {sql.LINES}, v AS ({_long('t', b.LINES.numeric)}),
    e AS (SELECT feature, min(value) AS a, max(value) AS z FROM v GROUP BY feature),
    c AS (SELECT v.feature,
        least(CAST(floor((value - a) / (z - a) * 30) AS INTEGER), 29) AS bin, count(*) AS n
      FROM v JOIN e ON v.feature = e.feature GROUP BY 1, 2)
    SELECT e.feature, CAST(k AS INTEGER) AS bin, round(a + k * ((z - a) / 30), 6) AS lower,
      round(a + (k + 1) * ((z - a) / 30), 6) AS upper, coalesce(n, 0) AS count
    FROM e CROSS JOIN range(0, 30) r(k) LEFT JOIN c ON c.feature = e.feature AND c.bin = k""",
)
def histogram(spark, sf):
    return shown(explore.histogram(b.lines_table(spark, sf), b.LINES.numeric))


@query(
    "leakage_review",
    f"WITH {sql.FLAGS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, 'known only together with the target' AS reason,"
        f" count(*) FILTER ({c} = 1) AS rows_set,"
        f" round(avg(at_risk) FILTER ({c} = 1), 6) AS failure_rate_set,"
        f" round(avg(at_risk) FILTER ({c} <> 1), 6) AS failure_rate_unset FROM flags"
        for c in b.ORDERS.leakage
    ),
)
def leakage_review(spark, sf):
    return shown(explore.leakage_review(b.orders_flags(spark, sf), b.ORDERS))


@query(
    "head",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
    " ORDER BY o_orderkey LIMIT 5",
)
def head(spark, sf):
    orders = b.read(spark, sf, "orders").drop("o_orderdate")
    return explore.head(orders, "o_orderkey", 5)


@query(
    "box_stats_by_supplier",
    f"""WITH {sql.LINES}, v AS ({_long('t', b.LINES.numeric, 'l_suppkey')}),
    {_FENCES.format(k="l_suppkey, ")}
    SELECT v.l_suppkey, v.feature, round(max(q1), 6) AS q1, round(max(median), 6) AS median,
      round(max(q3), 6) AS q3,
      round(min(value) FILTER (value >= lower_fence AND value <= upper_fence), 6) AS lower_whisker,
      round(max(value) FILTER (value >= lower_fence AND value <= upper_fence), 6) AS upper_whisker,
      count(*) FILTER (value < lower_fence OR value > upper_fence) AS outliers
    FROM v JOIN g ON v.feature = g.feature AND v.l_suppkey = g.l_suppkey GROUP BY v.l_suppkey, v.feature""",
)
def box_stats_by_supplier(spark, sf):
    """Any number of groups: the fences join by salted keys, not by broadcast."""
    return shown(
        explore.box_stats(
            b.lines_table(spark, sf), b.LINES.numeric, "l_suppkey", few_groups=False
        )
    )
