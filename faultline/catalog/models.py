"""Model training, importance, final evaluation and batch scoring over the whole tables.

All fits use the library's own settings. Scores depend on the solvers, so SQL checks what
follows from the data: which rows are scored, class counts, ranks and flags.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from faultline.catalog import sql
from faultline.catalog.sql import shown
from faultline.operators import importance, models
from faultline.operators.artifact import file_digests
from faultline.operators.boosting import LeafwiseBoosting
from faultline.operators.folds import FOLDS
from faultline.operators.splits import stratified_split as split_table
from faultline.plans import workflows
from faultline.functions.settle import checkpoint_dir, settle
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


#: The one candidate whose scores and metrics follow from the table alone.
_PRIOR_ONLY = {models.PRIOR: models.COMPARISON_MODELS[models.PRIOR]}
_PARTS = f"{sql.FLAGS}, {sql.split('flags', 'o_orderkey', 'at_risk')}"


def _train(name):
    def run(spark, sf):
        table = split_table(b.orders_table(spark, sf), "o_orderkey", "at_risk")
        model = models.fit_model(name, table.where("split = 'train'"), b.ORDERS)
        scored = models.score(model, table.where("split = 'validation'"))
        return scored.select(
            "o_orderkey", "at_risk", F.expr("probability BETWEEN 0 AND 1").alias("is_probability")
        )

    return run


for _query, _model in (
    ("train_lr", models.LOGISTIC),
    ("train_rf", models.FOREST),
    ("train_gbt", models.BOOSTING),
):
    # SQL can check which rows are scored, and that each has a probability.
    query(
        _query,
        f"WITH {_PARTS} SELECT o_orderkey, label AS at_risk, true AS is_probability FROM parts"
        " WHERE split = 'validation'",
    )(_train(_model))


#: Numeric features of the orders in their order in the vector; one-hot levels follow them.
_NUMBERS = [f for f in b.ORDERS.numeric]
_ROOT = f"""WITH {sql.ORDERS}, {sql.split('t', 'o_orderkey', 'at_risk')},
train AS (SELECT t.* FROM t JOIN parts USING (o_orderkey) WHERE split = 'train'),
c AS (SELECT at_risk, count(*) AS n, sum(count(*)) OVER () AS total FROM train GROUP BY at_risk),
levels AS (
  SELECT 0 AS kind, o_orderpriority AS level FROM train WHERE o_orderpriority IS NOT NULL
  UNION SELECT 1, o_orderstatus FROM train WHERE o_orderstatus IS NOT NULL),
hot AS (SELECT *, {len(_NUMBERS)} - 1 + row_number() OVER (ORDER BY kind, level) AS feature FROM levels),
cells AS (
  {" UNION ALL ".join(f"SELECT o_orderkey, at_risk, {i} AS feature, {f} AS x FROM train" for i, f in enumerate(_NUMBERS))}
  UNION ALL SELECT o_orderkey, at_risk, feature,
    CAST(coalesce(CASE kind WHEN 0 THEN o_orderpriority ELSE o_orderstatus END = level, false) AS DOUBLE)
  FROM train, hot),
g AS (
  SELECT feature, x, total / (2.0 * n) * (0.5 - at_risk) AS g, total / (2.0 * n) * 0.25 AS h
  FROM cells JOIN c USING (at_risk)),
placed AS (
  SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) AS place,
    count(*) OVER (PARTITION BY feature) AS n FROM g WHERE x IS NOT NULL),
edges AS (
  SELECT DISTINCT feature, x AS edge FROM placed, range(1, 255) r(i)
  WHERE place = greatest(CAST(ceil(i / 255.0 * n) AS BIGINT), 1)),
sides AS (
  SELECT e.feature, edge, missing_left, sum(g) AS g_all, sum(h) AS h_all, count(*) AS n_all,
    sum(g) FILTER (coalesce(x <= edge, missing_left)) AS g_left,
    sum(h) FILTER (coalesce(x <= edge, missing_left)) AS h_left,
    count(*) FILTER (coalesce(x <= edge, missing_left)) AS n_left
  FROM edges e JOIN g USING (feature), (VALUES (false), (true)) m(missing_left)
  GROUP BY e.feature, edge, missing_left),
gains AS (
  SELECT *, g_left * g_left / h_left + (g_all - g_left) * (g_all - g_left) / (h_all - h_left)
    - g_all * g_all / h_all AS gain
  FROM sides WHERE n_left >= 20 AND n_all - n_left >= 20)"""


@query(
    "train_hgb",
    f"""{_ROOT} SELECT CAST(feature AS BIGINT) AS feature, round(edge, 6) AS split_limit,
      round(gain, 3) AS gain, n_left AS left_rows, n_all AS rows
    FROM gains ORDER BY round(gain, 6) DESC, feature, edge, missing_left LIMIT 1""",
)
def train_hgb(spark, sf):
    """The first split of the first leaf-wise tree, with missing values as they are."""
    table = split_table(b.orders_table(spark, sf), "o_orderkey", "at_risk")
    pipeline = models.fit_model(
        models.BOOSTING,
        table.where("split = 'train'"),
        b.ORDERS,
        {models.BOOSTING: lambda weight_sum: LeafwiseBoosting(maxIter=1, earlyStopping="off")},
    )
    nodes = spark.createDataFrame(
        pipeline.stages[-1].nodes(),
        "tree long, node long, feature long, split_limit double, missing_left boolean, l long, r long,"
        " gain double, value double, rows long",
    )
    left = F.max(F.when(F.col("node") == 1, F.col("rows")))
    return shown(
        nodes.groupBy("tree").agg(
            *[F.max(F.when(F.col("node") == 0, F.col(c))).alias(c) for c in ("feature", "split_limit", "gain", "rows")],
            left.alias("left_rows"),
        ).drop("tree"),
        gain=3,
    )


@query(
    "model_comparison",
    f"""WITH {_PARTS}, n AS (SELECT count(*) FILTER (label = 0) AS actual_0,
      count(*) FILTER (label = 1) AS actual_1 FROM parts WHERE split = 'validation')
    SELECT model, actual_0, actual_1, model <> '{models.PRIOR}' AS above_prior FROM n,
      (VALUES {', '.join(f"('{m}')" for m in models.COMPARISON_MODELS)}) v(model)""",
)
def model_comparison(spark, sf):
    """Every model with its actual class counts, and whether its ranking beats the prior."""
    compared = workflows.model_comparison(b.orders_table(spark, sf), b.ORDERS)
    actual = F.col("true_positive") + F.col("false_negative")
    share = actual / (actual + F.col("true_negative") + F.col("false_positive"))
    return compared.select(
        "model",
        (F.col("true_negative") + F.col("false_positive")).alias("actual_0"),
        actual.alias("actual_1"),
        (F.col("average_precision") > share + 1e-9).alias("above_prior"),
    )


_OUT_OF_FOLD = f"""WITH {sql.FLAGS}, {sql.folds('flags', 'o_orderkey', 'at_risk', FOLDS)},
n AS (SELECT fold, count(*) AS n, sum(label) AS pos FROM folds GROUP BY fold),
fits AS (
  SELECT f.fold, f.n, f.pos, CAST(sum(o.pos) AS DOUBLE) / sum(o.n) AS p
  FROM n f JOIN n o ON f.fold <> o.fold GROUP BY ALL)"""


@query(
    "out_of_fold_scores",
    f"""{_OUT_OF_FOLD} SELECT '{models.PRIOR}' AS model, o_orderkey, fold, label, round(p, 9) AS probability
    FROM folds JOIN fits USING (fold)""",
)
def out_of_fold_scores(spark, sf):
    """The prior of the other folds for every row: a row's own fold never reaches its score."""
    return shown(workflows.out_of_fold_scores(b.orders_table(spark, sf), b.ORDERS, _PRIOR_ONLY))


@query(
    "cross_validation",
    f"""{_OUT_OF_FOLD}, c AS (
      SELECT fold, p >= 0.5 AS hit, n, CAST(pos AS BIGINT) AS pos FROM fits)
    SELECT '{models.PRIOR}' AS model, fold,
      round(CAST(CASE WHEN hit THEN pos ELSE n - pos END AS DOUBLE) / n, 6) AS accuracy,
      round(CASE WHEN hit THEN CAST(pos AS DOUBLE) / n ELSE 0 END, 6) AS precision,
      CAST(CASE WHEN hit THEN 1 ELSE 0 END AS DOUBLE) AS recall,
      round(CASE WHEN hit THEN 2.0 * pos / (n + pos) ELSE 0 END, 6) AS f1,
      CAST(0.5 AS DOUBLE) AS roc_auc, round(CAST(pos AS DOUBLE) / n, 6) AS average_precision,
      CASE WHEN hit THEN 0 ELSE n - pos END AS true_negative,
      CASE WHEN hit THEN n - pos ELSE 0 END AS false_positive,
      CASE WHEN hit THEN 0 ELSE pos END AS false_negative,
      CASE WHEN hit THEN pos ELSE 0 END AS true_positive
    FROM c""",
)
def cross_validation(spark, sf):
    """Every metric of the prior on each fold; SQL knows what a constant score must reach."""
    reports = workflows.cross_validation(b.orders_table(spark, sf), b.ORDERS, _PRIOR_ONLY)
    return shown(reports["cross_validation"])


@query(
    "final_evaluation",
    f"""WITH {_PARTS}, n AS (SELECT count(*) FILTER (label = 0) AS actual_0,
      count(*) FILTER (label = 1) AS actual_1 FROM parts WHERE split = 'test')
    SELECT operating_point, actual_0, actual_1, true AS is_threshold, true AS is_ranked FROM n,
      (VALUES ('default_0_5'), ('selected_balanced_threshold')) v(operating_point)""",
)
def final_evaluation(spark, sf):
    reports = workflows.final_evaluation(b.orders_table(spark, sf), b.ORDERS)
    return reports["final_evaluation"].select(
        "operating_point",
        (F.col("true_negative") + F.col("false_positive")).alias("actual_0"),
        (F.col("true_positive") + F.col("false_negative")).alias("actual_1"),
        F.expr("threshold > 0 AND threshold < 1").alias("is_threshold"),
        F.expr("roc_auc BETWEEN 0 AND 1 AND average_precision BETWEEN 0 AND 1").alias("is_ranked"),
    )


@query(
    "feature_importance",
    "SELECT rank, true AS in_order FROM range(1, "
    + str(len(b.ORDERS.features) + 1)
    + ") r(rank) UNION ALL SELECT -count(*), true FROM (VALUES "
    + ", ".join(f"('{f}')" for f in b.ORDERS.features)
    + ") f(feature)",
)
def feature_importance(spark, sf):
    """Ranks in order of importance, and a row with the number of known features ranked."""
    reports = workflows.explain(b.orders_table(spark, sf), b.ORDERS)
    ranked = settle(reports["feature_importance"])
    following = F.lead("importance_mean").over(Window.orderBy("rank"))  # one row per feature
    ordered = ranked.select(
        F.col("rank").cast("bigint").alias("rank"),
        F.coalesce(F.col("importance_mean") >= following, F.lit(True)).alias("in_order"),
    )
    known = ranked.agg(
        (-F.count_distinct(F.when(F.col("feature").isin(*b.ORDERS.features), F.col("feature")))).alias("rank"),
        F.every(F.col("importance_std") >= 0).alias("in_order"),
    )
    return ordered.unionAll(known)


@query(
    "batch_prediction",
    "SELECT o_orderkey, true AS is_probability, true AS is_consistent FROM orders",
)
def batch_prediction(spark, sf):
    """Build, save, check, load and apply an artifact to all orders."""
    path = f"{checkpoint_dir(spark)}/artifact-{uuid.uuid4().hex}"
    table = b.orders_table(spark, sf)
    workflows.build_artifact(table, b.ORDERS, path)
    rows = table.select(b.ORDERS.key, *b.ORDERS.features)
    predictions, report = workflows.batch_prediction(spark, rows, path, b.ORDERS)
    flagged = (F.col("failure_probability") >= report["operating_threshold"]).cast("int")
    return predictions.select(
        "o_orderkey",
        F.expr("failure_probability BETWEEN 0 AND 1").alias("is_probability"),
        (F.col("predicted_failure") == flagged).alias("is_consistent"),
    )


@query(
    "artifact_digest",
    """SELECT kind, true AS is_digest, true AS is_repeatable
    FROM (VALUES ('data'), ('metadata')) v(kind)""",
)
def artifact_digest(spark, sf):
    """Digests of a saved model's files by kind: well formed, and equal when hashed again."""
    path = f"{checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    model = models.fit_model(models.LOGISTIC, b.orders_table(spark, sf), b.ORDERS)
    model.write().overwrite().save(path)
    first, again = file_digests(spark, path), file_digests(spark, path)
    both = first.join(again.select("file", F.col("sha256").alias("again")), "file", "full")
    kind = F.when(F.col("file").contains("/metadata/") | F.col("file").startswith("metadata/"), "metadata")
    return both.groupBy(kind.otherwise("data").alias("kind")).agg(
        F.every(F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))).alias("is_digest"),
        F.every(F.coalesce(F.col("sha256") == F.col("again"), F.lit(False))).alias("is_repeatable"),
    )


_SCORE = """(CAST(0.7 AS DOUBLE) * (price / CAST(500000 AS DOUBLE))
    + CAST(0.3 AS DOUBLE) * (CAST((customer * 37) % 100 AS DOUBLE) / CAST(100 AS DOUBLE)))"""



def _feistel(x: str) -> str:
    """SELECT items that send ``x`` through the six rounds; the last two are l3 and r3."""
    out = [f"{x} // b AS l0", f"{x} % b AS r0"]
    for r in range(importance.ROUNDS):
        j = r // 2
        old, new, other, side = (f"l{j}", f"l{j + 1}", f"r{j}", "a") if r % 2 == 0 else (f"r{j}", f"r{j + 1}", f"l{j + 1}", "b")
        out.append(f"({other} + k{r}) % {importance.PRIME} * {importance.FIRST} % {importance.PRIME} AS t{r}")
        out.append(f"({old} + xor(t{r}, t{r} >> 15) * {importance.SECOND} % {importance.PRIME}) % {side} AS {new}")
    return ", ".join(out)


_KEYS = ", ".join(
    f"CAST('0x' || substr(md5(f || ':42:' || r || ':{i}'), 1, 7) AS BIGINT) AS k{i}" for i in range(importance.ROUNDS)
)
_PERMUTED = f"""RECURSIVE {sql.FLAGS},
base AS (
  SELECT o_orderkey, at_risk AS label, o_totalprice, o_custkey,
    row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS i
  FROM flags),
box AS (
  SELECT count(*) AS n, CAST(floor(sqrt(CAST(count(*) - 1 AS DOUBLE))) AS BIGINT) + 1 AS a,
    CAST(ceil(count(*) / floor(sqrt(CAST(count(*) - 1 AS DOUBLE)) + 1)) AS BIGINT) AS b
  FROM flags),
grid AS (SELECT f AS feature, r AS repeat, n, a, b, {_KEYS}
  FROM (VALUES ('o_totalprice'), ('o_custkey')) v(f), range(1, 11) w(r), box),
walk AS (
  SELECT feature, repeat, i, l3 * b + r3 AS x FROM (SELECT grid.*, i, {_feistel("i")} FROM base, grid)
  UNION ALL
  SELECT feature, repeat, i, l3 * b + r3 FROM (
    SELECT grid.*, walk.i, {_feistel("walk.x")} FROM walk JOIN grid USING (feature, repeat) WHERE walk.x >= n)),
moved AS (SELECT feature, repeat, i AS giver, x AS receiver FROM walk, box WHERE x < n),
swapped AS (
  SELECT m.feature, m.repeat, a.label,
    CASE WHEN m.feature = 'o_totalprice' THEN d.o_totalprice ELSE a.o_totalprice END AS price,
    CASE WHEN m.feature = 'o_custkey' THEN d.o_custkey ELSE a.o_custkey END AS customer
  FROM moved m JOIN base a ON a.i = m.receiver JOIN base d ON d.i = m.giver
  UNION ALL SELECT '', 0, label, o_totalprice, o_custkey FROM base),
points AS (
  SELECT feature, repeat, {_SCORE} AS p, sum(label) AS pos, count(*) AS n FROM swapped GROUP BY ALL),
steps AS (
  SELECT feature, repeat, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS k FROM points
  WINDOW w AS (PARTITION BY feature, repeat ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
ap AS (SELECT feature, repeat, sum(pos * CAST(tp AS DOUBLE) / k) / sum(pos) AS ap FROM steps GROUP BY ALL),
importance AS (
  SELECT feature, avg((SELECT ap FROM ap WHERE feature = '') - ap) AS importance_mean,
    stddev_pop((SELECT ap FROM ap WHERE feature = '') - ap) AS importance_std
  FROM ap WHERE feature <> '' GROUP BY feature)"""


def _importance(spark, sf):
    rows = b.orders_flags(spark, sf).select(
        "o_orderkey", F.col("at_risk").alias("label"), "o_totalprice", "o_custkey"
    )
    return importance.permutation_importance(
        rows,
        "o_orderkey",
        ("o_totalprice", "o_custkey"),
        lambda df: df.withColumn("probability", b.fixed_score()),
    )


@query(
    "permutation_importance",
    f"""WITH {_PERMUTED} SELECT feature, round(importance_mean, 6) AS importance_mean,
      round(importance_std, 6) AS importance_std FROM importance""",
)
def permutation_importance(spark, sf):
    return shown(_importance(spark, sf))


@query(
    "rank_importance",
    f"""WITH {_PERMUTED} SELECT CAST(row_number() OVER (ORDER BY importance_mean DESC, feature) AS INTEGER)
      AS rank, feature, round(importance_mean, 6) AS importance_mean,
      round(importance_std, 6) AS importance_std FROM importance""",
)
def rank_importance(spark, sf):
    return shown(importance.rank_importance(_importance(spark, sf)))
