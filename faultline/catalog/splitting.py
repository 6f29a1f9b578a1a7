"""Split, folds, scaling, encoding, class weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog import sql
from faultline.catalog.sql import shown
from faultline.operators import features, folds, models, splits
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


_PARTS = f"WITH {sql.FLAGS}, {sql.split('flags', 'o_orderkey', 'at_risk')}"


def _split_orders(spark, sf):
    rows = b.orders_flags(spark, sf).select("o_orderkey", F.col("at_risk").alias("label"))
    return splits.stratified_split(rows, "o_orderkey", "label")


@query("stratified_split", f"{_PARTS} SELECT o_orderkey, label, split FROM parts")
def stratified_split(spark, sf):
    return _split_orders(spark, sf)


@query(
    "stratified_split_events",
    f"WITH {sql.EVENTS}, {sql.split('e', 'event_id', 'label')} SELECT event_id, label, split FROM parts",
)
def stratified_split_events(spark, sf):
    rows = b.events_scored(spark, sf).select("event_id", "label")
    return splits.stratified_split(rows, "event_id", "label")


@query("split_counts", f"{_PARTS} SELECT split, count(*) AS count FROM parts GROUP BY split")
def split_counts(spark, sf):
    return splits.split_counts(_split_orders(spark, sf))


@query(
    "split_class_counts",
    f"{_PARTS} SELECT split, label, count(*) AS count FROM parts GROUP BY split, label",
)
def split_class_counts(spark, sf):
    return splits.split_class_counts(_split_orders(spark, sf), "label")


@query(
    "development_set",
    f"{_PARTS} SELECT o_orderkey, label, split FROM parts WHERE split <> 'test'",
)
def development_set(spark, sf):
    return splits.development_set(_split_orders(spark, sf))


_FOLDS = f"WITH {sql.FLAGS}, {sql.folds('flags', 'o_orderkey', 'at_risk', folds.FOLDS)}"


def _folded_orders(spark, sf):
    rows = b.orders_flags(spark, sf).select("o_orderkey", F.col("at_risk").alias("label"))
    return folds.stratified_folds(rows, "o_orderkey", "label")


@query("kfold_assignment", f"{_FOLDS} SELECT o_orderkey, label, fold FROM folds")
def kfold_assignment(spark, sf):
    return _folded_orders(spark, sf)


@query(
    "kfold_assignment_events",
    f"WITH {sql.EVENTS}, {sql.folds('e', 'event_id', 'label', 7)} SELECT event_id, label, fold FROM folds",
)
def kfold_assignment_events(spark, sf):
    rows = b.events_scored(spark, sf).select("event_id", "label")
    return folds.stratified_folds(rows, "event_id", "label", folds=7)


@query("kfold_counts", f"{_FOLDS} SELECT fold, label, count(*) AS count FROM folds GROUP BY fold, label")
def kfold_counts(spark, sf):
    return folds.fold_counts(_folded_orders(spark, sf), "label")


_NUMERIC = b.ORDERS.numeric
_TABLE = f"WITH {sql.ORDERS}, {sql.split('t', 'o_orderkey', 'at_risk')}"


def _table(spark, sf):
    table = b.orders_table(spark, sf)
    plan = splits.fit_split(
        b.orders_flags(spark, sf).select("o_orderkey", "at_risk"), "o_orderkey", "at_risk"
    )
    return plan.apply(table)


@query(
    "standard_scale",
    f"""{_TABLE}, f AS (SELECT """
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _NUMERIC)
    + " FROM t JOIN parts ON t.o_orderkey = parts.o_orderkey WHERE split = 'train')"
    + " SELECT o_orderkey, "
    + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _NUMERIC)
    + " FROM t, f",
)
def standard_scale(spark, sf):
    table = _table(spark, sf)
    train = table.where("split = 'train'")
    return shown(
        features.standard_scale(train, table.select("o_orderkey", *_NUMERIC), _NUMERIC)
    )


_LEVELS = {
    "o_orderstatus": ("F", "O", "P"),
    "o_orderpriority": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
}


@query(
    "one_hot",
    f"{_PARTS} SELECT orders.o_orderkey, "
    + ", ".join(
        f"CAST(coalesce({c} = '{v}', false) AS INTEGER) AS \"{c}={v}\"" for c, held in _LEVELS.items() for v in held
    )
    + " FROM orders",
)
def one_hot(spark, sf):
    """Levels are learned from the train part and laid over all orders."""
    orders = b.read(spark, sf, "orders").select("o_orderkey", *_LEVELS)
    train = orders.join(_split_orders(spark, sf).where("split = 'train'"), "o_orderkey")
    return features.one_hot(train, orders, tuple(_LEVELS)).drop(*_LEVELS)


@query(
    "balanced_weights",
    f"""{_PARTS}, train AS (SELECT * FROM parts WHERE split = 'train'),
    c AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM train GROUP BY label)
    SELECT o_orderkey, train.label, split, round(CAST(total AS DOUBLE) / (2 * n), 6) AS weight
    FROM train JOIN c ON train.label = c.label""",
)
def balanced_weights(spark, sf):
    train = _split_orders(spark, sf).where("split = 'train'")
    return shown(features.balanced_weights(train, "label"))


@query(
    "dummy_prior_scores",
    f"""{_PARTS}, p AS (SELECT avg(label) AS p FROM parts WHERE split = 'train')
    SELECT o_orderkey, label, split, round(p, 9) AS probability, CAST(p > 0.5 AS INTEGER) AS prediction
    FROM parts, p WHERE split = 'validation'""",
)
def dummy_prior_scores(spark, sf):
    table = _split_orders(spark, sf)
    train = table.where("split = 'train'")
    return shown(models.prior_scores(train, table.where("split = 'validation'"), "label"))


@query(
    "derived_features",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      round(l_extendedprice / l_quantity, 8) AS unit_price,
      round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge,
      round(l_quantity * l_discount, 6) AS discounted_units
    FROM lineitem""",
)
def derived_features(spark, sf):
    table = b.read(spark, sf, "lineitem")
    out = features.derived_features(
        table,
        {
            "unit_price": "l_extendedprice / l_quantity",
            "charge": "l_extendedprice * (1 - l_discount) * (1 + l_tax)",
            "discounted_units": "l_quantity * l_discount",
        },
    )
    return shown(
        out.select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "unit_price",
            "charge",
            "discounted_units",
        ),
        unit_price=8,
    )
