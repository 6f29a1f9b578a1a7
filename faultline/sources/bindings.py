"""Analysis tables built from the star-schema Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.spec import DatasetSpec

ORDERS = DatasetSpec(
    key="o_orderkey",
    target="at_risk",
    identifiers=("o_orderkey", "o_custkey"),
    categorical=("o_orderpriority", "o_orderstatus"),
    numeric=(
        "o_totalprice",
        "order_month",
        "order_weekday",
        "line_count",
        "quantity_sum",
        "discount_mean",
    ),
    leakage=("large_order", "urgent_order"),
    allowed={
        "o_orderpriority": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
        "o_orderstatus": ("F", "O"),
    },
    types={"o_orderkey": T.LongType(), "o_custkey": T.LongType()},
)

LINES = DatasetSpec(
    key="l_orderkey",
    target="returned",
    identifiers=("l_orderkey", "l_partkey", "l_suppkey"),
    categorical=("l_linestatus",),
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    allowed={"l_linestatus": ("F", "O")},
    types={k: T.LongType() for k in ("l_orderkey", "l_partkey", "l_suppkey")},
)

DOCUMENTS = DatasetSpec(
    key="doc_id",
    target="toxic",
    identifiers=("doc_id",),
    categorical=("lang", "source"),
    numeric=("n_chars",),
    leakage=("quality",),
    allowed={"lang": ("de", "en", "fr")},
    types={"doc_id": T.LongType()},
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_flags(orders: DataFrame) -> DataFrame:
    large = F.col("o_totalprice") > 450000
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return orders.select(
        "*",
        (large & urgent).cast("int").alias("at_risk"),
        large.cast("int").alias("large_order"),
        urgent.cast("int").alias("urgent_order"),
    )


def customer_share():
    return ((F.col("o_custkey") * 37) % 100) / F.lit(100.0)


def fixed_score():
    """A score in [0, 1] that SQL can repeat bit by bit."""
    return F.lit(0.7) * (F.col("o_totalprice") / F.lit(500000.0)) + F.lit(
        0.3
    ) * customer_share()


def orders_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with line-item features; orders without lines have missing features."""
    lines = (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).cast("double").alias("line_count"),
            F.sum("l_quantity").alias("quantity_sum"),
            F.round(F.avg("l_discount"), 6).alias("discount_mean"),
        )
    )
    orders = _order_flags(read(spark, sf_dir, "orders"))
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    return joined.select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        "o_orderstatus",
        "o_totalprice",
        F.month("o_orderdate").cast("double").alias("order_month"),
        F.weekday("o_orderdate").cast("double").alias("order_weekday"),
        "line_count",
        "quantity_sum",
        "discount_mean",
        "at_risk",
        "large_order",
        "urgent_order",
    )


def orders_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with target and leakage flags, one scan."""
    return _order_flags(read(spark, sf_dir, "orders"))


def orders_scored_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_custkey, label), one scan."""
    return orders_flags(spark, sf_dir).select("o_custkey", F.col("at_risk").alias("label"))


def orders_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, o_orderpriority, o_orderstatus, label, probability), one scan."""
    return orders_flags(spark, sf_dir).select(
        "o_orderkey",
        "o_orderpriority",
        "o_orderstatus",
        F.col("at_risk").alias("label"),
        fixed_score().alias("probability"),
    )


def orders_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form (model, key, label, probability) of three fixed scores, one scan."""
    share = customer_share()
    price = F.least(F.col("o_totalprice") / F.lit(500000.0), F.lit(1.0))
    scores = {"blend": fixed_score(), "price_only": price, "customer_only": share}
    cells = [
        F.struct(F.lit(m).alias("model"), p.alias("probability")) for m, p in scores.items()
    ]
    return (
        orders_flags(spark, sf_dir)
        .select(
            "o_orderkey", F.col("at_risk").alias("label"), F.inline(F.array(*cells))
        )
        .select("model", "o_orderkey", "label", "probability")
    )


def lines_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a returned flag; no column set identifies a row."""
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linestatus",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
    )


def events_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, user_id, label, probability): is the event an error?"""
    return read(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        (F.col("event_type") == "error").cast("int").alias("label"),
        F.least(F.col("value") / F.lit(600.0), F.lit(1.0)).alias("probability"),
    )


def documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; documents without a label have a missing target."""
    documents = read(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars")
    )
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return documents.join(labels, "doc_id", "left").select(
        "doc_id", "lang", "source", "n_chars", "toxic", "quality"
    )
