"""Mixing sources to target weights by exact budgets of words.

Every document gets a hash-random key. Within a source the documents are taken in the order
of their keys until the source's budget is used up: whole epochs first, then the documents
before the cut, then a part of the document at the cut. The cut is found through
prefix sums over ranges of keys, each level only inside the range that holds the cut, so
no task sees more than one range of one source. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.settle import settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: A source gives at most this many times its words.
MOST = 3
#: Key ranges double in number this many times per level; then the last range is ordered.
BITS, LEVELS = 10, 2
#: Budgets of so many sources at most are sent to every task; more are joined by shuffle.
BROADCAST_SOURCES = 100_000


def words_of(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(column, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from one row per source.

    Sources in code-point order, null last, weigh `weights` in turn and share the total.
    A target stops at `most` times its source; what is left is shared anew by weight.
    In one step: with sources ordered by limit per weight, the first whose limit is not
    below the level that the rest would share sets the level of all others.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_source) - 1, F.lit(len(weights)))
    listed = sizes.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(most)).alias("limit"),
    )
    everything = Window.partitionBy()
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(earlier), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(earlier), F.lit(0.0)
    )
    levels = listed.withColumn("level", rest / open_weight).withColumn(
        "place", F.row_number().over(by_limit)
    )
    enough = F.when(F.col("limit") / F.col("weight") >= F.col("level"), F.col("place"))
    level = F.min_by("level", enough).over(everything)
    return levels.withColumn("shared", level).select(
        "source",
        "source_size",
        F.least(
            F.col("limit").cast("double"), F.coalesce(F.col("weight") * F.col("shared"), F.lit(0.0))
        ).alias("target"),
    )


def _crossing(sums: DataFrame, order: list[str], rests: DataFrame) -> DataFrame:
    """The row of each source where the running sum of `n` reaches `rest`, and the rest there."""
    before = F.sum("n").over(Window.partitionBy("source").orderBy(*order)) - F.col("n")
    wanted = rests.select(F.col("source").alias("wanted"), "rest")
    return (
        sums.withColumn("before", before)
        .join(wanted, F.col("source").eqNullSafe(F.col("wanted")))
        .where("before < rest AND rest <= before + n")
        .withColumn("rest", F.col("rest") - F.col("before"))
        .drop("before", "wanted")
    )


def budgets(
    slim: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """One row per source: target, epochs, and where the last epoch is cut.

    `slim` has key, source, size and draw (the hash-random number of the key).
    """
    per_source = targets(
        settle(slim.groupBy("source").agg(F.sum("size").alias("source_size"))), weights, most
    )
    budget = F.round("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    full = F.least(full.cast("long"), F.lit(most).cast("long"))
    plan = settle(
        per_source.withColumn("epochs", full).withColumn(
            "rest", budget - F.col("epochs") * F.col("source_size")
        )
    )
    rests = plan.where("rest > 0").select("source", "rest")
    inside = slim
    for level in range(1, LEVELS + 1):
        inside = inside.withColumn("range", F.shiftright("draw", 64 - BITS * level))
        sums = inside.groupBy("source", "range").agg(F.sum("size").alias("n"))
        rests = settle(_crossing(sums, ["range"], rests).select("source", "range", "rest"))
        held = rests.select(F.col("source").alias("held_source"), F.col("range").alias("held_range"))
        same = F.col("source").eqNullSafe(F.col("held_source")) & (F.col("range") == F.col("held_range"))
        inside = settle(inside.join(held, same, "left_semi").drop("range"))
    # Rows with the same key share one place in the order.
    sums = inside.groupBy("source", "draw", "key").agg(F.sum("size").alias("n"))
    cuts = _crossing(sums, ["draw", F.col("key").asc_nulls_first()], rests).select(
        F.col("source").alias("cut_source"),
        F.col("draw").alias("cut_draw"),
        F.col("key").alias("cut_key"),
        F.col("rest").alias("cut_rest"),
        F.col("n").alias("cut_size"),
    )
    return settle(
        plan.drop("rest")
        .join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
        .drop("cut_source")
        .withColumnRenamed("source", "budget_source")
    )


def _draw(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "key")


def _with_taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds source_size, target and taken to rows with key, source, size and draw."""
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    same_place = (F.col("draw") == F.col("cut_draw")) & F.col("key").eqNullSafe(F.col("cut_key"))
    before = (F.col("draw") < F.col("cut_draw")) | (
        (F.col("draw") == F.col("cut_draw"))
        & F.coalesce(F.col("key") < F.col("cut_key"), F.col("key").isNull())
    )
    part = F.floor(F.col("cut_rest") * F.col("size") / F.col("cut_size")).cast("long")
    last = F.when(same_place, part).when(before, F.col("size")).otherwise(0)
    return rows.join(plan, F.col("source").eqNullSafe(F.col("budget_source"))).withColumn(
        "taken", (F.col("epochs") * F.col("size") + F.coalesce(last, F.lit(0))).cast("long")
    )


def _slim(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    return docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), words_of(text).alias("size")
    ).withColumn("draw", _draw(seed))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    *,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 17,
) -> DataFrame:
    """(key, size, source_size, target, taken) of every row; `taken` words, repeats counted.

    The taken words of a source differ from its target by its rounding only; where rows
    repeat the key at the cut they share what is left, rounded down each. Size counts the
    runs without ASCII white space; a null or empty text has 0 and gives 0. Null sources
    are one source, the last; null keys share one place in the order. The result depends
    on keys, sources, sizes and the seed alone. Other columns are not read.
    """
    slim = settle(_slim(docs, key, text, source, seed))
    taken = _with_taken(slim, budgets(slim, weights, most))
    return taken.select(F.col("key").alias(key), "size", "source_size", "target", "taken")


def mixed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    *,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 17,
) -> DataFrame:
    """The rows of the mix with the columns of `docs`, each as often as it is taken.

    The document at a source's cut is taken whole once more if at least half of its words are
    within the budget, else not at all; no text is cut. Documents that the mix does not take
    so, and those without a word (null or empty texts), are left out. Rows with a null or repeated key
    count each for themselves; a null source is a source. An empty table stays empty.
    Columns keep their names, whatever they are.
    """
    plan = budgets(settle(_slim(docs, key, text, source, seed)), weights, most)
    whole = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(key).alias("key"),
        F.col(source).alias("source"),
        words_of(text).alias("size"),
    ).withColumn("draw", _draw(seed))
    taken = _with_taken(whole, plan).where("taken > 0")
    copies = F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2))
    repeated = taken.select("row", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("copy"))
    return repeated.select("row.*")
