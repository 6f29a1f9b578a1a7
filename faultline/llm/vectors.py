"""Embeddings as checked numeric rows, with equal vectors kept once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.settle import settle


def finite(vector: str) -> Column:
    """True for a vector without null, NaN or infinite components."""

    def good(x: Column) -> Column:
        value = x.cast("double")
        return x.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))

    column = F.col(vector)
    return F.coalesce(column.isNotNull() & (F.size(column) > 0) & F.forall(column, good), F.lit(False))


def most_common_length(rows: DataFrame, vector: str = "vector") -> int:
    """The length most vectors have (the smaller of equally common ones); 0 without a row."""
    found = (
        rows.groupBy(F.size(vector).alias("n"))
        .agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), "n")
        .first()
    )
    return found["n"] if found else 0


def distinct_vectors(rows: DataFrame, keep: int) -> tuple[DataFrame, DataFrame]:
    """Equal vectors kept once: (rep, vector, asked) and (rep, ids).

    `rows` has id, vector and asked (true for queries). rep is the smallest id; ids are the
    `keep` smallest ids of the vector, enough for any list of keep - 1 neighbours without
    the query itself, as ties go to smaller ids. Ids beyond these are dropped before the
    shuffle, so a vector that a third of all rows share is no burden.
    """
    ranked = Window.partitionBy("vector").orderBy("id")
    ids = (
        rows.select("id", "vector")
        .distinct()
        .withColumn("place", F.row_number().over(ranked))
        .where(F.col("place") <= keep)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    asked = rows.groupBy("vector").agg(F.max("asked").alias("asked"))
    joined = settle(
        ids.join(asked, "vector").select(F.col("ids")[0].alias("rep"), "vector", "asked", "ids")
    )
    return joined.select("rep", "vector", "asked"), joined.select("rep", "ids")


def answers(
    rows: DataFrame, nearest: DataFrame, members: DataFrame, k: int, ascending: bool
) -> DataFrame:
    """(query_id, rank, vec_id, score) from (q, rep, score), the best k + 1 vectors of each query.

    `rows` has the queries as id and vector; equal query vectors share one search.
    """
    sign = 1 if ascending else -1
    by_vector = (
        nearest.join(members, "rep")
        .groupBy("q")
        .agg(
            F.sort_array(
                F.flatten(
                    F.collect_list(
                        F.transform(
                            "ids",
                            lambda i: F.struct(
                                (F.col("score") * sign).alias("order"),
                                i.alias("vec_id"),
                                F.col("score").alias("score"),
                            ),
                        )
                    )
                )
            ).alias("found")
        )
    )
    others = F.filter("found", lambda f: f["vec_id"] != F.col("id"))
    return (
        rows.join(by_vector, "q")
        .select(F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("p", "f"))
        .select("query_id", (F.col("p") + 1).alias("rank"), "f.vec_id", "f.score")
    )


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """An Arrow list column as a table of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
