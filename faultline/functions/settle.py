"""Cutting lineage between the steps of a workflow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, else one in the session's warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def settle(df: DataFrame) -> DataFrame:
    """Write the rows once to reliable storage and go on from there.

    Scoring is expensive and several reports read the scored rows. A checkpoint survives
    the loss of executors, where cached blocks would be scored again. With
    spark.cleaner.referenceTracking.cleanCheckpoints Spark removes its files once no frame
    uses them.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)
