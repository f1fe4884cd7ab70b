"""The flagship query: a checkpoint-evaluation report on text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import distance as E
from .scores import turn_pairs


def checkpoint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and character error rates of consecutive turns by role: mean, population deviation, range and bands."""
    r, h = F.col("reference"), F.col("hypothesis")
    scored = turn_pairs(spark, sf_dir).select("role", E.wer(r, h).alias("wer"), E.cer(r, h).alias("cer"))
    long = scored.select("role", F.explode(F.create_map(F.lit("wer"), "wer", F.lit("cer"), "cer")).alias("metric", "value")).where("value is not null")
    v = F.col("value")
    return long.groupBy("role", "metric").agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), F.count_if(v < 0.05).alias("excellent"), F.count_if((v >= 0.05) & (v < 0.1)).alias("good"), F.count_if((v >= 0.1) & (v < 0.2)).alias("acceptable"), F.count_if(v >= 0.2).alias("poor"))
