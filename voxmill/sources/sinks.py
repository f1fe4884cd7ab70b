"""Reports, histories and data sets on their way out.  Folders are written by Spark's commit protocol; only single small
documents are written by the driver."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import safe_name
from . import store


def csv_report(rows: DataFrame, path: str) -> None:
    """With a header; null becomes an empty field."""
    rows.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


#: The metrics of a report, in order.
METRICS = ("mcd", "pesq", "stoi", "utmos", "f0_correlation", "wer", "cer")


def metric_report(rows: DataFrame, path: str) -> None:
    """sample_id, text and all metrics, in their order, as CSV; a metric that the rows haven't, or a null one, is an empty field."""
    cells = [F.col(m).cast("double").alias(m) if m in rows.columns else F.lit(None).cast("double").alias(m) for m in METRICS]
    plain = rows.select("sample_id", "text", *cells)
    plain.write.mode("overwrite").options(header=True, nullValue="", emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A report that metric_report wrote; texts may hold line breaks."""
    schema = T.StructType([T.StructField("sample_id", T.StringType()), T.StructField("text", T.StringType()), *[T.StructField(m, T.DoubleType()) for m in METRICS]])
    return spark.read.schema(schema).options(header=True, multiLine=True, escape='"').csv(path)


def json_results(rows: DataFrame, summary: DataFrame, path: str) -> None:
    """JSON lines, and the summary beside them."""
    rows.write.mode("overwrite").json(f"{path}/rows")
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def metric_lines(rows: DataFrame, path: str, name: str, value: float) -> None:
    """JSON lines, and behind them, in the file that is read last, a line `NAME: value`."""
    rows.write.mode("overwrite").json(path)
    store.write_bytes(rows.sparkSession, f"{path}/zz-metric.json", f"{name.upper()}: {value}\n".encode())


def named_results(rows: DataFrame, path: str) -> None:
    """A folder for each model and metric."""
    rows.write.mode("overwrite").partitionBy("model", "metric").json(path)


def per_folder(rows: DataFrame, path: str, *keys: str) -> None:
    """A folder for each key; rows of a key are spread over as many tasks as hold them."""
    rows.write.mode("overwrite").partitionBy(*keys).parquet(path)


def prepared(rows: DataFrame, path: str, text: str = "text", duration: str = "duration") -> None:
    """The rows, their durations, and the characters they use in order of code points."""
    rows.write.mode("overwrite").parquet(f"{path}/raw")
    rows.select(duration).write.mode("overwrite").json(f"{path}/duration")
    rows.select(F.explode(F.split(text, "")).alias("value")).where(~F.col("value").isin("", "\n", "\r")).distinct().orderBy("value").coalesce(1).write.mode("overwrite").text(f"{path}/vocab")


def history(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What was appended so far; a missing or unreadable history is an empty one, old rows lack newer columns."""
    fields = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField("_broken", T.StringType())])
    try:
        rows = spark.read.schema(fields).option("columnNameOfCorruptRecord", "_broken").json(path)
    except Exception as e:  # a path that isn't there
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], T.StructType.fromDDL(schema))
    return rows.where(F.col("_broken").isNull()).drop("_broken")


def appended(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def document(spark: SparkSession, path: str, value: object) -> None:
    """One small JSON document, whole or not at all."""
    store.write_bytes(spark, path, json.dumps(value, ensure_ascii=False, indent=2).encode())


def read_document(spark: SparkSession, path: str, default: object) -> object:
    """The document; the default where it is missing or broken, or of another kind than the default."""
    held = store.read_bytes(spark, path)
    try:
        value = default if held is None else json.loads(held.decode())
    except ValueError:
        return default
    return value if isinstance(value, type(default)) else default


def quarantined(spark: SparkSession, path: str) -> str | None:
    """A broken file moved aside to the first free .backup name, which is returned."""
    if not store.exists(spark, path):
        return None
    free = next(n for k in range(1 << 30) if not store.exists(spark, n := path + ".backup" + (f".{k}" if k else "")))
    store.move(spark, path, free)
    return free


def result_name(model: str, metric: str) -> str:
    """<model>_<metric>.json, the model's name made safe."""
    safe = re.sub("_+", "_", re.sub(r"[^\w\-.]", "_", model)).strip("_") or "unknown_model"
    return f"{safe}_{metric}.json"


def result_name_of(model: Column, metric: str) -> Column:
    """result_name of a column of models."""
    return F.concat(safe_name(model), F.lit(f"_{metric}.json"))


def existing_results(spark: SparkSession, folder: str, models: DataFrame, metric: str) -> DataFrame:
    """models(model) -> (model, result JSON): what was saved for each, null where there is nothing.

    The folder is read once; broken files, which count as none, are moved aside where they are found, each to the first free
    .backup name.
    """
    held = spark.read.option("pathGlobFilter", f"*_{metric}.json").text(folder, wholetext=True)
    parsed = F.try_parse_json("value")
    good = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT<") & (F.to_json(parsed) != "{}"), F.lit(False))
    uri = F.col("_metadata.file_path")
    read = store.writer(spark)(held.select(uri.alias("uri"), F.substring_index(uri, "/", -1).alias("file"), "value", good.alias("good")))
    read.where("not good").select("uri").foreachPartition(_set_aside)
    found = read.where("good").select(F.url_decode("file").alias("file"), F.col("value").alias("result"))
    return models.withColumn("file", result_name_of(F.col("model"), metric)).join(found, "file", "left").drop("file")


def _set_aside(rows) -> None:
    for row in rows:
        fs, path = store.opened(row.uri)
        there = lambda name: fs.get_file_info(name).type.name != "NotFound"
        if there(path):
            fs.move(path, next(n for k in range(1 << 30) if not there(n := f"{path}.backup" + (f".{k}" if k else ""))))


def split_broken(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """JSON lines as (good rows, texts of the broken lines)."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    fields = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField("_broken", T.StringType())])
    parsed = lines.select("value", F.from_json("value", fields, {"columnNameOfCorruptRecord": "_broken"}).alias("r"))
    return parsed.where("r._broken is null").select("r.*").drop("_broken"), parsed.where("r._broken is not null").select("value")
