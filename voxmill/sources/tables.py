"""Table and manifest readers."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .formats import register
from .store import exists, is_folder, opened


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, folder: str, glob: str = "*", deep: bool = True) -> DataFrame:
    """path (below the folder) and size of its files; their content isn't read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(deep).lower())
    whole = found.load(folder if deep else f"{folder.rstrip('/')}/*").select("path", F.col("length").alias("size"))
    tail = folder.rstrip("/").rpartition("/")[2]
    return whole.select(F.substring_index("path", f"/{tail}/", -1).alias("path"), "size", F.col("path").alias("uri"))


def stem(path: Column) -> Column:
    """The path without its last suffix."""
    return F.regexp_replace(path, r"\.[^./]*$", "")


def shards(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of Arrow files, each read where it is; columns by name, missing ones null."""
    return register(spark).read.format("arrow_ipc").schema(schema).load(folder)


def write_shards(rows: DataFrame, folder: str) -> None:
    """One Arrow file for each partition."""
    kinds = to_arrow_schema(rows.schema)

    def run(batches):
        from pyspark import TaskContext

        fs, path = opened(f"{folder}/part-{TaskContext.get().partitionId():05d}.arrow")
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        n = 0
        with fs.open_output_stream(path) as out, pa.ipc.new_file(out, kinds) as writer:
            for batch in batches:
                writer.write_batch(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, kinds, strict=True)], schema=kinds))
                n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    rows.mapInArrow(run, "n long").agg(F.sum("n")).collect()


def columnar(spark: SparkSession, folder: str, schema: str | None = None, both: bool = False) -> DataFrame:
    """Shards of a folder (at any depth): its Parquet files, and the Arrow ones only where there are none, or with `both`."""
    parquet = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    if files(spark, folder, "*.parquet").limit(1).count() == 0:
        return shards(spark, folder, schema)
    rows = parquet.parquet(folder)
    return rows.unionByName(shards(spark, folder, schema or rows.schema.toDDL()), allowMissingColumns=True) if both else rows


def matched_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of one kind, told by the first one's suffix."""
    suffix = paths[0].rpartition(".")[2] if paths else ""
    readers = {"parquet": spark.read.parquet, "json": spark.read.json, "jsonl": spark.read.json, "csv": spark.read.option("header", True).csv, "txt": spark.read.text}
    if suffix not in readers:
        raise ValueError(f"no reader for {suffix!r}")
    return readers[suffix](paths) if suffix not in ("parquet",) else readers[suffix](*paths)


def split_lines(spark: SparkSession, path: str, mark: str = "|") -> DataFrame:
    """f: the fields of each line that isn't blank."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.split(F.trim("value"), "\\" + mark if mark == "|" else mark, -1).alias("f"))


def manifest(spark: SparkSession, path: str, listed: DataFrame | None = None) -> DataFrame:
    """Headerless `path|text[|...]` lines; short lines and empty fields are left out, and with `listed` (path) files that
    aren't there; sample_id is the file's stem."""
    parts = split_lines(spark, path).where(F.size("f") >= 2)
    rows = parts.select(F.trim(F.col("f")[0]).alias("audio_path"), F.trim(F.col("f")[1]).alias("text")).where("audio_path <> '' and text <> ''")
    if listed is not None:
        rows = rows.join(listed.select(F.col("path").alias("audio_path")).distinct(), "audio_path", "left_semi")
    return rows.select(F.regexp_replace(F.element_at(F.split("audio_path", "/"), -1), r"\.[^.]*$", "").alias("sample_id"), "audio_path", "text")


def strict_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Lines of exactly two fields."""
    return split_lines(spark, path).where(F.size("f") == 2).select(F.col("f")[0].alias("audio_path"), F.col("f")[1].alias("text"))


def three_fields(spark: SparkSession, path: str) -> DataFrame:
    """`id|text|normalised text`; the last counts."""
    return split_lines(spark, path).where(F.size("f") == 3).select(F.concat(F.lit("wavs/"), F.col("f")[0], F.lit(".wav")).alias("audio_path"), F.col("f")[2].alias("text"))


def spoken_chapters(spark: SparkSession, path: str, root: str) -> DataFrame:
    """Six fields between tabs: reference id, duration, text, and the same of what is to be said; ids are speaker-chapter-number."""
    f = split_lines(spark, path, "\t").where(F.size("f") == 6)

    def audio(utterance: Column) -> Column:
        parts = F.split(utterance, "-")
        return F.concat_ws("/", F.lit(root), parts[0], parts[1], F.concat(utterance, F.lit(".flac")))

    return f.select(F.col("f")[3].alias("utt"), F.col("f")[2].alias("ref_text"), audio(F.col("f")[0]).alias("ref_wav"), F.concat(F.lit(" "), F.col("f")[5]).alias("gen_text"), audio(F.col("f")[3]).alias("gen_wav"))


def first_lines(spark: SparkSession, folder: str) -> DataFrame:
    """`name<tab>text` of the first line of each file."""
    line = F.split(F.substring_index("value", "\n", 1), "\t")
    return spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True).select(F.concat(line[0], F.lit(".wav")).alias("audio"), F.trim(F.get(line, F.lit(1))).alias("text"))


def sidecars(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Audio files with the texts beside them, at any depth: (stem, text), and the stems that have none."""
    audio = files(spark, folder, "*.wav").select(stem(F.col("path")).alias("stem"))
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    tail = folder.rstrip("/").rpartition("/")[2]
    texts = read.select(stem(F.substring_index(F.col("_metadata.file_path"), f"/{tail}/", -1)).alias("stem"), F.col("value").alias("text"))
    return audio.join(texts, "stem"), audio.join(texts, "stem", "left_anti")


def flat_or_deep(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs with a text that isn't empty, of the folder itself, or of all below it where it has none."""
    pairs = sidecars(spark, folder)[0].where(F.trim("text") != "")
    flat = pairs.where(~F.contains("stem", F.lit("/")))
    found = flat if flat.limit(1).count() else pairs
    if not found.limit(1).count():
        raise FileNotFoundError(f"no audio with a text in {folder}")
    return found


def url_lists(spark: SparkSession, folder: str) -> DataFrame:
    """JSON arrays, one a file: (list, url, pos) of their texts, trimmed, empty ones left out, each at the first place where it stands."""
    name = stem(F.substring_index(F.col("_metadata.file_path"), "/", -1))
    held = spark.read.text(folder, wholetext=True).select(name.alias("list"), "value")
    each = held.select("list", F.posexplode(F.from_json("value", "array<string>")).alias("pos", "url")).select("list", "pos", F.trim("url").alias("url"))
    return each.where("url <> ''").groupBy("list", "url").agg(F.min("pos").alias("pos"))


def sheet(spark: SparkSession, path: str) -> DataFrame:
    """The `url` column of a table with a header, which must be there; null and blank ones are left out."""
    rows = spark.read.option("header", True).csv(path)
    if "url" not in rows.columns:
        raise ValueError(f"no column url in {path}")
    return rows.select(F.trim("url").alias("url")).where("url <> ''")


def is_corpus(spark: SparkSession, folder: str) -> bool:
    """Whether the folder has a manifest and a folder of audio."""
    return exists(spark, f"{folder}/metadata.csv") and is_folder(spark, f"{folder}/wavs")


def headed_manifest(spark: SparkSession, path: str) -> DataFrame:
    """`audio|text` with a header, fields quoted where they need it; a byte-order mark before it is dropped."""
    rows = spark.read.option("sep", "|").option("header", True).option("escape", '"').csv(path)
    return rows.toDF(*[c.lstrip("﻿") for c in rows.columns])


def listed_utterances(spark: SparkSession, path: str) -> DataFrame:
    """Four or five fields; the fifth defaults to wavs/<utterance>.wav."""
    f = spark.read.text(path).select(F.split("value", r"\|").alias("f")).where(F.size("f").isin(4, 5))
    utt = F.col("f")[0]
    default = F.concat(F.lit("wavs/"), F.regexp_replace(utt, r"\.wav$", ""), F.lit(".wav"))
    return f.select(utt.alias("utt"), F.col("f")[1].alias("prompt_text"), F.col("f")[2].alias("prompt_wav"), F.col("f")[3].alias("gen_text"), F.coalesce(F.get("f", F.lit(4)), default).alias("gt_wav"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Broken lines are left out."""
    fields = T.StructType([*(T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields, T.StructField("_broken", T.StringType())])
    # parsed from the line, not by the reader: a scan that prunes columns doesn't tell broken lines
    parsed = spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", fields, {"columnNameOfCorruptRecord": "_broken"}).alias("r"))
    return parsed.where("r._broken is null").select("r.*").drop("_broken")


def wav_durations(spark: SparkSession, folder: str) -> DataFrame:
    """path and seconds of audio files, by the heads of their chunks; null where they tell nothing."""
    return register(spark).read.format("wav").schema("path string, seconds double").load(folder)


def probed_durations(spark: SparkSession, folder: str, decode: Callable[[bytes], float | None]) -> DataFrame:
    """wav_durations, and `decode` of the content where the heads tell nothing; what has no positive duration is left out."""
    known = wav_durations(spark, folder)
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", "true").load(folder)
    tail = folder.rstrip("/").rpartition("/")[2]
    rest = content.select(F.substring_index("path", f"/{tail}/", -1).alias("path"), "content").join(known.where("seconds is null").select("path"), "path", "left_semi")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([decode(c) for c in batch.column(1).to_pylist()], pa.float64())], names=["path", "seconds"])

    return known.where("seconds is not null").unionByName(rest.mapInArrow(run, "path string, seconds double")).where("seconds > 0")
