"""Single files and folders of the store that Spark reads, by its own file systems; executors open files by pyarrow's."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def place(spark: SparkSession) -> str:
    """A new folder in the shared one that the cluster names; a temporary one only where all runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir isn't set; on {master} it must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="voxmill-")
    return f"{root.rstrip('/')}/files-{uuid.uuid4().hex}"


def writer(spark: SparkSession):
    """A function that writes a table to the shared folder and reads it back."""

    def put(df: DataFrame) -> DataFrame:
        at = place(spark)
        df.write.parquet(at)
        return spark.read.schema(df.schema).parquet(at)

    return put


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at) and fs.getFileStatus(at).isDirectory()


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """The whole file or none: written beside its place and moved there."""
    fs, at = _at(spark, path)
    held = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
    out = fs.create(held, True)
    out.write(bytearray(content))
    out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(options, 1)
    over[0] = options.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(held.toUri() if held.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()).rename(held, at, over)


def read_bytes(spark: SparkSession, path: str) -> bytes | None:
    """A small file's content, None where there is none."""
    if not exists(spark, path) or is_folder(spark, path):
        return None
    row = spark.read.format("binaryFile").load(path).select("content").first()
    return bytes(row[0]) if row and row[0] is not None else b""


def move(spark: SparkSession, path: str, to: str) -> bool:
    fs, at = _at(spark, path)
    return fs.rename(at, _at(spark, to)[1])


def opened(path: str):
    """(file system, path) for pyarrow, on any machine."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri("file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path)
    return fs.LocalFileSystem(), path


def write_files(rows: DataFrame, root: str) -> None:
    """rows (name, content): one file each below root, written where the rows are.  A task that runs again overwrites its own.

    A file costs a task as much as many bytes, so they are dealt out by their names.
    """
    plain = rows.select("name", rows["content"].cast("binary").alias("content")).repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, "name")

    def save(part) -> None:
        made = set()
        for name, content in part:
            fs, path = opened(f"{root}/{name}")
            folder = path.rpartition("/")[0]
            if folder not in made:
                fs.create_dir(folder, recursive=True)
                made.add(folder)
            with fs.open_output_stream(path) as out:
                out.write(bytes(content or b""))

    plain.foreachPartition(save)


def read_files(rows: DataFrame, root: str) -> DataFrame:
    """rows (name, ...) with the `content` of their files below root, read where the rows are; no folder is listed.  A missing file is an error."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            # some at a time, whose bytes are held together
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                found = []
                for name in part.column("name").to_pylist():
                    fs, path = opened(f"{root}/{name}")
                    with fs.open_input_stream(path) as held:
                        found.append(held.read())
                yield part.append_column("content", pa.array(found, pa.binary()))

    dealt = rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, "name")
    return dealt.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("content", T.BinaryType())]))
