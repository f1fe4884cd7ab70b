"""Shared plumbing of the training-data operators: table reads, durable intermediate tables, bounded Arrow slices."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a temporary one only where none is set and all runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir isn't set; on {master} it must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="voxmill-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/voxmill-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_written"] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the folders of durable tables that nothing will read any more; other frames are left alone."""
    for df in tables:
        path = df.__dict__.pop("_written", None)
        if path:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def halves(sha: Column) -> list[Column]:
    """Two numbers, t1 and t2, that name a text: 60 bits each of its hex digest."""
    return [F.conv(F.substring(sha, k, 15), 16, 10).cast("long").alias(f"t{i}") for i, k in ((1, 1), (2, 16))]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a record batch so that no slice holds more than about `limit` bytes of one text column (a longer row stands alone)."""
    col = batch.column(batch.schema.get_field_index(column))
    n = batch.num_rows
    if n == 0:
        return
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i in range(n):
        if held and held + sizes[i] > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(sizes[i])
    yield batch.slice(start, n - start)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: str = "text", limit: int = 2 << 20) -> DataFrame:
    """mapInArrow with one call of fn for each bounded slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, limit):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def whole_text(column: str = "text"):
    """Null text counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
