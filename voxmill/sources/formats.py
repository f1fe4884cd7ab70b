"""Formats for spark.read: `wav`, the heads of RIFF files as rows, and `arrow_ipc`, the rows of Arrow files.

Both plan their partitions from a listing (files, or ranges of a large file's record batches), read only the columns of
the schema that the reader is given, and take filters: those on a file's path and size leave files unopened, those on an
Arrow file's columns leave rows behind before they reach Spark.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from .store import opened

#: The fewest files of a partition, and the most partitions that files alone make.
FILES, PARTITIONS = 64, 10_000
#: Larger Arrow files are split between their record batches.
SPLIT_BYTES = 128 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

_COMPARED = {D.EqualTo: operator.eq, D.GreaterThan: operator.gt, D.GreaterThanOrEqual: operator.ge, D.LessThan: operator.lt, D.LessThanOrEqual: operator.le}
_TEXT = {D.StringStartsWith: str.startswith, D.StringEndsWith: str.endswith, D.StringContains: operator.contains}


def listed(root: str, suffix: str) -> list[tuple[str, str, int]]:
    """(path below the folder, path to open, bytes) of its files at any depth, in order of paths; or of a single file."""
    from pyarrow import fs

    store, path = opened(root)
    info = store.get_file_info(path)
    path = path.rstrip("/")
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=True))
    head = root.rstrip("/")[: len(root.rstrip("/")) - len(path)]
    below = path.rpartition("/")[0] if info.type == fs.FileType.File else path
    return sorted((f.path.removeprefix(f"{below}/"), head + f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(suffix))


def keeps(f: D.Filter, name: str, value) -> bool | None:
    """Whether a filter on column `name` lets a value pass; None where it is none that is known here."""
    if getattr(f, "attribute", None) != (name,):
        return None
    if type(f) in _COMPARED:
        return _COMPARED[type(f)](value, f.value)
    if type(f) in _TEXT and isinstance(value, str):
        return bool(_TEXT[type(f)](value, f.value))
    if isinstance(f, D.In):
        return value in f.value
    return True if isinstance(f, D.IsNotNull) else None


class _Files(D.InputPartition):
    def __init__(self, files: list[tuple]):
        super().__init__(files)


class _Reader(D.DataSourceReader):
    suffix = ""

    def __init__(self, options: dict, schema: T.StructType):
        self.root, self.names, self.kinds, self.filters = options["path"], schema.names, to_arrow_schema(schema), []

    def files(self) -> list[tuple[str, str, int]]:
        """Those that the filters on path and size leave."""
        passed = lambda x: all(keeps(f, "path", x[0]) is not False and keeps(f, "size", x[2]) is not False for f in self.filters)
        return [x for x in listed(self.root, self.suffix) if passed(x)]

    def partitions(self) -> list[D.InputPartition]:
        files = self.files()
        each = max(FILES, -(-len(files) // PARTITIONS))
        return [_Files(files[k : k + each]) for k in range(0, len(files), each)] or [_Files([])]


def _number(b: bytes) -> int:
    return int.from_bytes(b, "little")


def recorded(source, size: int, block: int) -> int:
    """Bytes of the samples of a list of `size` bytes: of its data chunks, and of its silences, which say only how many samples (of `block` bytes) they last."""
    end, n = source.tell() + size, 0
    while source.tell() + 8 <= end and len(chunk := source.read(8)) == 8:
        size = _number(chunk[4:])
        after = source.tell() + size + size % 2
        if chunk[:4] == b"data":
            n += size
        elif chunk[:4] == b"slnt":
            n += _number(source.read(4)) * block
        source.seek(after)
    return n


def riff_head(source) -> tuple[float, int, int, int] | None:
    """(seconds, rate, channels, bits) of a RIFF file from its chunks' heads; the samples aren't read.  They stand in one data chunk or in a
    list (wavl) of data and silences."""
    head = source.read(12)
    if len(head) < 12 or head[:4] != b"RIFF" or head[8:] != b"WAVE":
        return None
    form = None
    while len(chunk := source.read(8)) == 8:
        size = _number(chunk[4:])
        held = None
        if chunk[:4] == b"fmt ":
            form = source.read(16)
            size -= 16
        elif chunk[:4] == b"data":
            held = size
        elif chunk[:4] == b"LIST" and size >= 4:
            size -= 4
            held = recorded(source, size, _number(form[12:14]) if form else 0) if source.read(4) == b"wavl" else None
        if held is not None:
            per_second = _number(form[8:12]) if form else 0
            return (held / per_second, _number(form[4:8]), _number(form[2:4]), _number(form[14:16])) if per_second else None
        source.seek(source.tell() + size + size % 2)
    return None


class WavReader(_Reader):
    suffix = ".wav"

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        for f in filters:
            if keeps(f, "path", "") is not None or keeps(f, "size", 0) is not None:
                self.filters.append(f)
            else:
                yield f

    def read(self, partition):
        heads = {"seconds", "rate", "channels", "bits"} & set(self.names)
        rows = []
        for path, uri, size in partition.value:
            row = {"path": path, "size": size}
            if heads:
                store, at = opened(uri)
                with store.open_input_file(at) as held:
                    row |= dict(zip(("seconds", "rate", "channels", "bits"), riff_head(held) or (None,) * 4, strict=True))
            rows.append(row)
        yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in self.kinds], schema=self.kinds)


class Wav(D.DataSource):
    """path (below the folder), size in bytes, and what the head of a RIFF file says; null where it says nothing."""

    @classmethod
    def name(cls) -> str:
        return "wav"

    def schema(self) -> str:
        return "path string, size long, seconds double, rate int, channels int, bits int"

    def reader(self, schema):
        return WavReader(self.options, schema)


class ArrowReader(_Reader):
    suffix = ".arrow"

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        kinds = {f.name: f.type for f in self.kinds}
        for f in filters:
            kind = kinds.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            # NaN is compared otherwise here than in Spark
            plain = kind is not None and (pa.types.is_integer(kind) or pa.types.is_string(kind) or pa.types.is_boolean(kind))
            if plain and (type(f) in _COMPARED or isinstance(f, (D.In, D.IsNull, D.IsNotNull))):
                self.filters.append(f)
            else:
                yield f

    def files(self):
        return listed(self.root, self.suffix)

    def partitions(self) -> list[D.InputPartition]:
        """Small files together, and ranges of record batches of large ones."""
        files = self.files()
        small = [(uri, 0, None) for _, uri, size in files if size <= SPLIT_BYTES]
        each = max(1, -(-len(small) // PARTITIONS))
        out = [_Files(small[k : k + each]) for k in range(0, len(small), each)]
        for _, uri, size in files:
            if size > SPLIT_BYTES:
                store, at = opened(uri)
                with store.open_input_file(at) as held:
                    n = pa.ipc.open_file(held).num_record_batches
                step = max(1, n * SPLIT_BYTES // size)
                out += [_Files([(uri, k, min(n, k + step))]) for k in range(0, n, step)]
        return out or [_Files([])]

    def rows(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.schema.names
        whole = pa.RecordBatch.from_arrays([batch.column(names.index(f.name)).cast(f.type) if f.name in names else pa.nulls(batch.num_rows, f.type) for f in self.kinds], schema=self.kinds)
        for f in self.filters:
            column = whole.column(self.kinds.get_field_index(f.attribute[0]))
            if isinstance(f, D.IsNull):
                mask = pc.is_null(column)
            elif isinstance(f, D.IsNotNull):
                mask = pc.is_valid(column)
            elif isinstance(f, D.In):
                mask = pc.and_(pc.is_valid(column), pc.is_in(column, pa.array([v for v in f.value if v is not None], column.type)))
            else:
                mask = {D.EqualTo: pc.equal, D.GreaterThan: pc.greater, D.GreaterThanOrEqual: pc.greater_equal, D.LessThan: pc.less, D.LessThanOrEqual: pc.less_equal}[type(f)](column, pa.scalar(f.value, column.type))
            whole = whole.filter(mask)
        return whole

    def read(self, partition):
        for uri, first, last in partition.value:
            store, at = opened(uri)
            with store.open_input_file(at) as held:
                there = pa.ipc.open_file(held).schema.names
                held.seek(0)
                asked = [k for k, name in enumerate(there) if name in self.names]
                reader = pa.ipc.open_file(held, options=pa.ipc.IpcReadOptions(included_fields=asked)) if asked else pa.ipc.open_file(held)
                for k in range(first, reader.num_record_batches if last is None else last):
                    yield self.rows(reader.get_batch(k))


class ArrowFiles(D.DataSource):
    """Rows of a folder's Arrow files, columns by name, missing ones null; without a schema that of the first file."""

    @classmethod
    def name(cls) -> str:
        return "arrow_ipc"

    def schema(self) -> T.StructType:
        files = listed(self.options["path"], ".arrow")
        if not files:
            raise FileNotFoundError(f"no Arrow file in {self.options['path']}")
        store, at = opened(files[0][1])
        with store.open_input_file(at) as held:
            return from_arrow_schema(pa.ipc.open_file(held).schema)

    def reader(self, schema):
        return ArrowReader(self.options, schema)


def register(spark: SparkSession) -> SparkSession:
    """Makes the formats known to a session, filters included."""
    spark.conf.set(PUSHDOWN, "true")
    for source in (Wav, ArrowFiles):
        spark.dataSource.register(source)
    return spark
