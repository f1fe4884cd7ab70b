"""Exact quantiles and histograms against numpy; formats against the files they read."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from voxmill.operators import quantiles as Q
from voxmill.sources import formats, store, tables


@pytest.fixture()
def put(tmp_path):
    def write(df):
        at = str(tmp_path / f"t{random.random()}")
        df.write.parquet(at)
        return df.sparkSession.read.schema(df.schema).parquet(at)

    return write


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(4)
    return {
        "normal": rng.normal(size=5000).tolist(),
        "few": rng.choice([1.0, 2.0, 2.5], 3000).tolist(),
        "wide": (10.0 ** rng.uniform(-300, 300, 400)).tolist(),
        "signed": [*(-(10.0 ** rng.uniform(-5, 12, 300))), *rng.normal(size=300)],
        "one": [7.0],
        "same": [3.0] * 50,
        None: [1.0, 2.0, 4.0],
        "ends": [-1.7e308, 1.7e308, 0.0, 5.0],
    }


def test_quantiles_are_exact(spark, put, values):
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("normal", None), ("one", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75, "all": 1.0, "p001": 0.001}
    got = {r.g: r for r in Q.quantiles(df, ["g"], "v", shares, put).collect()}
    assert set(got) == set(values)
    for k, vs in values.items():
        sorted_ = np.sort(vs)
        for name, share in shares.items():
            at = (len(vs) - 1) * share
            low, high = sorted_[int(np.floor(at))], sorted_[int(np.ceil(at))]
            assert got[k][name] == low + (high - low) * (at - np.floor(at)), (k, name)
        assert (got[k].n, got[k].least, got[k].most) == (len(vs), sorted_[0], sorted_[-1])


def test_histograms_are_those_of_numpy(spark, values):
    rows = [(k, float(v)) for k, vs in values.items() for v in vs if k not in ("ends", "wide")]
    got = {}
    for r in Q.histogram(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").orderBy("bin").collect():
        got.setdefault(r.g, []).append((r.low, r.high, r.n))
    for k in set(values) - {"ends", "wide"}:
        n = min(20, max(5, len(values[k]) // 2))
        counts, edges = np.histogram(values[k], n)
        assert len(got[k]) == n and sum(x[2] for x in got[k]) == len(values[k])
        assert np.allclose([x[0] for x in got[k]], edges[:-1]) and np.abs(np.array([x[2] for x in got[k]]) - counts).sum() <= 2


def test_empty_groups(spark, put):
    none = spark.createDataFrame([], "g string, v double")
    assert Q.quantiles(none, ["g"], "v", {"m": 0.5}, put).count() == 0 and Q.histogram(none, ["g"], "v").count() == 0


def wav(seconds, rate=8000, extra=b""):
    data = b"\0\0" * int(seconds * rate)
    head = b"RIFF" + (36 + len(extra) + len(data)).to_bytes(4, "little") + b"WAVEfmt " + (16).to_bytes(4, "little") + (1).to_bytes(2, "little") * 2 + rate.to_bytes(4, "little") + (2 * rate).to_bytes(4, "little") + b"\2\0\20\0"
    return head + extra + b"data" + len(data).to_bytes(4, "little") + data


def test_wav_heads(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "a/one.wav").write_bytes(wav(1.5))
    (tmp_path / "a/b/two.wav").write_bytes(wav(0.25, 16000, b"LIST" + (3).to_bytes(4, "little") + b"abc\0"))
    (tmp_path / "a/broken.wav").write_bytes(b"RIFF")
    (tmp_path / "a/other.txt").write_bytes(b"x")
    read = formats.register(spark).read.format("wav").load(str(tmp_path / "a"))
    assert {tuple(r) for r in read.collect()} == {("one.wav", 24044, 1.5, 8000, 1, 16), ("b/two.wav", 8056, 0.25, 16000, 1, 16), ("broken.wav", 4, None, None, None, None)}
    assert [r.path for r in read.where("size > 10000 and path like '%.wav'").select("path").collect()] == ["one.wav"]
    assert tables.wav_durations(spark, str(tmp_path / "a")).columns == ["path", "seconds"]


def test_filters_leave_files_unopened(tmp_path):
    (tmp_path / "gone.wav").write_bytes(wav(1))
    (tmp_path / "kept.wav").write_bytes(wav(2))
    from pyspark.sql import types as T

    reader = formats.WavReader({"path": str(tmp_path)}, T.StructType().add("path", "string").add("seconds", "double"))
    left = list(reader.pushFilters([D.EqualTo(("path",), "kept.wav"), D.GreaterThan(("seconds",), 0.0)]))
    assert [type(f) for f in left] == [D.GreaterThan]
    planned = [x for p in reader.partitions() for x in p.value]
    assert [x[0] for x in planned] == ["kept.wav"]
    (tmp_path / "kept.wav").unlink()
    only = formats.WavReader({"path": str(tmp_path)}, T.StructType().add("path", "string").add("size", "long"))
    assert [b.to_pydict() for p in only.partitions() for b in only.read(p)] == [{"path": ["gone.wav"], "size": [16044]}]


def test_arrow_files(spark, tmp_path, monkeypatch):
    (tmp_path / "x").mkdir()
    first = pa.table({"k": [1, 2, None, 4], "name": ["a", "b", "c", None], "v": [1.0, float("nan"), 3.0, 4.0]})
    for name, part in (("x/1.arrow", first), ("2.arrow", pa.table({"k": [5], "other": [1]}))):
        with pa.OSFile(str(tmp_path / name), "wb") as out, pa.ipc.new_file(out, part.schema) as writer:
            writer.write_table(part, max_chunksize=1)
    read = formats.register(spark).read.format("arrow_ipc").schema("k long, name string, v double").load(str(tmp_path))
    assert sorted([r.k, r.name] for r in read.where("k >= 2").collect()) == [[2, "b"], [4, None], [5, None]]
    assert read.where("k is null").select("name").collect()[0].name == "c" and read.where("name in ('a', 'b')").count() == 2
    assert read.where("v > 3").count() == 2 and read.count() == 5
    assert read.where(F.col("name").isNull()).count() == 2
    inferred = spark.read.format("arrow_ipc").load(str(tmp_path / "x"))
    assert inferred.columns == ["k", "name", "v"] and inferred.count() == 4
    monkeypatch.setattr(formats, "SPLIT_BYTES", 400)
    from pyspark.sql import types as T

    reader = formats.ArrowReader({"path": str(tmp_path)}, T.StructType().add("k", "long"))
    planned = reader.partitions()
    assert len(planned) > 2 and sorted(v for p in planned for b in reader.read(p) for v in b.column(0).to_pylist() if v is not None) == [1, 2, 4, 5]


def test_empty_folder(spark, tmp_path):
    assert formats.register(spark).read.format("wav").load(str(tmp_path)).count() == 0
    assert spark.read.format("arrow_ipc").schema("k long").load(str(tmp_path)).count() == 0
    assert store.exists(spark, str(tmp_path))
