"""op12: what a worker holds beside its batch, and the sums that come out of pieces of it."""

import collections
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from voxmill.llm import brown


class Captured(Exception):
    pass


class Frame:
    """Takes every call of a DataFrame; mapInArrow gives away what a worker would run."""

    def __getattr__(self, name):
        return lambda *a, **b: self

    def mapInArrow(self, fn, schema):
        raise Captured(fn)


def task_of(make, *args):
    with pytest.raises(Captured) as found:
        make(Frame(), *args)
    return found.value.args[0]


def peak(fn, batches, use):
    """MB that numpy and Python hold at most while a task runs."""
    tracemalloc.start()
    for b in fn(iter(batches)):
        use(b)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most / 1e6


def test_a_unit_of_many_tasks_is_added_up_as_it_comes():
    tasks, others = 60, np.repeat(np.arange(brown.U + 1, dtype=np.int32), 60)
    units = np.repeat(np.array([3, 5], np.int32), len(others))
    names, others = ["unit", "other", "n"], np.tile(others, 2)
    batches = [pa.RecordBatch.from_arrays([pa.array(units[at : at + 10_000]), pa.array(others[at : at + 10_000]), pa.array(np.full(len(units[at : at + 10_000]), 2, np.int64))], names=names) for at in range(0, len(units), 10_000)]
    got = []
    most = peak(task_of(brown.lists), batches, lambda b: got.extend(b.to_pylist()))
    assert [r["unit"] for r in got] == [3, 5]
    for r in got:
        assert (np.frombuffer(r["others"], "<i4") == np.arange(brown.U + 1)).all() and (np.frombuffer(r["times"], "<i8") == 2 * tasks).all()
    # one unit's rows alone are 18 MB
    assert most < 10


def dense_rows(n):
    """n units with all others behind and before them, in one batch."""
    others = np.arange(brown.U + 1, dtype="<i4").tobytes()
    times = [np.full(brown.U + 1, 1 + k % 5, "<i8").tobytes() for k in range(n)]
    return pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array([others] * n), pa.array(times), pa.array([others] * n), pa.array(times)], names=["unit", "others", "times", "before", "before_times"])


def test_class_tables_and_moves_take_a_batch_piece_by_piece():
    n = 100
    classes = np.arange(brown.U + 1) % brown.CLASSES
    classes[brown.U] = brown.CLASSES
    want = np.zeros((brown.CLASSES + 1,) * 2)
    for u in range(n):
        np.add.at(want[classes[u]], classes, 1 + u % 5)
    got, batch = [], dense_rows(n)
    most = peak(task_of(brown.class_tables, [classes]), [batch], got.append)
    assert (got[0]["v"].to_numpy().reshape(want.shape) == want).all()
    # the batch itself is 44 MB
    assert most < 25

    moves = []
    most = peak(task_of(brown.best_moves, classes, want, 0), [batch], lambda b: moves.extend(b["unit"].to_pylist()))
    assert len(moves) == len(set(moves)) and set(moves) <= set(range(n)) and most < 80


def test_transitions_take_texts_piece_by_piece():
    texts = [bytes([i % 7] * 700 + [brown.CLASSES]) for i in range(10_000)]
    batch = pa.RecordBatch.from_arrays([pa.array([i % 3 == 0 for i in range(10_000)]), pa.array(texts, pa.binary())], names=["held_out", "classes"])
    got = collections.Counter()
    most = peak(task_of(brown.transitions), [batch], lambda b: got.update(dict(zip(b["e"].to_pylist(), b["v"].to_pylist(), strict=True))))
    c, want = brown.CLASSES + 1, collections.Counter()
    for i, text in enumerate(texts):
        if i % 3:
            k, e = i % 7, brown.CLASSES
            want.update({(e * c + e) * c + k: 1, (e * c + k) * c + k: 1, (k * c + k) * c + k: 698, (k * c + k) * c + e: 1})
    # 5 M classes are 37 MB as numbers, once
    assert got == want and most < 40


@pytest.mark.parametrize("held", [1, 40, 2_000_000])
def test_pairs_are_the_same_however_many_are_held(monkeypatch, held):
    rng = np.random.default_rng(held)
    words = [b"", *[f"w{k}".encode() for k in range(30)]]
    core = type("Core", (), {"value": {w: k for k, w in enumerate(words[1:13])}})
    rows, want = [], collections.Counter()
    for at in range(6):
        docs, sizes = list(range(20 * at, 20 * at + 20)), rng.integers(1, 40, 20)
        texts = [[*rng.integers(1, len(words), k - 1).tolist(), 0] for k in sizes]
        rows.append({"docs": docs, "tokens": sizes.tolist(), "ids": brown.packed(np.concatenate(texts).astype(np.uint32)), "words": words})
        units = [[brown.U if w == 0 else core.value.get(words[w], brown.ending(words[w])) for w in t] for t in texts]
        want.update(p for d, u in zip(docs, units, strict=True) if not brown.held_out(d) for p in zip([brown.U, *u], u, strict=False))
    types = pa.schema([("docs", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int32())), ("ids", pa.binary()), ("words", pa.list_(pa.binary()))])
    batches = [pa.RecordBatch.from_pylist(rows[at : at + 2], types) for at in (0, 2, 4)]
    monkeypatch.setattr(brown, "HELD_PAIRS", held)
    got = collections.Counter()
    for b in task_of(brown.pairs, core)(iter(batches)):
        keys = list(zip(b["unit"].to_pylist(), b["other"].to_pylist(), strict=True))
        assert keys == sorted(set(keys))
        got.update(dict(zip(keys, b["n"].to_pylist(), strict=True)))
    assert got == want
