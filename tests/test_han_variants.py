"""Segmentation against all segmentations, readings, and walks through JSON of unknown layout."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from voxmill.functions.han import Trie, dictionary, symbols_column
from voxmill.operators import variants as V
from voxmill.plans.texts import WORDS

SMALL = [(w, float(n), r.split()) for w, n, r in WORDS]


def all_segmentations(text):
    for cuts in itertools.product([False, True], repeat=max(0, len(text) - 1)):
        out, at = [], 0
        for k, cut in enumerate(cuts, 1):
            if cut:
                out.append(text[at:k])
                at = k
        yield [*out, text[at:]]


def test_the_most_probable_segmentation():
    trie, by = Trie(SMALL), {w: n for w, n, _ in SMALL}
    total = sum(by.values())
    pick = random.Random(8)

    def chance(parts):
        if any(p not in by and len(p) > 1 for p in parts):
            return -math.inf
        return sum(math.log(by[p]) - math.log(total + 1) if p in by else trie.unknown for p in parts)

    for _ in range(300):
        text = "".join(pick.choice("中国人大学生活长成银行音乐快") for _ in range(pick.randint(1, 9)))
        got = [w for w, _ in trie.words(text)]
        assert "".join(got) == text and chance(got) == pytest.approx(max(map(chance, all_segmentations(text))))


def test_readings_depend_on_words():
    trie = Trie(SMALL)
    join = lambda x: "".join(trie.symbols(x))
    assert join("我长大,银行人") == " 我 zhang3 da4, yin2 hang2 ren2"
    assert join("中国ab c:de“x”") == ' zhong1 guo2 ab c:de"x"'
    assert join("") == "" and join("ab1") == "ab1" and join("é中") == "é zhong1"
    assert len(trie.symbols("中国" * 100_000)) == 400_000


def test_dictionaries(spark, monkeypatch):
    rows = [("中国", 3, ["a", "b"]), ("中国", 5, ["a", "c"]), ("人", None, ["ren2"]), ("bad", 1, ["x"]), ("", 1, [])]
    df = spark.createDataFrame(rows, "word string, n long, readings array<string>")
    assert dictionary(df) == [("中国", 5.0, ["a", "b"]), ("人", 0.0, ["ren2"])]
    texts = spark.createDataFrame([("中国人",), (None,), ("",)], "text string")
    assert [r.x for r in texts.select(symbols_column(df)("text").alias("x")).collect()] == [[" ", "a", " ", "b", " ", "ren2"], None, []]
    monkeypatch.setattr("voxmill.functions.han.MOST_WORDS", 1)
    with pytest.raises(ValueError):
        dictionary(df)


def test_walks_find_named_nodes_at_any_depth(spark, tmp_path):
    def put(df):
        at = str(tmp_path / f"t{random.random()}")
        df.write.parquet(at)
        return spark.read.schema(df.schema).parquet(at)

    docs = [(1, '{"a":[{"x":{"v":1}},{"b":{"c":[{"x":{"v":2}},{"x":{"x":{"v":9}}}]}}]}'), (2, "{broken"), (3, None), (4, "[]"), (5, '{"x":7}')]
    rows = spark.createDataFrame(docs, "id long, json string")
    got = V.found(V.rooted(rows, "id", F.col("json")), "id", ("x",), put).select("id", "path", "item", F.to_json("node").alias("node")).collect()
    assert sorted((r.id, r.path, r.item, r.node) for r in got) == [(1, [0, 0, 0], [0, 0], '{"v":1}'), (1, [0, 1, 0, 0, 0, 0], [0, 1, 0, 0, 0], '{"v":2}'), (1, [0, 1, 0, 0, 1, 0], [0, 1, 0, 0, 1], '{"x":{"v":9}}'), (5, [0], [], "7")]
    with pytest.raises(RuntimeError):
        V.found(V.rooted(rows, "id", F.col("json")), "id", ("none",), put, rounds=2)
    first = V.first_found(V.found(V.rooted(rows, "id", F.col("json")), "id", ("x", "b"), put), "id", ("b", "x")).collect()
    assert sorted((r.id, r.name) for r in first) == [(1, "b"), (5, "x")]
