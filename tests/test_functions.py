import random

from pyspark.sql import functions as F

from voxmill.functions import distance, numbers, text


def test_number_words(spark):
    said = {0: "không", -7: "âm bảy", 11: "mười một", 14: "mười bốn", 15: "mười lăm", 21: "hai mươi mốt", 24: "hai mươi tư", 25: "hai mươi lăm", 105: "một trăm lẻ năm", 1005: "một nghìn, không trăm lẻ năm", 1_000_000_000: "một tỷ"}
    rows = spark.createDataFrame([(n,) for n in said], "n long").select("n", numbers.spoken(F.col("n")).alias("s")).collect()
    assert {r.n: r.s for r in rows} == said


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_word_distance(spark):
    rng = random.Random(3)
    pairs = [(" ".join(rng.choices("a bb c d é".split(), k=rng.randint(0, 9))), " ".join(rng.choices("a bb c x".split(), k=rng.randint(0, 9)))) for _ in range(60)]
    rows = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, r string, h string").select("k", distance.word_distance(F.col("r"), F.col("h")).alias("d")).collect()
    for r in rows:
        assert r.d == _distance(pairs[r.k][0].split(), pairs[r.k][1].split())


def test_empty_policies(spark):
    df = spark.createDataFrame([(0, "", ""), (1, "", "x"), (2, "x", "")], "k int, r string, h string")
    for policy, (words, _) in distance.POLICIES.items():
        got = [r.w for r in df.select("k", distance.wer(F.col("r"), F.col("h"), policy).alias("w")).orderBy("k").collect()]
        assert tuple(got) == words


def test_repeats_and_sentences(spark):
    eight = "a b c d e f g h"
    df = spark.createDataFrame([(0, f"{eight} {eight}"), (1, "a b c d e f g a b c d e f g"), (2, "")], "k int, t string")
    assert [r.x for r in df.select("k", text.repeats_word_ngram(F.col("t")).alias("x")).orderBy("k").collect()] == [True, False, False]
    one = spark.createDataFrame([("One two. Three four five six. Seven",)], "t string").select(text.sentences(F.col("t"), 3).alias("s")).first().s
    assert one == ["One two. Three four five six. Seven"]
