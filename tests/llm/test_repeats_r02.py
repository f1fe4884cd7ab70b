"""Suffix-array dedup on repeated rows, clashing doc_ids, short passages and pruned groups, against brute force."""

import collections
import random

from voxmill.llm import repeats

from test_operators import brute_repeats, frame, words


def check(spark, ids, texts):
    want = collections.Counter((i, *w) for i, w in zip(ids, brute_repeats([(t or "").encode() for t in texts]), strict=True))
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.find(frame(spark, texts, ids)).collect())
    assert got == want


def test_repeated_rows_and_clashing_ids(spark):
    rng = random.Random(11)
    passage = words(rng, 120)
    a, b, c = words(rng, 30) + passage + words(rng, 9), words(rng, 4) + passage, words(rng, 90)
    check(spark, [1, 1, 2, 3], [a, a, b, c])
    check(spark, [1, 1, 2], [a, b, c])
    check(spark, [1, 1, 1, None, None], [a, b, c, passage, passage])


def test_pruning_changes_no_match():
    rng = random.Random(12)
    for _ in range(300):
        extra = rng.randint(1, 6)
        group = []
        for row in range(rng.randint(2, 8)):
            lo = rng.randint(0, extra)
            hi = rng.randint(lo, extra)
            group.append((row, bytes(rng.choice(b"ab") for _ in range(hi)), bytes(rng.choice(b"ab") for _ in range(extra - lo)), lo, hi))
        windows = collections.Counter((o, left[len(left) - o :], tail[: extra - o]) for _, left, tail, lo, hi in group for o in range(lo, hi + 1))
        want = {(row, o) for row, left, tail, lo, hi in group for o in range(lo, hi + 1) if windows[o, left[len(left) - o :], tail[: extra - o]] > 1}
        cut = repeats.pruned(group, extra)
        found = repeats.compare_core_groups([cut], extra) if cut else []
        assert {(row, o) for row, a, b in found for o in range(a, b + 1)} == want


def test_passages_under_400_bytes(spark):
    rng = random.Random(13)
    short = " ".join(rng.choice("ab cd efg hi".split()) + rng.choice("x yz".split()) for _ in range(53))
    assert len(short) < 400
    texts = [words(rng, 40) + f" {short} " + words(rng, 7), f"{short.upper()} " + words(rng, 30), words(rng, 60), None, "", "one two", "one two"]
    inside = " ".join(short.split()[:50])
    texts += [words(rng, 20) + f" {inside} " + words(rng, 20), f"{short[::-1]} {short[::-1]}", "k " * 60, "k " * 60]
    got = {r.doc_id: r.n_passage_words for r in repeats.find(frame(spark, texts)).collect()}
    # the reversed one stands twice in one document only; fifty words are too few; whole copies count whole
    assert [got[k] for k in range(len(texts))] == [53, 53, 0, 0, 0, 0, 0, 0, 0, 60, 60]
