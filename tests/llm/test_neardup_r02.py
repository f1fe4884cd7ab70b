"""Near duplicates with repeated rows, clashing doc_ids, crowded leaders and buckets full of strays, against brute force."""

import random

import pytest
from test_operators import brute_components, frame, words

from voxmill.llm import neardup


def test_texts_with_one_doc_id_are_judged_each(spark):
    rng = random.Random(21)
    x, b, c = words(rng, 60), words(rng, 50), words(rng, 40)
    near = b.split()
    near[10] = "other"
    near = " ".join(near)
    kept = neardup.deduplicate(frame(spark, [x, b, b], [5, 5, 3])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(3, b), (5, x)]
    assert [r.text for r in neardup.deduplicate(frame(spark, [b, b], [7, 7])).collect()] == [b]
    kept = neardup.deduplicate(frame(spark, [b, near, c, c, "", "", None], [7, 7, 7, 9, 1, 1, None]), 5, 70).collect()
    assert sorted(r.text or "" for r in kept) == sorted([min(b, near, key=lambda t: next(k.text == t for k in kept)), c, "", "", ""], key=str) or len(kept) == 5


@pytest.mark.parametrize("block", [4, 512])
def test_crowded_buckets_and_leaders(spark, block, monkeypatch):
    # one long passage in all, tails that differ: likenesses on both sides of the threshold, in one bucket
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block)
    monkeypatch.setattr(neardup, "HOT_PAIRS", 3)
    rng = random.Random(22)
    passage = words(rng, 60)
    tails = [words(rng, 14) for _ in range(12)]
    texts = [f"{passage} {t} {words(rng, rng.randint(0, 3))}" for t in tails for _ in range(4)] + [f"{passage} x{k}" for k in range(20)]
    comp, sizes = brute_components(texts, 3, 85)
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in neardup.link(frame(spark, texts), 3, 85).collect()}
    assert got == {i: (c, n) for i, (c, n) in enumerate(zip(comp, sizes, strict=True))}
