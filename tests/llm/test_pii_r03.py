"""The bootstrap over pattern-instance graphs against plain loops; more identifiers, more found."""

import math
import random

import pytest
from test_operators import frame

from voxmill.llm import pii

EDGES = "pattern long, alone boolean, value long, n long, seed int, loose boolean"


def plain_fixed_point(edges, known):
    """(confident patterns, known values), a pattern at a time."""
    known, scores, patterns = set(known), {}, sorted({e[0] for e in edges})
    count = -1
    while True:
        confidence = {}
        for p in patterns:
            top = bottom = 0.0
            values = set()
            for q, alone, value, n, _, loose in edges:
                if q != p:
                    continue
                if value in known:
                    score = 1.0
                    values.add(value)
                elif loose:
                    score = 0.0
                elif alone:
                    continue
                else:
                    score = scores.get(value, 0.0)
                top, bottom = top + n * score, bottom + n
            if top > 0:
                confidence[p] = (top / (bottom + 1), len(values))
        good = {p for p, (c, k) in confidence.items() if c >= pii.CONFIDENT and k >= pii.SUPPORT}
        known |= {value for p, _, value, *_ in edges if p in good and value is not None}
        if len(known) == count:
            return good, known
        count = len(known)
        scores = {}
        for p, _, value, _, seed, loose in edges:
            if seed is None and not loose and p in confidence:
                scores[value] = scores.get(value, 0.0) + math.log(1 - confidence[p][0])
        scores = {v: 1 - math.exp(s) for v, s in scores.items()}


@pytest.mark.parametrize("seed", range(3))
def test_settled_graphs_are_those_of_plain_loops(spark, seed):
    pick = random.Random(seed)
    edges = []
    for p in range(30):
        alone, group = p % 2 == 0, pick.randint(0, 3)
        for value in pick.sample(range(group * 20, group * 20 + 40), pick.randint(3, 25)):
            edges.append((p, alone, value, pick.randint(1, 4), 1 if value % (5 + seed) < 3 else None, False))
        if alone and pick.random() < 0.5:
            edges.append((p, alone, None, pick.randint(1, 9), None, True))
    known = {e[2] for e in edges if e[4] is not None}
    good, found = pii.settled(spark.createDataFrame(edges, EDGES), spark.createDataFrame([(v,) for v in known], "value long"))
    want = plain_fixed_point(edges, known)
    assert ({r.pattern for r in good.collect()}, {r.value for r in found.collect()}) == want and len(want[1]) > len(known)


@pytest.mark.parametrize("n", [3, 300])
def test_more_identifiers_are_all_found(spark, n):
    pick = random.Random(n)
    texts = [f"reach me under +49 30 {pick.randint(1000000, 9999999)} today" for _ in range(12)] + [f"reach me under 030-{k:06d}x today" for k in range(n)]
    texts += [f"there are {k} apples and {k + 1} pears" for k in range(40)]
    rows = sorted(pii.find(frame(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert [r.n_context for r in rows] == [0] * 12 + [1] * n + [0] * 40


def test_words_that_stand_before_anything_find_nothing(spark):
    pick = random.Random(1)
    texts = [f"we saw the +49 30 {pick.randint(1000000, 9999999)} there" for _ in range(12)] + [f"we saw the {w} and the 17 there" for w in "dog cat cow pig hen fox bee ant elk yak".split()]
    assert sum(r.n_context for r in pii.find(frame(spark, texts)).collect()) == 0
