"""Golden records, whitening and class-based scores against plain versions, and their odd rows."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmill.llm import survivorship, whitening

CLIENT = "client_id long, master_id long, source string, updated_at timestamp_ntz, name string, email string, city string, nation_id int, segment string, balance double"
CLASHING = "trust int, at string, cluster_id long, _salt int, latest string, first int, x array<long>, n long, word string, id long"


def clashing(df):
    return df.withColumns({f.split()[0]: F.lit(None).cast(f.split()[1]) for f in CLASHING.split(", ") if f.split()[0] not in df.columns})


def plain_golden(rows):
    def solid(s):
        return s if s is not None and s.strip(" \t\n\v\f\r") else None

    groups = {}
    for c, m, source, at, name, email, city, nation, segment, balance in rows:
        trust = {"crm": 4, "web": 3, "store": 2, "partner": 1}.get(source, 0)
        balance = balance if balance is not None and math.isfinite(balance) else None
        groups.setdefault(m if m is not None else c, []).append((c, trust, at, solid(name), solid(email), solid(city), nation, solid(segment), balance))
    out = {}
    for key, group in groups.items():
        latest = max((r[2] for r in group if r[2]), default=None)

        def stale(r, latest=latest):
            return latest is None or r[2] is None or latest - r[2] > dt.timedelta(hours=1440)

        def recent(r):
            return (r[2] is None, -(r[2] - dt.datetime(1970, 1, 1)).total_seconds() if r[2] else 0, -r[1], r[0] is None, r[0] or 0)

        def trusted(r, stale=stale):
            return (stale(r), -r[1], recent(r))

        def first(k, order, group=group):
            return min((r for r in group if r[k] is not None), key=lambda r: (order(r), r[k]), default=None)

        segment, email = first(7, recent), first(4, trusted)
        name = first(3, lambda r: (-len(r[3]), trusted(r)))
        chosen = segment[7] if segment else None
        balance = first(8, lambda r: (chosen is None or r[7] != chosen, recent(r)))
        address = min(group, key=lambda r: (-(r[5] is not None) - (r[6] is not None), recent(r), r[5] is None, r[5] or "", r[6] is None, r[6] or 0))
        cents = math.floor(100 * balance[8] + 0.5) if balance else None
        some = address[5] is not None or address[6] is not None
        out[key] = (len(group), sum(map(stale, group)), name and name[3], email and email[4], chosen, address[5], address[6], cents, name and name[0], email and email[0], segment and segment[0], balance and balance[0], address[0] if some else None)
    return out


@pytest.fixture(scope="module")
def client_rows():
    pick = random.Random(11)
    day = dt.datetime(2024, 3, 1)
    times = [None, day, day - dt.timedelta(hours=1440), day - dt.timedelta(hours=1440, microseconds=1), day - dt.timedelta(days=3), day - dt.timedelta(days=90)]
    rows = []
    for c in range(600):
        master = pick.choice([1, 1, 2, 3, None, *range(400, 420)])
        rows.append((pick.choice([c, c, c, None]), master, pick.choice(["crm", "web", "store", "partner", "other", "", None]), pick.choice(times), pick.choice(["Ann", "Bea", " ", "Ögür", "", None, "x" * 5000]), pick.choice(["a@b.c", "d@e.f", "\t", None]), pick.choice(["Rom", "", None]), pick.choice([1, 2, None]), pick.choice(["retail", "public", " ", None]), pick.choice([1.005, -2.675, float("nan"), float("inf"), None])))
    return [*rows, *rows[:80]]


def test_golden_records_are_those_of_a_plain_version(spark, client_rows):
    spark.createDataFrame(client_rows, CLIENT).repartition(5).createOrReplaceTempView("golden_clients")
    rows = survivorship.golden_records(clashing(spark.table("golden_clients"))).collect()
    want = plain_golden(client_rows)
    assert len(rows) == len(want)
    for r in rows:
        a = r.address.value
        some = a.city is not None or a.nation_id is not None
        cents = None if r.balance is None else math.floor(100 * r.balance.value + 0.5)

        def both(f):
            return (f.value, f.client) if f else (None, None)

        got = (r.n_records, r.n_stale, both(r.name)[0], both(r.email)[0], both(r.segment)[0], a.city, a.nation_id, cents, both(r.name)[1], both(r.email)[1], both(r.segment)[1], both(r.balance)[1], r.address.client if some else None)
        assert got == want[r.cluster_id], r.cluster_id


def test_golden_records_of_nothing(spark):
    assert survivorship.golden_records(spark.createDataFrame([], CLIENT)).count() == 0


def test_golden_records_deal_a_hot_cluster_and_broadcast_nothing(spark):
    plan = survivorship.golden_records(spark.createDataFrame([(1, 1, "crm", None, "a", None, None, None, None, None)], CLIENT))._jdf.queryExecution().toString()
    assert "Broadcast" not in plan and "SinglePartition" not in plan


def plain_whitened(vectors, count=16):
    """Vectors of good rows -> (n, exact deviations, covariance) in Python integers."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    fit = [list(t) for t in {tuple(v) for v in x}]
    n, d = len(fit), len(fit[0])
    s = [sum(v[i] for v in fit) for i in range(d)]
    y = [[n * v[i] - s[i] for i in range(d)] for v in fit]
    scatter = [[sum(a[i] * a[j] for a in y) for j in range(d)] for i in range(d)]
    return n, [sum((n * v[i] - s[i]) ** 2 for i in range(d)) for v in x], scatter, x, s


def test_whitening_is_that_of_exact_integers(spark):
    rng = np.random.default_rng(13)
    base = (rng.normal(size=(300, 20)) * np.linspace(0.2, 3, 20)).astype(np.float32)
    vectors = [*base.tolist(), *base[:40].tolist(), *[base[0].tolist()] * 100]
    bad = [None, [], [1.0, None] * 10, [float("nan")] * 20, [float("inf")] * 20, [3e38] * 20, [1.0] * 7]
    rows = [(i, v) for i, v in enumerate([*vectors, *bad])] + [(None, vectors[3])]
    got = whitening.whiten(clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))).collect()
    n, deviations, scatter, x, sums = plain_whitened([*vectors, vectors[3]])
    assert {r.n for r in got} == {n} and len(got) == len(vectors) + 1
    by_id = {r.vec_id: r for r in got}
    assert [int(by_id[i].deviation_exact) for i in range(len(vectors))] == deviations[:-1]
    v = np.array([[a / n**3 for a in row] for row in scatter])
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:16], q[:, ::-1][:, :16]
    white = np.array([by_id[i].whitened for i in range(len(vectors))])
    want = (np.array(x[:-1], float) - np.array(sums) / n) @ q / np.sqrt(e)
    assert np.allclose(np.abs(white), np.abs(want), atol=1e-6)
    assert np.allclose(got[0].explained, e / np.trace(v), rtol=1e-9) and got[0].identity_error < 1e-9


@pytest.mark.parametrize("size", [3, 40_000])
def test_residue_scatter_is_exact(spark, size):
    rng = np.random.default_rng(size)
    x = rng.integers(-(2**44), 2**44, size=(size, 3))
    fit = spark.createDataFrame([(r.tolist(),) for r in x], "x array<long>")
    n, sums, greatest = whitening.moments(fit)
    y = x.astype(object) * n - np.array(sums, object)
    assert n == size and sums == [int(s) for s in x.astype(object).sum(axis=0)] and greatest == np.abs(y).max()
    assert (whitening.scatter(fit, n, sums, greatest) == y.T @ y).all()


def test_whitening_without_variance_and_of_nothing(spark):
    shape = "vec_id long, embedding array<float>"
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], shape)).collect()
    assert [(r.n, r.deviation_exact, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, [None, None], None, None)] * 2
    flat = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0])], shape)).collect()
    assert [abs(r.whitened[0]) for r in flat] == [1.0, 1.0] and {r.whitened[1] for r in flat} == {None} and flat[0].explained == [1.0, 0.0]
    assert whitening.whiten(spark.createDataFrame([], shape)).count() == 0


def sentences(pick, vocabulary, n):
    return " ".join(pick.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def language_docs():
    pick = random.Random(12)
    one, two = ([f"{a}{k}" for k in range(60)] for a in ("Foo", "bar"))
    rows = [(i, sentences(pick, one if i % 2 else two, pick.randint(0, 80))) for i in range(160)]
    return [*rows, (900, None), (901, ""), (None, "foo1 null id"), (902, "\t \n"), (3, rows[3][1]), (903, "w" * 100_000 + " ünseen\x0bbar3"), (904, "Σ unseen two " * 3)]


def plain_counts(rows):
    import collections
    import zlib

    texts = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    seen = collections.Counter(w for (_, words), h in zip(texts, held, strict=True) if not h for w in words)
    return texts, held, seen


def test_scores_are_those_of_the_plain_class_model(spark, language_docs, monkeypatch):
    """Counts, base and the product of transitions and emissions, all by loops over tokens."""
    import collections

    from voxmill.llm import brown

    found = {}
    for name in ("exchanged", "transitions"):
        monkeypatch.setattr(brown, name, lambda *a, f=getattr(brown, name), name=name: found.setdefault(name, f(*a)))
    got = brown.score_documents(clashing(spark.createDataFrame(language_docs, "doc_id long, text string").repartition(3)), 4).collect()
    texts, held, seen = plain_counts(language_docs)
    total, kinds = sum(seen.values()), len(seen)
    classes, kept = found["exchanged"]
    assert kept == sorted(kept) and len(kept) > 1

    core = {w: i for i, (w, _) in enumerate(sorted(((w, c) for w, c in seen.items() if c >= brown.CORE_SEEN and 0 < len(w) <= brown.LONGEST), key=lambda x: (-x[1], x[0])))}
    unit = {w: brown.U if w == b"" else core.get(w, brown.ending(w)) for _, words in texts for w in words}
    n, per = collections.Counter(), collections.Counter()
    for w, c in seen.items():
        n[unit[w]] += c
        per[unit[w]] += 1
    units = [*range(len(core)), *range(brown.CORE, brown.U + 1)]
    mass = collections.Counter()
    for u in units:
        mass[classes[u]] += n[u] + 1
    paths = [[brown.CLASSES] * 2 + [int(classes[unit[w]]) for w in words] for _, words in texts]
    grams = [collections.Counter() for _ in range(3)]
    for p, h in zip(paths, held, strict=True):
        for i in range(2, len(p)):
            for k in range(3):
                grams[k][tuple(p[i - k : i + 1])] += not h
    grams = [collections.Counter({g: c for g, c in x.items() if c}) for x in grams]

    def chance(gram):
        if len(gram) == 1:
            return (grams[0][gram] + 1) / (total + brown.CLASSES + 1)
        after = [c for g, c in grams[len(gram) - 1].items() if g[:-1] == gram[:-1]]
        less = chance(gram[1:])
        return (grams[len(gram) - 1][gram] + len(after) * less) / (sum(after) + len(after)) if after else less

    want = collections.Counter()
    for (i, words), p in zip(texts, paths, strict=True):
        score = 0.0
        for k, w in enumerate(words):
            u = unit[w]
            said = 1.0 if u < brown.CORE or u == brown.U else (seen[w] or per[u] + 1) / (n[u] + per[u] + 1)
            score += math.log10(chance(tuple(p[k : k + 3]))) + math.log10((n[u] + 1) / mass[classes[u]]) + math.log10(said)
        base = sum(math.log10((seen[w] + 1) / (total + kinds + 1)) for w in words)
        want[i, len(words), sum(seen[w] > 0 for w in words), round(base, 6), round(score, 6)] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {total}
    assert [r.held_out for r in got] and {(r.doc_id, r.held_out) for r in got} == {(i, h) for (i, _), h in zip(texts, held, strict=True)}
    table = found["transitions"]
    assert np.allclose((10**table).sum(axis=-1), 1)


def test_moves_gain_what_the_likelihood_gains(spark):
    """The change of a move against the likelihood of the whole table before and after it."""
    from voxmill.llm import brown

    rng = np.random.default_rng(1)
    units = rng.integers(0, 40, 3000)
    units[::50] = brown.U
    pairs = np.stack([units[:-1], units[1:]])
    classes = np.full(brown.U + 1, brown.CLASSES)
    classes[: brown.U] = rng.integers(0, 6, brown.U)

    def table(classes):
        out = np.zeros((brown.CLASSES + 1,) * 2)
        np.add.at(out, (classes[pairs[0]], classes[pairs[1]]), 1.0)
        return out

    for u in (0, 7, 39):
        left, right = np.zeros(brown.CLASSES + 1), np.zeros(brown.CLASSES + 1)
        np.add.at(left, classes[pairs[0][(pairs[1] == u) & (pairs[0] != u)]], 1)
        np.add.at(right, classes[pairs[1][(pairs[0] == u) & (pairs[1] != u)]], 1)
        own = float(((pairs[0] == u) & (pairs[1] == u)).sum())
        gain = brown.gains(np.array([u]), left[None], right[None], np.array([own]), classes, table(classes))[0]
        for to in range(8):
            moved = classes.copy()
            moved[u] = to
            assert abs((brown.likelihood(table(moved)) - brown.likelihood(table(classes))) - (gain[to] - gain[classes[u]])) < 1e-6


def test_scores_of_nothing_and_without_training(spark):
    from voxmill.llm import brown

    shape = "doc_id long, text string"
    assert brown.score_documents(spark.createDataFrame([], shape)).count() == 0
    held = next(i for i in range(100) if brown.held_out(i))
    row = brown.score_documents(spark.createDataFrame([(held, "a b")], shape)).collect()[0]
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.held_out) == (3, 0, 0, 0.0, True) and row.score < 0


def test_neighbours_count_every_pair(spark):
    """Chunks of random texts: what stands before and behind each unit, and the class tables that follow."""
    import collections

    from voxmill.llm import brown
    from voxmill.llm.common import durable

    pick = random.Random(3)
    rows = [(i, sentences(pick, [f"w{k}" for k in range(30)], pick.randint(0, 30))) for i in range(80)]
    chunks = durable(spark.createDataFrame(rows, "doc_id long, text string").repartition(4).mapInArrow(brown.encode, brown.CHUNK), "test-chunks")
    core = {f"w{k}".encode(): k for k in range(12)}
    want = collections.Counter()
    for i, text in rows:
        units = [brown.U, *[core.get(w, brown.ending(w)) for w in text.encode().split()], brown.U]
        want.update([] if brown.held_out(i) else list(zip(units, units[1:], strict=False)))
    beside = brown.neighbours(chunks, spark.sparkContext.broadcast(core))
    got, back = collections.Counter(), collections.Counter()
    for r in beside.collect():
        for others, times, out, turn in ((r.others, r.times, got, 1), (r.before, r.before_times, back, -1)):
            for other, n in zip(np.frombuffer(others or b"", "<i4"), np.frombuffer(times or b"", "<i8"), strict=True):
                out[(r.unit, int(other))[::turn]] += int(n)
    assert got == want and back == want
    maps = [np.arange(brown.U + 1) % k for k in (3, 7)]
    for m, table in zip(maps, brown.class_tables(beside, maps), strict=True):
        whole = np.zeros_like(table)
        for (a, b), n in want.items():
            whole[m[a], m[b]] += n
        assert (whole == table).all()


def test_packed_numbers_come_back():
    from voxmill.llm import brown

    ids = np.array([0, 1, 255, 256, 70_000, 2**32 - 1], np.uint32)
    assert (brown.unpacked(brown.packed(ids)) == ids).all()


def test_classes_say_more_than_frequencies(spark):
    """Held-out documents of the given table."""
    from voxmill.llm import brown

    rows = [r for r in brown.op12_lm_scoring(spark, "/root/testdata/sf0.001").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 0.3 * sum(r.n_tokens for r in rows)
