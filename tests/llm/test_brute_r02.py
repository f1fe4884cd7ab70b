"""Operators without SQL against brute force or plain formulas, on hostile and empty input."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from test_operators import frame, words

from voxmill.llm import common, decontamination, language, packing, pii, secrets, toxicity


def plain(text):
    return re.sub(r"\s+", " ", text.lower())


def cheapest(item, text):
    """Least edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        k = rng.randrange(len(text))
        text[k : k + rng.randint(0, 1)] = rng.choice(["", "#", "~"])
    return "".join(text)


@pytest.mark.parametrize("block", [4_000_000, 300])
def test_decontamination(spark, block, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", block)
    rng = random.Random(31)
    items = [words(rng, rng.randint(3, 16)) for _ in range(8)] + ["a" * 40, "tiny", "", None]
    texts = [None, "", "a" * 300, "x" * 3000]
    for item in items[:9]:
        texts += [words(rng, rng.randint(0, 20)) + " " + edited(rng, item, n) + "\n\t" + words(rng, 3) for n in (0, 1, 2, 4, 7)]
    texts.append(items[0][: len(items[0]) // 2])
    want = {}
    for k, item in enumerate(items):
        m = len(plain((item or "").strip()))
        if m < 8:
            continue
        budget = max(0, min(int(0.1 * m), (m - 9) // 8))
        for i, t in enumerate(texts):
            if (n := cheapest(plain(item.strip()), plain(t or ""))) <= budget:
                want[i, k] = n
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontamination.search(frame(spark, texts), benchmark).collect()}
    assert got == want
    left = {r.doc_id for r in decontamination.decontaminate(frame(spark, texts), benchmark).collect()}
    assert left == set(range(len(texts))) - {i for i, _ in want}


def test_an_item_longer_than_the_text():
    item = words(random.Random(1), 30_000)
    index = decontamination.Index([(1, item)])
    assert decontamination.occurrences(["short " + item[5000:9000], item], index)[0][:3] == (1, 1, 0)


def test_language_by_the_formula(spark):
    rng = random.Random(32)
    grams = {"en": collections.Counter(language.trigrams("the cat and the dog went home " * 30)), "de": collections.Counter(language.trigrams("der hund und die katze gingen heim " * 30))}
    model = language.Model(grams)
    hosts = ["a.shop.co.uk", "b.shop.co.uk", "www.x.de", "10.0.0.9", ""]
    pages = []
    for k in range(60):
        host, text = rng.choice(hosts), rng.choice(["the cat and the dog", "der hund und die katze", "the katze", ""])
        pages.append((k, f"http://{host}/p" if host else None, f"<html lang='{rng.choice(['en', 'de', 'qq'])}'><p>{text}</p></html>" if k % 7 else None))
    x = [model.score(language.main_text(p[2] or "")) for p in pages]
    post = [np.exp(v - v.max()) / np.exp(v - v.max()).sum() for v in x]
    parts = [language.host_parts(p[1] or "") for p in pages]
    said = [re.search("lang='(..)'", p[2])[1] if p[2] else "" for p in pages]
    assert language.host_parts("http://a.shop.co.uk/")[1] == "shop.co.uk"
    total = sum(post) + 1
    prior = total / total.sum()
    got = {r.page_id: r for r in language.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()}
    for k in range(len(pages)):
        z = x[k].copy()
        for values in (said, [p[2] for p in parts]):
            if values[k]:
                own = sum((post[j] for j in range(len(pages)) if values[j] == values[k] and j != k), np.zeros(2))
                width = len({v for v in values if v}) + 1
                z += np.log((own + 0.5) / (total - post[k] + 0.5 * width))
        own = sum((post[j] for j in range(len(pages)) if parts[j][0] == parts[k][0] and j != k), np.zeros(2))
        dom = sum((post[j] for j in range(len(pages)) if parts[j][1] == parts[k][1] and j != k), np.zeros(2)) + 20 * prior
        z += np.log((own + 10 * dom / dom.sum()) / (own.sum() + 10))
        p = np.exp(z - z.max())
        assert got[k].probability == pytest.approx(p.max() / p.sum(), rel=1e-6)
        assert got[k].lang == model.langs[int(np.argmax(np.round(z, 9)))]


def test_secrets_base_spans(spark):
    rng = random.Random(33)
    hard = ["".join(rng.choice(["password", "API_KEY", "apikey", "token", "=", ": ", '"', "'", "abc123", "AKIA", "ABCDEFGH12345678", "0f" * rng.randint(1, 20), " ", "\n", "é😀"]) for _ in range(30)) for _ in range(200)] + [None, "", "0" * 100_000, "x" * 100_000, "token=" * 20_000]
    assign = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
    for r in secrets.scan_documents(frame(spark, hard)).collect():
        t = hard[r.doc_id] or ""
        want = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        want = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(want))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert r.n_found == (len(r.spans.split(",")) if r.spans else 0)


def test_toxicity_scores_by_the_grammar_alone(spark):
    # the machines run one after the other over each clause give what their product gives
    rng = random.Random(34)
    machines = [toxicity.latch("insult"), toxicity.latch("threat"), toxicity.latch("target"), toxicity.near("negation", 2), toxicity.latch("report")]
    for _ in range(2000):
        clause = [rng.choice(toxicity.CLASSES) for _ in range(rng.randint(0, 7))]
        state, alone = 0, [0] * len(machines)
        for c in clause:
            state = toxicity.GRAMMAR[state, c]
            alone = [m[s, c] for m, s in zip(machines, alone, strict=True)]
        assert toxicity.STATES[state] == tuple(alone)
    # held-out labels change nothing
    texts = [words(rng, 12) + (" grumpf you" if k % 4 == 0 else "") for k in range(300)]
    labels = [(k, int(k % 4 == 0)) for k in range(300)]
    schema = "doc_id long, toxic int"
    docs = frame(spark, texts)
    held = {r.doc_id for r in docs.where(toxicity.held_out(docs["doc_id"])).collect()}
    assert 40 < len(held) < 120
    flipped = [(k, 1 - v if k in held else v) for k, v in labels]
    one, two = ({r.doc_id: r.score for r in toxicity.score_documents(docs, spark.createDataFrame(x, schema)).collect()} for x in (labels, flipped))
    assert one == two
    assert all((one[k] >= 0.3) == (k % 4 == 0) for k in held)


def test_personal_data_and_secrets_beyond_the_base_patterns(spark):
    # identifiers that no base pattern has, in the places of those that one has
    rng = random.Random(35)
    phones = [f"call +49 30 {rng.randint(1000000, 9999999)} now" for _ in range(30)]
    planted = [f"call 030-{rng.randint(100000, 999999)}x now" for _ in range(40)]
    seeded = [f"call 030-{rng.randint(100000, 999999)}x now" for _ in range(6)]
    names = ("ann", "ben", "cat", "dan", "eva", "fin")
    mails = [f"write to {a}.{b}@example.org soon" for a in names for b in names]
    handles = [f"write to {n}-at-home soon" for n in ("ann", "ben", "gus", "hal")]
    texts = phones + planted + seeded + mails + handles + [words(rng, 30) for _ in range(30)]
    rows = {r.doc_id: r for r in pii.find(frame(spark, texts)).collect()}
    assert all(rows[k].n_found == 1 for k in range(30))
    # all identifiers behind the word of the phones, few or many
    assert all(rows[30 + k].n_context == 1 for k in range(len(planted + seeded)))
    # the handles stand behind a word that precedes e-mail addresses
    at = len(phones + planted + seeded + mails)
    assert sum(rows[at + k].n_context > 0 for k in range(4)) == 4
    assert not any(rows[k].n_found for k in range(len(texts) - 30, len(texts)))


def test_packing_many_short_documents():
    planned = packing.plan({1030: 1, 1019: 1000, 1: 1018})
    assert sum(b for b, _ in planned) == 501
    planned = packing.plan({683: 300, 682: 300, 684: 300})
    assert sum(b for b, _ in planned) <= 338
    assert sum(b for b, _ in packing.plan({1: 100_000, 2: 3})) == math.ceil(100_006 / 2048)


def test_scratch_is_shared_or_fails():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        common.scratch_root(Session())


def test_discarded_tables_are_gone(spark):
    import glob

    df = common.durable(spark.range(3).toDF("x"), "once")
    root = common.scratch_root(spark)
    assert df.count() == 3 and glob.glob(f"{root}/voxmill-once-*")
    common.discard(df, spark.range(1))
    assert not glob.glob(f"{root}/voxmill-once-*")
